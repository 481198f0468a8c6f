"""Compositions: reports to pages to chunks to evidence, and pages to financial facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.common import materialise
from docquarry.functions import text as T
from docquarry.operators import chunking, evidence, financial, incremental, index, reports, retrieval
from docquarry.sources import readers, sinks


def corpus(spark: SparkSession, folder: str, done: DataFrame | None = None, size: int = 650, overlap: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages, chunks, errors) of the reports in a folder, those of ``done`` (report_id, file_hash) left out."""
    files = readers.discover_reports(spark, folder)
    todo = incremental.changed_or_new(files, done) if done is not None else files
    parsed = materialise(readers.parse_reports(todo))
    pages = parsed.where("error IS NULL").withColumn("page_key", F.xxhash64("report_id", "page_number"))
    return pages, chunking.chunk_reports(pages, size, overlap, report=["report_id"]), readers.parse_errors(parsed)


def evidence_from_chunks(chunks: DataFrame, ontology: list[dict], codebook: DataFrame, dims: int = 1024, dense_k: int = 30, keyword_k: int = 80, top_k: int = 5) -> DataFrame:
    """Calibrated evidence rows of every (company, year) and indicator.

    chunks: (chunk_id, company, year, source_file, page, text); codebook: (indicator_id, pillar, indicator_name).
    """
    spark = chunks.sparkSession
    groups = ("company", "year")
    queries = [(e["indicator_id"], " ".join(x for x in (str(e.get("name") or ""), *readers.expanded_terms(e)) if x)) for e in ontology]
    asked = spark.createDataFrame(queries, "query_id string, query string")
    keyword = retrieval.bm25_top_k(retrieval.build_index(chunks, groups=groups), retrieval.query_terms(asked), keyword_k, groups)
    vectors = T.embed_batch([q for _, q in queries], dims)
    embedded = chunks.select("chunk_id", *groups, T.hash_embed("text", dims).alias("embedding"))
    dense = retrieval.dense_top_k(embedded, [(i, v.tolist()) for (i, _), v in zip(queries, vectors)], dense_k, groups)
    merged = retrieval.merge_candidates(dense, keyword, ["query_id", *groups, "chunk_id"]).withColumnRenamed("query_id", "indicator_id")
    full = merged.join(chunks.select("chunk_id", "page", "source_file", "text"), "chunk_id")
    judged = materialise(evidence.evaluate_candidates(full, ontology))
    grid = chunks.select(*groups).distinct().crossJoin(F.broadcast(codebook.select("indicator_id", "pillar", "indicator_name")))
    return reports.calibrate_confidence(evidence.evidence_rows(grid, evidence.select_evidence(judged, top_k), evidence.funnel_counts(judged, top_k)))


def disclosure_index(evidence_rows: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(panel, pillars, index), written as tables where a folder is given."""
    panel = materialise(index.prepare_scores(evidence_rows))
    out = panel, index.pillar_breakdown(panel), index.firm_year_index(panel)
    if folder:
        for df, name in zip(out, ("indicator_panel", "pillar_breakdown", "index")):
            sinks.write_table(df, f"{folder}/{name}.parquet")
    return out


def financial_facts(spark: SparkSession, pages: DataFrame, indicators: DataFrame, scans: DataFrame | None = None, rules: tuple[list[tuple[str, str]], list[str]] = ((), ()), top_k: int = 8, warehouse_k: int = 40) -> tuple[DataFrame, DataFrame]:
    """(facts, validation): facts of every (firm, year) and indicator from the pages its statement group chose, with rows for
    what was not found, flags of failed rules and of implausible values. rules: pairs that must be at least each other, and
    indicators that must not be negative."""
    found = financial.detect_financial_pages(pages)
    if scans is not None:
        found = financial.merge_ocr_pages(found, scans).withColumn("page_key", F.coalesce("page_key", F.xxhash64("source_file", "page_number", "statement_type")))
    once = materialise(financial.first_per_key(found, ["source_file", "page_number"], F.struct("page_key")))
    book = [r.asDict() for r in indicators.orderBy("indicator_id").collect()]
    warehouse = materialise(financial.statement_warehouse(once, indicators, keyword_k=warehouse_k))
    facts = financial.warehouse_facts(once, warehouse, book, top_k)
    grid = financial.fact_grid(facts, pages.select(F.col("company").alias("firm"), "year").distinct(), book)
    grid = materialise(grid.withColumn("fact_id", F.xxhash64("firm", "report_year", "indicator_id")))
    validation = financial.validate_facts(grid.drop("year").withColumnRenamed("report_year", "year"), list(rules[0]), list(rules[1])) if any(rules) else spark.createDataFrame([], "firm string, year int, rule string, status string")
    flagged = financial.attach_flags(grid, validation)
    flags = financial.anomaly_flags(F.col("validation_flag"), F.col("value"), F.col("currency"), F.col("indicator_id"))
    return financial.coerce_facts(flagged.withColumn("validation_flag", flags)), validation


def plain_evidence(chunks: DataFrame, codebook: DataFrame, top_k: int = 5, prefetch: int = 20, dims: int = 1024) -> DataFrame:
    """(company, year, indicator_id, evidence, pages, chunk_ids, source_documents): the bundle of every cell from hybrid search
    with the codebook's query and keywords alone, without an ontology."""
    groups = ("company", "year")
    asked = codebook.select(F.col("indicator_id").alias("query_id"), T.join_parts(F.col("retrieval_query"), F.col("keywords_vi")).alias("query"))
    terms = retrieval.query_terms(asked)
    bm25 = retrieval.bm25_top_k(retrieval.build_index(chunks, groups=groups, terms=terms), terms, prefetch, groups)
    rows = asked.collect()  # indicators of a codebook
    embedded = chunks.select("chunk_id", *groups, T.hash_embed("text", dims).alias("embedding"))
    vectors = T.embed_batch([r["query"] for r in rows], dims)
    dense = retrieval.dense_top_k(embedded, [(r["query_id"], v.tolist()) for r, v in zip(rows, vectors)], prefetch, groups)
    best = retrieval.rerank(retrieval.fuse(bm25, dense, prefetch, groups), top_k, groups).withColumnRenamed("query_id", "indicator_id")
    full = best.join(chunks.select("chunk_id", "page", "source_file", "text"), "chunk_id")
    return evidence.evidence_bundles(full, ["company", "year", "indicator_id"])


def run(spark: SparkSession, reports_folder: str, out: str, ontology: list[dict], codebook: DataFrame, manifest: DataFrame | None = None) -> dict:
    """The whole job, stage by stage, with the manifest of stages and the seconds of each: reports to pages, chunks,
    evidence, index. Tables go under ``out``; the entry of the run is returned and written as its manifest."""
    timer = incremental.StageTimer()
    timer.start("Parsing")
    pages, chunks, errors = corpus(spark, reports_folder)
    sinks.write_reports({"pages.parquet": pages, "errors.parquet": errors}, out)
    timer.stop("Parsing")
    timer.start("Chunking")
    done = pages.groupBy("report_id").agg(F.max("file_hash").alias("file_hash"))
    chunks = materialise(chunks)
    sinks.write_table(chunks, f"{out}/chunks.parquet")
    timer.stop("Chunking")
    timer.start("Retrieval")
    passages = chunks.select("chunk_id", "company", "year", "source_file", F.col("page_number").alias("page"), F.col("chunk").alias("text"))
    rows = materialise(evidence_from_chunks(passages, ontology, codebook))
    sinks.write_table(rows, f"{out}/evidence.parquet")
    timer.stop("Retrieval")
    timer.start("Export")
    panel, _, _ = disclosure_index(rows, out)
    state = incremental.load_manifest(manifest) if manifest is not None else spark.createDataFrame([], "report_id string, file_hash string, parsed boolean, chunked boolean, embedded boolean, retrieved boolean, exported boolean")
    for stage in incremental.STAGES:
        state = incremental.mark_stage(state, done, stage)
    sinks.write_table(state, f"{out}/progress.parquet")
    timer.stop("Export")
    return sinks.write_run_manifest(f"{out}/run_manifest.json", {"reports": done.count(), "cells": panel.count(), "retrieval_time_seconds": timer.seconds["Retrieval"], "stage_seconds": timer.seconds})
