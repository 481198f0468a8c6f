"""Scanning runs, caches, whole jobs and small helpers."""

import time

import pytest
from pyspark.sql import functions as F

from docquarry.operators import caches, incremental, reports
from docquarry.plans import pipelines
from docquarry.sources import readers, scans, sinks


def test_pages_are_scanned_once_and_failures_are_recorded(spark, tmp_path):
    def engine(content: bytes, page: int) -> str:
        if page == 2:
            raise ValueError("broken page")
        if page == 3:
            time.sleep(30)
        return f"{content.decode()}  page {page}"

    reports_ = spark.createDataFrame([("h1", "a.pdf", bytearray(b"one")), ("h2", "b.pdf", bytearray(b""))], "file_hash string, source_file string, content binary")
    jobs = scans.page_jobs(reports_, lambda raw: 3 if raw else 1 / 0)
    assert sorted((r["file_hash"], r["page_number"]) for r in jobs.collect()) == [("h1", 1), ("h1", 2), ("h1", 3), ("h2", 1)]
    path = str(tmp_path / "scans")
    got = {(r["file_hash"], r["page_number"]): r for r in scans.resume_scans(spark, jobs, path, engine, timeout=2).collect()}
    assert got["h1", 1]["text"] == "one page 1" and got["h1", 2]["error"] == "ValueError: broken page" and "TimeoutError" in got["h1", 3]["error"]
    again = {(r["file_hash"], r["page_number"]): r for r in scans.resume_scans(spark, jobs, path, lambda c, p: "again", timeout=5).collect()}
    assert again["h1", 1]["text"] == "one page 1" and again["h1", 3]["text"] == "again" and len(again) == 4
    report = {r["file_hash"]: r for r in scans.scan_report(jobs, scans.read_scans(spark, path)).collect()}
    assert report["h1"]["status"] == "completed" and report["h1"]["pages_per_hour"] > 0
    scans.resume_scans(spark, jobs, path, lambda c, p: 1 / 0)  # nothing is left to scan
    assert spark.read.parquet(path).count() == 6


def test_rows_go_through_a_cache(spark, tmp_path):
    path, key, schema = str(tmp_path / "cache"), incremental.config_key({"top_k": 8}), "firm string, year int, value double"
    asked = []

    def compute(missing):
        asked.append(missing.count())
        return missing.select("firm", "year", F.lit(1.5).alias("value"))

    wanted = spark.createDataFrame([("a", 1), ("b", 1)], "firm string, year int")
    first = caches.through_cache(wanted, path, key, ["firm", "year"], compute, schema)
    assert {(r["firm"], r["cache_hit"]) for r in first.collect()} == {("a", False), ("b", False)}
    second = caches.through_cache(wanted.unionByName(spark.createDataFrame([("c", 2)], "firm string, year int")), path, key, ["firm", "year"], compute, schema)
    assert {(r["firm"], r["cache_hit"]) for r in second.collect()} == {("a", True), ("b", True), ("c", False)} and asked == [2, 1]
    assert caches.read_cache(spark, path, "other", schema).count() == 0 and caches.read_cache(spark, path + "x", key, schema).count() == 0


def test_names_of_older_caches(spark):
    df = spark.createDataFrame([("A_2020_E1.parquet", "A_B_2020"), ("A_2020_x.parquet", "A"), ("A_B_S1", "A_"), (None, None)], "name string, id string")
    company, year = caches.identity(F.col("id"))
    got = [tuple(r) for r in df.select(caches.is_indicator_cache(F.col("name")), company, year).collect()]
    assert got == [(True, "A_B", "2020"), (False, "A", ""), (False, "A", ""), (False, None, "")]
    hashes = caches.report_hashes(spark.createDataFrame([("r1", "f1"), ("r2", "f2")], "report_id string, file_hash string"), spark.createDataFrame([("r1", "m1")], "report_id string, file_hash string"))
    assert {tuple(r) for r in hashes.collect()} == {("r1", "m1"), ("r2", "f2")}


def test_manifests(spark):
    old = spark.createDataFrame([("r1", "h1", True), ("r2", None, None)], "report_id string, file_hash string, parsed boolean")
    state = incremental.load_manifest(old)
    assert {(r["report_id"], r["file_hash"], r["parsed"], r["exported"]) for r in state.collect()} == {("r1", "h1", True, False), ("r2", "", False, False)}
    marked = {r["report_id"]: r for r in incremental.mark_retrieved(state, spark.createDataFrame([("r1",), ("r1",)], "report_id string")).collect()}
    assert marked["r1"]["retrieved"] and marked["r1"]["parsed"] and not marked["r2"]["retrieved"]
    now = spark.createDataFrame([("r1", "h1"), ("r2", "h2"), ("r3", "h3")], "report_id string, file_hash string")
    stored = spark.createDataFrame([("r1", "h1")], "report_id string, file_hash string")
    assert {r["report_id"] for r in incremental.to_parse(now, state, stored).collect()} == {"r2", "r3"}


def test_run_figures(spark):
    order = reports.firm_years(spark.createDataFrame([("b", 2), ("a", 3), ("a", None), ("a", 3)], "company string, year int")).collect()
    assert [tuple(r) for r in order] == [("a", None), ("a", 3), ("b", 2)]
    memory = {r["stage"]: (r["peak_mb"], r["avg_mb"]) for r in reports.memory_model(spark, 1000, 100_000, 10).collect()}
    assert memory["Parsing"] == (80.0, 32.0) and memory["Retrieval"] == (566.0, 288.0) and memory["OCR"] == (768.0, 384.0) and len(memory) == 9
    runs = spark.createDataFrame([(1.0, True, True, False), (3.0, False, True, False)], "runtime_seconds double, reranker_used boolean, cache_hit boolean, warehouse_hit boolean")
    profile = {r["metric"]: r["value"] for r in reports.retrieval_profile(runs).collect()}
    assert profile["average_retrieval_time_seconds"] == 2 and profile["average_rerank_time_seconds"] == 1 and profile["cache_hit_rate_percent"] == 100
    assert reports.latest_runtime({}, [{"stage": "Retrieval", "runtime_seconds": "x"}, {"stage": "Retrieval", "runtime_seconds": "7"}]) == 7 and reports.latest_runtime({"retrieval_time_seconds": 2}, []) == 2


def test_sinks_and_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert sinks.write_jsonl(df, str(tmp_path / "l.json")) == 2
    paths = sinks.write_reports({"x": df, "y": df.limit(0)}, str(tmp_path / "r"), ".parquet")
    assert [spark.read.parquet(p).count() for p in paths] == [2, 0]
    store, manifest = str(tmp_path / "s.parquet"), str(tmp_path / "m.json")
    assert [sinks.write_if_changed(x, store, manifest, "id") for x in (df, df, df.withColumn("v", F.lit("new")))] == [True, False, True]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "f" / "b.txt").write_text("text")
    about = readers.file_metadata(spark, str(tmp_path / "f"))
    assert (about["files"], about["csv_rows"], about["chunks"]) == (2, 2, 50)
    (tmp_path / "fin.yaml").write_text("ASSETS:\n  label_vi: Tổng tài sản\n  statement_group: balance_sheet\n  aliases: total assets\n  normalization_rules: {convert_to_vnd: true}\nSTAFF: {}\n", encoding="utf-8")
    found = readers.read_financial_indicators(str(tmp_path / "fin.yaml"))
    assert found[0]["aliases"] == ["total assets"] and found[0]["convert_to_vnd"] and found[1]["statement_group"] == "general" and list(readers.by_group(found)) == ["balance_sheet", "general"]
    odd = spark.createDataFrame([("r", "h", "a.xyz", bytearray(b"text"))], "report_id string, file_hash string, source_file string, content binary")
    assert "unsupported" in readers.parse_reports(odd).first()["error"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("reports")
    (d / "ACME_2023.txt").write_text("Carbon emission was 120 tCO2e in 2023.\nBảng cân đối kế toán\nTổng cộng tài sản 1.234.567.890 VND", encoding="utf-8")
    (d / "BETA_2022.txt").write_text("The board met and approved the safety policy of the company.", encoding="utf-8")
    return d


def test_the_whole_job_and_its_command_line(spark, folder, tmp_path):
    from docquarry.__main__ import main

    (tmp_path / "book.csv").write_text("indicator_id,pillar,indicator_name_vi,retrieval_query\nE1,E,carbon emission,carbon emission reduction\n", encoding="utf-8")
    out = str(tmp_path / "out")
    assert main(["run", "--input-dir", str(folder), "--output", out, "--codebook", str(tmp_path / "book.csv"), "--ontology-dir", str(tmp_path)], spark) == 0
    rows = {r["company"]: r["score"] for r in spark.read.parquet(f"{out}/evidence.parquet").collect()}
    assert rows["ACME"] > 0 and rows["BETA"] == 0
    assert spark.read.parquet(f"{out}/progress.parquet").where("exported AND retrieved").count() == 2 and sinks.read_json(f"{out}/run_manifest.json")["reports"] == 2
    assert main(["query", "region_summary", "/root/testdata/sf0.001", "--output", f"{out}/q"], spark) == 0 and spark.read.parquet(f"{out}/q").count() > 0


def test_facts_and_plain_evidence_of_a_corpus(spark, folder):
    pages, chunks, _ = pipelines.corpus(spark, str(folder))
    indicators = spark.createDataFrame([("ASSETS", "Tổng cộng tài sản", "balance_sheet", ["tổng cộng tài sản"], ["total assets"], ["VND"], True)], "indicator_id string, label_vi string, statement_group string, aliases array<string>, retrieval_queries array<string>, unit_candidates array<string>, convert_to_vnd boolean")
    facts, validation = pipelines.financial_facts(spark, pages, indicators, rules=([], ["ASSETS"]))
    got = {r["firm"]: (r["value"], r["extraction_method"]) for r in facts.collect()}
    assert got == {"ACME": (1234567890.0, "table"), "BETA": (None, "none")} and {r["status"] for r in validation.collect()} == {"PASS", "SKIP"}
    book = spark.createDataFrame([("E1", "carbon emission", None)], "indicator_id string, retrieval_query string, keywords_vi string")
    passages = chunks.select("chunk_id", "company", "year", "source_file", F.col("page_number").alias("page"), F.col("chunk").alias("text"))
    bundles = {r["company"]: r["evidence"] for r in pipelines.plain_evidence(passages, book).collect()}
    assert "120 tCO2e" in bundles["ACME"]
