"""Queries of incremental processing, batches and caches."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.common import table
from docquarry.operators import incremental, retrieval
from docquarry.sources import sinks

TEMPLATE = "Batch {batch_id}\n\n{lines}\n"


def _snapshots(spark, d):
    """The documents as delivered now and as an earlier delivery had them: without forum posts, English texts upper-cased, some sources gone."""
    docs = table(spark, d, "documents")
    now = docs.where("source IS NULL OR source <> 'hop-thu-gop-y-01'").select(F.col("doc_id").alias("report_id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("file_hash"))
    text = F.when(F.col("lang") == "en", F.upper("text")).otherwise(F.col("text"))
    old = docs.where("doc_type <> 'forum'").select(F.col("doc_id").alias("report_id"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("file_hash"))
    return now, old


def change_detection(spark, d):
    return incremental.detect_changes(*_snapshots(spark, d))


def changed_reports(spark, d):
    return incremental.changed_or_new(*_snapshots(spark, d)).select("report_id")


def stage_manifest(spark, d):
    now, old = _snapshots(spark, d)
    first = incremental.mark_stage(old.limit(0), old, "parsed")
    return incremental.mark_stage(incremental.mark_stage(first, old, "chunked"), now, "parsed").select("report_id", "file_hash", "parsed", "chunked", "exported")


def incomplete_reports(spark, d):
    now, old = _snapshots(spark, d)
    return incremental.incomplete(now, incremental.mark_stage(old.limit(0), old, "parsed"), "parsed").select("report_id")


def scan_status(spark, d):
    p = table(spark, d, "financial_pages").where("page_number IS NOT NULL")
    jobs = p.select(F.col("source_file").alias("file_hash"), "page_number")
    done = p.where("statement_type IS NOT NULL").select(F.col("source_file").alias("file_hash"), "page_number", F.when(F.col("text").isNull() | (F.length("text") < 200), "failed").otherwise("completed").alias("status"), F.col("page_key").alias("seq"))
    return incremental.scan_status(jobs, done)


def cache_split(spark, d):
    hits, misses = retrieval.split_by_cache(table(spark, d, "customer"), table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])
    return hits.select("c_custkey", F.lit("hit").alias("state")).unionByName(misses.select("c_custkey", F.lit("miss").alias("state")))


def migration_report(spark, d):
    f = table(spark, d, "financial_facts")
    keys = ["firm", "indicator_id"]
    return incremental.migration_status(f, f.where("cache_hit"), f.where("extraction_method = 'table'"), keys)


def batch_slices(spark, d):
    out = sinks.with_batches(table(spark, d, "financial_facts").select("fact_id", "indicator_id"), ["fact_id"], 50)
    return out.select("fact_id", "batch_no", "place")


def batch_manifest(spark, d):
    out = sinks.with_batches(table(spark, d, "financial_facts").select("fact_id", "indicator_id"), ["fact_id"], 50)
    return sinks.batch_manifest(out, "indicator_id")


def batch_prompts(spark, d):
    rows = table(spark, d, "financial_facts").select("fact_id", "indicator_id", "indicator_name", "warehouse_group", "unit")
    out = sinks.with_batches(rows, ["fact_id"], 50)
    line = sinks.prompt_lines(F.col("indicator_id"), F.col("indicator_name"), [("Group", F.col("warehouse_group")), ("Unit", F.col("unit"))])
    return sinks.render_prompts(out, line, TEMPLATE).select("batch_no", F.md5(F.col("prompt").cast("binary")).alias("digest"))


def event_windows(spark, d):
    from docquarry.streaming.pages import window_counts

    return window_counts(table(spark, d, "events")).select("window_start", "event_type", "n", F.round("total", 4).alias("total"))


def first_deliveries(spark, d):
    """Each page content once, the earliest delivery: the batch form of the streaming deduplication."""
    p = table(spark, d, "financial_pages")
    key = F.sha2(F.concat_ws("\u0001", F.coalesce("source_file", F.lit("")), F.coalesce(F.col("page_number").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))), 256)
    return p.groupBy(key.alias("content_hash")).agg(F.min_by("page_key", F.struct("ingested_at", "page_key")).alias("page_key"), F.count("*").alias("deliveries"))


def region_summary(spark, d):
    """A star join over the order tables: everything Catalyst plans by itself, as a check of the session."""
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


NAMES = [
    "change_detection", "changed_reports", "stage_manifest", "incomplete_reports", "scan_status", "cache_split", "migration_report", "batch_slices", "batch_manifest", "batch_prompts", "event_windows", "first_deliveries", "region_summary",
]
QUERIES = {n: globals()[n] for n in NAMES}

_SNAP = """now AS (SELECT doc_id AS report_id, md5(coalesce(text, '')) AS h FROM documents WHERE source IS NULL OR source <> 'hop-thu-gop-y-01'),
old AS (SELECT doc_id AS report_id, md5(coalesce(CASE WHEN lang = 'en' THEN upper(text) ELSE text END, '')) AS h FROM documents WHERE doc_type <> 'forum')"""
_BATCH = "b AS (SELECT *, row_number() OVER (ORDER BY fact_id) - 1 AS pos FROM financial_facts)"

ORACLES = {
    "change_detection": f"""WITH {_SNAP} SELECT coalesce(n.report_id, o.report_id) AS report_id, CASE WHEN n.report_id IS NULL THEN 'removed' WHEN o.report_id IS NULL THEN 'new' WHEN n.h = o.h THEN 'unchanged' ELSE 'changed' END AS status
        FROM now n FULL JOIN old o ON n.report_id = o.report_id""",
    "changed_reports": f"WITH {_SNAP} SELECT report_id FROM now n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.report_id = n.report_id AND o.h = n.h)",
    "stage_manifest": f"""WITH {_SNAP} SELECT coalesce(n.report_id, o.report_id) AS report_id, coalesce(n.h, o.h) AS file_hash, true AS parsed, o.report_id IS NOT NULL AND (n.h IS NULL OR n.h = o.h) AS chunked, false AS exported
        FROM now n FULL JOIN old o ON n.report_id = o.report_id""",
    "incomplete_reports": f"WITH {_SNAP} SELECT report_id FROM now n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.report_id = n.report_id AND o.h = n.h)",
    "scan_status": """WITH last AS (SELECT source_file, page_number, arg_max(CASE WHEN text IS NULL OR length(text) < 200 THEN 'failed' ELSE 'completed' END, page_key) AS s FROM financial_pages WHERE page_number IS NOT NULL AND statement_type IS NOT NULL GROUP BY ALL),
        j AS (SELECT DISTINCT source_file, page_number FROM financial_pages WHERE page_number IS NOT NULL), g AS (SELECT source_file AS file_hash, count(*) AS total_pages, count(*) FILTER (s = 'completed') AS completed_pages, count(*) FILTER (s = 'failed') AS failed_pages
        FROM j LEFT JOIN last USING (source_file, page_number) GROUP BY source_file) SELECT *, round_even(failed_pages / total_pages, 6) AS failure_rate, CASE WHEN completed_pages = total_pages THEN 'completed' WHEN failed_pages = total_pages THEN 'failed' WHEN completed_pages + failed_pages > 0 THEN 'partial' ELSE 'running' END AS status FROM g""",
    "cache_split": "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'hit' ELSE 'miss' END AS state FROM customer",
    "migration_report": """WITH w AS (SELECT DISTINCT firm, indicator_id FROM financial_facts), e AS (SELECT DISTINCT firm, indicator_id FROM financial_facts WHERE cache_hit), l AS (SELECT firm, indicator_id, count(DISTINCT evidence) AS n FROM financial_facts WHERE extraction_method = 'table' AND evidence <> '' GROUP BY ALL)
        SELECT w.firm, w.indicator_id, CASE WHEN e.firm IS NOT NULL THEN 'exists' WHEN n > 0 THEN 'migrated' ELSE 'missing_legacy_cache' END AS status, CASE WHEN e.firm IS NULL AND n > 0 THEN n ELSE 0 END AS chunks FROM w LEFT JOIN e USING (firm, indicator_id) LEFT JOIN l USING (firm, indicator_id)""",
    "batch_slices": f"WITH {_BATCH} SELECT fact_id, pos // 50 + 1 AS batch_no, pos % 50 + 1 AS place FROM b",
    "batch_manifest": f"WITH {_BATCH} SELECT pos // 50 + 1 AS batch_no, count(*) AS record_count, arg_min(indicator_id, pos) AS first, arg_max(indicator_id, pos) AS last FROM b GROUP BY batch_no",
    "batch_prompts": f"""WITH {_BATCH}, g AS (SELECT pos // 50 + 1 AS batch_no, string_agg('- ' || indicator_id || ' | ' || coalesce(indicator_name, '') || chr(10) || '  Group: ' || coalesce(warehouse_group, '') || chr(10) || '  Unit: ' || coalesce(unit, ''), chr(10) ORDER BY pos) AS lines FROM b GROUP BY batch_no)
        SELECT batch_no, md5('Batch batch_' || lpad(CAST(batch_no AS VARCHAR), 3, '0') || chr(10) || chr(10) || lines || chr(10)) AS digest FROM g""",
    "event_windows": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "first_deliveries": "SELECT sha256(concat_ws(chr(1), coalesce(source_file, ''), coalesce(CAST(page_number AS VARCHAR), ''), coalesce(text, ''))) AS content_hash, arg_min(page_key, struct_pack(a := ingested_at, b := page_key)) AS page_key, count(*) AS deliveries FROM financial_pages GROUP BY ALL",
    "region_summary": """SELECT r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
}
