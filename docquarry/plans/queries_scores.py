"""Queries over score panels: index, diagnostics, agreement. The panel is derived from lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.common import table
from docquarry.operators import agreement, index, reports

TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax", "l_discount"]


def score_rows(spark: SparkSession, d: str) -> DataFrame:
    """Evidence rows: company, year, indicator and scores from the order lines."""
    k = F.col("l_partkey") % 50
    quality = F.col("l_extendedprice")
    label = F.when(F.col("l_discount") >= 0.07, "HIGH_CONFIDENCE").when(F.col("l_discount") >= 0.03, "MEDIUM_CONFIDENCE").otherwise("LOW_CONFIDENCE")
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("company"), F.year("l_shipdate").alias("year"), F.concat(F.lit("I"), k.cast("string")).alias("indicator_id"),
        F.when(k < 20, "E").when(k < 40, "S").otherwise("G").alias("pillar"), F.concat(F.lit("indicator "), k.cast("string")).alias("indicator_name"),
        (F.col("l_quantity").cast("int") % 4).alias("score"), (F.col("l_discount") * 3.14159).alias("confidence"), label.alias("confidence_label"), quality.alias("evidence_quality_score"),
        F.col("l_tax").alias("retrieval_score"), (quality / 1000).alias("rerank_score"), F.col("l_quantity").alias("keyword_score"), F.col("l_linenumber").alias("merged_candidate_count"),
        (F.col("l_linenumber") % 5).alias("after_relaxed_filter_count"), (F.col("l_linenumber") % 3).alias("after_strict_filter_count"), F.when(F.col("l_returnflag") == "R", "x").otherwise("").alias("matched_units"),
        F.when(F.col("l_linestatus") == "O", "y").alias("matched_hard_required"), *(F.col(c) for c in TIES),
    )


ROWS_SQL = """
rows AS (SELECT 'S' || l_suppkey AS company, CAST(year(l_shipdate) AS INTEGER) AS year, 'I' || (l_partkey % 50) AS indicator_id,
  CASE WHEN l_partkey % 50 < 20 THEN 'E' WHEN l_partkey % 50 < 40 THEN 'S' ELSE 'G' END AS pillar, 'indicator ' || (l_partkey % 50) AS indicator_name,
  CAST(trunc(l_quantity) AS INTEGER) % 4 AS score, l_discount * 3.14159 AS confidence,
  CASE WHEN l_discount >= 0.07 THEN 'HIGH_CONFIDENCE' WHEN l_discount >= 0.03 THEN 'MEDIUM_CONFIDENCE' ELSE 'LOW_CONFIDENCE' END AS confidence_label,
  l_extendedprice AS evidence_quality_score, l_tax AS retrieval_score, l_extendedprice / 1000 AS rerank_score, l_quantity AS keyword_score, l_linenumber AS merged_candidate_count,
  l_linenumber % 5 AS after_relaxed_filter_count, l_linenumber % 3 AS after_strict_filter_count, CASE WHEN l_returnflag = 'R' THEN 'x' ELSE '' END AS matched_units,
  CASE WHEN l_linestatus = 'O' THEN 'y' END AS matched_hard_required, l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax, l_discount FROM lineitem)"""
PANEL_SQL = (
    ROWS_SQL
    + """,
panel AS (SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY company, year, indicator_id
  ORDER BY evidence_quality_score DESC, l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax, l_discount) = 1)"""
)
_COUNTS = """CAST(sum(score) AS BIGINT) AS raw, CAST(count(DISTINCT indicator_id) AS BIGINT) AS indicator_count, CAST(sum(CASE WHEN score > 0 THEN 1 ELSE 0 END) AS BIGINT) AS disclosed_count,
  CAST(sum(CASE WHEN confidence_label = 'HIGH_CONFIDENCE' THEN 1 ELSE 0 END) AS BIGINT) AS high_confidence_count,
  CAST(sum(CASE WHEN confidence_label = 'MEDIUM_CONFIDENCE' THEN 1 ELSE 0 END) AS BIGINT) AS medium_confidence_count,
  CAST(sum(CASE WHEN confidence_label = 'LOW_CONFIDENCE' THEN 1 ELSE 0 END) AS BIGINT) AS low_confidence_count, round_even(avg(confidence), 4) AS avg_confidence"""
_PILLARS = f"""pillars AS (SELECT company, year, pillar, {_COUNTS} FROM panel GROUP BY ALL),
broken AS (SELECT company, year, pillar, raw AS raw_score, indicator_count, disclosed_count, high_confidence_count, medium_confidence_count, low_confidence_count, avg_confidence,
  indicator_count * 3 AS max_score, round_even(raw / (indicator_count * 3) * 100, 4) AS pillar_index_0_100, round_even(disclosed_count / indicator_count, 4) AS disclosure_rate FROM pillars)"""
_INDEX = f"""{_PILLARS}, wide AS (SELECT company, year, coalesce(avg(pillar_index_0_100) FILTER (pillar = 'E'), 0.0) AS environment_index,
  coalesce(avg(pillar_index_0_100) FILTER (pillar = 'S'), 0.0) AS social_index, coalesce(avg(pillar_index_0_100) FILTER (pillar = 'G'), 0.0) AS governance_index FROM broken GROUP BY company, year),
totals AS (SELECT company, year, {_COUNTS} FROM panel GROUP BY ALL),
idx AS (SELECT t.company, t.year, round_even(raw / (indicator_count * 3) * 100, 4) AS index_equal_indicator, round_even((environment_index + social_index + governance_index) / 3, 4) AS index_equal_pillar,
  environment_index, social_index, governance_index, raw AS total_raw_score, indicator_count * 3 AS total_max_score, indicator_count, disclosed_count,
  round_even(disclosed_count / indicator_count, 4) AS disclosure_rate, avg_confidence, high_confidence_count, medium_confidence_count, low_confidence_count
  FROM totals t JOIN wide w ON t.company = w.company AND t.year IS NOT DISTINCT FROM w.year)"""


def _panel(spark: SparkSession, d: str) -> DataFrame:
    rows = score_rows(spark, d).select("company", "year", "indicator_id", "pillar", "score", "confidence", "confidence_label", "evidence_quality_score", *TIES)
    return index.best_per_key(rows, ["company", "year", "indicator_id"], "evidence_quality_score", TIES)


def flagship_firm_year_index(spark, d):
    return index.firm_year_index(index.prepare_scores(score_rows(spark, d), TIES, index.INDEX_COLUMNS))


def pillar_breakdown(spark, d):
    return index.pillar_breakdown(index.prepare_scores(score_rows(spark, d), TIES, index.INDEX_COLUMNS))


def legacy_scores(spark, d):
    return index.legacy_scores(_panel(spark, d))


def prepared_scores(spark, d):
    return _panel(spark, d).select("company", "year", "indicator_id", "pillar", "score", "confidence_label", F.round("evidence_quality_score", 2).alias("evidence_quality_score"))


def imported_scores(spark, d):
    rows = score_rows(spark, d).select("company", "year", "indicator_id", "score", (F.col("l_discount") * 10 % 1).alias("confidence"), F.lit("none").alias("reasoning"))
    book = score_rows(spark, d).select("indicator_id", "pillar").distinct()
    return index.import_scores(rows, book).groupBy("pillar", "score").agg(F.count("*").alias("rows"), F.round(F.sum("confidence"), 4).alias("confidence"))


def union_scores(spark, d):
    """Two deliveries of scores put together by name, then distinct firm-years in order."""
    rows = score_rows(spark, d)
    first, second = rows.where("pillar = 'E'").select("company", "year"), rows.where("pillar <> 'E'").select("year", "company")
    return first.unionByName(second).distinct().orderBy("company", F.coalesce("year", F.lit(0)))


def score_distribution_indicator(spark, d):
    return reports.score_distribution_by_indicator(score_rows(spark, d))


def score_distribution_pillar(spark, d):
    return reports.score_distribution_by_pillar(score_rows(spark, d))


def confidence_by_indicator(spark, d):
    return reports.confidence_by_indicator(score_rows(spark, d))


def numeric_distribution(spark, d):
    return reports.distribution(score_rows(spark, d), "evidence_quality_score").unionByName(reports.distribution(table(spark, d, "events"), "value"))


def candidate_funnel_report(spark, d):
    return reports.candidate_funnel(score_rows(spark, d))


def false_negative_hotspots(spark, d):
    return reports.false_negative_hotspots(score_rows(spark, d))


def ontology_coverage(spark, d):
    return reports.ontology_coverage(score_rows(spark, d)).select("pillar", "indicator_id", "indicator_name", "rows", "matched_units_hit_rate", "matched_hard_required_hit_rate")


def review_sample(spark, d):
    return reports.review_sample(score_rows(spark, d), TIES).select("score", "confidence_label", "company", "year", "indicator_id", "l_orderkey", "l_linenumber")


def calibrated_confidence(spark, d):
    out = reports.calibrate_confidence(_panel(spark, d))
    return out.select("company", "year", "indicator_id", "score", "confidence", "confidence_label")


def _rated(spark, d):
    return agreement.raters(table(spark, d, "moderation_labels"), "doc_id", "rater", "unfit", ["unfit"])


def _order_ratings(spark, d):
    """Two ratings of every order line: quantity and discount classes."""
    return table(spark, d, "lineitem").select((F.col("l_quantity").cast("int") % 4).alias("left"), (F.round(F.col("l_discount") * 100).cast("int") % 4).alias("right"))


def agreement_metrics(spark, d):
    out = agreement.label_metrics(_order_ratings(spark, d))
    return out.select("label", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")), "support", *(F.round(c, 6).alias(c) for c in ("kappa", "alpha")))


def cohen_kappa(spark, d):
    return agreement.cohen_kappa(_order_ratings(spark, d)).select(F.round("kappa", 8).alias("kappa"))


def krippendorff_alpha(spark, d):
    return agreement.krippendorff_alpha(_order_ratings(spark, d)).select(F.round("alpha", 8).alias("alpha"))


def rater_agreement(spark, d):
    return agreement.crosstab(_rated(spark, d), [0, 1])


def external_correlation(spark, d):
    a = score_rows(spark, d).groupBy("company", "year").agg(F.avg("score").alias("s"))
    b = score_rows(spark, d).groupBy("company", "year").agg(F.avg("confidence").alias("s"))
    return agreement.correlation(a, b, ["company", "year"], F.col("s"), F.col("s")).select(F.round("correlation", 6).alias("correlation"), "n")


def runtime_shares(spark, d):
    return reports.runtime_shares(table(spark, d, "events"), "event_type", "value")


def throughput_per_hour(spark, d):
    e = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("s"))
    return e.select("event_type", F.round(reports.per_hour(F.col("n"), F.col("s")), 6).alias("per_hour"))


def cache_report(spark, d):
    return reports.cache_report(table(spark, d, "financial_facts"), "cache_hit", "warehouse_group")


def warehouse_search_reduction(spark, d):
    return reports.search_reduction(table(spark, d, "financial_facts"), "warehouse_group")


def robustness_grid(spark, d):
    return reports.robustness_grid(score_rows(spark, d), [3, 5, 10], ["v1", "v2"])


def ocr_run_report(spark, d):
    """Latest run per scanned report, its throughput and failure rate, recomputed from page counts."""
    o = table(spark, d, "ocr_results").where("report_path IS NOT NULL")
    order = F.struct("finished_at", "completed_pages", F.coalesce("error", F.lit("")))
    last = o.groupBy("report_path").agg(F.max_by(F.struct("total_pages", "completed_pages", "failed_pages", "runtime_seconds"), order).alias("r"), F.count("*").alias("runs"))
    rate = reports.per_hour(F.col("r.completed_pages"), F.col("r.runtime_seconds"))
    return last.select("report_path", "runs", F.round(rate, 3).alias("pages_per_hour"), F.round(F.coalesce(F.col("r.failed_pages") / F.nullif("r.total_pages", F.lit(0)), F.lit(0.0)), 6).alias("failure_rate"))


NAMES = [
    "flagship_firm_year_index", "pillar_breakdown", "legacy_scores", "prepared_scores", "imported_scores", "union_scores", "score_distribution_indicator", "score_distribution_pillar", "confidence_by_indicator",
    "numeric_distribution", "candidate_funnel_report", "false_negative_hotspots", "ontology_coverage", "review_sample", "calibrated_confidence", "agreement_metrics", "cohen_kappa", "krippendorff_alpha",
    "rater_agreement", "external_correlation", "runtime_shares", "throughput_per_hour", "cache_report", "warehouse_search_reduction", "robustness_grid", "ocr_run_report",
]
QUERIES = {n: globals()[n] for n in NAMES}

_KEYS = "pillar, indicator_id, indicator_name"
_DIST = """SELECT '{0}' AS metric, count(*) AS count, round_even(avg(coalesce({0}, 0)), 4) AS mean, round_even(quantile_cont(coalesce({0}, 0), 0.1), 4) AS p10, round_even(quantile_cont(coalesce({0}, 0), 0.25), 4) AS p25,
  round_even(quantile_cont(coalesce({0}, 0), 0.5), 4) AS p50, round_even(quantile_cont(coalesce({0}, 0), 0.75), 4) AS p75, round_even(quantile_cont(coalesce({0}, 0), 0.9), 4) AS p90, round_even(max(coalesce({0}, 0)), 4) AS max FROM {1}"""
_PAIRS = "pairs AS (SELECT CAST(trunc(l_quantity) AS INTEGER) % 4 AS a, CAST(round(l_discount * 100) AS INTEGER) % 4 AS b FROM lineitem)"
_KAPPA = "(SELECT (o - e) / (1 - e) FROM (SELECT (SELECT avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) FROM pairs) AS o, (SELECT sum(pa * pb) FROM (SELECT v, (SELECT avg(CASE WHEN a = v THEN 1.0 ELSE 0.0 END) FROM pairs) AS pa, (SELECT avg(CASE WHEN b = v THEN 1.0 ELSE 0.0 END) FROM pairs) AS pb FROM labels)) AS e))"
_ALPHA = "(SELECT 1 - o / e FROM (SELECT (SELECT avg(CASE WHEN a <> b THEN 1.0 ELSE 0.0 END) FROM pairs) AS o, 1 - (SELECT sum(s * s) FROM (SELECT count(*) / (SELECT 2.0 * count(*) FROM pairs) AS s FROM (SELECT a AS v FROM pairs UNION ALL SELECT b FROM pairs) GROUP BY v)) AS e))"
_LABELS = "labels AS (SELECT DISTINCT v FROM (SELECT a AS v FROM pairs UNION ALL SELECT b FROM pairs))"

ORACLES = {
    "flagship_firm_year_index": f"WITH {PANEL_SQL}, {_INDEX} SELECT * FROM idx",
    "pillar_breakdown": f"WITH {PANEL_SQL}, {_PILLARS} SELECT * FROM broken",
    "legacy_scores": f"WITH {PANEL_SQL}, {_INDEX} SELECT company, year, environment_index AS E, social_index AS S, governance_index AS G, index_equal_pillar AS ESG FROM idx",
    "prepared_scores": f"WITH {PANEL_SQL} SELECT company, year, indicator_id, pillar, score, confidence_label, round(evidence_quality_score, 2) AS evidence_quality_score FROM panel",
    "imported_scores": f"WITH {ROWS_SQL} SELECT pillar, score, count(*) AS rows, round(sum(l_discount * 10 % 1), 4) AS confidence FROM rows GROUP BY ALL",
    "union_scores": f"WITH {ROWS_SQL} SELECT DISTINCT company, year FROM rows",
    "score_distribution_indicator": f"""WITH {ROWS_SQL} SELECT {_KEYS}, count(company) FILTER (score = 0) AS score_0, count(company) FILTER (score = 1) AS score_1, count(company) FILTER (score = 2) AS score_2,
        count(company) FILTER (score = 3) AS score_3, count(company) AS total, round_even(count(company) FILTER (score > 0) / count(company), 4) AS positive_rate FROM rows GROUP BY {_KEYS}""",
    "score_distribution_pillar": f"WITH {ROWS_SQL} SELECT pillar, score, count(*) AS count FROM rows GROUP BY ALL",
    "confidence_by_indicator": f"""WITH {ROWS_SQL} SELECT {_KEYS}, count(*) FILTER (confidence_label = 'LOW_CONFIDENCE') AS low_confidence, count(*) FILTER (confidence_label = 'MEDIUM_CONFIDENCE') AS medium_confidence,
        count(*) FILTER (confidence_label = 'HIGH_CONFIDENCE') AS high_confidence, round_even(avg(confidence), 4) AS avg_confidence FROM rows GROUP BY {_KEYS}""",
    "numeric_distribution": f"WITH {ROWS_SQL} {_DIST.format('evidence_quality_score', 'rows')} UNION ALL {_DIST.format('value', 'events')}",
    "candidate_funnel_report": f"""WITH {ROWS_SQL} SELECT {_KEYS}, round_even(avg(merged_candidate_count), 3) AS merged_candidate_count, round_even(avg(after_relaxed_filter_count), 3) AS after_relaxed_filter_count,
        round_even(avg(after_strict_filter_count), 3) AS after_strict_filter_count FROM rows GROUP BY {_KEYS}""",
    "false_negative_hotspots": f"""WITH {ROWS_SQL} SELECT {_KEYS}, count(*) AS score0_count, round_even(avg(merged_candidate_count), 3) AS avg_merged_candidates, round_even(avg(after_relaxed_filter_count), 3) AS avg_relaxed_candidates,
        round_even(avg(after_strict_filter_count), 3) AS avg_strict_candidates, round_even(avg(retrieval_score), 3) AS avg_retrieval_score, round_even(avg(keyword_score), 3) AS avg_keyword_score FROM rows WHERE score = 0 GROUP BY {_KEYS}""",
    "ontology_coverage": f"""WITH {ROWS_SQL} SELECT {_KEYS}, count(*) AS rows, round_even(avg(CASE WHEN length(coalesce(matched_units, '')) > 0 THEN 1.0 ELSE 0.0 END), 4) AS matched_units_hit_rate,
        round_even(avg(CASE WHEN length(coalesce(matched_hard_required, '')) > 0 THEN 1.0 ELSE 0.0 END), 4) AS matched_hard_required_hit_rate FROM rows GROUP BY {_KEYS}""",
    "review_sample": f"""WITH {ROWS_SQL} SELECT score, confidence_label, company, year, indicator_id, l_orderkey, l_linenumber FROM rows
        QUALIFY row_number() OVER (PARTITION BY score, confidence_label ORDER BY evidence_quality_score DESC, l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax, l_discount) <= 25""",
    "calibrated_confidence": f"""WITH {PANEL_SQL}, ranked AS (SELECT *, (rank() OVER g + (count(*) OVER (PARTITION BY indicator_id, evidence_quality_score) - 1) / 2) / count(*) OVER (PARTITION BY indicator_id) AS own,
        (rank() OVER w + (count(*) OVER (PARTITION BY evidence_quality_score) - 1) / 2) / count(*) OVER () AS world, min(evidence_quality_score) OVER (PARTITION BY indicator_id) AS lo, max(evidence_quality_score) OVER (PARTITION BY indicator_id) AS hi
        FROM panel WINDOW g AS (PARTITION BY indicator_id ORDER BY evidence_quality_score), w AS (ORDER BY evidence_quality_score)), p AS (SELECT *, CASE WHEN hi > lo THEN own ELSE world END AS pct FROM ranked)
        SELECT company, year, indicator_id, score, CASE WHEN evidence_quality_score <= 0 OR score = 0 THEN 0.0 ELSE round_even(pct, 4) END AS confidence,
        CASE WHEN evidence_quality_score <= 0 OR score = 0 THEN 'LOW_CONFIDENCE' WHEN pct >= 0.8 THEN 'HIGH_CONFIDENCE' WHEN pct >= 0.4 THEN 'MEDIUM_CONFIDENCE' ELSE 'LOW_CONFIDENCE' END AS confidence_label FROM p""",
    "agreement_metrics": f"""WITH {_PAIRS}, {_LABELS}, per AS (SELECT v, count(*) FILTER (a = v AND b = v) AS tp, count(*) FILTER (a = v) AS support, count(*) FILTER (b = v) AS named FROM labels, pairs GROUP BY v),
        m AS (SELECT v, support, tp / greatest(named, 1) AS p, tp / greatest(support, 1) AS r FROM per), f AS (SELECT *, 2 * p * r / greatest(p + r, 1e-12) AS f1 FROM m)
        SELECT CAST(v AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support, CAST(NULL AS DOUBLE) AS kappa, CAST(NULL AS DOUBLE) AS alpha FROM f
        UNION ALL SELECT 'overall', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT), round({_KAPPA}, 6), round({_ALPHA}, 6) FROM f""",
    "cohen_kappa": f"WITH {_PAIRS}, {_LABELS} SELECT round({_KAPPA}, 8) AS kappa",
    "krippendorff_alpha": f"WITH {_PAIRS} SELECT round({_ALPHA}, 8) AS alpha",
    "rater_agreement": """WITH k AS (SELECT doc_id, unfit, row_number() OVER (PARTITION BY doc_id ORDER BY rater, unfit) AS n FROM moderation_labels),
        p AS (SELECT doc_id, max(unfit) FILTER (n = 1) AS a, max(unfit) FILTER (n = 2) AS b FROM k WHERE n <= 2 GROUP BY doc_id)
        SELECT v AS left, count(*) FILTER (b = 0) AS right_0, count(*) FILTER (b = 1) AS right_1 FROM (SELECT CAST(unnest([0, 1]) AS INTEGER) AS v) LEFT JOIN (SELECT * FROM p WHERE a IS NOT NULL AND b IS NOT NULL) ON a = v GROUP BY v""",
    "external_correlation": f"WITH {ROWS_SQL}, g AS (SELECT company, year, avg(score) AS a, avg(confidence) AS b FROM rows GROUP BY ALL) SELECT round(corr(a, b), 6) AS correlation, count(*) AS n FROM g",
    "runtime_shares": "SELECT event_type, round_even(sum(value), 4) AS seconds, round_even(sum(value) / sum(sum(value)) OVER (), 6) AS share FROM events GROUP BY event_type",
    "throughput_per_hour": "SELECT event_type, round(CASE WHEN sum(value) > 0 THEN count(*) / sum(value) * 3600 ELSE 0 END, 6) AS per_hour FROM events GROUP BY event_type",
    "cache_report": "SELECT warehouse_group, count(*) AS lookups, count(*) FILTER (cache_hit) AS hits, round_even(count(*) FILTER (cache_hit) / count(*) * 100, 4) AS hit_percent FROM financial_facts GROUP BY warehouse_group",
    "warehouse_search_reduction": """SELECT a AS searches_alone, b AS searches_grouped, round_even((a - b) / a * 100, 4) AS reduction_percent, round_even(r, 6) AS hit_rate FROM
        (SELECT (SELECT count(*) FROM (SELECT DISTINCT firm, year, indicator_id FROM financial_facts)) AS a, (SELECT count(*) FROM (SELECT DISTINCT firm, year, warehouse_group FROM financial_facts)) AS b,
        (SELECT avg(CASE WHEN warehouse_hit THEN 1.0 WHEN NOT warehouse_hit THEN 0.0 END) FROM financial_facts) AS r)""",
    "robustness_grid": f"""WITH {ROWS_SQL} SELECT CAST(k AS INTEGER) AS top_k, v AS prompt_version, (SELECT round_even(avg(score), 6) FROM rows) AS reference_mean, 'requires_explicit_rescore' AS status
        FROM (SELECT unnest([3, 5, 10]) AS k), (SELECT unnest(['v1', 'v2']) AS v)""",
    "ocr_run_report": """SELECT report_path, runs, round(CASE WHEN runtime_seconds > 0 THEN completed_pages / runtime_seconds * 3600 ELSE 0 END, 3) AS pages_per_hour, round(coalesce(failed_pages / nullif(total_pages, 0), 0), 6) AS failure_rate
        FROM (SELECT *, count(*) OVER (PARTITION BY report_path) AS runs FROM ocr_results WHERE report_path IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY report_path ORDER BY finished_at DESC NULLS LAST, completed_pages DESC NULLS LAST, coalesce(error, '') DESC) = 1)""",
}
