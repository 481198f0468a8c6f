"""Disclosure index: from indicator scores to pillar and firm-year indices.

Defined results: null companies and years are groups of their own (keys are compared null-safely), a missing label
counts nowhere, a missing or unreadable confidence is 0; of repeated rows for one key the best quality stays, ties are
broken by the remaining columns named in ``ties``; an empty panel gives empty indices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELS = ("HIGH_CONFIDENCE", "MEDIUM_CONFIDENCE", "LOW_CONFIDENCE")
INDICATOR_COLUMNS = [
    "company", "year", "indicator_id", "pillar", "indicator_name", "score", "confidence", "confidence_label", "disclosure_type", "evidence_quality_score", "retrieval_score", "rerank_score",
    "matched_keywords", "page_numbers", "reasoning",
]


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def best_per_key(df: DataFrame, keys: list[str], quality: str, ties: list[str] = ()) -> DataFrame:
    """One row per key: the highest quality, ties by ascending ``ties``. An aggregate with map-side combine, no sort."""
    order = F.struct(F.coalesce(F.col(quality).cast("double"), F.lit(float("-inf"))).alias("q"), *(_descending(df, c).alias(f"t{i}") for i, c in enumerate(ties)))
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r"))
    return kept.select(*keys, "__r.*").select(*df.columns)


def _descending(df: DataFrame, name: str) -> Column:
    """A numeric column whose maximum is the smallest value of the original, nulls last."""
    return F.coalesce(-F.col(name).cast("double"), F.lit(float("-inf")))


def prepare_scores(evidence: DataFrame, ties: list[str] = (), columns: list[str] = INDICATOR_COLUMNS) -> DataFrame:
    """Validated panel with one row per (company, year, indicator); a score outside 0..3 raises when it is read.

    Only ``columns`` of the panel are read and carried through the shuffle, the order of the choice beside them.
    """
    require_columns(evidence, ["company", "year", "indicator_id", "pillar", "score"])
    score = F.col("score").cast("int")
    checked = F.when(score.isin(0, 1, 2, 3), score).otherwise(F.raise_error(F.concat(F.lit("invalid score value: "), F.coalesce(F.col("score").cast("string"), F.lit("null")))).cast("int"))
    number = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in evidence.columns else F.lit(0.0)
    evidence = evidence.select(*[c for c in evidence.columns if c in {*columns, *ties, "company", "year", "indicator_id", "pillar", "score", "evidence_quality_score"}])
    panel = evidence.withColumns({"score": checked, "confidence": number("confidence"), "evidence_quality_score": number("evidence_quality_score")})
    panel = best_per_key(panel, ["company", "year", "indicator_id"], "evidence_quality_score", list(ties))
    return panel.select(*(F.col(c) if c in panel.columns else F.lit("").alias(c) for c in columns))


def _measures(panel: DataFrame) -> list[Column]:
    label = F.col("confidence_label") if "confidence_label" in panel.columns else F.lit(None).cast("string")
    return [
        F.sum("score").alias("raw"), F.countDistinct("indicator_id").alias("indicator_count"), F.sum((F.col("score") > 0).cast("int")).alias("disclosed_count"),
        *(F.sum(F.coalesce((label == x).cast("int"), F.lit(0))).alias(x.split("_")[0].lower() + "_confidence_count") for x in LABELS),
        F.avg(F.coalesce("confidence", F.lit(0.0)) if "confidence" in panel.columns else F.lit(0.0)).alias("avg"),
    ]


def pillar_breakdown(panel: DataFrame) -> DataFrame:
    """Scores, counts, index and disclosure rate per (company, year, pillar)."""
    out = panel.groupBy("company", "year", "pillar").agg(*_measures(panel)).withColumnRenamed("raw", "raw_score")
    most = F.col("indicator_count") * 3
    return out.select(
        "company", "year", "pillar", "raw_score", "indicator_count", "disclosed_count", "high_confidence_count", "medium_confidence_count", "low_confidence_count",
        F.bround("avg", 4).alias("avg_confidence"), most.alias("max_score"), F.bround(F.col("raw_score") / most * 100, 4).alias("pillar_index_0_100"),
        F.bround(F.col("disclosed_count") / F.col("indicator_count"), 4).alias("disclosure_rate"),
    )


#: The columns an index is computed from.
INDEX_COLUMNS = ["company", "year", "indicator_id", "pillar", "score", "confidence", "confidence_label"]


def firm_year_index(panel: DataFrame) -> DataFrame:
    """The index table per (company, year): equal-indicator and equal-pillar indices, counts, rates.

    One pass: rows are combined per indicator first (no further shuffle after ``prepare_scores``), then per firm-year,
    the pillars as conditional sums.
    """
    label = F.col("confidence_label") if "confidence_label" in panel.columns else F.lit(None).cast("string")
    sure = F.coalesce("confidence", F.lit(0.0)) if "confidence" in panel.columns else F.lit(0.0)
    names = [x.split("_")[0].lower() + "_confidence_count" for x in LABELS]
    cells = panel.groupBy("company", "year", "indicator_id", "pillar").agg(
        F.sum("score").alias("raw"), F.sum((F.col("score") > 0).cast("int")).alias("shown"), F.sum(sure).alias("sure"), F.count("*").alias("rows"),
        *(F.sum(F.coalesce((label == x).cast("int"), F.lit(0))).alias(n) for x, n in zip(LABELS, names)),
    )
    of = lambda p: F.col("pillar") == p
    out = cells.groupBy("company", "year").agg(
        F.sum("raw").alias("total_raw_score"), F.countDistinct("indicator_id").alias("indicator_count"), F.sum("shown").alias("disclosed_count"), (F.sum("sure") / F.sum("rows")).alias("avg"), *(F.sum(n).alias(n) for n in names),
        *(F.sum(F.when(of(p), F.col("raw"))).alias(f"raw_{p}") for p in "ESG"), *(F.count(F.when(of(p), F.col("indicator_id"))).alias(f"n_{p}") for p in "ESG"),
    )
    pillar = lambda p: F.coalesce(F.bround(F.col(f"raw_{p}") / F.nullif(F.col(f"n_{p}") * 3, F.lit(0)) * 100, 4), F.lit(0.0))
    out = out.withColumns({"environment_index": pillar("E"), "social_index": pillar("S"), "governance_index": pillar("G")})
    most = F.col("indicator_count") * 3
    pillars = (F.col("environment_index") + F.col("social_index") + F.col("governance_index")) / 3
    return out.select(
        "company", "year", F.bround(F.col("total_raw_score") / most * 100, 4).alias("index_equal_indicator"), F.bround(pillars, 4).alias("index_equal_pillar"), "environment_index", "social_index",
        "governance_index", "total_raw_score", most.alias("total_max_score"), "indicator_count", "disclosed_count", F.bround(F.col("disclosed_count") / F.col("indicator_count"), 4).alias("disclosure_rate"),
        F.bround("avg", 4).alias("avg_confidence"), *names,
    )


def legacy_scores(panel: DataFrame) -> DataFrame:
    """The short form: company, year, E, S, G and their mean."""
    return firm_year_index(panel).select(
        "company", "year", F.col("environment_index").alias("E"), F.col("social_index").alias("S"), F.col("governance_index").alias("G"), F.col("index_equal_pillar").alias("ESG")
    )


def import_scores(scores: DataFrame, codebook: DataFrame) -> DataFrame:
    """Returned scores with the pillar of the codebook; unknown indicators or values out of range raise when read."""
    require_columns(scores, ["company", "year", "indicator_id", "score", "confidence", "reasoning"])
    pillars = codebook.select("indicator_id", F.col("pillar").alias("__pillar")).distinct()
    out = scores.join(pillars, "indicator_id", "left")
    fail = lambda why, c: F.raise_error(F.concat(F.lit(why), F.coalesce(F.col(c).cast("string"), F.lit("null"))))
    pillar = F.when(F.col("__pillar").isNull(), fail("indicator not in the codebook: ", "indicator_id").cast("string")).otherwise(F.col("__pillar"))
    score = F.when(F.col("score").cast("int").isin(0, 1, 2, 3), F.col("score").cast("int")).otherwise(fail("invalid score: ", "score").cast("int"))
    sure = F.col("confidence").cast("double")
    sure = F.when(sure.between(0, 1), sure).otherwise(fail("confidence outside 0..1: ", "confidence").cast("double"))
    return out.select("company", "year", "indicator_id", pillar.alias("pillar"), score.alias("score"), sure.alias("confidence"), "reasoning")
