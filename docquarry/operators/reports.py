"""Diagnostics over evidence rows: distributions, funnels, coverage, review samples, run metrics.

Defined results: null keys are groups of their own where the table says so; missing figures count as 0 in numeric
distributions; an empty input gives an empty report (a distribution gives one row of zeros and nulls).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.common import materialise
from docquarry.operators.ordering import prefix_sums, within

KEYS = ["pillar", "indicator_id", "indicator_name"]
FUNNEL = ["dense_candidate_count", "keyword_candidate_count", "merged_candidate_count", "after_relaxed_filter_count", "after_strict_filter_count", "final_candidate_count"]
MATCHES = ["matched_hard_required", "matched_soft_positive", "matched_qualitative_patterns", "matched_quantitative_patterns", "matched_units", "matched_negative_keywords"]


def score_distribution_by_indicator(evidence: DataFrame) -> DataFrame:
    """Rows per score 0..3, total and share above 0, of every indicator; rows without a company do not count."""
    out = evidence.groupBy(*KEYS).agg(*(F.count(F.when(F.col("score") == k, F.col("company"))).alias(f"score_{k}") for k in range(4)))
    total = F.col("score_0") + F.col("score_1") + F.col("score_2") + F.col("score_3")
    return out.withColumn("total", total).withColumn("positive_rate", F.bround(F.coalesce((F.col("total") - F.col("score_0")) / F.nullif("total", F.lit(0)), F.lit(0.0)), 4))


def confidence_by_indicator(evidence: DataFrame) -> DataFrame:
    """Rows per confidence label and mean confidence of every indicator, in one aggregate."""
    labels = ("LOW_CONFIDENCE", "MEDIUM_CONFIDENCE", "HIGH_CONFIDENCE")
    return evidence.groupBy(*KEYS).agg(*(F.count_if(F.col("confidence_label") == x).alias(x.lower()) for x in labels), F.bround(F.avg("confidence"), 4).alias("avg_confidence"))


def score_distribution_by_pillar(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy("pillar", "score").agg(F.count("*").alias("count"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, five exact percentiles with linear interpolation, and maximum of one column; nulls count as 0."""
    v = F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))
    out = df.agg(F.count("*").alias("count"), F.avg(v).alias("mean"), F.percentile(v, F.array(*map(F.lit, (0.1, 0.25, 0.5, 0.75, 0.9)))).alias("p"), F.max(v).alias("max"))
    names = ("p10", "p25", "p50", "p75", "p90")
    return out.select(F.lit(column).alias("metric"), "count", F.bround("mean", 4).alias("mean"), *(F.bround(F.col("p")[i], 4).alias(n) for i, n in enumerate(names)), F.bround("max", 4).alias("max"))


def candidate_funnel(evidence: DataFrame) -> DataFrame:
    have = [c for c in FUNNEL if c in evidence.columns]
    return evidence.groupBy(*KEYS).agg(*(F.bround(F.avg(c), 3).alias(c) for c in have))


def false_negative_hotspots(evidence: DataFrame) -> DataFrame:
    """Indicators by how often they score 0, with the candidates they had."""
    zero = evidence.where("score = 0")
    mean = lambda c, n: F.bround(F.avg(c) if c in evidence.columns else F.lit(0.0), 3).alias(n)
    out = zero.groupBy(*KEYS).agg(
        F.count("*").alias("score0_count"), mean("merged_candidate_count", "avg_merged_candidates"), mean("after_relaxed_filter_count", "avg_relaxed_candidates"),
        mean("after_strict_filter_count", "avg_strict_candidates"), mean("retrieval_score", "avg_retrieval_score"), mean("keyword_score", "avg_keyword_score"),
    )
    return out.orderBy(F.desc("score0_count"), F.asc("avg_relaxed_candidates"), *KEYS)


def ontology_coverage(evidence: DataFrame) -> DataFrame:
    """Share of rows with a match, by kind of match."""
    rate = lambda c: F.bround(F.avg((F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) > 0).cast("double")), 4) if c in evidence.columns else F.lit(0.0)
    return evidence.groupBy(*KEYS).agg(F.count("*").alias("rows"), *(rate(c).alias(f"{c}_hit_rate") for c in MATCHES))


def head_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of every group in a total order; rank filters are pushed below the shuffle by the planner."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def review_sample(evidence: DataFrame, ties: list[str], per_bucket: int = 25) -> DataFrame:
    return head_per_group(evidence, ["score", "confidence_label"], [F.desc("evidence_quality_score"), *ties], per_bucket)


def percentile_rank(df: DataFrame, value: str, group: str, out: str = "percentile") -> DataFrame:
    """Average-rank percentile of a value within its group; in groups of one distinct value that among all rows.

    Ranks come from counts per distinct value, so ties of any number are one row, and from running sums over ranges of
    the order, so neither a group nor the whole is ever sorted in one task.
    """
    base = df.withColumn("__v", F.coalesce(F.col(value).try_cast("double"), F.lit(0.0)))
    counts = materialise(base.groupBy(F.col(group).alias("__g"), F.col("__v").alias("__gv")).agg(F.count("*").alias("__n")))
    own = within(prefix_sums(counts, ["__g", "__gv"], "__n", "__sum"), ["__g"], "__sum", "__below")
    sizes = counts.groupBy(F.col("__g").alias("__h")).agg(F.sum("__n").alias("__all"), F.count("*").alias("__distinct"))
    own = own.join(sizes, F.col("__g").eqNullSafe(F.col("__h"))).select("__g", "__gv", ((F.col("__below") + (F.col("__n") + 1) / 2) / F.col("__all")).alias("__own"), "__distinct")
    every = prefix_sums(counts.groupBy(F.col("__gv").alias("__w")).agg(F.sum("__n").alias("__m")), ["__w"], "__m", "__before")
    total = every.agg(F.sum("__m").alias("__total"))
    world = every.crossJoin(F.broadcast(total)).select("__w", ((F.col("__before") + (F.col("__m") + 1) / 2) / F.col("__total")).alias("__world"))
    out_ = base.join(own, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__v") == F.col("__gv"))).join(world, F.col("__v") == F.col("__w"))
    return out_.withColumn(out, F.when(F.col("__distinct") > 1, F.col("__own")).otherwise(F.col("__world"))).drop("__g", "__gv", "__w", "__own", "__world", "__distinct", "__v")


def calibrate_confidence(evidence: DataFrame) -> DataFrame:
    """Confidence as percentile of evidence quality within the indicator, and its label; 0 without quality or score."""
    ranked = percentile_rank(evidence.drop("confidence", "confidence_label"), "evidence_quality_score", "indicator_id", "__pct")
    none = (F.coalesce(F.col("evidence_quality_score").try_cast("double"), F.lit(0.0)) <= 0) | (F.col("score") == 0)
    label = F.when(none, "LOW_CONFIDENCE").when(F.col("__pct") >= 0.8, "HIGH_CONFIDENCE").when(F.col("__pct") >= 0.4, "MEDIUM_CONFIDENCE").otherwise("LOW_CONFIDENCE")
    return ranked.withColumns({"confidence": F.when(none, 0.0).otherwise(F.bround("__pct", 4)), "confidence_label": label}).drop("__pct")


def runtime_shares(stages: DataFrame, stage: str = "stage", seconds: str = "seconds") -> DataFrame:
    """Seconds per stage and their share of all seconds (0 if there are none)."""
    out = stages.groupBy(stage).agg(F.sum(seconds).alias("seconds"))
    total = F.sum("seconds").over(Window.partitionBy())  # one row per stage: a fixed, small number
    return out.select(stage, F.bround("seconds", 4).alias("seconds"), F.bround(F.coalesce(F.col("seconds") / F.nullif(total, F.lit(0.0)), F.lit(0.0)), 6).alias("share"))


def per_hour(count: Column, seconds: Column) -> Column:
    """Throughput per hour; 0 where no time passed."""
    return F.when(seconds > 0, count / seconds * 3600).otherwise(F.lit(0.0))


def cache_report(lookups: DataFrame, hit: str = "hit", by: str = "kind") -> DataFrame:
    """Lookups, hits and hit percentage by kind."""
    out = lookups.groupBy(by).agg(F.count("*").alias("lookups"), F.count_if(F.col(hit)).alias("hits"))
    return out.withColumn("hit_percent", F.bround(F.col("hits") / F.col("lookups") * 100, 4))


def search_reduction(facts: DataFrame, group: str, firm: str = "firm", year: str = "year", indicator: str = "indicator_id", hit: str = "warehouse_hit") -> DataFrame:
    """Searches if every indicator were searched alone, searches with one per group, their ratio, and the hit rate."""
    out = facts.agg(
        F.countDistinct(F.struct(firm, year, indicator)).alias("searches_alone"), F.countDistinct(F.struct(firm, year, group)).alias("searches_grouped"), F.avg(F.col(hit).cast("double")).alias("rate")
    )
    less = F.coalesce((F.col("searches_alone") - F.col("searches_grouped")) / F.nullif("searches_alone", F.lit(0)), F.lit(0.0))
    return out.select("searches_alone", "searches_grouped", F.bround(less * 100, 4).alias("reduction_percent"), F.bround(F.coalesce("rate", F.lit(0.0)), 6).alias("hit_rate"))


def estimated_seconds(counts: dict[str, float], cost: dict[str, float], floor: float = 0.0) -> dict[str, float]:
    """Fallback model of stage times: count times unit cost, at least the floor."""
    return {k: max(counts.get(k, 0) * c, floor) for k, c in cost.items()}


def robustness_grid(scores: DataFrame, top_ks: list[int], prompt_versions: list[str]) -> DataFrame:
    """One row per setting with the mean reference score; nothing is rescored."""
    spark = scores.sparkSession
    grid = spark.createDataFrame([(k, v) for k in top_ks for v in prompt_versions], "top_k int, prompt_version string")
    mean = scores.agg(F.avg(F.col("score").cast("double")).alias("m"))
    return grid.crossJoin(F.broadcast(mean)).select("top_k", "prompt_version", F.bround("m", 6).alias("reference_mean"), F.lit("requires_explicit_rescore").alias("status"))


def firm_years(rows: DataFrame, company: str = "company", year: str = "year") -> DataFrame:
    """Distinct firm-years in order; an unknown year sorts as 0 and stays null."""
    return rows.select(company, year).distinct().orderBy(F.asc(company), F.coalesce(F.col(year), F.lit(0)).asc())


#: Peak and mean memory of stages that do not depend on the input, in MB.
FIXED_MEMORY = {"OCR": (768.0, 384.0), "Reranking": (2048.0, 1024.0), "Export": (128.0, 64.0), "Batch Generation": (128.0, 64.0)}
#: MB of text of a chunk; the factors of ``memory_model`` are fixed values too.
TEXT_MB_PER_CHUNK = 0.003


def memory_model(spark, raw_mb: float, chunks: int, embedding_mb: float) -> DataFrame:
    """(stage, peak_mb, avg_mb): estimated memory per stage from sizes of inputs; nothing is measured."""
    text, vectors = max(chunks * TEXT_MB_PER_CHUNK, 1.0), max(embedding_mb, 1.0)
    sized = {
        "Parsing": (max(raw_mb * 0.08, 64.0), max(raw_mb * 0.03, 32.0)), "Chunking": (2 * text, text), "Embedding": (2.5 * vectors + 128, 1.4 * vectors + 64), "Vector Store Build": (2 * vectors + 128, 1.2 * vectors + 64),
        "Retrieval": (text + vectors + 256, 0.5 * text + vectors + 128),
    }
    return spark.createDataFrame([(k, round(float(p), 2), round(float(a), 2)) for k, (p, a) in (sized | FIXED_MEMORY).items()], "stage string, peak_mb double, avg_mb double")


def retrieval_profile(runs: DataFrame) -> DataFrame:
    """(metric, value) of retrieval runs (runtime_seconds, reranker_used, cache_hit, warehouse_hit); 0 without runs."""
    mean = lambda c: F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0))
    r = runs.agg(mean("runtime_seconds").alias("s"), mean("reranker_used").alias("r"), mean("cache_hit").alias("c"), mean("warehouse_hit").alias("w"))
    metrics = {
        "average_retrieval_time_seconds": F.bround("s", 6), "average_rerank_time_seconds": F.bround(F.col("s") * F.col("r"), 6), "cache_hit_rate_percent": F.bround(F.col("c") * 100, 3),
        "warehouse_hit_rate_percent": F.bround(F.col("w") * 100, 3), "reranker_used_rate_percent": F.bround(F.col("r") * 100, 3),
    }
    return r.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in metrics.items()))).alias("m")).select("m.*")


def latest_runtime(manifest: dict, profile: list[dict], stage: str = "Retrieval", key: str = "retrieval_time_seconds") -> float:
    """Seconds of the last run: from its manifest, else from a profile of stages, else 0; unreadable figures count as none."""
    for value in (manifest.get(key), *(r.get("runtime_seconds") for r in profile if r.get("stage") == stage)):
        try:
            if value is not None and float(value) > 0:
                return float(value)
        except (TypeError, ValueError):
            continue
    return 0.0
