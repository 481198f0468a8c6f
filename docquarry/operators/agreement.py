"""Agreement of raters and correlation of score sets, from counts per pair of labels.

All statistics need only the table of label pairs, which has as many rows as there are pairs of labels, so the scores
are aggregated once with map-side combine whatever their number.

Defined results: rows with a null rating take no part; without common rows rates are 0 and kappa and alpha null
(alpha 1 with a single label); many-to-many keys multiply as in any inner join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def paired(a: DataFrame, b: DataFrame, keys: list[str], value: str = "score") -> DataFrame:
    """Common rows of two score tables: keys, left, right."""
    return a.select(*keys, F.col(value).alias("left")).join(b.select(*keys, F.col(value).alias("right")), keys).where("left IS NOT NULL AND right IS NOT NULL")


def pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("left", "right").agg(F.count("*").alias("n"))


def label_metrics(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label, and a row ``overall`` with their means, kappa and alpha."""
    counts = pair_counts(pairs)
    sides = counts.select(F.explode(F.array(F.struct(F.col("left").alias("label"), F.lit(1).alias("h"), F.lit(0).alias("m")), F.struct(F.col("right").alias("label"), F.lit(0).alias("h"), F.lit(1).alias("m")))).alias("x"), "left", "right", "n")
    per = sides.groupBy(F.col("x.label").alias("label")).agg(
        F.sum(F.when((F.col("x.h") == 1) & (F.col("left") == F.col("right")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("x.h") == 1, F.col("n")).otherwise(0)).alias("support"), F.sum(F.when(F.col("x.m") == 1, F.col("n")).otherwise(0)).alias("named"),
    )
    precision, recall = F.col("tp") / F.greatest("named", F.lit(1)), F.col("tp") / F.greatest("support", F.lit(1))
    per = per.select("label", "tp", "support", precision.alias("precision"), recall.alias("recall"))
    per = per.withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-12)))
    rows = per.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support", F.lit(None).cast("double").alias("kappa"), F.lit(None).cast("double").alias("alpha"))
    means = per.agg(F.lit("overall").alias("label"), *(F.avg(c).alias(c) for c in ("precision", "recall", "f1")), F.sum("support").alias("support"))
    overall = means.crossJoin(F.broadcast(cohen_kappa(pairs))).crossJoin(F.broadcast(krippendorff_alpha(pairs))).select(*rows.columns)
    return rows.unionByName(overall)


def _marginals(counts: DataFrame) -> DataFrame:
    """Per label: how often the left and the right rater gave it."""
    both = counts.select(F.explode(F.array(F.struct(F.col("left").alias("label"), F.col("n").alias("l"), F.lit(0).cast("bigint").alias("r")), F.struct(F.col("right").alias("label"), F.lit(0).cast("bigint").alias("l"), F.col("n").alias("r")))).alias("x"))
    return both.groupBy("x.label").agg(F.sum("x.l").alias("l"), F.sum("x.r").alias("r"))


def cohen_kappa(pairs: DataFrame) -> DataFrame:
    """One row (kappa): 1 where chance agreement is certain, null without rows."""
    counts = pair_counts(pairs)
    seen = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("left") == F.col("right"), F.col("n")).otherwise(0)).alias("same"))
    chance = _marginals(counts).agg(F.sum(F.col("l").cast("double") * F.col("r")).alias("c"))
    expected = F.col("c") / (F.col("n").cast("double") * F.col("n"))
    observed = F.col("same") / F.col("n")
    return seen.crossJoin(F.broadcast(chance)).select(F.when(expected < 1, (observed - expected) / (1 - expected)).when(F.col("n") > 0, 1.0).alias("kappa"))


def krippendorff_alpha(pairs: DataFrame) -> DataFrame:
    """One row (alpha): nominal, expected disagreement from the pooled label shares; 1 with a single label."""
    counts = pair_counts(pairs)
    seen = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("left") != F.col("right"), F.col("n")).otherwise(0)).alias("off"))
    pooled = _marginals(counts).select((F.col("l") + F.col("r")).alias("k")).agg(F.sum("k").alias("all"), F.sum(F.col("k").cast("double") * F.col("k")).alias("sq"), F.count("*").alias("labels"))
    expected = 1 - F.col("sq") / (F.col("all").cast("double") * F.col("all"))
    alpha = F.when(F.col("labels") <= 1, 1.0).when(expected > 0, 1 - (F.col("off") / F.col("n")) / expected).otherwise(1.0)
    return seen.crossJoin(F.broadcast(pooled)).select(alpha.alias("alpha"))


def crosstab(pairs: DataFrame, labels: list) -> DataFrame:
    """A row per left label, a column per right label, zeros where nothing fell; all ``labels`` appear."""
    spark = pairs.sparkSession
    rows = spark.createDataFrame([(x,) for x in labels], f"left {dict(pairs.dtypes)['left']}")
    wide = pair_counts(pairs).groupBy("left").pivot("right", labels).agg(F.sum("n"))
    return rows.join(wide, "left", "left").select("left", *(F.coalesce(F.col(f"`{x}`"), F.lit(0)).alias(f"right_{x}") for x in labels))


def correlation(a: DataFrame, b: DataFrame, keys: list[str], left: Column, right: Column) -> DataFrame:
    """One row (correlation, n): Pearson over the common rows, null under two."""
    both = a.select(*keys, left.cast("double").alias("l")).join(b.select(*keys, right.cast("double").alias("r")), keys)
    out = both.agg(F.corr("l", "r").alias("c"), F.count("*").alias("n"))
    return out.select(F.when(F.col("n") >= 2, F.col("c")).alias("correlation"), "n")


def raters(labels: DataFrame, item: str, rater: str, value: str, ties: list[str]) -> DataFrame:
    """The first and second rating of every item rated at least twice, in the order of the rater."""
    w = Window.partitionBy(item).orderBy(rater, *ties)
    ranked = labels.withColumn("__k", F.row_number().over(w)).where("__k <= 2")
    wide = ranked.groupBy(item).agg(F.max(F.when(F.col("__k") == 1, F.col(value))).alias("left"), F.max(F.when(F.col("__k") == 2, F.col(value))).alias("right"))
    return wide.where("left IS NOT NULL AND right IS NOT NULL")
