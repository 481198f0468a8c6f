"""Persistent caches of rows: evidence per report and indicator, statement warehouses, facts.

A cache is a table partitioned by the key of the configuration that made its rows (``incremental.config_key``); rows of
other configurations are never read. Looking up is an anti and a semi join, filling is an append. Defined results: a cache
that does not exist is empty; equal rows stored twice come out once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.common import materialise
from docquarry.operators.retrieval import split_by_cache


def read_cache(spark: SparkSession, path: str, key: str, schema) -> DataFrame:
    """The rows stored under a configuration; none where there is no cache."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).where(F.col("config_key") == key).drop("config_key")


def store(rows: DataFrame, path: str, key: str) -> None:
    """Append rows to the cache under a configuration."""
    rows.withColumn("config_key", F.lit(key)).write.mode("append").partitionBy("config_key").parquet(path)


def through_cache(wanted: DataFrame, path: str, key: str, keys: list[str], compute: Callable[[DataFrame], DataFrame], schema, rebuild: bool = False) -> DataFrame:
    """Rows for all wanted keys with ``cache_hit``: stored ones as they are, the others computed and stored.

    compute: from the wanted rows that are missing to result rows holding ``keys``. With ``rebuild`` all are computed and
    nothing is stored, so that an old cache is never mixed with new rows.
    """
    spark = wanted.sparkSession
    if rebuild:
        return compute(wanted).withColumn("cache_hit", F.lit(False))
    cached = read_cache(spark, path, key, schema)
    hits, misses = split_by_cache(wanted, cached, keys)
    found = cached.join(hits.select(*keys).distinct(), keys, "left_semi").distinct().withColumn("cache_hit", F.lit(True))
    # Both sides are written out before the append changes the files they were read from.
    found, new = materialise(found), materialise(compute(misses))
    store(new, path, key)
    return found.unionByName(new.withColumn("cache_hit", F.lit(False)))


def is_indicator_cache(name: Column) -> Column:
    """Whether a file name is that of an older cache of one indicator: report, year and indicator, joined by underscores."""
    parts = F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "_")
    return F.coalesce((F.size(parts) == 3) & F.get(parts, F.lit(1)).rlike(r"^\p{Nd}+$") & F.substring(F.get(parts, F.lit(2)), 1, 1).isin("E", "S", "G"), F.lit(False))


def identity(report_id: Column) -> tuple[Column, Column]:
    """Company and year text of a report id, split at the last underscore; the whole id and '' without one."""
    has = F.instr(report_id, "_") > 0
    return F.when(has, F.regexp_replace(report_id, "_[^_]*$", "")).otherwise(report_id), F.when(has, F.substring_index(report_id, "_", -1)).otherwise(F.lit(""))


def report_hashes(reports: DataFrame, manifest: DataFrame) -> DataFrame:
    """(report_id, file_hash): the hash the manifest holds, else the one of the file."""
    known = manifest.groupBy("report_id").agg(F.min("file_hash").alias("__known"))
    return reports.join(known, "report_id", "left").select("report_id", F.coalesce("__known", "file_hash").alias("file_hash"))
