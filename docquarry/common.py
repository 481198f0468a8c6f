"""Helpers shared by all operators: table access, checkpointing, parallelism."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Open ``{sf_dir}/{name}.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the session names in ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (tests) is a folder of our own made; on a cluster a folder
    of one machine would not be shared, so there its absence is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    target = named
    if not target:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        target = os.path.join(tempfile.gettempdir(), f"docquarry-ckpt-{os.getpid()}")
        atexit.register(shutil.rmtree, target, ignore_errors=True)
    sc.setCheckpointDir(target)
    return target


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy map stages over a scan at least one partition per core.

    A scan that already yields enough partitions is returned untouched, so large inputs never pay a shuffle here; so is
    anything but filters and projections of a scan, as counting its partitions could run it. Call it before any join.
    """
    execution = df._jdf.queryExecution()
    plan = execution.optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    if plan.children().size():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if execution.toRdd().getNumPartitions() >= cores else df.repartition(cores)


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """The side of a join, marked for broadcast only after its rows were counted; else left to a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df
