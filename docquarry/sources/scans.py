"""Scanning of report pages with a pluggable engine: one process per page with a time limit, resumable, failures recorded.

Page jobs are rows, so pages of all reports run side by side over the cluster and a hot report is spread like any other.
Results are appended to a table; a later run takes only the pages without a completed scan. Defined results: a page that
fails or exceeds the limit has status ``failed``, its error and a null text; a page scanned twice keeps its latest row.
"""

from __future__ import annotations

import multiprocessing
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.text import normalize_text
from docquarry.operators.incremental import pages_to_scan, scan_status

SCAN_SCHEMA = "file_hash string, source_file string, page_number int, text string, status string, error string, seconds double, seq bigint"
#: Seconds a page may take; pages of one task.
TIMEOUT, PAGES_PER_TASK = 60, 64


def page_jobs(reports: DataFrame, count_pages: Callable[[bytes], int]) -> DataFrame:
    """(file_hash, source_file, page_number, content): a job for every page of every report; a report that cannot be
    counted has one job, which will fail with its error."""

    @F.pandas_udf("int")
    def pages(content: pd.Series) -> pd.Series:
        def count(raw) -> int:
            try:
                return max(1, int(count_pages(bytes(raw))))
            except Exception:  # noqa: BLE001 - shown by the page job
                return 1

        return content.map(count)

    return reports.select("file_hash", "source_file", F.explode(F.sequence(F.lit(1), pages("content"))).alias("page_number"), "content")


def run_limited(engine: Callable[[bytes, int], str], content: bytes, page: int, timeout: float) -> tuple[str | None, str | None]:
    """(text, error) of one page, read in a process of its own that is ended after ``timeout`` seconds."""
    context = multiprocessing.get_context("fork")
    receive, send = context.Pipe(duplex=False)

    def work() -> None:
        try:
            send.send((engine(content, page) or "", None))
        except BaseException as e:  # noqa: BLE001 - recorded per page
            send.send((None, f"{type(e).__name__}: {e}"))

    child = context.Process(target=work, daemon=True)
    child.start()
    send.close()
    try:
        return receive.recv() if receive.poll(timeout) else (None, f"TimeoutError: page exceeded {timeout:g} seconds")
    except EOFError:
        return None, "EOFError: the engine ended without a result"
    finally:
        if child.is_alive():
            child.terminate()
        child.join()
        receive.close()


def scan_pages(jobs: DataFrame, engine: Callable[[bytes, int], str], timeout: float = TIMEOUT, run: int = 0) -> DataFrame:
    """``SCAN_SCHEMA`` of page jobs; ``run`` numbers the attempt and orders repeated scans of a page."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                began = time.perf_counter()
                text, error = run_limited(engine, bytes(r.content), int(r.page_number), timeout)
                rows.append((r.file_hash, r.source_file, r.page_number, text, "failed" if error else "completed", error, time.perf_counter() - began, run))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCAN_SCHEMA.split(", ")]).astype({"page_number": "Int32", "seq": "int64", "seconds": "float64"})

    return jobs.mapInPandas(work, SCAN_SCHEMA).withColumn("text", normalize_text("text"))


def resume_scans(spark: SparkSession, jobs: DataFrame, path: str, engine: Callable[[bytes, int], str], timeout: float = TIMEOUT, retry_failed: bool = True) -> DataFrame:
    """Scan the jobs not yet done, append them to the table at ``path``, and give the latest scan of every page.

    A page whose last scan failed is tried again unless ``retry_failed`` is off.
    """
    done = read_scans(spark, path)
    known = done if retry_failed else done.withColumn("status", F.lit("completed"))
    todo = pages_to_scan(jobs, known)
    run = (done.agg(F.max("seq")).first()[0] or 0) + 1
    pages = todo.count()
    if pages:
        todo = todo.repartition(max(1, -(-pages // PAGES_PER_TASK)), "file_hash", "page_number")
        scan_pages(todo, engine, timeout, run).write.mode("append").parquet(path)
    return latest_scans(read_scans(spark, path))


def read_scans(spark: SparkSession, path: str) -> DataFrame:
    """The table of scans, empty where there is none yet."""
    jvm = spark._jvm.org.apache.hadoop.fs
    where = jvm.Path(path)
    exists = where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(SCAN_SCHEMA).parquet(path) if exists else spark.createDataFrame([], SCAN_SCHEMA)


def latest_scans(scans: DataFrame) -> DataFrame:
    rest = [c for c in scans.columns if c not in ("file_hash", "page_number")]
    return scans.groupBy("file_hash", "page_number").agg(F.max_by(F.struct(*rest), F.struct("seq", "status")).alias("r")).select("file_hash", "page_number", "r.*").select(*scans.columns)


def scan_report(jobs: DataFrame, scans: DataFrame) -> DataFrame:
    """Per report: pages, completed and failed ones, status, seconds and pages an hour."""
    time_spent = scans.groupBy("file_hash").agg(F.sum("seconds").alias("runtime_seconds"))
    out = scan_status(jobs, scans).join(time_spent, "file_hash", "left").withColumn("runtime_seconds", F.coalesce("runtime_seconds", F.lit(0.0)))
    return out.withColumn("pages_per_hour", F.when(F.col("runtime_seconds") > 0, F.col("completed_pages") / F.col("runtime_seconds") * 3600).otherwise(F.lit(0.0)))
