"""Incremental processing: change detection by content hash, stage manifests, resumable pages, cache keys.

Manifests are tables; every update is a join or an aggregate that yields the next manifest, so a lost job is simply
run again. Defined results: a null hash counts as changed; a report twice in one delivery keeps its latest row.
"""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGES = ("parsed", "chunked", "embedded", "retrieved", "exported")


def detect_changes(current: DataFrame, previous: DataFrame, key: str = "report_id", digest: str = "file_hash") -> DataFrame:
    """(key, status): new, changed, unchanged or removed."""
    a = current.groupBy(key).agg(F.max(digest).alias("__now"), F.lit(True).alias("__in"))
    b = previous.groupBy(key).agg(F.max(digest).alias("__old"), F.lit(True).alias("__was"))
    status = (
        F.when(F.col("__in").isNull(), "removed").when(F.col("__was").isNull(), "new").when(F.col("__now").isNotNull() & (F.col("__now") == F.col("__old")), "unchanged").otherwise("changed")
    )
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def changed_or_new(current: DataFrame, previous: DataFrame, key: str = "report_id", digest: str = "file_hash") -> DataFrame:
    """Rows of the current delivery that the manifest does not hold with the same hash."""
    return current.join(previous.select(key, digest).distinct(), [key, digest], "left_anti")


def mark_stage(manifest: DataFrame, done: DataFrame, stage: str, value: bool = True) -> DataFrame:
    """The manifest after a stage: done (report_id, file_hash) get the flag; a changed hash first clears all flags."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage: {stage}")
    d = done.groupBy("report_id").agg(F.max("file_hash").alias("__hash"))
    m = manifest.select("report_id", "file_hash", *(F.coalesce(F.col(s), F.lit(False)).alias(s) if s in manifest.columns else F.lit(False).alias(s) for s in STAGES))
    out = m.join(d, "report_id", "full_outer")
    fresh = F.col("__hash").isNotNull() & (F.col("file_hash").isNull() | (F.col("file_hash") != F.col("__hash")))
    flags = [
        F.when(F.col("__hash").isNotNull() & F.lit(s == stage), F.lit(value)).when(fresh, F.lit(False)).otherwise(F.coalesce(F.col(s), F.lit(False))).alias(s) for s in STAGES
    ]
    return out.select("report_id", F.coalesce("__hash", "file_hash").alias("file_hash"), *flags)


def mark_exported(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("exported", F.lit(True))


def mark_retrieved(manifest: DataFrame, evidence: DataFrame) -> DataFrame:
    """The manifest after retrieval: reports with evidence rows (report_id) are marked, all in one join; hashes stay."""
    done = evidence.select("report_id").distinct().join(manifest.select("report_id", "file_hash"), "report_id")
    return mark_stage(manifest, done, "retrieved")


def load_manifest(rows: DataFrame) -> DataFrame:
    """A stored manifest with every column of today: missing stages are not done, missing texts are empty."""
    text = ("report_id", "file_hash", "timestamp")
    have = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("")
    flag = lambda c: F.coalesce(F.col(c).try_cast("boolean"), F.lit(False)) if c in rows.columns else F.lit(False)
    return rows.select(*(have(c).alias(c) for c in text), *(flag(c).alias(c) for c in STAGES))


def to_parse(current: DataFrame, manifest: DataFrame, parsed: DataFrame, only_changed: bool = False) -> DataFrame:
    """Reports to parse: not those parsed and stored (``parsed``: report_id, file_hash) under this hash, and with
    ``only_changed`` not those the manifest knows with this hash."""
    out = incomplete(current, manifest.join(parsed.select("report_id", "file_hash").distinct(), ["report_id", "file_hash"], "left_semi"), "parsed")
    return changed_or_new(out, manifest) if only_changed else out


def incomplete(current: DataFrame, manifest: DataFrame, stage: str) -> DataFrame:
    """Reports of the delivery whose stage is not done for this hash."""
    return current.join(manifest.where(F.col(stage)).select("report_id", "file_hash").distinct(), ["report_id", "file_hash"], "left_anti")


def pages_to_scan(jobs: DataFrame, done: DataFrame) -> DataFrame:
    """Page jobs (file_hash, page_number, ...) without a completed scan; failed ones are tried again."""
    return jobs.join(done.where("status = 'completed'").select("file_hash", "page_number").distinct(), ["file_hash", "page_number"], "left_anti")


def scan_status(jobs: DataFrame, done: DataFrame) -> DataFrame:
    """(file_hash, total_pages, completed_pages, failed_pages, failure_rate, status) per report."""
    last = done.groupBy("file_hash", "page_number").agg(F.max_by("status", "seq").alias("s"))
    out = jobs.select("file_hash", "page_number").distinct().join(last, ["file_hash", "page_number"], "left").groupBy("file_hash")
    out = out.agg(F.count("*").alias("total_pages"), F.count_if(F.col("s") == "completed").alias("completed_pages"), F.count_if(F.col("s") == "failed").alias("failed_pages"))
    status = F.when(F.col("completed_pages") == F.col("total_pages"), "completed").when(F.col("failed_pages") == F.col("total_pages"), "failed").when(F.col("completed_pages") + F.col("failed_pages") > 0, "partial").otherwise("running")
    return out.withColumn("failure_rate", F.bround(F.col("failed_pages") / F.col("total_pages"), 6)).withColumn("status", status)


def config_key(settings: dict) -> str:
    """First 16 hexadecimal digits of the SHA-256 of the sorted JSON of a configuration."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, ensure_ascii=False).encode("utf-8")).hexdigest()[:16]


def migration_status(wanted: DataFrame, existing: DataFrame, legacy: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status, chunks): exists, migrated (legacy rows with text, each text once) or missing_legacy_cache."""
    have = existing.select(*keys).distinct().withColumn("__have", F.lit(True))
    texts = legacy.where("evidence <> ''").groupBy(*keys).agg(F.countDistinct("evidence").alias("__n"))
    out = wanted.select(*keys).distinct().join(have, keys, "left").join(texts, keys, "left")
    status = F.when(F.col("__have"), "exists").when(F.col("__n") > 0, "migrated").otherwise("missing_legacy_cache")
    return out.select(*keys, status.alias("status"), F.when(status == "migrated", F.col("__n")).otherwise(F.lit(0)).alias("chunks"))


class StageTimer:
    """Seconds per stage on the driver; repeated runs of a stage add up."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}
        self._begun: dict[str, float] = {}

    def start(self, stage: str) -> None:
        self._begun[stage] = time.perf_counter()

    def stop(self, stage: str) -> float:
        spent = time.perf_counter() - self._begun.pop(stage, time.perf_counter())
        self.seconds[stage] = self.seconds.get(stage, 0.0) + spent
        return self.seconds[stage]
