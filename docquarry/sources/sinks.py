"""Sinks: tables, JSON lines, batches with prompts, manifests and logs."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from docquarry.operators.ordering import positions


def write_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """Overwrite Parquet by suffix, else CSV with header."""
    w = df.write.mode("overwrite")
    w = w.partitionBy(*partition_by) if partition_by else w
    w.parquet(path) if path.rstrip("/").endswith(".parquet") else w.option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> int:
    """Write JSON lines; the number of rows is observed while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return int(seen.get["n"])


def write_reports(reports: dict[str, DataFrame], folder: str, suffix: str = "") -> list[str]:
    """Write every named report as a table of its own; the paths in the order given."""
    paths = [f"{folder.rstrip('/')}/{name}{suffix}" for name in reports]
    for path, df in zip(paths, reports.values()):
        write_table(df, path)
    return paths


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a catalogue table."""
    df.write.mode("overwrite").saveAsTable(name)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a log of errors, experiments or runtimes."""
    df.write.mode("append").parquet(path)


def fingerprint(df: DataFrame, key: str) -> dict:
    """Row count and an order-free hash of whole rows, keys and values: one row, from map-side combined sums."""
    whole = F.xxhash64(F.col(key).cast("string"), *(F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns if c != key))
    r = df.agg(F.count("*").alias("n"), F.sum(whole.cast("decimal(38,0)")).alias("h")).first()
    return {"count": r["n"], "hash": str(r["h"])}


def write_if_changed(df: DataFrame, path: str, manifest: str, key: str) -> bool:
    """Write unless the manifest names the same count and keys; whether it was written."""
    now, old = fingerprint(df, key), Path(manifest)
    if old.exists() and json.loads(old.read_text()) == now:
        return False
    write_table(df, path)
    old.parent.mkdir(parents=True, exist_ok=True)
    old.write_text(json.dumps(now))
    return True


def with_batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """batch_no (from 1) and place in the batch, by a total order; no single task sorts all rows."""
    if size < 1:
        raise ValueError("the batch size must be positive")
    placed = positions(df, order, "__at")
    return placed.withColumns({"batch_no": F.floor(F.col("__at") / size) + 1, "place": F.pmod(F.col("__at"), F.lit(size)) + 1}).drop("__at")


def batch_manifest(batched: DataFrame, name: str) -> DataFrame:
    """Per batch: rows, first and last value of a column."""
    return batched.groupBy("batch_no").agg(F.count("*").alias("record_count"), F.min_by(name, "place").alias("first"), F.max_by(name, "place").alias("last"))


def prompt_lines(id_col: Column, name: Column, parts: list[tuple[str, Column]]) -> Column:
    """One bullet block per row: id and name, then labelled parts."""
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(F.lit("- "), empty(id_col), F.lit(" | "), empty(name), *(x for label, c in parts for x in (F.lit(f"\n  {label}: "), empty(c))))


def render_prompts(batched: DataFrame, line: Column, template: str) -> DataFrame:
    """(batch_no, prompt): the template with {batch_id} and {lines}; a batch has a fixed number of rows."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("t")))), lambda x: x["t"]), "\n")
    out = batched.groupBy("batch_no").agg(lines.alias("lines"))
    name = F.format_string("batch_%03d", F.col("batch_no"))
    return out.select("batch_no", F.replace(F.replace(F.lit(template), F.lit("{batch_id}"), name), F.lit("{lines}"), F.col("lines")).alias("prompt"))


def export_batches(df: DataFrame, order: list[str], size: int, folder: str, line: Column, template: str, name: str) -> DataFrame:
    """Write batches as CSV and JSON by batch, prompts and the manifest; returns the manifest."""
    from docquarry.common import materialise

    batched = materialise(with_batches(df, order, size))
    write_table(batched, f"{folder}/csv", ["batch_no"])
    batched.write.mode("overwrite").partitionBy("batch_no").json(f"{folder}/json")
    write_table(render_prompts(batched, line, template), f"{folder}/prompts.parquet")
    manifest = batch_manifest(batched, name)
    write_table(manifest, f"{folder}/manifest.parquet")
    return manifest


def write_run_manifest(path: str, entries: dict) -> dict:
    """A JSON record of a run with its time."""
    out = {"timestamp": datetime.now(timezone.utc).isoformat()} | entries
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(out, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    return out


def read_json(path: str) -> dict:
    """A JSON mapping, {} where the file is missing or unreadable."""
    try:
        data = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return {}
    return data if isinstance(data, dict) else {}
