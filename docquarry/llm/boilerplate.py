"""Lines repeated excessively within one source: found and removed.

1. Every line is normalised and hashed together with its source; the hashes are written once (checkpoint).
2. Each map task keeps a heavy-hitter summary per source (counters that are decremented when a capacity is exceeded,
   with the decremented amount kept as the error). Summaries merge by adding counters and errors, which is a plain
   distributed group-by. A line whose count plus error reaches the threshold is a candidate.
3. Candidates are counted exactly over all rows in a second pass and confirmed against the threshold.
4. Confirmed lines are removed while the pages are read once more, with the set of their keys broadcast; no text is
   shuffled. A set of more than ``BROADCAST_KEYS`` keys (8 bytes each) is joined by shuffle instead, with the same rows.

The capacity of a summary follows the lines and rows it has seen, so its error stays under a quarter of the share at
any input size and no frequent line is lost; a source holding a third of all rows costs one summary per map task.

Defined results: a null source is no source, its lines are never removed; null and empty texts count as rows but have
no lines; lines without a letter or digit do not count; repeated rows count like any row; extra columns are kept by
``remove_repeated_lines`` and ignored by ``repeated_lines``.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from docquarry.common import materialise, spread

BROADCAST_KEYS = 8_000_000
_U64 = np.uint64
#: Zero-width, joining, direction and soft-hyphen characters that leave no visible trace.
INVISIBLE = "".join(map(chr, [0xAD, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), *range(0x2066, 0x2070), 0xFEFF]))
_INVISIBLE = re.compile(f"[{INVISIBLE}]")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def normal_lines(text: str) -> list[str]:
    """The lines of a text in the form in which they are compared; '' for lines that do not count."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    text = text.casefold()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return [_EDGES.sub("", " ".join(line.split())) for line in text.split("\n")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def _keys(texts: list[str | None], sources: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(lines of each text, a key per line): equal for equal lines of one source, 0 where a line does not count."""
    lines: list[str] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            found = normal_lines(text)
            lines += found
            counts[i] = len(found)
    if not lines:
        return counts, np.zeros(0, np.int64)
    seeds = pd.util.hash_array(np.array(["" if s is None else s for s in sources], dtype=object))
    words = np.array(lines, dtype=object)
    keys = _mix(pd.util.hash_array(words) ^ np.repeat(_mix(seeds), counts))
    usable = np.repeat(np.array([s is not None for s in sources], bool), counts)
    return counts, np.where(usable & (words != ""), keys, _U64(0)).astype(_U64).view(np.int64)


def line_keys(pages: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, source, keys array<bigint>) of every page, in the order of its lines."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                counts, keys = _keys(batch.column("text").to_pylist(), batch.column("source").to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), pa.ListArray.from_arrays(offsets, pa.array(keys))], ["id", "source", "keys"])

    src = spread(pages.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")))
    return src.mapInArrow(run, f"id {kinds[id_col]}, source {kinds[source_col]}, keys array<bigint>")


def _distinct_in_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of each line, 1-based number, key, whether it is the first such line of the row) of lines that count."""
    lists = batch.column("keys")
    keys = lists.flatten().to_numpy(zero_copy_only=False)
    counts = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), counts)
    number = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    real = keys != 0
    row, number, keys = row[real], number[real], keys[real]
    order = np.lexsort((number, keys, row))
    row, number, keys = row[order], number[order], keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    return row, number, keys, first


def _summarise(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        held: dict[str, list] = {}  # source -> [keys, counts, rows, lines, error]
        for batch in batches:
            names = batch.column("source").to_pylist()
            code, uniques = pd.factorize(np.array(names, dtype=object))
            row, _, keys, first = _distinct_in_rows(batch)
            row, keys = row[first], keys[first]
            owner = code[row]
            order = np.lexsort((keys, owner))
            owner, keys = owner[order], keys[order]
            rows = np.bincount(code[code >= 0], minlength=len(uniques))
            bounds = np.searchsorted(owner, np.arange(len(uniques) + 1))
            for k, name in enumerate(uniques):
                mine, n = np.unique(keys[bounds[k] : bounds[k + 1]], return_counts=True)
                s = held.setdefault(name, [np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, 0])
                every = np.concatenate([s[0], mine])
                merged, at = np.unique(every, return_inverse=True)
                count = np.bincount(at, weights=np.concatenate([s[1], n]), minlength=len(merged)).astype(np.int64)
                s[2] += int(rows[k])
                s[3] += int(n.sum())
                capacity = max(1024, int(4 * s[3] / (share * s[2])) + 1)
                if len(merged) > capacity:
                    cut = int(np.partition(count, len(count) - capacity - 1)[len(count) - capacity - 1])
                    s[4] += cut
                    count = count - cut
                    merged, count = merged[count > 0], count[count > 0]
                s[0], s[1] = merged, count
        if held:
            names, keys, counts, rows, errors = [], [], [], [], []
            for name, (mine, n, seen, _, error) in held.items():
                names += [name] * (len(mine) + 1)
                keys += [np.array([0]), mine]
                counts += [np.array([0]), n]
                rows += [np.array([seen]), np.zeros(len(mine), np.int64)]
                errors += [np.array([error]), np.zeros(len(mine), np.int64)]
            columns = [np.concatenate(x).astype(np.int64) for x in (keys, counts, rows, errors)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *map(pa.array, columns)], ["source", "key", "n", "rows", "error"])

    return run


def _member(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which of the asked keys are in the sorted set."""
    if not len(keys):
        return np.zeros(len(asked), bool)
    return keys[np.minimum(np.searchsorted(keys, asked), len(keys) - 1)] == asked


def _only(keys):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            row, number, key, first = _distinct_in_rows(batch)
            hit = _member(keys.value, key)
            take = pa.array(row[hit])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("source").take(take), pa.array(key[hit]), pa.array(number[hit].astype(np.int32)), pa.array(first[hit].astype(np.int64))],
                ["id", "source", "key", "line_no", "first"],
            )

    return run


def _confirmed(pages: DataFrame, id_col: str, source_col: str, text_col: str, least_rows: int, share: float, broadcast_keys: int) -> tuple[DataFrame, DataFrame]:
    """(hits, keys): the lines (id, source, key, line_no, first) that candidates may be, and the confirmed keys."""
    spark = pages.sparkSession
    kinds = dict(pages.dtypes)
    lines = materialise(line_keys(pages, id_col, source_col, text_col))
    parts = materialise(lines.where("source IS NOT NULL").mapInArrow(_summarise(share), "source string, key bigint, n bigint, rows bigint, error bigint"))
    sources = parts.where("key = 0").groupBy("source").agg(F.sum("rows").alias("rows"), F.sum("error").alias("error"))
    sources = sources.where(F.col("rows") >= least_rows).withColumn("least", F.greatest(F.lit(float(least_rows)), F.col("rows") * share - 1e-9))
    heavy = parts.where("key <> 0").groupBy("source", "key").agg(F.sum("n").alias("n")).join(sources, "source").where("n + error >= least")
    candidates = heavy.select("key").distinct()
    schema = f"id {kinds[id_col]}, source {kinds[source_col]}, key bigint, line_no int, first bigint"
    if candidates.count() <= broadcast_keys:
        hits = lines.mapInArrow(_only(spark.sparkContext.broadcast(_sorted_keys(candidates))), schema)
    else:
        # Rows of the written lines are numbered, so that repeated rows and null ids stay rows of their own.
        numbered = lines.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "source", F.posexplode("keys").alias("line_no", "key"))
        numbered = numbered.where("key <> 0").join(candidates, "key", "left_semi")
        hits = numbered.groupBy("row", "id", "source", "key").agg(F.sort_array(F.collect_list("line_no")).alias("at")).select("id", "source", "key", F.posexplode("at").alias("k", "line_no"))
        hits = hits.select("id", "source", "key", (F.col("line_no") + 1).cast("int").alias("line_no"), (F.col("k") == 0).cast("bigint").alias("first"))
    hits = materialise(hits)
    return hits, hits.groupBy("source", "key").agg(F.sum("first").alias("n")).join(sources, "source").where("n >= least").select("key")


def _sorted_keys(keys: DataFrame) -> np.ndarray:
    return np.unique(keys.toArrow()["key"].to_numpy().astype(np.int64))


def repeated_lines(
    pages: DataFrame, id_col: str = "page_key", source_col: str = "source_file", text_col: str = "text", least_rows: int = 8, share: float = 0.05, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """(id_col, line_no): every line equal lines of which stand on ``least_rows`` and ``share`` of the rows of its source."""
    hits, exact = _confirmed(pages, id_col, source_col, text_col, least_rows, share, broadcast_keys)
    return hits.join(exact, "key", "left_semi").select(F.col("id").alias(id_col), "line_no").distinct()


def remove_repeated_lines(
    pages: DataFrame, id_col: str = "page_key", source_col: str = "source_file", text_col: str = "text", least_rows: int = 8, share: float = 0.05, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """The pages with the repeated lines taken out of their text, and how many were (``lines_removed``)."""
    _, exact = _confirmed(pages, id_col, source_col, text_col, least_rows, share, broadcast_keys)
    exact = materialise(exact.distinct())
    if exact.count() > broadcast_keys:
        rows = materialise(pages.withColumn("__row", F.monotonically_increasing_id()))
        keyed = line_keys(rows, "__row", source_col, text_col).select("id", F.posexplode("keys").alias("line_no", "key"))
        gone = keyed.join(exact, "key", "left_semi").groupBy(F.col("id").alias("__row")).agg(F.collect_set(F.col("line_no").cast("int")).alias("__gone"))
        kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.array_contains("__gone", i))
        text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
        out = rows.join(gone, "__row", "left").withColumns({text_col: text, "lines_removed": F.coalesce(F.size("__gone"), F.lit(0))})
        return out.select(*(F.col(f"`{c}`") for c in pages.columns), "lines_removed")
    keys = pages.sparkSession.sparkContext.broadcast(_sorted_keys(exact))
    at, by = pages.columns.index(text_col), pages.columns.index(source_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                texts = batch.column(at).to_pylist()
                counts, found = _keys(texts, batch.column(by).to_pylist())
                gone = (found != 0) & _member(keys.value, found)
                removed = np.bincount(np.repeat(np.arange(len(texts)), counts), weights=gone, minlength=len(texts)).astype(np.int32)
                first = np.cumsum(counts) - counts
                for i in np.flatnonzero(removed):
                    texts[i] = "\n".join(x for x, out in zip(texts[i].split("\n"), gone[first[i] : first[i] + counts[i]]) if not out)
                columns = list(batch.columns)
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(removed)], [*batch.schema.names, "lines_removed"])

    return spread(pages).mapInArrow(run, StructType([*pages.schema.fields, StructField("lines_removed", IntegerType())]))
