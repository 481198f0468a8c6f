"""Pages largely taken over from one another, found without comparing all pairs.

The shingles of every page of enough words are put in one order, rare ones first; the inverted index holds the first of
them (prefix filter): two sets reaching the similarity must share ``SHARED`` of these, so no pair is lost. Shared postings
count where the sizes of the sets and the places of the shingle still allow the similarity, which they always do for the
first ``SHARED`` of a true pair; pairs reaching that count go on to the comparison of their shingle sets. The order comes from a sample of
pages; it decides how many pairs meet, never which are found. A posting that the sample says is shared by more than ``HOT``
pages is split: one side of its join is dealt to as many parts as that takes, the other goes to each of them, so that no
task holds a posting of a third of all pages.

Pages with equal shingle sets form one class and take part once, so copies never meet in the index. Shingles are
compared as 32-bit hashes; two pages of 1,000 shingles meet a chance collision in fewer than 1 of 1,000 comparisons,
which then moves their similarity by 0.001.

Defined results: null, empty and short texts (under ``least_words`` words) take no part and give no pair; repeated rows
are copies and pair with each other; a pair of equal similarity to the threshold counts; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.common import materialise, spread
from docquarry.llm.splitting import WORD
from docquarry.operators.pairs import EXPAND, expand_pairs

#: About so many pages are read for the order of the shingles; shingles seen less often there than ``SEEN`` count as rare.
SAMPLE, SEEN = 20_000, 3
#: Shingles of their prefixes that two sets must share; any number is exact, more means longer prefixes and fewer comparisons.
SHARED = 4
#: Pages expected in one posting, beyond which it is split into parts.
HOT = 4_000
#: Ids of pages to compare exactly are broadcast up to this count (16 bytes each), joined by shuffle beyond.
BROADCAST_IDS = 1_000_000
#: The places after a shingle are kept in 16 bits of its posting; so many or more count as any number.
ANY = 0xFFFF
_U64 = np.uint64


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def shingle_sets(texts: list[str | None], size: int, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, bounds, hashes): sorted distinct 64-bit shingle hashes of every text long enough."""
    words: list[str] = []
    index, counts = [], []
    for i, text in enumerate(texts):
        if text and len(text) >= 2 * least_words - 1:
            found = WORD.findall(text.lower())
            if len(found) >= max(least_words, size):
                index.append(i)
                counts.append(len(found))
                words += found
    if not index:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, _U64)
    h = pd.util.hash_array(np.array(words, dtype=object))
    n = len(h) - size + 1
    s = np.zeros(n, _U64)
    for k in range(size):
        s = _mix64(s * _U64(0x9E3779B97F4A7C15) + h[k : k + n])
    count = np.array(counts)
    owner = np.repeat(np.arange(len(count)), count)
    inside = owner[:n] == owner[size - 1 : size - 1 + n]
    s, owner = s[inside], owner[:n][inside]
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    s, owner = s[fresh], owner[fresh]
    return np.array(index), np.searchsorted(owner, np.arange(len(count) + 1)), s


def shingle_order(pages: DataFrame, id_col: str, text_col: str, size: int, least_words: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sorted shingle hashes, counts, pages a sampled page stands for) of shingles that recur in a sample; bounded by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = (shingle_sets(batch.column("text").to_pylist(), size, least_words)[2] >> _U64(32)).astype(np.int64)
            key, n = np.unique(low, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    step = max(1, pages.count() // SAMPLE)
    src = pages.where(F.pmod(F.xxhash64(id_col), F.lit(step)) == 0).select(F.col(text_col).alias("text"))
    out = src.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN).toArrow().sort_by("key")
    return out["key"].to_numpy().astype(np.uint32), out["n"].to_numpy(), step


def prefixes(bounds: np.ndarray, low: np.ndarray, order: tuple[np.ndarray, np.ndarray, int], threshold: float, hot: int = HOT) -> tuple[list[np.ndarray], list[np.ndarray | None]]:
    """(shingles, parts): the rarest shingles of every set, as many as make sure that sets reaching the similarity share
    ``SHARED`` of them, and into how many parts the posting of each is split, None where none is."""
    keys, counts, step = order
    seen = np.zeros(len(low), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
        seen = np.where(keys[at] == low, counts[at], 0)
    n = np.diff(bounds)
    at = np.lexsort((low, seen, np.repeat(np.arange(len(n)), n)))
    ranked, parts = low[at], np.minimum(-(-seen[at] * step // hot), 1 << 14).clip(1).astype(np.int16)
    take = np.minimum(n, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + SHARED)
    spans = [slice(a, a + k) for a, k in zip(bounds[:-1], take)]
    return [ranked[x] for x in spans], [parts[x] if (parts[x] > 1).any() else None for x in spans]


def signatures(pages: DataFrame, id_col: str, text_col: str, size: int, least_words: int, threshold: float = 0.6, hot: int = HOT) -> DataFrame:
    """(id, set_a, set_b, n, prefix, parts, copy) of every page long enough: two sums of its set, its size, its rarest shingles in order, the parts of their postings, a hash of its text."""
    kind = dict(pages.dtypes)[id_col]
    order = pages.sparkSession.sparkContext.broadcast(shingle_order(pages, id_col, text_col, size, least_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                index, bounds, s = shingle_sets(batch.column("text").to_pylist(), size, least_words)
                if not len(index):
                    continue
                starts = bounds[:-1]
                first, parts = prefixes(bounds, (s >> _U64(32)).astype(np.uint32), order.value, threshold, hot)
                set_a = np.add.reduceat(_mix64(s ^ _U64(0x5851F42D4C957F2D)), starts).view(np.int64)
                set_b = np.add.reduceat(_mix64(s ^ _U64(0x14057B7EF767814F)), starts).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(index)), pa.array(set_a), pa.array(set_b), pa.array(np.diff(bounds).astype(np.int32)), pa.array([x.tobytes() for x in first], pa.binary()), pa.array([None if x is None else x.tobytes() for x in parts], pa.binary()), batch.column("copy").take(pa.array(index))],
                    ["id", "set_a", "set_b", "n", "prefix", "parts", "copy"],
                )

    src = spread(pages.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("copy")))
    return src.mapInArrow(run, f"id {kind}, set_a bigint, set_b bigint, n int, prefix binary, parts binary, copy bigint")


def _postings(split: bool):
    """A row for every shingle of a prefix whose posting is (not) split: the shingle (upper 32 bits) and how many come after
    it in the order (next 16 bits, ``ANY`` at most), the size of its set, its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                posts = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column("prefix")]
                if not posts:
                    continue
                count = np.array([len(x) for x in posts])
                parts = np.concatenate([np.frombuffer(x.as_buffer(), np.int16) if x.is_valid else np.ones(k, np.int16) for x, k in zip(batch.column("parts"), count)])
                owner = np.repeat(np.arange(len(posts)), count)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                use = (parts > 1) == split
                owner, place = owner[use], place[use]
                after = np.minimum(batch.column("n").to_numpy()[owner] - place - 1, ANY)
                key = np.concatenate(posts)[use].astype(np.int64) << 32 | after.astype(np.int64) << 16
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column("id").take(pa.array(owner)), batch.column("n").take(pa.array(owner)), pa.array(parts[use].astype(np.int32))],
                    ["key", "id", "n", "parts"],
                )

    return run


def _shingles(size: int, least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                index, bounds, s = shingle_sets(batch.column("text").to_pylist(), size, least_words)
                low = (s >> _U64(32)).astype(np.uint32)
                sets = [np.sort(low[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(index, pa.int64())), pa.array(sets, pa.binary())], ["id", "shingles"])

    return run


def _similar(threshold: float):
    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint32), np.diff(offsets) // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                (a, na), (b, nb) = flat(batch.column("sa")), flat(batch.column("sb"))
                pair = np.arange(batch.num_rows, dtype=_U64) << _U64(32)
                both = np.concatenate([np.repeat(pair, na) | a, np.repeat(pair, nb) | b])  # a set has no shingle twice
                both.sort(kind="stable")
                same = both[1:][both[1:] == both[:-1]] >> _U64(32)
                shared = np.bincount(same.astype(np.int64), minlength=batch.num_rows)
                value = shared / np.maximum(na + nb - shared, 1)
                take = pa.array(np.flatnonzero(value >= threshold))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take), pa.array(value).take(take)], ["a", "b", "similarity"])

    return run


def near_duplicate_links(pages: DataFrame, id_col: str = "page_key", text_col: str = "text", size: int = 3, threshold: float = 0.6, least_words: int = 80, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (a, b, similarity) between classes of equal shingle sets, members (cls, copy, id).

    Rows that agree in copy have the same text. The class id is the smallest id of the class.
    """
    kind = dict(pages.dtypes)[id_col]
    pages = pages.where(F.col(id_col).isNotNull())
    sigs = materialise(signatures(pages, id_col, text_col, size, least_words, threshold, hot))
    heads = sigs.groupBy("set_a", "set_b").agg(F.min("id").alias("cls"))
    members = materialise(sigs.select("id", "set_a", "set_b", "copy").join(heads, ["set_a", "set_b"]).select("cls", "copy", "id"))
    firsts = members.where("cls = id").select("cls").distinct()
    indexed = sigs.select("id", "n", "prefix", "parts").join(firsts, F.col("id") == F.col("cls"), "left_semi")
    schema = f"key bigint, id {kind}, n int, parts int"
    posts, hot = indexed.mapInArrow(_postings(False), schema), indexed.where("parts IS NOT NULL").mapInArrow(_postings(True), schema)
    # Postings are most of what is shuffled: they stay packed until they are joined.
    side = lambda rows, x, *keys: rows.select(*keys, F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("key").alias(f"key{x}"))
    same = F.shiftright("keya", 32) == F.shiftright("keyb", 32)
    met = side(posts, "a").join(side(posts, "b"), same)
    dealt = side(hot.withColumn("parta", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "a", "parta")
    every = side(hot.withColumn("partb", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), "b", "partb")
    met = met.unionByName(dealt.join(every, same & (F.col("parta") == F.col("partb"))).drop("parta", "partb"))
    sizes = F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9
    least = F.ceil(threshold / (1 + threshold) * (F.col("na") + F.col("nb")) - 1e-6)  # shared shingles at the threshold
    after = F.least(*(F.shiftright(f"key{x}", 16).bitwiseAND(F.lit(ANY)) for x in "ab"))
    pairs = met.where((F.col("a") < F.col("b")) & sizes & ((after == ANY) | (SHARED + after >= least)))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min(F.least(least, F.lit(SHARED))).alias("least"))
    pairs = materialise(pairs.where("shared >= least").select("a", "b"))
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    src = pages.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi")
    sets = src.mapInArrow(_shingles(size, least_words), f"id {kind}, shingles binary")
    pairs = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    pairs = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    links = pairs.select("a", "b", "sa", "sb").mapInArrow(_similar(threshold), f"a {kind}, b {kind}, similarity double").distinct()
    return links, members


def near_duplicate_pairs(
    pages: DataFrame, id_col: str = "page_key", text_col: str = "text", size: int = 3, threshold: float = 0.6, least_words: int = 80, expand: int | None = EXPAND
) -> DataFrame:
    """Pairs ({id}_a, {id}_b) of rows whose shingle sets reach the similarity; groups of more than ``expand`` rows of one text
    as a star around their smallest id (None: all pairs)."""
    links, members = near_duplicate_links(pages, id_col, text_col, size, threshold, least_words)
    return expand_pairs(links.select("a", "b"), members, expand).select(F.col("a").alias(f"{id_col}_a"), F.col("b").alias(f"{id_col}_b")).distinct()
