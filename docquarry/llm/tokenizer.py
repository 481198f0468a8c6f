"""Corpus encoding with a public byte-level BPE vocabulary.

Two tiers resolve a pre-token: a minimal perfect hash over the vocabulary answers whole pre-tokens in one vectorised
lookup per batch; only the misses run the merge loop, a heap over a doubly linked list of bytes.

Defined results: an empty and a null text both give an empty list; ids of special tokens are never produced, their
strings are ordinary text; extra columns of the input are not carried.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from docquarry.common import spread

DEFAULT_VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published pre-token pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_GAMMA = 1.6
_MEMO = 400_000


def read_ranks(path: str = DEFAULT_VOCAB) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys: cascaded bit arrays, the rank of a set bit is the slot."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.base: list[np.ndarray] = []
        rest, placed = keys.astype(np.uint64), 0
        while len(rest):
            size = max(64, int(len(rest) * _GAMMA))
            at = (_mix(rest, len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(alone)
            self.base.append(placed + np.cumsum(alone) - 1)
            placed += int(alone.sum())
            rest = rest[~alone[at]]
        self.size = placed

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; keys outside the built set get some slot or -1, so the caller compares the stored key."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, base) in enumerate(zip(self.levels, self.base)):
            if not len(left):
                break
            at = (_mix(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = base[at[hit]]
            left = left[~hit]
        return out


class BytePairEncoder:
    """Picklable encoder: build once on the driver, broadcast, use per Arrow batch."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        words, ids = [], []
        for piece, rank in ranks.items():
            try:
                words.append(piece.decode("utf-8"))
                ids.append(rank)
            except UnicodeDecodeError:
                continue
        names = np.array(words, dtype=object)
        keys = pd.util.hash_array(names, categorize=False)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("hash collision inside the vocabulary")
        self.mph = PerfectHash(keys)
        slot = self.mph.slots(keys)
        self.names = np.empty(self.mph.size, dtype=object)
        self.names[slot] = names
        self.ids = np.empty(self.mph.size, dtype=np.int32)
        self.ids[slot] = np.array(ids, dtype=np.int32)
        self._pattern = None
        self._memo: dict[str, list[int]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_pattern": None, "_memo": {}}

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token: always merge the leftmost pair of lowest rank, found through a heap."""
        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1))
        nxt = [*range(1, n), -1]
        prv = [-1, *range(n - 1)]
        live = [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j >= 0:
                rank = ranks.get(raw[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not live[i] or nxt[i] < 0 or end[nxt[i]] != stop or raw[i:stop] not in ranks:
                continue
            j = nxt[i]
            live[j] = False
            end[i], nxt[i] = stop, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        out, i = [], 0
        while i >= 0:
            out.append(ranks[raw[i : end[i]]])
            i = nxt[i]
        return out

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        if self._pattern is None:
            self._pattern = regex.compile(PATTERN)
        find = self._pattern.findall
        pieces: list[str] = []
        counts = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                found = find(text)
                pieces += found
                counts[i + 1] = len(found)
        if not pieces:
            return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32)
        code, names = pd.factorize(np.array(pieces, dtype=object))
        slot = self.mph.slots(pd.util.hash_array(names, categorize=False))
        known = slot >= 0
        known[known] = self.names[slot[known]] == names[known]
        length = np.ones(len(names), np.int64)
        flat_ids = np.where(known, self.ids[np.maximum(slot, 0)], 0).astype(np.int32)
        memo, parts = self._memo, []
        misses = np.flatnonzero(~known)
        for k in misses:
            ids = memo.get(names[k])
            if ids is None:
                if len(memo) >= _MEMO:
                    memo.clear()
                ids = memo[names[k]] = self.merge(names[k].encode("utf-8"))
            parts.append(ids)
            length[k] = len(ids)
        start = np.zeros(len(names), np.int64)
        total = np.cumsum(length)
        start[1:] = total[:-1]
        table = np.empty(int(total[-1]), np.int32)
        table[start[known]] = flat_ids[known]
        for k, ids in zip(misses, parts):
            table[start[k] : start[k] + len(ids)] = ids
        each = length[code]
        ends = np.cumsum(each)
        at = np.arange(int(ends[-1]), dtype=np.int64) + np.repeat(start[code] - (ends - each), each)
        piece_ends = np.concatenate([[0], ends])
        return piece_ends[np.cumsum(counts)], table[at]


def _texts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of bounded text volume, so a batch of very long texts stays small in memory."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0)).astype(np.int64)
    total, at = np.cumsum(lengths), 0
    while at < len(lengths):
        base = total[at] - lengths[at]
        stop = max(at + 1, int(np.searchsorted(total, base + size, side="right")))
        part = batch.slice(at, stop - at)
        yield part, part.column("text").to_pylist()
        at = stop


def encode_documents(docs: DataFrame, vocab: str = DEFAULT_VOCAB, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id_col, ids array<int>). Repeated rows each give a row; a null id is kept."""
    import pyarrow.compute  # noqa: F401

    coder = docs.sparkSession.sparkContext.broadcast(BytePairEncoder(read_ranks(vocab)))
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        enc = coder.value
        for batch in batches:
            for part, texts in _texts(batch, 4 << 20):
                offsets, ids = enc.encode_batch(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "ids"])

    src = spread(docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text"))
    return src.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def token_counts(docs: DataFrame, vocab: str = DEFAULT_VOCAB, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id_col, n_tokens bigint); empty and null texts have 0 tokens."""
    coder = docs.sparkSession.sparkContext.broadcast(BytePairEncoder(read_ranks(vocab)))
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        enc = coder.value
        for batch in batches:
            for part, texts in _texts(batch, 4 << 20):
                offsets, _ = enc.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(offsets))], ["id", "n_tokens"])

    src = spread(docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text"))
    return src.mapInArrow(run, f"id {kind}, n_tokens bigint").withColumnRenamed("id", id_col)
