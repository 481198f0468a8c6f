"""Abusive, hateful or sexual content: scores of documents, offending spans, rates of sources.

A linear-chain conditional random field with the tags clean and toxic reads every sentence of every document. Its token
labels come from the labelled documents: sentences typical of the unfit ones are told apart from the rest by
rounds of sentence evidence, which also draw on unlabelled documents, and their tokens, trimmed of neutral ends, are toxic. Forward-backward
marginals give every token its probability; a document scores its strongest token, and the threshold is set on labels
held out of a first fit.

The field is trained on all labelled and all other documents, whole texts. Every step sums over all labelled documents
and one slice of the others; a round of steps passes through all slices. Up to ``SAMPLE`` labelled and ``2 * UNLABELLED``
other documents the sums are made in the driver, beyond in Spark, one job a step over packed tokens. Words are compared without accents, case,
look-alike letters, stretched letters, digits for letters and spaced-out spelling.

Defined results: null, empty and blank texts score 0 and are not found; a document without labels is scored like any
other; raters that disagree evenly leave a document out of the training; without labels of both kinds every score is
0; repeated rows each give a row; a null source forms its own group in the rates; extra columns are ignored.
"""

from __future__ import annotations

import gc
import os
import pickle
import re
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import cache, cached_property, lru_cache, partial
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.common import ensure_checkpoint_dir, materialise, spread
from docquarry.llm.scanned import plain
from docquarry.llm.splitting import WORD

#: Labelled documents up to which the driver fits, other documents of a slice (twice as many in the driver), feature buckets, features of a token and those of them that sentence evidence reads.
SAMPLE, UNLABELLED, BUCKETS, FEATURES, WORDS = 8_000, 5_000, 1 << 18, 7, 3
#: Every how manieth labelled document is held out for the threshold; how many of each kind that takes at least.
HELD, LEAST_HELD = 4, 10
#: Rounds of sentence evidence, steps of each; slices of the other documents at most; tasks of a step at most, tokens of a task at least.
ROUNDS, STEPS, SLICES, TASKS, TASK_TOKENS = 4, 20, 20, 64, 1 << 21
#: Documents and tokens at which a block of a task is written; documents of a file of blocks.
BLOCK_DOCS, BLOCK_TOKENS, FILE_DOCS = 1_000, 1 << 18, 50_000
#: Tokens of which the features are made at once; tokens of labelled blocks that a Python worker keeps (some 80 bytes each); tokens to which it joins other blocks.
CHUNK, KEPT_TOKENS, JOINED_TOKENS = 1 << 14, 1 << 20, 3 << 17
#: Labels are broadcast up to this count (16 bytes each), joined by shuffle beyond.
BROADCAST_LABELS = 1_000_000
#: Thresholds tried.
GRID = np.arange(2, 100) / 100
_U64 = np.uint64
_A, _B = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F)
#: Digits and signs written for letters.
_LEET = str.maketrans("0134578@$", "oieastbas")
_MARKS = re.compile("[\u0300-\u036f]")
_CODE = re.compile(r"[a-z]{2}-\d+")
_STRETCH = re.compile(r"(.)\1{2,}")
_SPACED = re.compile(r"\w(?:[.\-_*·]\w){3,}")
_EDGE = re.compile(r"^[^\w@$*]+|[^\w@$*]+$")
_ASCII_EDGE = "".join(c for c in map(chr, range(128)) if _EDGE.fullmatch(c))
_DIGIT, _JOINTS = re.compile("[0-9]"), frozenset(".-_*·")
_CLOSERS, _ENDS = "\"'”’)]", frozenset(".!?…")


def normal_word(word: str) -> str:
    """The form in which a word is compared; '' for what is no word."""
    if not word.isascii():
        return _normal(word)
    w = word.lower().strip(_ASCII_EDGE)
    if w.isalpha():
        return _STRETCH.sub(r"\1", w)
    digits, letters = _DIGIT.search(w) is not None, w.islower()
    return "#number" if digits and not letters and w[1:2] not in _JOINTS else _compared(w, digits, letters)


@lru_cache(1 << 16)
def _normal(word: str) -> str:
    w = plain(word).lower()
    if not w.isascii():
        w = _MARKS.sub("", unicodedata.normalize("NFD", w)).replace("đ", "d")
    w = _EDGE.sub("", w)
    return _compared(w, any(c.isdigit() for c in w), any(c.isalpha() for c in w))


def _compared(w: str, digits: bool, letters: bool) -> str:
    if w[2:3] == "-" and _CODE.fullmatch(w):
        return "#code"
    if w[1:2] in _JOINTS and _SPACED.fullmatch(w):
        return "~" + re.sub(r"[\W_]", "", w)
    if digits:
        if not letters:
            return "#number"
        w = w.translate(_LEET)
    return _STRETCH.sub(r"\1", w).replace("@", "a").replace("$", "s")


def _words(text: str) -> list[str]:
    """WORD.findall(text); str.split parts at the same signs and at four more."""
    return WORD.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


def _crossed(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    x = a + _U64(salt * int(_A) % (1 << 64))
    x ^= b
    x ^= x >> _U64(29)
    return x


@dataclass
class Tokens:
    doc: np.ndarray  # document of each token
    word: np.ndarray  # its number among the words of the document, from 0
    span: np.ndarray  # how many words it covers (spaced-out spelling covers several)
    sentence: np.ndarray  # running number of its sentence
    hash: np.ndarray

    @cached_property
    def feats(self) -> np.ndarray:
        """(FEATURES, tokens) buckets."""
        return _features(self.hash, self.sentence)


def read_tokens(texts: list[str | None]) -> Tokens:
    """The tokens of some documents with their features; sentences never cross documents."""
    flat: list[str] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            found = _words(text)
            counts[i] = len(found)
            flat += found
    code, names = pd.factorize(np.array(flat, dtype=object)) if flat else (np.zeros(0, np.int64), np.zeros(0, object))
    norm = np.array([normal_word(x) for x in names], dtype=object)
    ends = np.array([x.rstrip(_CLOSERS)[-1:] in _ENDS for x in names], bool)
    single = np.array([len(x) == 1 and x.isalpha() for x in norm], bool)
    doc = np.repeat(np.arange(len(texts)), counts)
    word = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    h = (pd.util.hash_array(norm, categorize=False) if len(norm) else np.zeros(0, _U64))[code]
    keep = (norm != "")[code] if len(norm) else np.zeros(0, bool)
    span = np.ones(len(code), np.int64)
    end = ends[code] if len(ends) else np.zeros(0, bool)
    lone = single[code] if len(single) else np.zeros(0, bool)
    if lone.any():  # runs of at least four single letters are one word spelled out
        change = np.flatnonzero(np.diff(np.concatenate([[False], lone, [False]]).astype(np.int8)))
        for a, b in zip(change[::2], change[1::2]):
            for lo, hi in _inside(doc, a, b) if b - a >= 4 else ():
                if hi - lo >= 4:
                    joined = "~" + "".join(norm[code[k]] for k in range(lo, hi))
                    h[lo] = pd.util.hash_array(np.array([joined], dtype=object), categorize=False)[0]
                    span[lo] = hi - lo
                    keep[lo + 1 : hi] = False
                    end[lo] = end[hi - 1]
    # A sentence boundary on a dropped word still counts.
    boundary = np.concatenate([[0], (end[:-1] | (doc[1:] != doc[:-1])).cumsum()]) if len(code) else np.zeros(0, np.int64)
    doc, word, span, sentence, h = (x[keep] for x in (doc, word, span, boundary, h))
    return Tokens(doc, word, span, sentence, h)


def _features(h: np.ndarray, sentence: np.ndarray, count: int = FEATURES) -> np.ndarray:
    """The first ``count`` features of every token; the first ``WORDS`` are those of sentence evidence."""
    n = len(h)
    out = np.empty((count, n), np.int64)
    for at in range(0, n, CHUNK):  # what is made on the way stays in the processor's cache
        low, high = max(0, at - 2), min(n, at + CHUNK + 2)
        _mixed(h[low:high], sentence[low:high], slice(at - low, min(n, at + CHUNK) - low), out[:, at : at + CHUNK])
    return out


def _mixed(h: np.ndarray, sentence: np.ndarray, rows: slice, out: np.ndarray) -> None:
    """Features of some rows. A mix of a and b is a * _A plus a number, crossed with b * _B, so the products are made once."""
    n = len(h)
    same = {k: sentence[k:] == sentence[: n - k] for k in (1, 2)}
    left, right = h * _A, h * _B

    def near(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, _U64)
        if k > 0:
            np.multiply(x[: n - k], same[k], out=out[k:])
        else:
            np.multiply(x[-k:], same[-k], out=out[:k])
        return out[rows]

    p1, own = near(left, 1), left[rows]
    p2r, ownr = near(right, 2), right[rows]
    pair = _crossed(near(left, 2), near(right, 1), 4)
    feats = [_crossed(own, ownr, 1), _crossed(p1, ownr, 2), _crossed(pair * _A, ownr, 5)]
    if len(out) > WORDS:
        n1r = near(right, -1)
        feats += [_crossed(own, n1r, 3), _crossed(_crossed(own, n1r, 6) * _A, near(right, -2), 7), _crossed(p1, n1r, 8), _crossed(p1, p2r, 9)]
    for row, x in zip(out, feats):
        np.bitwise_and(x, _U64(BUCKETS - 1), out=row.view(_U64))  # the remainder, as BUCKETS is a power of two


def _inside(doc: np.ndarray, a: int, b: int) -> list[tuple[int, int]]:
    cuts = [a, *(a + 1 + np.flatnonzero(np.diff(doc[a:b]))), b]
    return list(zip(cuts[:-1], cuts[1:]))


@dataclass
class Field:
    """Weights of the toxic tag per feature bucket, and start, stay and change scores of the chain."""

    weight: np.ndarray
    start: float = 0.0
    trans: np.ndarray = None  # (2, 2)
    threshold: float = 0.5

    def marginals(self, emit: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of the toxic tag per token, expected transitions (2, 2)) by forward-backward."""
        return self.passes(emit, *_runs(sentence))

    def passes(self, emit: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same over the sentences that begin at ``first``; other tokens get 0.

        With two tags, forward and backward scores are one number each: toxic over clean. Sentences are ordered by length, so
        those that reach a position are the first ones and nothing is padded.
        """
        prob = np.zeros(len(emit))
        if not len(first):
            return prob, np.zeros((2, 2))
        (cc, ct), (tc, tt) = np.exp(self.trans)
        odds = np.exp(np.clip(emit, -30, 30))
        order = np.argsort(-size, kind="stable")
        first = first[order]
        live = len(first) - np.cumsum(np.bincount(size))[:-1]  # sentences longer than each position
        at = first
        fwd, own = [np.exp(self.start) * odds[at]], [odds[at]]
        for n in live[1:]:
            at = at[:n] + 1
            o, r = odds[at], fwd[-1][:n]
            own.append(o)
            fwd.append(o * (ct + tt * r) / (cc + tc * r))
        moves = np.zeros(4)
        back = np.ones(live[-1])
        for t in range(len(live) - 1, -1, -1):
            r = fwd[t] * back
            prob[first[: live[t]] + t] = r / (1 + r)
            if t:
                ahead, before = own[t] * back, fwd[t - 1][: live[t]]
                clean, toxic = cc + ct * ahead, tc + tt * ahead
                part = 1 / (clean + before * toxic)
                mixed = before * part
                moves += cc * part.sum(), ct * (part * ahead).sum(), tc * mixed.sum(), tt * (mixed * ahead).sum()
                back = np.ones(live[t - 1])
                np.divide(toxic, clean, out=back[: live[t]])
        return prob, moves.reshape(2, 2)

    def emit(self, feats: np.ndarray) -> np.ndarray:
        return _summed(self.weight, feats)

    def read(self, tokens: Tokens) -> np.ndarray:
        return self.marginals(self.emit(tokens.feats), tokens.sentence)[0]


def _runs(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where every run of equal numbers begins, and its length."""
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else np.zeros(0, np.int64)
    return first, np.diff(first, append=len(number))


def _summed(weight: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """The sum of the weights of each token."""
    out = weight[feats[0]]
    for row in feats[1:]:
        out += weight[row]
    return out


@dataclass
class Block:
    """Some documents of the training: their tokens, labels (1, 0, -1 for none) and which labels are held out of the first fit."""

    hash: np.ndarray  # of every token
    sentence: np.ndarray  # numbered without gaps
    doc_of: np.ndarray  # document of every sentence
    label: np.ndarray
    held: np.ndarray
    memo: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.count = len(self.doc_of)
        self.first, self.size = _runs(self.sentence)
        self.root = np.sqrt(self.size)

    @staticmethod
    def read(texts: list[str | None], label: np.ndarray, held: np.ndarray) -> Block:
        t = read_tokens(texts)
        first, size = _runs(t.sentence)
        return Block(t.hash, np.repeat(np.arange(len(first)), size), t.doc[first], label, held)

    def part(self, a: int, b: int) -> Block:
        """Documents a to b (excluded)."""
        low, high = np.searchsorted(self.doc_of, [a, b])
        rows = slice(*np.searchsorted(self.sentence, [low, high]))
        return Block(self.hash[rows], self.sentence[rows] - low, self.doc_of[low:high] - a, self.label[a:b], self.held[a:b])

    @staticmethod
    def joined(parts: list[Block]) -> Block:
        docs, sentences = (np.cumsum([0, *n]) for n in ([len(x.label) for x in parts], [x.count for x in parts]))
        return Block(*(np.concatenate(x) for x in zip(*((x.hash, x.sentence + n, x.doc_of + k, x.label, x.held) for x, k, n in zip(parts, docs, sentences)))))

    @cached_property
    def words(self) -> np.ndarray:
        """The features of sentence evidence."""
        return self.feats[:WORDS] if "feats" in self.__dict__ else _features(self.hash, self.sentence, WORDS)

    @cached_property
    def feats(self) -> np.ndarray:
        return _features(self.hash, self.sentence)

    def scores(self, model: Field) -> np.ndarray:
        """The score of every document, as document_scores gives it."""
        score = np.zeros(len(self.label))
        if self.count:
            prob, _ = model.passes(model.emit(self.feats), self.first, self.size)
            np.maximum.at(score, self.doc_of, np.maximum.reduceat(prob, self.first))
        return score

    def seen(self, first: bool) -> np.ndarray:
        return np.where(self.held, -1, self.label) if first else self.label

    def pack(self) -> bytes:
        code, words = pd.factorize(self.hash)
        return pickle.dumps((words, code.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32), self.size.astype(np.int32), self.doc_of.astype(np.int32), self.label.astype(np.int8), self.held))

    @staticmethod
    def unpack(data: bytes) -> Block:
        words, code, size, doc_of, label, held = pickle.loads(data)
        return Block(words[code], np.repeat(np.arange(len(size)), size), doc_of.astype(np.int64), label.astype(np.int64), held)


class Held:
    """Blocks of the driver: those with labels and those of every slice of the other documents."""

    def __init__(self, labelled: list[Block], slices: list[list[Block]]):
        self.labelled, self.slices, self.n = labelled, slices, max(1, len(slices))

    def total(self, f: Callable[[Block], list], at: int | None) -> list:
        """The sums of f over the labelled blocks and those of one slice, or of all (None)."""
        others = self.slices if at is None else self.slices[at : at + 1]
        return _sum(f(b) for b in [*self.labelled, *(b for x in others for b in x)] if b.count)


@cache
def _settle() -> None:
    """Once per Python worker: what is loaded is left out of the garbage collection that follows every task."""
    gc.freeze()


#: Labelled blocks that this Python worker has read, of one fit: every step takes them, so features and aims are made once.
_KEPT: dict[tuple[str, bytes], Block] = {}


def _kept(data: bytes, fit: str) -> Block:
    if _KEPT and next(iter(_KEPT))[0] != fit:
        _KEPT.clear()
    key = fit, blake2b(data, digest_size=16).digest()
    block = _KEPT.get(key) or Block.unpack(data)
    if key not in _KEPT and sum(len(x.hash) for x in _KEPT.values()) + len(block.hash) <= KEPT_TOKENS:
        _KEPT[key] = block
    return block


def _joined(blocks: Iterator[tuple[Block, bool]]) -> Iterator[Block]:
    """Those marked as they are, the others joined to ``JOINED_TOKENS``: sums over small blocks cost twice as much a token."""
    waiting: list[Block] = []
    for block, alone in blocks:
        if alone:
            yield block
            continue
        waiting.append(block)
        if sum(len(x.hash) for x in waiting) >= JOINED_TOKENS:
            yield Block.joined(waiting)
            waiting = []
    if waiting:
        yield Block.joined(waiting)


class Spread:
    """The same over packed blocks in Parquet files, in a folder for the labelled (-1) and one for every slice."""

    def __init__(self, spark: SparkSession, path: str, n: int, kind: str):
        self.path, self.rows, self.n, self.kind = path, spark.read.schema(f"ids {kind}, data binary, tokens int, slice int").parquet(path), n, kind
        self.most = min(TASKS, max(1, spark.sparkContext.defaultParallelism))
        self.tokens = {r["slice"]: r["tokens"] for r in self.rows.groupBy("slice").agg(F.sum("tokens").alias("tokens")).collect()}

    def total(self, f: Callable[[Block], list], at: int | None) -> list:
        held, fit = self.rows.sparkSession.sparkContext.broadcast(f), self.path

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _settle()
            rows = ((x, k.as_py()) for batch in batches for x, k in zip(batch.column("data"), batch.column("slice")))
            out = _sum(held.value(b) for b in _joined((_kept(x.as_py(), fit), True) if k < 0 else (Block.unpack(x.as_buffer()), False) for x, k in rows) if b.count)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(out)], pa.binary())], ["sums"])

        rows = self.rows if at is None else self.rows.where(F.col("slice").isin(-1, at))
        tokens = sum(n for k, n in self.tokens.items() if at is None or k in (-1, at))
        tasks = min(self.most, 1 + tokens // TASK_TOKENS)  # the sums that a task sends are as large for few tokens as for many
        try:
            parts = rows.select("data", "slice").coalesce(tasks).mapInArrow(run, "sums binary").toArrow()["sums"]
        finally:
            held.destroy()  # else every step leaves its weights on every disk
        return _sum(y for x in parts if (y := pickle.loads(x.as_buffer())))


    def found(self, model: Field) -> DataFrame:
        """(id) of the unfit documents of the slices, one row for each of their rows."""
        held = self.rows.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ids, data in zip(batch.column("ids"), batch.column("data")):
                    score = Block.unpack(data.as_buffer()).scores(held.value)
                    yield pa.RecordBatch.from_arrays([ids.values.filter(pa.array(score >= held.value.threshold))], ["id"])

        return self.rows.where("slice >= 0").select("ids", "data").mapInArrow(run, f"id {self.kind[6:-1]}")


def _sum(parts: Iterator[list]) -> list:
    """The sums of lists of numbers and arrays; the arrays of the first are added to."""
    out: list = []
    for part in parts:
        if not out:
            out = part
            continue
        for k, x in enumerate(part):
            out[k] += x
    return out


def _paired(values: list[np.ndarray]) -> np.ndarray:
    """One array for one or two: two travel as a complex one, so that both are gathered or added up in one go."""
    return values[0] if len(values) == 1 else values[0] + 1j * values[1]


def _parts(values: np.ndarray) -> list[np.ndarray]:
    return [values.real, values.imag] if np.iscomplexobj(values) else [values]


@dataclass
class Evidence:
    """The logistic model of sentences: its present weights, and the round and weights that set what it is fitted to."""

    first: bool  # without the held labels
    share: float
    weight: np.ndarray = None
    bias: float = -3.0
    past: tuple[int, np.ndarray, float] | None = None
    tables: dict = field(default_factory=dict)  # weights of this and the next model, paired

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": {}}

    @property
    def aim(self) -> tuple:
        """What the aims depend on, besides the block."""
        return self.first, self.share, *(() if self.past is None else self.past[::2])


def _chances(models: list[Evidence], block: Block, past: bool) -> list[np.ndarray]:
    """The chance of every sentence, by the present or the past weights of every model."""
    weights = [m.past[1] if past else m.weight for m in models]
    kept = models[0].tables.get(past)
    if not kept or any(x is not y for x, y in zip(kept[0], weights)):
        kept = models[0].tables[past] = weights, _paired(weights)
    raw = np.add.reduceat(_summed(kept[1], block.words), block.first) / block.root
    return [1 / (1 + np.exp(-np.clip(x + (m.past[2] if past else m.bias), -30, 30))) for m, x in zip(models, _parts(raw))]


def _aims(models: list[Evidence], block: Block) -> list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(goal, mass, chance) for every model: the tag a sentence is fitted to, its weight, its chance when these were set."""
    now = [m.aim for m in models]
    kept = block.memo.get("aims")
    if kept and kept[0] == now:
        return kept[1]
    chances = [None] * len(models) if models[0].past is None else _chances(models, block, True)
    out = [_aim(m, block, x) for m, x in zip(models, chances)]
    block.memo["aims"] = now, out
    return out


def _aim(model: Evidence, block: Block, chance: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    label = block.seen(model.first)
    kind, other = label[block.doc_of], 0.3
    if chance is None:
        per_doc = np.bincount(block.doc_of, minlength=len(label)).astype(float)
        return (kind == 1).astype(float), np.where(kind == 1, model.share / per_doc[block.doc_of], np.where(kind == 0, 1.0, other)), None
    turn = model.past[0]
    best = np.zeros(len(label))
    np.maximum.at(best, block.doc_of, chance)
    likely = (kind == 1) & (chance >= np.minimum(0.5, 0.7 * best[block.doc_of])) & (chance > (0.15 if turn == 0 else 0.25))
    found = (kind == -1) & (chance > (0.3 if turn == 0 else 0.6))
    goal = np.where(likely | (found if turn > 0 else False), 1.0, 0.0)
    mass = np.where(likely, 2.0, np.where(kind == 1, 0.3, np.where(kind == 0, 1.0, other)))
    mass[found & (turn == 0)] = 0
    mass[(kind == -1) & ~found & (chance > 0.2)] = 0
    return goal, mass, chance


def _tags(models: list[Evidence], block: Block) -> list[np.ndarray]:
    """The tag of every token for every model: 1 toxic, 0 clean, -1 unclear."""
    now = [(m.aim, m.bias) for m in models]
    kept = block.memo.get("tags")
    if kept and kept[0] == now:
        return kept[1]
    out = [_tag(m, block, goal, chance) for m, (goal, _, chance) in zip(models, _aims(models, block))]
    block.memo["tags"] = now, out
    return out


def _tag(model: Evidence, block: Block, goal: np.ndarray, chance: np.ndarray) -> np.ndarray:
    state = np.where(goal == 1, 1, np.where((chance > 0.2) & (block.seen(model.first)[block.doc_of] != 0), -1, 0))
    tag = np.repeat(np.where(state == -1, -1, 0).astype(np.int8), block.size)
    rows = np.flatnonzero(np.repeat(state == 1, block.size))
    if len(rows):  # from the first to the last token that speaks clearly for toxic
        value, own = _summed(model.weight, block.words[:, rows]), block.sentence[rows]
        peak = np.zeros(block.count)
        np.maximum.at(peak, own, value)
        strong = value > 0.35 * peak[own]
        low, high = np.full(block.count, len(tag)), np.full(block.count, -1)
        np.minimum.at(low, own[strong], rows[strong])
        np.maximum.at(high, own[strong], rows[strong])
        tag[rows[(rows >= low[own]) & (rows <= high[own])]] = 1
    return tag


def _scattered(feats: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The sum of the values of the tokens of every bucket."""
    out = np.zeros(BUCKETS, value.dtype)
    for row in feats:
        np.add.at(out, row, value)
    return out


def _unfit(kinds: list[bool], block: Block) -> list:
    return [float((block.seen(k) == 1).sum()) for k in kinds]


def _sentences(block: Block) -> list:
    return [float(block.count)]


def _labels(block: Block) -> list:
    return [int(((block.label == k) & (block.held == h)).sum()) for k in (0, 1) for h in (False, True)]


def _evidence_step(models: list[Evidence], block: Block) -> list:
    errors = [(goal - p) * mass for p, (goal, mass, _) in zip(_chances(models, block, False), _aims(models, block))]
    grads = _parts(_scattered(block.words, np.repeat(_paired(errors) / block.root, block.size)))
    return [x for grad, error in zip(grads, errors) for x in (grad, error.sum())]


def _sentence_evidence(blocks: Held | Spread, kinds: list[bool]) -> list[Evidence]:
    """A model of sentences for every kind of fit, from labels of documents.

    Multiple-instance learning: a logistic model over the words and word groups of sentences sees the sentences of unfit
    documents as positive (each document counts once) and all others as negative, unlabelled ones at a lower weight.
    After every round an unfit document keeps only its likely sentences, and unlabelled sentences that look toxic
    leave the negatives.
    """
    unfit = blocks.total(partial(_unfit, kinds), 0)
    models = [Evidence(k, float(np.clip(np.sqrt(600 / max(1, n)), 1.0, 3.0))) for k, n in zip(kinds, unfit)]  # few labels weigh more
    step = 0
    for turn in range(ROUNDS):
        total, bias = [np.full(BUCKETS, 1e-6) for _ in models], [1e-6] * len(models)
        for m in models:
            m.weight, m.bias = np.zeros(BUCKETS), -3.0
        for turn_step in range(STEPS):
            sums = blocks.total(partial(_evidence_step, models), step % blocks.n)
            step += 1
            for k, m in enumerate(models):
                last = turn, m.weight, m.bias
                grad, error = sums[2 * k] - 0.02 * m.weight, float(sums[2 * k + 1])
                total[k] = total[k] + grad * grad
                m.weight = m.weight + 0.3 * grad / np.sqrt(total[k])
                bias[k] += error**2
                m.bias += 0.3 * error / bias[k] ** 0.5
                if turn_step == STEPS - 1:
                    m.past = last
    return models


def _chain_errors(block: Block, tag: np.ndarray, chain: Field, emit: np.ndarray, part: int, parts: int) -> list:
    """(errors of the tokens, transitions, start, tokens): what the gradient of the likelihood takes, over the toxic sentences and every n-th clean one."""
    toxic, vague = np.zeros((2, block.count), bool)
    ones = np.flatnonzero(tag == 1)
    toxic[block.sentence[ones]] = True
    vague[block.sentence[tag == -1]] = True
    use = toxic | (~vague & (np.arange(block.count) % parts == part))
    first, size = block.first[use], block.size[use]
    prob, moves = chain.passes(emit, first, size)
    starts, ends = (np.zeros(len(tag), bool) for _ in range(2))
    starts[block.first] = ends[block.first + block.size - 1] = True
    inside = ones[~ends[ones]]
    both = int((tag[inside + 1] == 1).sum())
    to, out = int((~starts[ones]).sum()) - both, len(inside) - both
    seen = np.array([[int((size - 1).sum()) - both - to - out, to], [out, both]])
    error = -prob  # 0 in sentences not used
    error[ones] += 1
    return [error, seen - moves, float(error[first].sum()), int(size.sum())]


def _chain_step(models: list[Evidence], chains: list[Field], weight: np.ndarray, part: int, parts: int, block: Block) -> list:
    """weight: those of all chains."""
    emits = _parts(_summed(weight, block.feats))
    out = [_chain_errors(block, tag, c, e, part, parts) for tag, c, e in zip(_tags(models, block), chains, emits)]
    grads = _parts(_scattered(block.feats, _paired([x[0] for x in out])))
    return [y for grad, x in zip(grads, out) for y in (grad, *x[1:])]


def _fit(blocks: Held | Spread, kinds: list[bool], epochs: int, rate: float, decay: float, clean: int) -> list[Field]:
    """A field for every kind of fit. A step takes about ``clean`` clean sentences if there are few slices, so that all are seen."""
    models = _sentence_evidence(blocks, kinds)
    counted = blocks.total(_sentences, 0)
    parts = int(np.clip(counted[0] // clean, 1, max(1, epochs // blocks.n)))
    chains = [Field(np.zeros(BUCKETS), -3.0, np.array([[1.0, -2.0], [-1.0, 1.0]])) for _ in kinds]
    total, step_t, step_s = [np.zeros(BUCKETS) for _ in kinds], [np.zeros((2, 2)) for _ in kinds], [0.0] * len(kinds)
    for step in range(epochs):
        part = step // blocks.n % parts
        bare = [replace(c, weight=None) for c in chains]
        sums = blocks.total(partial(_chain_step, models, bare, _paired([c.weight for c in chains]), part, parts), step % blocks.n)
        for k, c in enumerate(chains):
            grad, g, s, n = sums[4 * k : 4 * k + 4]
            grad = grad - decay * n * c.weight / 100
            total[k] += grad * grad
            c.weight = c.weight + rate * grad / np.sqrt(total[k] + 1e-8)
            step_t[k] += g * g
            c.trans = c.trans + 0.2 * g / np.sqrt(step_t[k] + 1e-8)
            step_s[k] += s * s
            c.start += 0.2 * s / (step_s[k] + 1e-8) ** 0.5
    return chains


def _reached(chain: Field, block: Block) -> list:
    """How many held-out unfit, held-out fit and unlabelled documents of a block there are, and how many of each reach every threshold."""
    score = block.scores(chain)
    out = []
    for mine in (block.held & (block.label == 1), block.held & (block.label == 0), block.label == -1):
        out += [int(mine.sum()), (score[mine][:, None] >= GRID).sum(axis=0)]
    return out


def train(texts: list[str], label: list[int], epochs: int = 30, rate: float = 0.4, decay: float = 2e-4, clean: int = 20_000) -> Field:
    """Fit the field by batch gradient of the likelihood with adaptive steps.

    The threshold of the scores comes from a first fit without the labels of every ``HELD``-th document of each kind and
    from the scores it gives to all unlabelled documents; the field itself is fitted on all labels. label: 1 unfit, 0 fit,
    -1 not labelled. Clean sentences take turns where there are more than ``clean``.
    """
    label = np.array(label, np.int64)
    held = np.zeros(len(label), bool)
    for kind in (0, 1):
        held[np.random.default_rng(5 + kind).permutation(np.flatnonzero(label == kind))[::HELD]] = True

    def blocks(rows: np.ndarray) -> list[Block]:
        return [Block.read([texts[i] for i in at], label[at], held[at]) for at in np.array_split(rows, -(-len(rows) // 3000)) if len(at)] if len(rows) else []

    rest = np.flatnonzero(label == -1)
    n = slice_count(len(rest))
    return _trained(Held(blocks(np.flatnonzero(label >= 0)), [blocks(rest[k::n]) for k in range(n)]), epochs, rate, decay, clean)


def slice_count(unlabelled: int) -> int:
    return int(np.clip(unlabelled // UNLABELLED, 1, SLICES))


def _trained(blocks: Held | Spread, epochs: int = 30, rate: float = 0.4, decay: float = 2e-4, clean: int = 20_000) -> Field:
    counts = blocks.total(_labels, 0)
    fit, held_fit, unfit, held_unfit = counts or [0] * 4
    if not fit + held_fit or not unfit + held_unfit:
        return Field(np.zeros(BUCKETS), -30.0, np.array([[0.0, -30.0], [0.0, 0.0]]), 1.1)
    two = min(held_fit, held_unfit) >= LEAST_HELD and min(fit, unfit) > 0
    *first, chain = _fit(blocks, [True, False] if two else [False], epochs, rate, decay, clean)
    if first:
        chain.threshold = _best_threshold(*blocks.total(partial(_reached, first[0]), None))
    return chain


def document_scores(tokens: Tokens, prob: np.ndarray, n: int) -> np.ndarray:
    """Score of each document: the highest marginal of any of its tokens, so the length of a sentence plays no part."""
    out = np.zeros(n)
    first, _ = _runs(tokens.doc)
    if len(first):
        out[tokens.doc[first]] = np.maximum.reduceat(prob, first)
    return out


def held_out_threshold(score: np.ndarray, unfit: np.ndarray, other: np.ndarray | None = None) -> float:
    """The score with the best F1, estimated from labelled documents kept out of the fit and from unlabelled ones.

    Unfit documents may be labelled more often than others, so the labels give only the share of unfit documents that reach
    a score; what share of all documents reaches it comes from ``other`` (the held-out ones if empty), and so does the
    share of unfit ones: those at 0.5 or more over the share of unfit documents found there. Of thresholds within one
    standard error of the best the middle one is taken; 0.5 where fewer than ``LEAST_HELD`` are unfit or fit.
    """
    reach, over, flagged = ((score_of[:, None] >= GRID).sum(axis=0) for score_of in (score[unfit], score[~unfit], np.zeros(0) if other is None else other))
    return _best_threshold(int(unfit.sum()), reach, int((~unfit).sum()), over, 0 if other is None else len(other), flagged)


def _best_threshold(n: int, reach: np.ndarray, fit: int, over: np.ndarray, others: int, flagged: np.ndarray) -> float:
    """The same from numbers of documents, and of those at each threshold of the grid or above."""
    if min(n, fit) < LEAST_HELD:
        return 0.5
    labelled = (reach + over) / (n + fit)
    reach, share = reach / n, n / (n + fit)
    if others:
        flagged = flagged / others
        half = int(np.searchsorted(GRID, 0.5))
        share = min(share, flagged[half] / reach[half]) if reach[half] else share
    else:
        flagged = labelled
    f1 = 2 * share * reach / (share + flagged)
    best = int(np.argmax(f1))
    error = 2 * share / (share + flagged[best]) * (reach[best] * (1 - reach[best]) / n) ** 0.5
    return round(float(np.median(GRID[f1 >= f1[best] - error - 1e-9])), 3)


def fit_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> Field:
    """The field trained on the whole texts of all documents; in the driver up to ``sample`` labelled and ``2 * unlabelled`` others."""
    return _fitted(docs, labels, id_col, text_col, sample, unlabelled, False)[0]


def _fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int, unlabelled: int, find: bool) -> tuple[Field, DataFrame, DataFrame | None]:
    """(the field, ids with labels of both or either kind, ids of the unfit rows without labels if asked for and fitted in Spark)."""
    spark = docs.sparkSession
    votes = labels.where(F.col(id_col).isNotNull() & F.col("unfit").isNotNull()).groupBy(id_col).agg(F.avg("unfit").alias("share")).where("share <> 0.5")
    votes = votes.select(id_col, (F.col("share") > 0.5).cast("int").alias("label"))
    rows = docs.select(id_col, F.col(text_col).alias("text")).where("text IS NOT NULL")
    count, marked = docs.count(), votes.count()
    if marked <= BROADCAST_LABELS:
        votes = F.broadcast(votes)
    known = rows.join(votes, id_col).dropDuplicates([id_col])
    if marked <= sample and count <= 2 * unlabelled + marked:
        other = rows.join(votes, id_col, "left_anti")
        table = known.select(id_col, "text", "label").unionByName(other.select(id_col, "text", F.lit(-1).alias("label"))).toArrow().sort_by([(id_col, "ascending"), ("text", "ascending")])
        return train(table["text"].to_pylist(), table["label"].to_pylist()), votes, None
    n = int(np.clip(count // unlabelled, 1, SLICES))
    held = F.pmod(F.xxhash64(id_col, F.lit(5)), F.lit(HELD)) == 0
    ids = F.col(id_col).alias("id")
    known = known.select(ids, "text", "label", held.alias("held"), F.lit(-1).alias("slice"))
    other = spread(rows).join(votes, id_col, "left_anti").select(ids, "text", F.lit(-1).alias("label"), F.lit(False).alias("held"), F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(n)).cast("int").alias("slice"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[Block, pa.Array]]] = {}

        def packed(k: int) -> pa.RecordBatch:
            blocks, ids = zip(*waiting.pop(k))
            block, own = Block.joined(blocks), pa.concat_arrays(ids)
            own = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            return pa.RecordBatch.from_arrays([own, pa.array([block.pack()], pa.binary()), pa.array([len(block.hash)], pa.int32()), pa.array([k], pa.int32())], ["ids", "data", "tokens", "slice"])

        for batch in batches:
            order = np.argsort(batch.column("slice").to_numpy(), kind="stable")
            for at in np.array_split(order, max(1, -(-len(order) // BLOCK_DOCS))):
                some = batch.take(pa.array(at))
                own = some.column("slice").to_numpy()
                block = Block.read(some.column("text").to_pylist(), some.column("label").to_numpy().astype(np.int64), some.column("held").to_numpy(zero_copy_only=False))
                for k in np.unique(own).tolist():
                    parts = waiting.setdefault(k, [])
                    a, b = np.searchsorted(own, [k, k + 1]).tolist()
                    parts.append((block.part(a, b), some.column("id").slice(a, b - a)))
                    if sum(len(x.label) for x, _ in parts) >= BLOCK_DOCS or sum(len(x.hash) for x, _ in parts) >= BLOCK_TOKENS:
                        yield packed(k)
        for k in list(waiting):
            yield packed(k)

    folder = os.path.join(ensure_checkpoint_dir(spark), f"blocks-{uuid.uuid4()}")
    kind = f"array<{dict(docs.dtypes)[id_col]}>"
    try:
        files = F.pmod(F.xxhash64("data"), F.lit(1 + count // n // FILE_DOCS))  # every step opens all files of its slice, so few
        known.unionByName(other).mapInArrow(pack, f"ids {kind}, data binary, tokens int, slice int").repartition("slice", files).write.option("compression", "uncompressed").partitionBy("slice").parquet(folder)
        blocks = Spread(spark, folder, n, kind)
        field = _trained(blocks)
        return field, votes, materialise(blocks.found(field).withColumnRenamed("id", id_col)) if find else None
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def save_field(spark: SparkSession, field: Field, path: str) -> None:
    """Write a fitted field as a table of its weights that are not 0, so that it is fitted once and used by many jobs."""
    at = np.flatnonzero(field.weight)
    rows = pd.DataFrame({"bucket": at, "value": field.weight[at]})
    scalars = [field.start, *field.trans.ravel(), field.threshold]
    rows = pd.concat([rows, pd.DataFrame({"bucket": -1 - np.arange(len(scalars)), "value": scalars})])
    spark.createDataFrame(rows.astype({"bucket": "int64", "value": "float64"})).coalesce(1).write.mode("overwrite").parquet(path)


def load_field(spark: SparkSession, path: str) -> Field:
    table = spark.read.parquet(path).toArrow()
    at, value = table["bucket"].to_numpy(), table["value"].to_numpy()
    weight = np.zeros(BUCKETS)
    weight[at[at >= 0]] = value[at >= 0]
    scalars = value[at < 0][np.argsort(-at[at < 0])]
    return Field(weight, float(scalars[0]), scalars[1:5].reshape(2, 2), float(scalars[5]))


def score_documents(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), sample: int = SAMPLE, field: Field | None = None) -> DataFrame:
    """(id_col, *carry, score, unfit, spans): spans are (start, end) code point offsets of the offending stretches.

    A field fitted before is used as it is; then labels are not needed.
    """
    kinds = dict(docs.dtypes)
    field = docs.sparkSession.sparkContext.broadcast(field or fit_field(docs, labels, id_col, text_col, sample))
    names = ["id", *(f"c{i}" for i in range(len(carry)))]
    src = spread(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = field.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = batch.column("text").to_pylist()
                tokens = read_tokens(texts)
                prob = model.read(tokens)
                score = document_scores(tokens, prob, len(texts))
                unfit = score >= model.threshold
                spans: list[list[dict]] = [[] for _ in texts]
                if unfit.any():
                    for k in np.flatnonzero((prob >= np.minimum(0.5, score[tokens.doc])) & unfit[tokens.doc]):
                        d = tokens.doc[k]
                        spans[d].append((int(tokens.word[k]), int(tokens.word[k] + tokens.span[k])))
                    for d in np.flatnonzero(unfit):
                        places = [m.span() for m in WORD.finditer(texts[d])]
                        merged: list[list[int]] = []
                        for a, b in spans[d]:
                            if merged and a <= merged[-1][1]:
                                merged[-1][1] = b
                            else:
                                merged.append([a, b])
                        spans[d] = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in merged]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.round(score, 6)), pa.array(unfit), pa.array(spans, kind)], [*names, "score", "unfit", "spans"])

    schema = ", ".join([f"id {kinds[id_col]}", *(f"c{i} {kinds[c]}" for i, c in enumerate(carry)), "score double, unfit boolean, spans array<struct<start:int,end:int>>"])
    out = src.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "score", "unfit", "spans")


def found_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> DataFrame:
    """(id_col) of the documents that score_documents finds unfit, each once.

    After a fit in Spark the documents without labels are scored from the tokens that the fit has read.
    """
    field, votes, found = _fitted(docs, labels, id_col, text_col, sample, unlabelled, True)
    rest = docs if found is None else docs.join(votes, id_col, "left_semi")
    out = score_documents(rest, None, id_col, text_col, field=field).where("unfit").select(id_col)
    return (out if found is None else out.unionByName(found)).distinct()


def source_rates(docs: DataFrame, labels: DataFrame | None, source_col: str = "source", **options) -> DataFrame:
    """(source, n_documents, n_unfit, rate) of every source; counts are combined before the shuffle."""
    scored = score_documents(docs, labels, carry=(source_col,), **options)
    out = scored.groupBy(source_col).agg(F.count("*").alias("n_documents"), F.count_if("unfit").alias("n_unfit"))
    return out.withColumn("rate", F.round(F.col("n_unfit") / F.col("n_documents"), 6))
