"""Repairing text of scanned pages: page furniture, words cut across lines, misread characters.

A vocabulary of the pages that were not scanned goes into a trie of flat arrays. For every unknown word all vocabulary
words whose accepted cost of known confusions and other edits explains it are found by weighted Levenshtein automata
that run along the trie, all words of a batch together (complete: no blocking, no sampling); they are ranked by how well
known confusions explain the difference, then by the neighbouring words, then by frequency. Running lines are found at
page edges, by page-number forms and by what recurs at the edges of a report's pages, also where it is itself misread.
The rest is joined into paragraphs.

The vocabulary and the word pairs hold what was seen at least ``LEAST`` times, whatever the size of the corpus. Up to
``BROADCAST_WORDS`` words and ``BROADCAST_PAIRS`` pairs are sent to the workers. A larger vocabulary is cut into parts by
a hash of the word, each with a trie of its own; the words the pages ask for meet every part in blocks, and the pages get
their answers by joins: the same findings, with memory bounded by the part. Edge lines recur in a report from
``max(3, 2 %)`` of its pages, or from 3 pages of any 100 consecutive page numbers aligned to ``WINDOW``, however long the
report; the latter hold for pages of those numbers.

Defined results: null and empty texts give no findings and a null or empty repaired text; pages of reports that were
not scanned are left out; a null source is never a scanned report; repeated rows each give their rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.common import materialise, small, spread
from docquarry.llm.boilerplate import INVISIBLE
from docquarry.llm.visual import _translation

#: How often words and word pairs of the vocabulary are seen at least.
LEAST = 3
#: Words (about 50 bytes each in a worker) and pairs (16 bytes) broadcast at most; words of a part and of a block beyond.
BROADCAST_WORDS, BROADCAST_PAIRS, PART = 1_000_000, 8_000_000, 200_000
#: Accepted cost of a misread word, and of one holding other characters than letters.
ACCEPT, ACCEPT_ODD = 0.8, 1.3
#: Half the page numbers within which an edge line recurs; pages of a window that have to show it.
WINDOW, RECURS = 50, 3
_U64 = np.uint64
#: What a letter or digit group is misread as by character recognition, read -> true.
CONFUSIONS = {
    "ri": "n", "li": "h", "ii": "u", "cl": "d", "rn": "m", "vv": "w", "u'": "ư", "o'": "ơ", "c": "e", "f": "t", "l": "it1", "@": "a", "9": "g", "0": "o", "5": "s", "1": "li",
    "6": "b", "8": "b", "å": "ảạáàãấầẩẫậắằẳẵặ", "ẹ^": "ệ", "e^": "ê", "a^": "â", "o^": "ô", "|": "li", "\ufffd": "?",
}
#: Letters that stand where a digit was read.
DIGITS = {"O": "0", "o": "0", "l": "1", "I": "1", "|": "1", "S": "5", "s": "5", "b": "6", "B": "8", "g": "9", "q": "9", "Z": "2", "z": "2"}
HYPHENS = "-\u00ad\u2010\u2011¬"
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_CUT = re.compile(rf"[^\W\d_]['’]?[{HYPHENS}][ \t]*$")
_TRANSLATE = str.maketrans(*_translation())
_HIDDEN = re.compile(f"[{INVISIBLE}]")
_CORE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[(+-]?\d[\d.,/:%-]*\)?|[A-Z]{2,4}-\d+")
_FIGURE = re.compile(r"[\dOolISsbBgqZz.,/%-]+")
_CODE = re.compile(r"[A-Z]{2,3}-[\dOolISsbBgqZz]+")


def plain(text: str) -> str:
    """Look-alikes, compatibility forms and invisible characters undone (a soft hyphen at a line end stays)."""
    if text.isascii():
        return text
    text = re.sub("\u00ad(?=[ \t]*(\n|$))", "\u2010", text)
    return unicodedata.normalize("NFC", _HIDDEN.sub("", text.replace("\ufeff", "")).translate(_TRANSLATE))


class Trie:
    """A trie in flat arrays, searched by Levenshtein automata weighted by known confusions.

    Nodes are numbered level by level, so the children of a node lie side by side. The states of an automaton are rows of
    costs in quarters; all asked words of one length move down the trie together.
    """

    def __init__(self, words: list[str]):
        self.words = words = sorted(words)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points)
        size = np.array([len(x) for x in words], np.int64)
        letters = np.zeros((len(words), int(size.max()) if len(words) else 0), np.uint16)
        row = np.repeat(np.arange(len(words)), size)
        letters[row, np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)] = np.searchsorted(self.alphabet, points)
        node = np.zeros(len(words), np.int64)
        parents, labels, total = [], [np.zeros(1, np.uint16)], 1
        for depth in range(letters.shape[1]):
            at = np.flatnonzero(size > depth)
            above, letter = node[at], letters[at, depth]
            fresh = np.ones(len(at), bool)
            fresh[1:] = (above[1:] != above[:-1]) | (letter[1:] != letter[:-1])
            node[at] = total + np.cumsum(fresh) - 1
            parents.append(above[fresh])
            labels.append(letter[fresh])
            total += int(fresh.sum())
        parent = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        self.label = np.concatenate(labels)
        self.first = np.searchsorted(parent, np.arange(total + 1)).astype(np.int32) + 1
        self.ends = np.full(total, -1, np.int32)
        self.ends[node] = np.arange(len(words))

    def _costs(self, asked: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(letter of each place, its costs by true letter, double letter ending at each place, costs of doubles)."""
        chars = sorted(set("".join(asked)))
        code = {chr(c): i for i, c in enumerate(self.alphabet)}
        single = np.full((len(chars), len(self.alphabet)), 4, np.int16)
        for i, c in enumerate(chars):
            if c == "\ufffd":
                single[i] = 1
            single[i, [code[x] for x in CONFUSIONS.get(c, "") if x in code]] = 1
            if c in code:
                single[i, code[c]] = 0
        pairs = [x for x in CONFUSIONS if len(x) == 2]
        double = np.full((len(pairs) + 1, len(self.alphabet)), 1000, np.int16)
        for i, x in enumerate(pairs, 1):
            double[i, [code[t] for t in CONFUSIONS[x] if t in code]] = 1
        place = {c: i for i, c in enumerate(chars)}
        read = np.array([[place[c] for c in w] for w in asked], np.int32)
        two = np.array([[0, *(pairs.index(w[j : j + 2]) + 1 if w[j : j + 2] in pairs else 0 for j in range(len(w) - 1))] for w in asked], np.int32)
        return read, single, two, double

    def misread(self, asked: list[str], limits: list[float]) -> list[list[tuple[str, float]]]:
        """Of every asked word all (vocabulary word, ``confusion_cost``) of at most its limit."""
        out: list[list[tuple[str, float]]] = [[] for _ in asked]
        size = np.array([len(x) for x in asked], np.int64)
        for n in np.unique(size) if len(self.words) else ():
            mine = np.flatnonzero(size == n)
            for a in range(0, len(mine), 512) if n else ():
                self._search(mine[a : a + 512], [asked[i] for i in mine[a : a + 512]], np.floor(np.array([limits[i] for i in mine[a : a + 512]]) * 4 + 1e-9), out)
        return out

    def _search(self, names: np.ndarray, asked: list[str], limit: np.ndarray, out: list) -> None:
        read, single, two, double = self._costs(asked)
        n = read.shape[1]
        who, node = np.arange(len(asked)), np.zeros(len(asked), np.int64)
        rows = np.tile(4 * np.arange(n + 1, dtype=np.int16), (len(asked), 1))
        while len(who):
            count = self.first[node + 1] - self.first[node]
            up = np.repeat(np.arange(len(who)), count)
            child = self.first[node][up] + np.arange(len(up)) - np.repeat(np.cumsum(count) - count, count)
            letter, who, old = self.label[child], who[up], rows[up]
            new = np.empty_like(old)
            new[:, 0] = old[:, 0] + 4
            for j in range(1, n + 1):
                cost = old[:, j - 1] + single[read[who, j - 1], letter]
                if j > 1 and two[:, j - 1].any():
                    cost = np.minimum(cost, old[:, j - 2] + double[two[who, j - 1], letter])
                new[:, j] = np.minimum(np.minimum(cost, old[:, j] + 4), new[:, j - 1] + 4)
            for i in np.flatnonzero((self.ends[child] >= 0) & (new[:, n] <= limit[who])):
                out[names[who[i]]].append((self.words[self.ends[child[i]]], float(new[i, n]) / 4))
            live = new.min(axis=1) <= limit[who]
            who, node, rows = who[live], child[live], new[live]


def confusion_cost(read: str, true: str) -> float:
    """Edits that turn ``true`` into ``read``, where a known confusion costs 0.25 and any other edit 1."""
    n, m = len(read), len(true)
    best = [[1e9] * (m + 1) for _ in range(n + 1)]
    best[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            here = best[i][j]
            if here >= 1e9:
                continue
            if i < n and j < m:
                step = 0.0 if read[i] == true[j] else 0.25 if true[j] in CONFUSIONS.get(read[i], "") or read[i] == "\ufffd" else 1.0
                best[i + 1][j + 1] = min(best[i + 1][j + 1], here + step)
            if i + 1 < n and j < m and true[j] in CONFUSIONS.get(read[i : i + 2], ""):
                best[i + 2][j + 1] = min(best[i + 2][j + 1], here + 0.25)
            if i < n:
                best[i + 1][j] = min(best[i + 1][j], here + 1)
            if j < m:
                best[i][j + 1] = min(best[i][j + 1], here + 1)
    return best[n][m]


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _U64(0x9E3779B97F4A7C15) + (b ^ (b >> _U64(29))) * _U64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> _U64(31))).view(np.int64)


def _count_words(with_pairs: bool):
    """Word counts and hashed word-pair counts, combined in the task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                words: list[str] = []
                for text in whole.column("text").slice(at, 2048).to_pylist():
                    if text:
                        words += _WORD.findall(plain(text).lower())
                        words.append("")
                if not words:
                    continue
                if not with_pairs:
                    count = {w: n for w, n in Counter(words).items() if 0 < len(w) <= 40}
                    yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(np.zeros(len(count), np.int64)), pa.array(list(count.values()), pa.int64())], ["word", "pair", "n"])
                    continue
                code, names = pd.factorize(np.array(words, dtype=object))
                n = np.bincount(code)
                h = pd.util.hash_array(names, categorize=False)
                keep = np.array([0 < len(x) <= 40 for x in names])
                inside = (keep[code[:-1]] & keep[code[1:]]) if len(code) > 1 else np.zeros(0, bool)
                pairs, m = np.unique(code[:-1][inside].astype(np.int64) * len(names) + code[1:][inside], return_counts=True)
                hashes = _pair_hash(h[pairs // len(names)], h[pairs % len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(list(names[keep]) + [None] * len(pairs), pa.string()), pa.array(np.concatenate([np.zeros(int(keep.sum()), np.int64), hashes])), pa.array(np.concatenate([n[keep], m]))], ["word", "pair", "n"])

    return run


def vocabulary(pages: DataFrame, text_col: str = "text", with_pairs: bool = True) -> tuple[DataFrame, DataFrame]:
    """(words: word, n; pairs: pair, n) of pages: all seen ``LEAST`` times or more; pairs are hashes of two words in a row."""
    src = spread(pages.select(F.col(text_col).alias("text"))).where("text IS NOT NULL")
    counts = src.mapInArrow(_count_words(with_pairs), "word string, pair bigint, n bigint").groupBy("word", "pair").agg(F.sum("n").alias("n"))
    common = materialise(counts.where(F.col("n") >= LEAST))
    return common.where("word IS NOT NULL").select("word", "n"), common.where("word IS NULL").select("pair", "n")


def _hash(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, _U64)


def _limit(word: str) -> float:
    return ACCEPT if word.isalpha() else ACCEPT_ODD


def _ask(trie: Trie, words: list[str]) -> list[list[tuple[str, float]]]:
    """The candidates of unknown words; a cost of 0 is no misreading, and one letter or a very long word is not looked up."""
    fit = [2 <= len(w) <= 40 for w in words]
    found = iter(trie.misread([w for w, ok in zip(words, fit) if ok], [_limit(w) for w, ok in zip(words, fit) if ok]))
    return [[x for x in next(found) if x[1] > 0] if ok else [] for ok in fit]


class Lexicon:
    """The vocabulary in one worker: sorted hashes of words with their counts, the trie, sorted hashes of pairs.

    Lives in a broadcast value, so a worker makes it and fills its memory of answers once, whatever the number of tasks.
    """

    def __init__(self, words: list[str], counts: list[int], pairs: np.ndarray = np.zeros(0, np.int64), pair_counts: np.ndarray = np.zeros(0, np.int64)):
        self.trie = Trie(words)
        count = dict(zip(words, counts))
        self.counts = np.array([count[w] for w in self.trie.words], np.int64)
        hashes = _hash(self.trie.words)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.pairs, self.pair_counts = pairs, pair_counts
        self.memory: dict[str, list[tuple[str, float, int]]] = {}

    def numbers(self, words: list[str]) -> np.ndarray:
        """The place of each word in the vocabulary, -1 where it is none."""
        if not len(self.hashes) or not words:
            return np.full(len(words), -1)
        h = _hash(words)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at], -1)

    def answers(self, asked: set[str]) -> tuple[dict[str, int], dict[str, list[tuple[str, float, int]]]]:
        """(counts of the asked words that are known, candidates of the others)."""
        words = list(asked)
        place = self.numbers(words)
        known = {w: int(self.counts[i]) for w, i in zip(words, place) if i >= 0}
        if len(self.memory) > 200_000:
            self.memory.clear()
        new = [w for w in words if w not in known and w not in self.memory]
        for word, found in zip(new, _ask(self.trie, new)):
            numbers = self.numbers([x for x, _ in found])
            self.memory[word] = [(x, cost, int(self.counts[i])) for (x, cost), i in zip(found, numbers)]
        return known, {w: self.memory[w] for w in words if w not in known}

    def together(self, hashes: np.ndarray) -> np.ndarray:
        """How often each pair was seen."""
        if not len(self.pairs):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.pairs, hashes), len(self.pairs) - 1)
        return np.where(self.pairs[at] == hashes, self.pair_counts[at], 0)


def asked_words(text: str) -> set[str]:
    """Every word whose reading may be asked for on a page: each token with and without its edges, and what is cut at line ends."""
    out: set[str] = set()
    lines = plain(text).split("\n")
    glue = ""
    for i, line in enumerate(lines):
        tokens = line.split()
        whole = [glue + tokens[0]] if glue and tokens else []
        last = ""
        if tokens and i + 1 < len(lines) and lines[i + 1].strip() and _CUT.search(line):
            last = tokens[-1].rstrip(HYPHENS)
            whole += [glue + last] if len(tokens) == 1 and glue else []
            chained = glue + last if len(tokens) == 1 else last
        for token in (*tokens, *whole, last, *([last + lines[i + 1].split()[0]] if last else ())):
            out.update((_CORE.sub("", token).lower() if not token.startswith("\ufffd") else token.lower(), _CORE.sub("", token).lower(), token.strip(".,;:()[]\"“”").lower()))
        glue = chained if last else ""
    out.discard("")
    return out


_ROMAN = re.compile(r"(?=.)c{0,3}x{0,4}(ix|iv|v?i{0,4})", re.I)


def page_number(line: str) -> bool:
    """Whether a line is nothing but a page number, in any usual form, its digits possibly misread."""
    s = line.strip().strip("|[](){}-–—· ").strip()
    if not s or len(s) > 24:
        return False
    digits = "".join(DIGITS.get(c, c) for c in s)
    if re.fullmatch(r"\d{1,4}", digits) or (len(s) <= 8 and _ROMAN.fullmatch(re.sub("[lI1]", "i", s))):
        return True
    if re.fullmatch(r"(\S ){3,}\S? ?\|? ?\d{1,4}", digits) or re.fullmatch(r"(\S ?){4,6}\| ?\S{1,4}", s):
        return True
    tail = re.fullmatch(r"(?:\S{3,7}|\S(?: \S){2,5}) (\S{1,4}?) ?(?:/|\b\S{2}\b) ?(\S{1,4})", s)
    if tail and all(re.fullmatch(r"\d+", "".join(DIGITS.get(c, c) for c in g)) for g in tail.groups()):
        return True
    return bool(re.fullmatch(r"\S{3,7} \d{1,4}/\d{1,4}", digits) or re.fullmatch(r"\S{3,7} \d{1,4}", digits) and re.match(r"(p|tr)\S{2,4} ", s, re.I))


_YEAR_OR_CODE = re.compile(r"(?<!\S)\S?\d\S{0,2}\d\S?$|(?<!\S)(?=\S*[^\W\d])(?=\S*\d)[\w~'.@]{4,}(?!\S)")


def edge_parts(line: str, strict: bool = True) -> list[str]:
    """The parts of a possible running line (title, name, section) without its page number, digits masked.

    Empty for a line that reads like running text: ending in a full stop, long, with figures other than a year, or,
    where ``strict``, beginning with a small letter (which may itself be misread).
    """
    s = line.strip()
    if len(s) > 90 or s.endswith((".", ",", ";", ":")) and len(s) > 4 and s[-2].isalnum():
        return []
    parts = [x.strip(" -–") for x in re.split(r"\s*[|·]\s*|\s{2,}|\s[-–]\s", s)]
    parts = [x for x in parts if x and not page_number(x)]
    if any(len(x) > 60 or (strict and x[:1].islower() and x[:1].isascii()) or re.search(r"\d", _YEAR_OR_CODE.sub("", x)) for x in parts):
        return []
    return [re.sub(r"\d", "0", x).lower() for x in parts]


def _edges(lines: list[str], depth: int = 3) -> list[int]:
    full = [i for i, x in enumerate(lines) if x.strip()]
    return sorted({*full[:depth], *full[-depth:]})


def _edge_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of edge parts per report (window null) and per window of page numbers; every page is in two windows."""
    for batch in batches:
        found: Counter = Counter()
        for source, text, window in zip(*(batch.column(c).to_pylist() for c in ("source", "text", "window"))):
            found[source, None, ""] += 1
            lines = plain(text or "").split("\n")
            for key in {part for i in _edges(lines) for part in edge_parts(lines[i])}:
                for w in (None,) if window is None else (None, window, window + 1):
                    found[source, w, key] += 1
        names, windows, keys = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(windows, pa.int64()), pa.array(keys, pa.string()), pa.array(list(found.values()), pa.int64())], ["source", "window", "key", "n"])


def _near(a: str, b: str, most: int) -> bool:
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        if min(new) > most:
            return False
        row = new
    return row[-1] <= most


class Repairer:
    """Finds and repairs scanning noise on pages, given the counts of known words and the candidates of the others."""

    def __init__(self, words: dict[str, int], found: dict[str, list[tuple[str, float, int]]], together=None):
        self.words, self.found, self.pair_counts = words, found, together
        self.near: dict[tuple[str, str], bool] = {}

    def _alike(self, key: str, other: str) -> bool:
        at = (key, other)
        if at not in self.near:
            self.near[at] = _near(key, other, min(3, max(1, len(other) // 6)))
        return self.near[at]

    def candidates(self, word: str) -> list[tuple[str, float, int]]:
        """Vocabulary words that known confusions may have turned into this one, with their cost and count."""
        return self.found.get(word, [])

    def best(self, word: str, before: str | None, after: str | None) -> str | None:
        """The most plausible true word: least confusion cost, adjusted by neighbours and frequency; ties by the alphabet."""
        found = self.candidates(word)
        if not found:
            return None
        together = np.zeros((2, len(found)))
        if self.pair_counts is not None:
            for side, hashes in enumerate(_context([x[0] for x in found], before, after)):
                if hashes is not None:
                    together[side] = np.log1p(self.pair_counts(hashes))
        score = [(x[1] * 4 - together[0, i] - together[1, i] - 0.2 * log(1 + x[2]), x[0]) for i, x in enumerate(found)]
        return min(score)[1]

    def read_word(self, token: str) -> str | None:
        """None if a token is sound, else its core as read: a figure or word with misrecognised characters."""
        core = _CORE.sub("", token) if not token.startswith("\ufffd") else token
        if not core or _NUMBER.fullmatch(core):
            return None
        low = core.lower()
        if low in self.words:
            return None
        if any(c.isdigit() for c in core):
            figures = sum(c.isdigit() for c in core)
            if _FIGURE.fullmatch(core) and (figures > 1 or len(core) <= 4) and not core.isdigit():
                return core
            if _CODE.fullmatch(core):
                return core
            return core if self.candidates(low) else None
        if "\ufffd" in core:
            return core
        if self.candidates(low):
            return core
        edge = token.strip(".,;:()[]\"“”")
        return edge if edge != core and edge.lower() not in self.words and any(c in "@|\ufffd" for c in edge) and self.candidates(edge.lower()) else None

    def running(self, lines: list[str], recurring: list[str]) -> set[int]:
        """Line indices of headers, footers and page numbers: runs of such lines from the top and from the bottom.

        A short line before a page number counts with it; a line of several parts counts if all parts but one recur.
        """
        full = [i for i, x in enumerate(lines) if x.strip()]
        known = set(recurring)
        out: set[int] = set()
        for order in (full[:3], full[::-1][:3]):
            for k, i in enumerate(order):
                parts = edge_parts(lines[i], strict=False)
                hits = sum(p in known or any(self._alike(p, r) for r in recurring if abs(len(r) - len(p)) <= 3) for p in parts)
                rest = len(parts) - hits
                if page_number(lines[i]) or (hits and rest <= 1):
                    out.add(i)
                elif k + 1 < len(order) and len(lines[i]) <= 60 and not lines[i].rstrip().endswith(".") and page_number(lines[order[k + 1]]):
                    out.add(i)
                else:
                    break
        return out


    def findings(self, text: str, recurring: list[str]) -> tuple[list[str], set[int], set[int], set[int]]:
        """(lines, running, cut, misread): indices of lines of each kind."""
        lines = plain(text).split("\n")
        running = self.running(lines, recurring)
        cut, misread = set(), set()
        body = [i for i in range(len(lines)) if i not in running and lines[i].strip()]
        carried = ""  # the beginning of a word that goes on in this line
        for at, i in enumerate(body):
            tokens = lines[i].split()
            goes_on = False
            if at + 1 < len(body) and body[at + 1] == i + 1 and _CUT.search(lines[i]):
                following = lines[body[at + 1]].split()[0]
                goes_on = bool(_WORD.match(_CORE.sub("", following)[:1])) if following else False
            if goes_on:
                cut.add(i)
            for k, token in enumerate(tokens):
                first, last = k == 0 and carried, k == len(tokens) - 1 and goes_on
                if first:
                    whole = carried + token
                    if self.read_word(whole) and self.read_word(token) and not (last and token == whole):
                        side = self.best(_CORE.sub("", whole).lower(), None, None) or ""
                        (misread.add(i - 1) if not side.startswith(carried.lower()) else misread.add(i))
                    continue
                if last:
                    continue
                if self.read_word(token):
                    misread.add(i)
            carried = tokens[-1].rstrip(HYPHENS) if goes_on else ""
        return lines, running, cut, misread

    def repair(self, text: str, recurring: list[str]) -> str:
        """The text as paragraphs: running lines out, cut words joined, misread words and figures set right."""
        lines, running, cut, _ = self.findings(text, recurring)
        paragraphs, words, glue = [], [], ""
        for i, line in enumerate(lines):
            if i in running:
                continue
            if not line.strip():
                if words and not glue:
                    paragraphs.append(words)
                    words = []
                continue
            tokens = line.split()
            if glue:
                tokens[0] = glue + tokens[0]
            glue = tokens.pop().rstrip(HYPHENS) if i in cut else ""
            if tokens and tokens[-1] in ("-", "–"):
                tokens.pop()
            words += tokens
        if words or glue:
            paragraphs.append([*words, glue] if glue else words)
        return "\n\n".join(self._set_right(p) for p in paragraphs)

    def _set_right(self, tokens: list[str]) -> str:
        core = [_CORE.sub("", t).lower() for t in tokens]
        out = []
        for k, token in enumerate(tokens):
            wrong = self.read_word(token)
            if wrong:
                if (_FIGURE.fullmatch(wrong) and any(c.isdigit() for c in wrong)) or _CODE.fullmatch(wrong):
                    head, sep, tail = wrong.rpartition("-") if _CODE.fullmatch(wrong) else ("", "", wrong)
                    right = head + sep + "".join(DIGITS.get(c, c) for c in tail)
                else:
                    right = self.best(wrong.lower(), core[k - 1] if k else None, core[k + 1] if k + 1 < len(core) else None) or wrong
                    right = right.upper() if wrong.isupper() and len(wrong) > 1 else right[:1].upper() + right[1:] if wrong[:1].isupper() else right
                token = token.replace(wrong, right, 1)
            out.append(token)
        return " ".join(out)


def _context(words: list[str], before: str | None, after: str | None) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Hashes of the pairs the words would form with their neighbours."""
    h = _hash(words)
    left = _pair_hash(np.repeat(_hash([before]), len(h)), h) if before else None
    return left, _pair_hash(h, np.repeat(_hash([after]), len(h))) if after else None


def _asked_of(known: list | None, found: list | None) -> tuple[dict[str, int], dict[str, list[tuple[str, float, int]]]]:
    """The answers joined to a page, in the shape of a worker's own."""
    out: dict[str, list[tuple[str, float, int]]] = {}
    for x in found or ():
        out.setdefault(x["word"], []).append((x["true"], x["cost"], x["n"]))
    return {x["word"]: x["n"] for x in known or ()}, out


def _answers_by_joins(pages: DataFrame, words: DataFrame, part: int) -> DataFrame:
    """The pages (row, text, ...) with the answers to all they ask, where the vocabulary is too large for a worker."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, asked = [], []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                mine = asked_words(text) if text else ()
                rows += [row] * len(mine)
                asked += mine
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(asked, pa.string())], ["row", "word"])

    def match(vocabulary: pa.Table, asked: pa.Table) -> pa.Table:
        mine = asked["word"].to_pylist()
        count = dict(zip(vocabulary["word"].to_pylist(), vocabulary["n"].to_pylist()))
        rows = [(w, x, cost, count[x]) for w, found in zip(mine, _ask(Trie(list(count)), mine)) for x, cost in found]
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.table({"word": pa.array(columns[0], pa.string()), "true": pa.array(columns[1], pa.string()), "cost": pa.array(columns[2], pa.float64()), "n": pa.array(columns[3], pa.int64())})

    asked = materialise(pages.select("row", "text").mapInArrow(ask, "row bigint, word string"))
    every = asked.select("word").distinct()
    known = words.join(every, "word", "left_semi")
    unknown = materialise(every.join(words, "word", "left_anti"))
    parts, blocks = (max(1, -(-df.count() // part)) for df in (words, unknown))
    deal = lambda n: F.pmod(F.xxhash64("word"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = words.select("word", "n", deal(parts).alias("p"), each(blocks).alias("b"))
    right = unknown.select("word", each(parts).alias("p"), deal(blocks).alias("b"))
    found = left.groupBy("p", "b").cogroup(right.groupBy("p", "b")).applyInArrow(match, "word string, true string, cost double, n bigint")
    known = asked.join(known, "word").groupBy("row").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    found = asked.join(found, "word").groupBy("row").agg(F.collect_list(F.struct("word", "true", "cost", "n")).alias("found"))
    return pages.join(known, "row", "left").join(found, "row", "left")


def _pairs_by_joins(pages: DataFrame, pairs: DataFrame, recurring) -> DataFrame:
    """The pages with the counts of the word pairs their repair asks for."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, asked = [], []
            for x in batch.to_pylist():
                wanted: set[int] = set()
                keep = lambda hashes: wanted.update(hashes.tolist()) or np.zeros(len(hashes))  # noqa: B023, E731
                if x["text"]:
                    Repairer(*_asked_of(x["known"], x["found"]), keep).repair(x["text"], recurring(x["keys"]))
                rows += [x["row"]] * len(wanted)
                asked += wanted
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(asked, pa.int64())], ["row", "pair"])

    asked = pages.select("row", "text", "keys", "known", "found").mapInArrow(ask, "row bigint, pair bigint")
    seen = asked.join(pairs, "pair").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("pair", "n"))).alias("pairs"))
    return pages.join(seen, "row", "left")


def _scanned(pages: DataFrame, ocr: DataFrame, id_col: str, source_col: str, text_col: str, output: str, page_col: str = "page_number", broadcast_words: int = BROADCAST_WORDS, broadcast_pairs: int = BROADCAST_PAIRS, part: int = PART) -> DataFrame:
    """Run the repairer over the pages of scanned reports; output is 'findings' or 'repaired'."""
    spark = pages.sparkSession
    kind = dict(pages.dtypes)[id_col]
    reports = materialise(ocr.select(F.element_at(F.split("report_path", "/"), -1).alias("source")).where("source IS NOT NULL AND source <> ''").distinct())
    window = F.floor(F.col(page_col) / WINDOW).cast("bigint") if page_col in pages.columns else F.lit(None).cast("bigint")
    rows = spread(pages.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), window.alias("window")))
    hint = small(reports, 1_000_000)
    mine = rows.join(hint, "source", "left_semi")
    found = output == "findings"
    words, pairs = vocabulary(rows.join(hint, "source", "left_anti"), with_pairs=not found)  # findings rest on single words
    counts = materialise(mine.mapInArrow(_edge_keys, "source string, window bigint, key string, n bigint").groupBy("source", "window", "key").agg(F.sum("n").alias("n")))
    near = counts.where((F.col("window").isNotNull()) & (F.col("n") >= RECURS)).groupBy("source", "window").agg(F.collect_list("key").alias("keys"))
    counts = counts.where("window IS NULL").drop("window")
    totals = counts.where("key = ''").select("source", F.col("n").alias("rows"))
    own = counts.where("key <> ''").join(totals, "source").where(F.col("n") >= F.greatest(F.lit(3), F.ceil(F.col("rows") * 0.02)))
    own = own.groupBy("source").agg(F.collect_list("key").alias("keys"))
    wide = counts.where("key <> ''").groupBy("key").agg(F.countDistinct("source").alias("reports"), F.sum("n").alias("n"))
    every = (totals.agg(F.sum("rows")).first() or [0])[0] or 0
    shared = [r["key"] for r in wide.where((F.col("reports") >= 3) & (F.col("n") >= max(5, every * 0.002))).collect()]  # at most 3,000: six edge lines a page, 0.2 % of the pages each
    src = mine.join(small(own, 100_000), "source", "left")
    near = small(near, 100_000)
    for k in (0, 1):  # the two windows of a page
        src = src.join(near.select("source", (F.col("window") - k).alias("window"), F.col("keys").alias(f"keys{k}")), ["source", "window"], "left")
    src = src.withColumn("keys", F.array_distinct(F.concat(*(F.coalesce(c, F.array().cast("array<string>")) for c in ("keys", "keys0", "keys1"))))).select("id", "text", "keys")
    recurring = lambda keys: [*(keys or ()), *shared]
    many, many_pairs = words.count() > broadcast_words, not found and pairs.count() > broadcast_pairs
    if many or many_pairs:
        src = _answers_by_joins(materialise(src.withColumn("row", F.monotonically_increasing_id())), words, part)
        src = src if found else _pairs_by_joins(materialise(src), pairs, recurring)
        model = None
    else:
        w, p = words.toArrow(), pairs.orderBy("pair").toArrow()
        model = spark.sparkContext.broadcast(Lexicon(w["word"].to_pylist(), w["n"].to_pylist(), p["pair"].to_numpy(), p["n"].to_numpy()))

    def tools(batch: pa.RecordBatch, texts: list[str | None]) -> Iterator[Repairer]:
        if model is None:
            joined = batch.select(["known", "found", *(["pairs"] if not found else [])]).to_pylist()
            for x in joined:
                seen = dict(x.get("pairs") or ())
                yield Repairer(*_asked_of(x["known"], x["found"]), None if found else lambda hashes, seen=seen: np.array([seen.get(h, 0) for h in hashes.tolist()]))
            return
        asked = set().union(*(asked_words(t) for t in texts if t))
        tool = Repairer(*model.value.answers(asked), None if found else model.value.together)
        for _ in texts:
            yield tool

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                at, numbers, kinds, out = [], [], [], []
                texts = batch.column("text").to_pylist()
                for i, (text, keys, tool) in enumerate(zip(texts, batch.column("keys").to_pylist(), tools(batch, texts))):
                    if not found:
                        out.append(tool.repair(text, recurring(keys)) if text else text)
                    elif text:
                        for name, which in zip(("running", "cut", "misread"), tool.findings(text, recurring(keys))[1:]):
                            at += [i] * len(which)
                            numbers += [n + 1 for n in sorted(which)]
                            kinds += [name] * len(which)
                if found:
                    yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), pa.array(numbers, pa.int32()), pa.array(kinds, pa.string())], ["id", "line_no", "kind"])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], ["id", "repaired"])

    schema = f"id {kind}, line_no int, kind string" if found else f"id {kind}, repaired string"
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def scan_noise(pages: DataFrame, ocr: DataFrame, id_col: str = "page_key", source_col: str = "source_file", text_col: str = "text", **bounds) -> DataFrame:
    """(id_col, line_no, kind): running, cut and misread lines of the pages of scanned reports."""
    return _scanned(pages, ocr, id_col, source_col, text_col, "findings", **bounds).distinct()


def repair_pages(pages: DataFrame, ocr: DataFrame, id_col: str = "page_key", source_col: str = "source_file", text_col: str = "text", **bounds) -> DataFrame:
    """(id_col, repaired): the text of every page of a scanned report as continuous paragraphs."""
    return _scanned(pages, ocr, id_col, source_col, text_col, "repaired", **bounds)
