"""Cutting oversized texts into overlapping pieces at natural boundaries.

Words are longest runs of characters outside the Unicode White_Space property. Per text, word offsets and a sorted
array of boundary positions (a paragraph end before a sentence end) are built once; every cut is a binary search for
the last boundary that keeps the piece within ``chunk_size`` words, the next piece starts ``overlap`` words earlier,
and where no boundary lies in reach the cut falls hard after ``chunk_size`` words.

Defined results: null and blank texts give no piece; a text of at most ``chunk_size`` words is one piece; a type
without a row in the configuration is not cut (no limit is known for it) and gives no piece; repeated rows each give
their pieces; extra columns are not carried. A configuration with overlap >= chunk_size or chunk_size < 1 is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.common import spread

#: The Unicode White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = re.compile(f"[^{WHITE}]+")
JAVA_WHITE = r"\p{IsWhite_Space}"
_SENTENCE_END = re.compile("[.!?\u2026\u3002\uff0e\uff01\uff1f][\"'\u201d\u2019)\\]\u00bb]*$")
_PARAGRAPH = re.compile("\n[^\\S\n]*\n|\u2029")


def cut_points(text: str, limit: int, overlap: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Word spans (n, 2) of a text and the half-open word ranges of its pieces."""
    spans = np.array([m.span() for m in WORD.finditer(text)], dtype=np.int64).reshape(-1, 2)
    n = len(spans)
    if n <= limit:
        return spans, [(0, n)] if n else []
    gaps = [text[a:b] for a, b in zip(spans[:-1, 1], spans[1:, 0])]
    paragraphs = np.array([i + 1 for i, g in enumerate(gaps) if _PARAGRAPH.search(g)], dtype=np.int64)
    sentences = np.array([i + 1 for i in range(n - 1) if _SENTENCE_END.search(text[spans[i, 0] : spans[i, 1]])], dtype=np.int64)

    def last(array: np.ndarray, low: int, high: int) -> int:
        k = int(np.searchsorted(array, high, side="right")) - 1
        return int(array[k]) if k >= 0 and array[k] > low else -1

    pieces, start = [], 0
    while n - start > limit:
        floor, half = start + overlap, start + max(overlap, limit // 2)
        stop = last(paragraphs, half, start + limit)
        if stop < 0:
            stop = last(sentences, half, start + limit)
        if stop < 0:
            stop = max(last(paragraphs, floor, start + limit), last(sentences, floor, start + limit))
        if stop < 0:
            stop = start + limit
        pieces.append((start, stop))
        start = stop - overlap
    pieces.append((start, n))
    return spans, pieces


def split_pages(pages: DataFrame, config: DataFrame, id_col: str = "page_key", text_col: str = "text", type_col: str = "statement_type") -> DataFrame:
    """(id_col, piece_no, start_word, end_word, n_pieces, piece) for every page with a limit for its type.

    The configuration is a table of a few rows per statement type and is joined null-safely as a broadcast side of
    proven size (one row per type). Only texts long enough to need a cut go through Python; all others stay JVM-side.
    """
    bad = config.where("chunk_size < 1 OR overlap < 0 OR overlap >= chunk_size OR chunk_size IS NULL OR overlap IS NULL")
    if bad.limit(1).count():
        raise ValueError("chunking configuration needs 0 <= overlap < chunk_size")
    kind = dict(pages.dtypes)[id_col]
    rules = config.groupBy(F.col("statement_type").alias("__type")).agg(F.min("chunk_size").alias("__limit"), F.min_by("overlap", "chunk_size").alias("__overlap"))
    src = spread(pages.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(type_col).alias("type")))
    joined = src.join(F.broadcast(rules), F.col("type").eqNullSafe(F.col("__type"))).where(F.col("text").isNotNull())
    joined = joined.select("id", "text", F.col("__limit").alias("size"), F.col("__overlap").alias("overlap"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, (text, size, overlap) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", "size", "overlap")))):
                spans, pieces = cut_points(text, size, overlap)
                ids += [i] * len(pieces)
                rows += [(k + 1, a + 1, b, len(pieces), text[spans[a, 0] : spans[b - 1, 1]]) for k, (a, b) in enumerate(pieces)]
            if rows:
                cols = list(zip(*rows))
                kinds = [pa.int32()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(ids)), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["id", "piece_no", "start_word", "end_word", "n_pieces", "piece"]
                )

    schema = f"id {kind}, piece_no int, start_word int, end_word int, n_pieces int, piece string"
    # A text of more than n words has at least 2n + 1 characters; below that it is one piece without leaving the JVM.
    long = joined.where(F.length("text") > 2 * F.col("size")).mapInArrow(run, schema)
    trimmed = F.regexp_replace("text", f"^{JAVA_WHITE}+|{JAVA_WHITE}+$", "")
    words = F.size(F.split(F.col("piece"), f"{JAVA_WHITE}+"))
    short = joined.where(F.length("text") <= 2 * F.col("size")).select("id", trimmed.alias("piece")).where("piece <> ''")
    short = short.select("id", F.lit(1).alias("piece_no"), F.lit(1).alias("start_word"), words.alias("end_word"), F.lit(1).alias("n_pieces"), "piece")
    return long.unionByName(short).withColumnRenamed("id", id_col)


def oversized(pages: DataFrame, config: DataFrame, id_col: str = "page_key") -> DataFrame:
    """Ids of the pages that the splitter cut into several pieces."""
    return split_pages(pages, config, id_col).where("n_pieces > 1 AND piece_no = 1").select(id_col).distinct()
