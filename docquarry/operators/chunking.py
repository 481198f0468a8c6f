"""Overlapping token windows over page texts; window texts are exact substrings of the page.

The text is cut once into tokens with the white space that follows them; a window is a slice of that array glued
together, so inner white space is kept and nothing leaves the JVM.

Defined results: null, empty and blank texts give no window; a text of up to ``size`` tokens gives one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.common import spread
from docquarry.operators.ordering import positions, prefix_sums, within


def window_starts(n: Column, size: int, overlap: int) -> Column:
    """First tokens (from 0) of the windows over n tokens: the last window is the first that reaches the end."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((n - size) / step)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda k: k * step)).otherwise(F.array().cast("array<int>"))


def split_text(pages: DataFrame, size: int, overlap: int, text_col: str = "text") -> DataFrame:
    """A row per window: the page's columns and window_no (from 1), first_token, n_tokens, chunk."""
    if size <= overlap:
        raise ValueError("the window size must exceed the overlap")
    pieces = F.regexp_extract_all(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"(?U)^\s+", ""), F.lit(r"(?U)\S+\s*"), F.lit(0))
    cut = spread(pages).withColumn("__pieces", pieces).withColumn("__n", F.size("__pieces"))
    out = cut.select("*", F.posexplode(window_starts(F.col("__n"), size, overlap)).alias("__k", "__first"))
    chunk = F.regexp_replace(F.array_join(F.slice("__pieces", F.col("__first") + 1, F.lit(size)), ""), r"(?U)\s+$", "")
    out = out.withColumns({"window_no": F.col("__k") + 1, "first_token": F.col("__first"), "n_tokens": F.least(F.lit(size), F.col("__n") - F.col("__first")), "chunk": chunk})
    return out.drop("__pieces", "__n", "__k", "__first")


def chunk_reports(pages: DataFrame, size: int = 650, overlap: int = 100, marker: str = "", report: list[str] = ("source_file",)) -> DataFrame:
    """Chunks of every report with ids ``company_year_[marker]NNNNNN`` that count within the report.

    Counting runs over one short row per page (see ``ordering``); the texts themselves are never sorted. A null year
    reads ``unknown`` in the id. ``page_key`` must be unique.
    """
    report = list(report)
    windows = split_text(pages, size, overlap)
    n = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?U)\S+"), F.lit(0)))
    count = pages.select(*report, "page_number", "page_key", F.size(window_starts(n, size, overlap)).alias("__count"))
    counted = within(prefix_sums(count, [*report, "page_number", "page_key"], "__count", "__sum"), report, "__sum", "__before").select("page_key", "__before")
    number = F.col("__before") + F.col("window_no")
    name = F.concat(F.coalesce("company", F.lit("")), F.lit("_"), F.coalesce(F.col("year").cast("string"), F.lit("unknown")), F.lit("_" + marker), F.lpad(number.cast("string"), 6, "0"))
    return windows.join(counted, "page_key").withColumn("chunk_id", name).drop("__before")


def number_all(chunks: DataFrame, order: list[str]) -> DataFrame:
    """A running number (from 1) over all rows in the given total order."""
    return positions(chunks, order, "__at").withColumn("chunk_no", F.col("__at") + 1).drop("__at")
