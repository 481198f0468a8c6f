"""Turning links between classes of exact copies into links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Classes of at most this many copies are expanded into all row pairs; larger ones stay a star around their smallest id.
EXPAND = 64


def _by_copies(links: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and members of the groups of true copies inside the classes; groups of one class are all linked."""
    groups = members.groupBy("cls", "copy").agg(F.min("id").alias("group"))
    rows = members.join(groups, ["cls", "copy"]).select(F.col("group").alias("cls"), "id")
    one, two = (groups.select(F.col("cls").alias(c), F.col("group").alias(g)) for c, g in (("a", "ga"), ("b", "gb")))
    across = links.join(one, "a").join(two, "b").select("ga", "gb")
    inside = one.join(two.withColumnRenamed("b", "a"), "a").where("ga < gb").select("ga", "gb")
    return across.unionByName(inside).select(F.col("ga").alias("a"), F.col("gb").alias("b")), rows


def expand_pairs(links: DataFrame, members: DataFrame, expand: int | None = EXPAND) -> DataFrame:
    """Row pairs (a, b), a < b.

    links: (a, b), class ids, a != b. members: (cls, id), one row per row of the collection that may take part.
    members may have a third column, copy (not null): then only rows of a class that agree in it are copies, rows that
    differ in it are all paired, and what follows holds for each group of copies.
    A class larger than ``expand`` is represented by its smallest id in every link to other classes, and its own
    rows are each paired with that id: no link between different texts is lost and no quadratic group is written. Whether
    a row stands for its class follows from ``members``; ``expand=None`` writes every pair of rows.
    The size of each class is a map-side combined count, so a class holding a third of all rows costs one row per
    map task; joins to it are split by the adaptive skew join.
    """
    if expand is None:
        left = links.join(members.select(F.col("cls").alias("a"), F.col("id").alias("ia")), "a")
        cross = left.join(members.select(F.col("cls").alias("b"), F.col("id").alias("ib")), "b").select("ia", "ib")
        inner = members.select("cls", F.col("id").alias("ia")).join(members.select("cls", F.col("id").alias("ib")), "cls").where("ia < ib").select("ia", "ib")
        return cross.unionByName(inner).select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b")).where("a < b")
    if "copy" in members.columns:
        links, members = _by_copies(links, members)
    sizes = members.groupBy("cls").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    linked = links.select(F.col("a").alias("cls")).unionByName(links.select(F.col("b").alias("cls"))).distinct()
    few = sizes.where(F.col("n") <= expand).join(linked, "cls", "left_semi")
    rows = members.join(few.select("cls"), "cls").select("cls", "id")
    rows = rows.unionByName(sizes.where(F.col("n") > expand).select("cls", F.col("low").alias("id")))
    left = links.join(rows.select(F.col("cls").alias("a"), F.col("id").alias("ia")), "a")
    cross = left.join(rows.select(F.col("cls").alias("b"), F.col("id").alias("ib")), "b").select("ia", "ib")
    copied = members.join(sizes.where(F.col("n") > 1), "cls")
    small = copied.where(F.col("n") <= expand).select("cls", "id")
    inner = small.select("cls", F.col("id").alias("ia")).join(small.select("cls", F.col("id").alias("ib")), "cls").where("ia < ib").select("ia", "ib")
    star = copied.where((F.col("n") > expand) & (F.col("id") > F.col("low"))).select(F.col("low").alias("ia"), F.col("id").alias("ib"))
    every = cross.unionByName(inner).unionByName(star)
    return every.select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b")).where("a < b")
