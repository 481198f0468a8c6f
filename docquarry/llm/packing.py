"""Packing documents into fixed-capacity containers of several sizes.

Documents are routed to the smallest container that holds them. The long tier is packed first, its gaps are filled from
the shorter tiers, then the next tier, and so on; only a document above the largest capacity is split. All decisions
are made on the histogram of sizes, which has at most ``capacity`` entries at any number of documents: packing yields
patterns (sizes with multiplicities, repeated so many times), at most a few per distinct size. A document finds its
place by its rank among the documents of its size, counted per partition and offset by partition totals, so no step
sorts, groups or collects the documents.

Containers of a tier are numbered by falling fill and dealt to step groups in a snake, so groups carry equal loads.

Defined results: empty and null texts have no tokens, take no space and come out with a null container; a repeated
row is a document of its own; a document above the largest capacity gives full pieces and one rest; null or
non-positive capacities are ignored; without any capacity every container is null; extra columns are not carried.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.common import materialise
from docquarry.llm.tokenizer import DEFAULT_VOCAB, token_counts


@dataclass
class Pattern:
    tier: int
    parts: dict[int, int]  # size -> how many of it in one container
    times: int

    @property
    def fill(self) -> int:
        return sum(s * m for s, m in self.parts.items())


def plan(histogram: dict[int, int], capacities: list[int]) -> list[Pattern]:
    """Patterns that place every item of the histogram; capacities ascend, no size exceeds the last."""
    left = {s: n for s, n in histogram.items() if s > 0 and n > 0}
    sizes = sorted(left)
    out: list[Pattern] = []
    for tier in range(len(capacities) - 1, -1, -1):
        room, floor = capacities[tier], capacities[tier - 1] if tier else 0
        while sizes and sizes[-1] > floor:
            parts: dict[int, int] = {}
            rest, at = room, len(sizes)
            while rest > 0:
                at = bisect.bisect_right(sizes, rest, 0, at)
                if not at:
                    break
                size = sizes[at - 1]
                many = min(rest // size, left[size])
                parts[size] = many
                rest -= many * size
                at -= 1
            times = min(left[s] // m for s, m in parts.items())
            out.append(Pattern(tier, parts, times))
            for s, m in parts.items():
                left[s] -= m * times
                if not left[s]:
                    del left[s]
                    del sizes[bisect.bisect_left(sizes, s)]
    return out


def _slots(patterns: list[Pattern], tiers: int, group: int) -> tuple[dict[str, np.ndarray], list[int]]:
    """Flat slot arrays sorted by (size, first rank), and the number of containers per tier."""
    used: dict[int, int] = {}
    count = [0] * tiers
    rows = []
    for p in sorted(patterns, key=lambda p: -p.fill):
        base = count[p.tier]
        count[p.tier] += p.times
        for size, many in p.parts.items():
            first = used.get(size, 0)
            used[size] = first + many * p.times
            rows.append((size, first, many, base, p.tier))
    rows.sort()
    names = ("size", "first", "many", "base", "tier")
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(names)}, count


def pack_documents(docs: DataFrame, containers: DataFrame, vocab: str = DEFAULT_VOCAB, id_col: str = "doc_id", text_col: str = "text", step: int = 8) -> DataFrame:
    """(id_col, piece_no, start_token, n_tokens, container_type, container_no, step_group), a row per document or piece.

    ``container_no`` counts from 1 within its type; ``step`` containers of a type make one step group.
    """
    kind = dict(docs.dtypes)[id_col]
    limits = containers.where("capacity_tokens > 0 AND container_type IS NOT NULL").groupBy("capacity_tokens").agg(F.min("container_type").alias("name")).collect()
    limits = sorted((int(r["capacity_tokens"]), r["name"]) for r in limits)
    sizes = token_counts(docs, vocab, id_col, text_col).select(F.col(id_col).alias("id"), "n_tokens")
    largest = limits[-1][0] if limits else 0
    if largest:
        cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.col("n_tokens") - largest) / largest)).cast("int"))
        pieces = sizes.select("id", "n_tokens", F.explode(cuts).alias("k")).select(
            "id", (F.col("k") + 1).alias("piece_no"), (F.col("k").cast("bigint") * largest).alias("start_token"),
            F.least(F.lit(largest).cast("bigint"), F.col("n_tokens") - F.col("k").cast("bigint") * largest).alias("n_tokens"),
        )
    else:
        pieces = sizes.selectExpr("id", "1 AS piece_no", "0L AS start_token", "n_tokens")
    pieces = materialise(pieces)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rank of each row among the rows of its size in this partition."""
        from pyspark import TaskContext

        pid, seen = TaskContext.get().partitionId(), np.zeros(largest + 1, np.int64)
        for batch in batches:
            size = batch.column("n_tokens").to_numpy()
            order = np.argsort(size, kind="stable")
            ranked = size[order]
            local = np.arange(len(size)) - np.searchsorted(ranked, ranked)
            rank = np.empty(len(size), np.int64)
            rank[order] = local + seen[ranked]
            np.add.at(seen, size, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(size), pid, np.int32)), pa.array(rank)], [*batch.schema.names, "pid", "rank"])

    if not largest:
        return pieces.selectExpr(f"id AS `{id_col}`", "piece_no", "start_token", "n_tokens", "CAST(NULL AS STRING) container_type", "CAST(NULL AS BIGINT) container_no", "CAST(NULL AS BIGINT) step_group")
    ranked = materialise(pieces.mapInArrow(number, f"id {kind}, piece_no int, start_token bigint, n_tokens bigint, pid int, rank bigint"))
    shares = ranked.groupBy("pid", "n_tokens").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("n_tokens").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = materialise(shares.withColumn("before", before))
    histogram = {int(r["n_tokens"]): int(r["n"]) for r in shares.groupBy("n_tokens").agg(F.sum("n").alias("n")).collect()}
    slots, count = _slots(plan(histogram, [c for c, _ in limits]), len(limits), step)
    names = [n for _, n in limits]
    given = ranked.sparkSession.sparkContext.broadcast((slots, np.array([-(-c // step) for c in count], dtype=np.int64)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, groups = given.value
        wide = np.int64(1) << np.int64(40)
        starts = slots["size"] * wide + slots["first"]
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("n_tokens", "rank"))
            full = size > 0
            at = np.maximum(np.searchsorted(starts, size * wide + rank, side="right") - 1, 0)
            if len(starts):
                no = slots["base"][at] + (rank - slots["first"][at]) // slots["many"][at]
                tier = slots["tier"][at]
            else:
                no, tier = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            g = np.maximum(groups[tier], 1)
            lap, pos = no // g, no % g
            group = np.where(lap % 2 == 0, pos, g - 1 - pos) + 1
            empty = ~full
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "piece_no", "start_token", "n_tokens")), pa.array([names[t] for t in tier], pa.string(), mask=empty), pa.array(no + 1, mask=empty), pa.array(group, mask=empty)],
                ["id", "piece_no", "start_token", "n_tokens", "container_type", "container_no", "step_group"],
            )

    joined = ranked.join(shares.select("pid", "n_tokens", "before"), ["pid", "n_tokens"]).select("id", "piece_no", "start_token", "n_tokens", (F.col("rank") + F.col("before")).alias("rank"))
    schema = f"id {kind}, piece_no int, start_token bigint, n_tokens bigint, container_type string, container_no bigint, step_group bigint"
    return joined.mapInArrow(place, schema).withColumnRenamed("id", id_col)


def packing_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_type, n_containers, n_pieces, n_tokens, fill) per type in use."""
    used = packed.where("container_type IS NOT NULL").groupBy("container_type").agg(F.max("container_no").alias("n_containers"), F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"))
    room = containers.groupBy("container_type").agg(F.min("capacity_tokens").alias("room"))
    return used.join(room, "container_type").select("container_type", "n_containers", "n_pieces", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("room")), 6).alias("fill"))
