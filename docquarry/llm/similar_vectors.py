"""The k most similar vectors of every vector, through one navigable small-world graph per shard.

Centroids cut the collection into shards of about ``SHARD`` nearby vectors. Up to ``ROOT`` shards have centroids of one
level, fitted on a bounded sample; beyond, ``ROOT`` cells each get their own, fitted by one task per cell on a bounded
sample of the cell, at most ``MOST`` in all (with more vectors shards grow; the work of a vector in a graph does not).
Every vector is a member of the graph of its nearest centroid. All lists come from searches of the graphs: members enter
their own graph at their place, and every vector visits from the top level the graphs of the next ``probes`` centroids
and of those, up to ``VISITS``, whose border is within ``REACH``; the more shards there are the more vectors lie near
several borders. The lists of all graphs are merged by cosine.

Vectors of equal content are indexed once per shard with their number of copies, so a group of copies holding a third
of all rows costs one row per batch of the scan. The fit samples are the only sampling: every usable vector is indexed.

Defined results: a vector takes part only if it is not null, has exactly the dimensions its configuration names, holds
only finite numbers and is not all zero; a configuration that is null or not listed has no usable vectors; vectors of
different configurations never meet; ties in cosine share their rank; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.common import materialise, spread
from docquarry.operators.pairs import EXPAND, expand_pairs

#: Vectors of a shard; rows of a sample on which centroids are fitted; centroids of the first level and of all.
SHARD, SAMPLE, ROOT, MOST = 4096, 16_384, 256, 65_536
#: Distance to the border of a shard, times the root of the dimensions, at which it is visited; shards visited at most;
#: cells looked at for the nearest centroids of the second level.
REACH, VISITS, CELLS = 0.45, 16, 16
_U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def _usable(names: pa.Array, lists: pa.Array, dims: dict[str, int]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(configuration, row numbers, float32 matrix) of the usable vectors of a batch."""
    import pyarrow.compute as pc

    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    for name, width in dims.items():
        fits = pc.and_kleene(pc.equal(names, name), pc.equal(pc.list_value_length(lists), width))
        rows = np.flatnonzero(np.asarray(pc.fill_null(fits, False).to_numpy(zero_copy_only=False), dtype=bool))
        if not len(rows):
            continue
        flat = lists.take(pa.array(rows)).flatten().cast(pa.float32())
        x = flat.to_numpy(zero_copy_only=False).reshape(-1, width)  # null elements turn into NaN
        good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        if good.any():
            yield name, rows[good], np.ascontiguousarray(x[good])


def _content(name: str, x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the content of every vector, together with its configuration."""
    salt = np.random.default_rng(list(name.encode())).integers(1, 1 << 63, x.shape[1], dtype=_U64) | _U64(1)
    bits = (x + np.float32(0)).view(np.uint32).astype(_U64)
    return _mix((_mix(bits * salt + salt[::-1])).sum(axis=1, dtype=_U64)).view(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary value per row of a matrix, without copying row by row."""
    rows = np.ascontiguousarray(rows)
    offsets = (np.arange(len(rows) + 1) * rows[:1].nbytes).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _matrix(values: pa.ChunkedArray) -> np.ndarray:
    """The float32 matrix whose rows the binary values hold; all have one length."""
    parts = [np.frombuffer(c.buffers()[2], np.uint8)[(o := np.frombuffer(c.buffers()[1], np.int32))[c.offset] : o[c.offset + len(c)]] for c in values.chunks if len(c)]
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return flat.view(np.float32).reshape(len(values), -1) if len(values) else np.zeros((0, 1), np.float32)


def _k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = x[np.random.default_rng(len(x)).choice(len(x), min(len(x), max(1, k)), replace=False)].copy()
    for _ in range(rounds if len(c) > 1 else 0):
        near = (x @ c.T).argmax(axis=1)
        order = np.argsort(near, kind="stable")
        at = np.searchsorted(near[order], np.arange(len(c)))
        filled = np.bincount(near, minlength=len(c)) > 0
        sums = np.add.reduceat(x[order], at[filled])
        c[filled] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def fit_cell(x: np.ndarray, each: float, shard: int) -> np.ndarray:
    """Centroids of shards of about ``shard`` vectors, from distinct sampled vectors that stand for ``each`` vectors; cells
    that come out at more than twice the size are cut again."""
    c = _k_means(x, int(np.ceil(each * len(x) / shard)))
    near = (x @ c.T).argmax(axis=1)
    out = []
    for j in range(len(c)):
        mine = x[near == j]
        if each * len(mine) > 2 * shard and 1 < len(mine) < len(x):
            out.append(fit_cell(mine, each, shard))
        else:
            out.append(c[j : j + 1])
    return np.concatenate(out)


class Router:
    """Centroids of one configuration, of one level or two; a shard is numbered by its centroid."""

    def __init__(self, coarse: np.ndarray | None, fine: list[np.ndarray]):
        self.coarse, self.fine = coarse, fine
        self.first = np.concatenate([[0], np.cumsum([len(f) for f in fine])])

    def nearest(self, x: np.ndarray, w: int) -> np.ndarray:
        """(rows, w) numbers of the shards of the nearest centroids, nearest first; -1 where there are fewer. With two
        levels those of the ``CELLS`` nearest cells are looked at."""
        return self._near(x, w)[0]

    def _near(self, x: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
        if self.coarse is None:
            return _top(x @ self.fine[0].T, w)
        cells = _top(x @ self.coarse.T, CELLS)[0]
        ids, sims = np.full((len(x), CELLS, w), -1), np.full((len(x), CELLS, w), -np.inf, np.float32)
        for cell in np.unique(cells[cells >= 0]):
            rows, place = np.nonzero(cells == cell)
            i, s = _top(x[rows] @ self.fine[cell].T, w)
            ids[rows, place] = np.where(i >= 0, i + self.first[cell], -1)
            sims[rows, place] = s
        ids, sims = ids.reshape(len(x), -1), sims.reshape(len(x), -1)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :w]
        return np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)

    def visited(self, x: np.ndarray, probes: int) -> np.ndarray:
        """Like ``nearest``: the own shard, the next ``probes``, then those whose border is within reach; -1 for the rest.

        A pair is lost only if each of the two lies farther than that from the border of the other's shard.
        """
        ids, sims = self._near(x, 1 + max(probes, VISITS))
        centroids = np.concatenate(self.fine)
        for a in range(0, len(x), 1024):
            i, s = ids[a : a + 1024], sims[a : a + 1024]
            apart = np.linalg.norm(centroids[i] - centroids[i[:, :1]], axis=2)
            far = s[:, :1] - s > REACH / x.shape[1] ** 0.5 * apart
            far[:, : 1 + probes] = False
            i[far] = -1
        return ids


def _top(s: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    ids, sims = np.full((len(s), w), -1), np.full((len(s), w), -np.inf, np.float32)
    n = min(w, s.shape[1])
    at = np.argpartition(-s, n - 1, axis=1)[:, :n]
    v = np.take_along_axis(s, at, 1)
    order = np.argsort(-v, axis=1, kind="stable")
    ids[:, :n], sims[:, :n] = np.take_along_axis(at, order, 1), np.take_along_axis(v, order, 1)
    return ids, sims


def _sampled(rows: DataFrame, id_col: str, step: int) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64(id_col), F.lit(step)) == 0)


def fit_centroids(vectors: DataFrame, dims: dict[str, int], id_col: str, emb_col: str, config_col: str, shard: int, sample: int, root: int = ROOT, most: int = MOST) -> dict[str, Router]:
    """The router of every configuration, fitted on at most about ``sample`` rows, or so many of each of ``root`` cells."""
    total = vectors.count()
    shard = max(shard, -(-total // most))
    step = max(1, total // sample)
    some = _sampled(vectors, id_col, step).select(config_col, emb_col).limit(4 * sample).toArrow()
    out, cells = {}, {}
    for name, _, x in _usable(some[config_col], some[emb_col], dims):
        x = np.unique(_unit(x), axis=0)
        if step * len(x) > root * shard:
            cells[name] = _k_means(x, root)
        else:
            out[name] = Router(None, [fit_cell(x, step, shard)])
    if not cells:
        return out
    finer = max(1, total // (root * sample))
    held = vectors.sparkSession.sparkContext.broadcast(cells)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, rows, x in _usable(batch.column("config"), batch.column("emb"), {n: dims[n] for n in cells}):
                x = np.unique(_unit(x), axis=0)
                near = (x @ held.value[name].T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(x), pa.string()), pa.array(near.astype(np.int32)), _binary(x)], ["config", "cell", "vec"])

    def fit(table: pa.Table) -> pa.Table:
        # A cell holding far more than its share is fitted on every n-th of its vectors.
        skip = max(1, len(table) // (4 * sample))
        c = fit_cell(np.unique(_matrix(table["vec"])[::skip], axis=0), finer * skip, shard)
        return pa.table({"config": pa.array([table["config"][0].as_py()] * len(c), pa.string()), "cell": pa.array(np.full(len(c), table["cell"][0].as_py(), np.int32)), "vec": _binary(c)})

    dealt = _sampled(vectors, id_col, finer).select(F.col(config_col).alias("config"), F.col(emb_col).alias("emb")).mapInArrow(deal, "config string, cell int, vec binary")
    fitted = dealt.groupBy("config", "cell").applyInArrow(fit, "config string, cell int, vec binary").toArrow()
    for name, coarse in cells.items():
        own = fitted.filter(pa.compute.equal(fitted["config"], name))
        c, cell = _matrix(own["vec"]), own["cell"].to_numpy()
        out[name] = Router(coarse, [c[cell == k] if (cell == k).any() else coarse[k : k + 1] for k in range(len(coarse))])
    return out


def _route(fitted, dims: dict[str, int], probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(dims)
        for batch in batches:
            for name, rows, x in _usable(batch.column("config"), batch.column("emb"), dims):
                h, first, copies = np.unique(_content(name, x), return_index=True, return_counts=True)
                x = _unit(x[first])
                router = fitted.value.get(name) or Router(None, [np.zeros((1, x.shape[1]), np.float32)])
                to = router.visited(x, probes)
                who, place = np.nonzero(to >= 0)
                shard = (names.index(name) << 40) + to[who, place].astype(np.int64)
                n = np.where(place == 0, copies[who], 0)
                for a in range(0, len(who), 4096):
                    at = who[a : a + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array(shard[a : a + 4096]), pa.array(h[at]), pa.array(n[a : a + 4096]), _binary(x[at])], ["shard", "h", "n", "vec"])

    return run


def _search_shard(k: int, least: float, ef: int):
    def run(table: pa.Table) -> pa.Table:
        from docquarry.llm.hnsw import Graph

        h, n = table["h"].to_numpy(), table["n"].to_numpy()
        order = np.lexsort((-n, h))
        h, n = h[order], n[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        total = np.add.reduceat(n, np.flatnonzero(first)) if len(n) else n
        h, x = h[first], _matrix(table["vec"])[order[first]]
        member = total > 0
        parts = []
        if member.any():
            names, copies = h[member], total[member]
            graph = Graph(x[member])
            asked = [(names, *graph.search_members(k, ef))]
            if (~member).any():
                asked.append((h[~member], *graph.search(x[~member], k, ef)))
            for who, ids, cos in asked:
                r, c = np.nonzero((ids >= 0) & (cos >= least))
                parts.append((who[r], names[ids[r, c]], cos[r, c].astype(np.float64), copies[ids[r, c]]))
        cols = [np.concatenate(z) for z in zip(*parts)] if parts else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        return pa.table({"h": cols[0].astype(np.int64), "near": cols[1].astype(np.int64), "cosine": cols[2], "n_near": cols[3].astype(np.int64)})

    return run


def similar_classes(
    vectors: DataFrame, config: DataFrame, k: int = 10, least: float = -1.0, id_col: str = "vec_id", emb_col: str = "embedding", config_col: str = "config_name", probes: int = 1, ef: int = 20,
    shard: int = SHARD, sample: int = SAMPLE,
) -> tuple[DataFrame, DataFrame]:
    """(lists, members). lists: (h, near, cosine, rank) with the classes among the k most similar of class h at a cosine
    of at least ``least``; members: (cls, id). A class is all vectors of equal content; its copies count into the k.
    """
    spark = vectors.sparkSession
    dims = {r["config_name"]: int(r["dimensions"]) for r in config.where("config_name IS NOT NULL AND dimensions > 0").select("config_name", "dimensions").distinct().collect()}
    kind = dict(vectors.dtypes)[id_col]
    vectors = vectors.where(F.col(id_col).isNotNull())
    routers = fit_centroids(vectors, dims, id_col, emb_col, config_col, shard, sample)
    fitted = spark.sparkContext.broadcast(routers)
    src = spread(vectors.select(F.col(id_col).alias("id"), F.col(config_col).alias("config"), F.col(emb_col).alias("emb")))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, rows, x in _usable(batch.column("config"), batch.column("emb"), dims):
                yield pa.RecordBatch.from_arrays([pa.array(_content(name, x)), batch.column("id").take(pa.array(rows))], ["cls", "id"])

    members = materialise(src.mapInArrow(contents, f"cls bigint, id {kind}"))
    routed = src.select("config", "emb").mapInArrow(_route(fitted, dims, probes), "shard bigint, h bigint, n bigint, vec binary")
    # A partition for every shard, so that the largest task does not grow with the collection.
    routed = routed.repartition(max(1, sum(int(r.first[-1]) for r in routers.values())), "shard")
    found = routed.groupBy("shard").applyInArrow(_search_shard(k, least, ef), "h bigint, near bigint, cosine double, n_near bigint")
    copies = members.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1").select(F.col("cls").alias("h"), "n")
    found = found.repartition("h").groupBy("h", "near").agg(F.max("cosine").alias("cosine"), F.max("n_near").alias("n_near")).join(copies, "h", "left")
    before = F.coalesce(F.sum("n_near").over(Window.partitionBy("h").orderBy(F.desc("cosine")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lists = found.withColumn("rank", before + F.coalesce(F.col("n"), F.lit(1))).where(F.col("rank") <= k)
    return lists.select("h", "near", "cosine", "rank"), members


def similar_pairs(vectors: DataFrame, config: DataFrame, k: int = 10, least: float = 0.8, id_col: str = "vec_id", expand: int | None = EXPAND, **options) -> DataFrame:
    """Pairs ({id}_a, {id}_b) of one configuration with a cosine of at least ``least`` in which one is among the k most
    similar of the other; classes of more than ``expand`` copies as a star around their smallest id (None: all pairs)."""
    lists, members = similar_classes(vectors, config, k, least, id_col, **options)
    links = lists.select(F.least("h", "near").alias("a"), F.greatest("h", "near").alias("b")).distinct()
    return expand_pairs(links, members, expand).select(F.col("a").alias(f"{id_col}_a"), F.col("b").alias(f"{id_col}_b")).distinct()
