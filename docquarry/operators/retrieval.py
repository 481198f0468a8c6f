"""Ranked retrieval: BM25 over an inverted index, exact dense search, rank fusion, top-k per query.

Documents are rows with an id column ``chunk_id`` and optional group columns (company, year). Statistics of BM25 are
those of the whole store, rankings are per query and group. All ranks break ties by ``chunk_id``.

Term counts of a document are final in the task that reads it: no token is shuffled. For a stated set of query terms the
index holds only their postings, as one small array per document.

Defined results: a null or empty text has no postings, length 0 counts as 1; a query whose terms occur nowhere scores
0 everywhere; a null group year matches null, and every year of the company after ``any_year``; repeated query terms add
repeatedly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.common import materialise, small, spread
from docquarry.functions import text as T

K1, B, RRF = 1.5, 0.75, 60


#: Terms of a stated set of queries that are looked up in the plan itself; more are joined.
PLAN_TERMS = 5_000


@dataclass
class Postings:
    """Inverted index: postings (chunk_id, groups, term, tf, dl), df per term, and one row of totals (n, avgdl)."""

    postings: DataFrame
    df: DataFrame
    totals: DataFrame
    documents: DataFrame


def plain_tokens(c: Column | str) -> Column:
    """Lower-case word tokens without accent-free doubles."""
    return F.regexp_extract_all(F.lower(F.col(c) if isinstance(c, str) else c), F.lit(T.TOKEN), F.lit(0))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of each term of every document."""
    for batch in batches:
        counts = [Counter(t) for t in batch.column("terms").to_pylist()]
        kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
        hits = pa.array([[{"term": t, "tf": n} for t, n in c.items()] for c in counts], kind)
        names = [c for c in batch.schema.names if c != "terms"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), hits], [*names, "hits"])


def build_index(docs: DataFrame, text_col: str = "text", groups: tuple[str, ...] = (), tokens: Column | None = None, terms: DataFrame | None = None) -> Postings:
    """Tokenise once and write (checkpoint) one row per document: its length and the counts of its terms.

    terms: (query_id, term, qtf) of a stated set of queries; then only these terms are kept, in the plan for up to
    ``PLAN_TERMS`` of them. All statistics come from the written rows; an index of all terms serves any query.
    """
    found = F.coalesce(tokens if tokens is not None else T.tokenize(text_col), F.array().cast("array<string>"))
    base = spread(docs.select("chunk_id", *groups, found.alias("terms"))).select("chunk_id", *groups, F.size("terms").alias("dl"), "terms")
    asked = None if terms is None else [r["term"] for r in terms.select("term").distinct().limit(PLAN_TERMS + 1).collect()]
    if asked is not None and len(asked) <= PLAN_TERMS:
        kept = base.withColumn("terms", F.filter("terms", lambda t: t.isin(asked)))
        count = lambda t: F.size(F.filter("terms", lambda x: x == t)).cast("bigint")
        rows = kept.select("chunk_id", *groups, "dl", F.transform(F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), count(t).alias("tf"))).alias("hits"))
    else:
        kinds = dict(base.dtypes)
        schema = ", ".join([*(f"{c} {kinds[c]}" for c in ("chunk_id", *groups, "dl")), "hits array<struct<term:string,tf:bigint>>"])
        rows = base.mapInArrow(_count_terms, schema)
    rows = materialise(rows)
    posts = rows.select("chunk_id", *groups, "dl", F.explode("hits").alias("h")).select("chunk_id", *groups, "dl", "h.term", "h.tf")
    df = posts.groupBy("term").agg(F.count("*").alias("df"))
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("all"))
    totals = totals.select("n", F.greatest(F.col("all") / F.nullif("n", F.lit(0)), F.lit(1e-9)).alias("avgdl"))
    return Postings(posts, df, totals, rows.select("chunk_id", *groups))


def any_year(rows: DataFrame, cells: DataFrame, company: str = "company", year: str = "year") -> DataFrame:
    """The rows, and each once more under a null year where ``cells`` asks for the company without a year.

    A cell of unknown year is answered from all years of its company; rows of unknown year belong to it once.
    """
    open_cells = small(cells.where(F.col(year).isNull() & F.col(company).isNotNull()).select(F.col(company).alias("__c")).distinct())
    more = rows.where(F.col(year).isNotNull()).join(open_cells, F.col(company) == F.col("__c")).drop("__c")
    return rows.unionByName(more.withColumn(year, F.lit(None).cast(dict(rows.dtypes)[year])))


def query_terms(queries: DataFrame, text_col: str = "query", tokens: Column | None = None) -> DataFrame:
    """(query_id, term, qtf): terms of each query with their multiplicity."""
    terms = tokens if tokens is not None else T.tokenize(text_col)
    return queries.select("query_id", F.explode(terms).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def bm25_scores(index: Postings, terms: DataFrame, groups: tuple[str, ...] = ()) -> DataFrame:
    """(query_id, groups, chunk_id, bm25_score) of documents sharing a term with the query.

    Only postings of query terms are touched: the terms, few for a stated set of queries, are counted and then
    broadcast, so that postings are filtered where they are read.
    """
    idf = index.df.crossJoin(F.broadcast(index.totals)).select("term", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), F.col("avgdl"))
    weighted = idf.join(small(terms), "term")
    hits = index.postings.join(small(weighted), "term")
    dl = F.greatest("dl", F.lit(1))
    part = F.col("qtf") * F.col("idf") * (F.col("tf") * (K1 + 1)) / (F.col("tf") + K1 * (1 - B + B * dl / F.col("avgdl")))
    return hits.groupBy("query_id", *groups, "chunk_id").agg(F.sum(part).alias("bm25_score"))


def top_k(scored: DataFrame, keys: list[str], score: str, k: int, rank: str, digits: int | None = 9) -> DataFrame:
    """The k best rows per key with their rank, scores compared at ``digits`` decimals, ties by chunk_id."""
    value = F.col(score) if digits is None else F.round(score, digits)
    w = Window.partitionBy(*keys).orderBy(value.desc(), F.asc("chunk_id"))
    return scored.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def bm25_top_k(index: Postings, terms: DataFrame, k: int, groups: tuple[str, ...] = ()) -> DataFrame:
    return top_k(bm25_scores(index, terms, groups), ["query_id", *groups], "bm25_score", k, "bm25_rank")


def with_zero_scores(ranked: DataFrame, documents: DataFrame, queries: DataFrame, groups: tuple[str, ...], k: int) -> DataFrame:
    """Fill lists shorter than k with documents of score 0, lowest ids first, as an exhaustive ranking would."""
    heads = top_k(documents.select(*groups, "chunk_id").withColumn("zero", F.lit(0.0)), list(groups), "zero", k, "__r") if groups else documents.select("chunk_id").orderBy("chunk_id").limit(k)
    filler = heads.select(*groups, "chunk_id").crossJoin(F.broadcast(queries.select("query_id").distinct()))
    filler = filler.join(ranked.select("query_id", *groups, "chunk_id"), ["query_id", *groups, "chunk_id"], "left_anti").withColumn("bm25_score", F.lit(0.0))
    both = ranked.select("query_id", *groups, "chunk_id", "bm25_score").unionByName(filler)
    return top_k(both, ["query_id", *groups], "bm25_score", k, "bm25_rank")


def dense_top_k(docs: DataFrame, queries: list[tuple[object, list[float]]], k: int, groups: tuple[str, ...] = (), vector: str = "embedding", id_type: str = "string", mask: str | None = None) -> DataFrame:
    """(query_id, groups, chunk_id, dense_score, dense_rank): exact dot products, every query against every document.

    The query matrix (a stated set of queries) goes to the workers; each batch keeps its k best per query and group, so
    what is shuffled does not grow with batch size and a group holding a third of all rows is never in one task.
    Vectors that are null or of another length than the queries do not take part. ``mask`` names a query id column of
    the documents that is left out of its own list.
    """
    ids = [q for q, _ in queries]
    matrix = np.array([v for _, v in queries], dtype=np.float64).reshape(len(queries), -1)
    kinds = dict(docs.dtypes)
    names = ["chunk_id", *groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                lists = batch.column("vec")
                fits = np.flatnonzero(np.asarray(pc.fill_null(pc.equal(pc.list_value_length(lists), matrix.shape[1]), False).to_numpy(zero_copy_only=False), dtype=bool))
                if not len(fits) or not len(ids):
                    continue
                x = lists.take(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(fits), -1)
                scores = matrix @ x.T
                part = batch.take(pa.array(fits))
                if groups:
                    table = pa.table({g: part.column(g) for g in groups}).to_pandas()
                    code = table.groupby(list(groups), dropna=False, sort=False).ngroup().to_numpy()
                else:
                    code = np.zeros(len(fits), np.int64)
                rows, which = [], []
                for g in np.unique(code):
                    own = np.flatnonzero(code == g)
                    s = scores[:, own]
                    # all ties with the k-th are kept here; the final rank decides
                    if len(own) > k:
                        kth = np.partition(s, len(own) - k, axis=1)[:, len(own) - k]
                        q, c = np.nonzero(np.round(s, 9) >= np.round(kth, 9)[:, None] - 1e-9)
                    else:
                        q, c = np.nonzero(np.ones_like(s, bool))
                    rows.append(own[c])
                    which.append(q)
                r, q = np.concatenate(rows), np.concatenate(which)
                take = pa.array(r)
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in q]), *(part.column(n).take(take) for n in names), pa.array(scores[q, r])], ["query_id", *names, "dense_score"])

    schema = ", ".join([f"query_id {id_type}", *(f"{n} {kinds[n]}" for n in names), "dense_score double"])
    found = docs.select(*names, F.col(vector).alias("vec")).mapInArrow(run, schema)
    if mask:
        found = found.where(F.col("query_id") != F.col("chunk_id"))
    return top_k(found, ["query_id", *groups], "dense_score", k, "dense_rank")


def _pack(id_name: str, size: int):
    """Rows (ids, vectors) of up to ``size`` rows of one length each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec")
            width = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))
            for w in np.unique(width[width > 0]):
                rows = np.flatnonzero(width == w)
                for a in range(0, len(rows), size):
                    at = pa.array(rows[a : a + size])
                    x = lists.take(at).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
                    ids = batch.column(id_name).take(at)
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), ids), pa.array([x.tobytes()], pa.binary())], ["ids", "vecs"])

    return run


def dense_top_k_blocks(docs: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", mask: bool = False, block: int = 1024, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(query_id, chunk_id, dense_score, dense_rank) for queries that are rows of a table (query_id, vector).

    Both sides are packed into blocks of ``block`` rows; every pair of blocks is one matrix product, of which each query
    keeps its k best before anything is shuffled. The query blocks are broadcast while their bytes stay under
    ``broadcast_bytes``, else the pairs of blocks are dealt by the planner. Null vectors and those of another length do
    not take part; with ``mask`` a query is left out of its own list.
    """
    kinds = dict(docs.dtypes), dict(queries.dtypes)
    pack = lambda df, name, kind: df.select(name, F.col(vector).alias("vec")).mapInArrow(_pack(name, block), f"ids array<{kind}>, vecs binary")
    left = pack(spread(docs.select("chunk_id", vector)), "chunk_id", kinds[0]["chunk_id"])
    right = materialise(pack(queries, "query_id", kinds[1]["query_id"]).withColumnsRenamed({"ids": "qids", "vecs": "qvecs"}))
    size = right.agg(F.coalesce(F.sum(F.length("qvecs")), F.lit(0)).alias("n")).first()["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                d, q = batch.column("ids")[i].values, batch.column("qids")[i].values
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.float64) for c in ("vecs", "qvecs"))
                if len(x) // len(d) != len(y) // len(q):
                    continue
                s = np.round(y.reshape(len(q), -1) @ x.reshape(len(d), -1).T, 9)
                if mask:
                    at = {v: j for j, v in enumerate(d.to_pylist())}
                    own = [(j, at[v]) for j, v in enumerate(q.to_pylist()) if v in at]
                    if own:
                        s[tuple(zip(*own))] = -np.inf
                least = np.partition(s, len(d) - k, axis=1)[:, len(d) - k] if len(d) > k else np.full(len(q), -np.inf)
                r, c = np.nonzero((s >= least[:, None]) & np.isfinite(s))  # all ties with the k-th; the final rank decides
                yield pa.RecordBatch.from_arrays([q.take(pa.array(r)), d.take(pa.array(c)), pa.array(s[r, c])], ["query_id", "chunk_id", "dense_score"])

    met = left.crossJoin(F.broadcast(right) if size <= broadcast_bytes else right)  # a stated query set against all rows, in blocks
    found = met.mapInArrow(run, f"query_id {kinds[1]['query_id']}, chunk_id {kinds[0]['chunk_id']}, dense_score double")
    return top_k(found, ["query_id"], "dense_score", k, "dense_rank")


def fuse(bm25: DataFrame, dense: DataFrame, k: int, groups: tuple[str, ...] = ()) -> DataFrame:
    """Reciprocal rank fusion: a list in which a document is missing counts as rank k + 1."""
    keys = ["query_id", *groups, "chunk_id"]
    both = bm25.select(*keys, "bm25_score", "bm25_rank").join(dense.select(*keys, "dense_score", "dense_rank"), keys, "full_outer")
    rank = lambda c: F.coalesce(F.col(c), F.lit(k + 1))
    score = 1 / (RRF + rank("bm25_rank")) + 1 / (RRF + rank("dense_rank"))
    return top_k(both.withColumn("hybrid_score", score), ["query_id", *groups], "hybrid_score", k, "hybrid_rank", digits=12)


def pair_scorer(score: Callable[[list[str], list[str]], list[float]], query: str = "query", text: str = "text", batch: int = 256) -> Column:
    """A model that reads a query and a passage together, as a column over Arrow batches; ``score`` gets the texts of a batch.

    The pairs of all queries go through the same batches, so many small lists cost no more than one long one. A null
    query or passage is read as an empty text.
    """

    @F.pandas_udf("double")
    def run(q: pd.Series, t: pd.Series) -> pd.Series:
        a, b = q.fillna("").tolist(), t.fillna("").tolist()
        return pd.Series([float(x) for k in range(0, len(a), batch) for x in score(a[k : k + batch], b[k : k + batch])], dtype="float64")

    return run(F.col(query), F.col(text))


def rerank(fused: DataFrame, k: int, groups: tuple[str, ...] = (), scorer: Column | None = None, skip_at: float | None = None, model: str = "pluggable") -> DataFrame:
    """The k best after a second scoring; without a scorer the hybrid score stays.

    Where the best hybrid score of a list reaches ``skip_at`` the list is kept as it is and the scorer is not asked.
    """
    keys = ["query_id", *groups]
    if scorer is None:
        out = top_k(fused.withColumn("rerank_score", F.col("hybrid_score")), keys, "rerank_score", k, "rank", digits=12)
        return out.withColumn("reranker", F.lit("hybrid-fallback"))
    if skip_at is None:
        return top_k(fused.withColumn("rerank_score", scorer), keys, "rerank_score", k, "rank", digits=12).withColumn("reranker", F.lit(model))
    best = F.max("hybrid_score").over(Window.partitionBy(*keys))  # a list has at most as many rows as were fused
    marked = fused.withColumn("__sure", best >= skip_at)
    asked = marked.where(~F.col("__sure")).withColumns({"rerank_score": scorer, "reranker": F.lit(model)})
    kept = marked.where("__sure").withColumns({"rerank_score": F.col("hybrid_score"), "reranker": F.lit("hybrid-fallback")})
    return top_k(asked.unionByName(kept).drop("__sure"), keys, "rerank_score", k, "rank", digits=12)


def merge_candidates(dense: DataFrame, keyword: DataFrame, keys: list[str]) -> DataFrame:
    """One row per candidate with the scores and ranks of both searches; dense order first."""
    out = dense.select(*keys, "dense_score", "dense_rank").join(keyword.select(*keys, "bm25_score", "bm25_rank"), keys, "full_outer")
    return out.withColumn("first_seen", F.coalesce(F.col("dense_rank"), F.lit(1_000_000) + F.col("bm25_rank")))


def split_by_cache(wanted: DataFrame, cached: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): rows of ``wanted`` whose key is in the cache, and the rest."""
    known = cached.select(*keys).distinct()
    return wanted.join(known, keys, "left_semi"), wanted.join(known, keys, "left_anti")
