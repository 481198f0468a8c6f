"""Near duplicates, similar vectors, packing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import near_duplicates, packing, similar_vectors
from docquarry.llm.hnsw import Graph, _nearest

WORDS = [f"w{i}" for i in range(400)]


def texts(seed=5, groups=25):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [rng.choice(WORDS) for _ in range(rng.randint(80, 160))]
        for _ in range(rng.randint(1, 5)):
            t = list(base)
            for _ in range(rng.randint(0, 12)):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            out.append(" ".join(t))
    return out


def shingles(t):
    w = t.lower().split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 80 else None


def test_pairs_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    rows += [(1000, rows[0][1].upper()), (1001, rows[0][1]), (1002, None), (1003, ""), (1004, "short text"), (1005, "same " * 100), (1006, "same " * 90)]
    df = spark.createDataFrame(rows, "page_key bigint, text string").withColumn("a", F.lit("clash")).withColumn("id", F.lit("clash"))
    got = {tuple(r) for r in near_duplicates.near_duplicate_pairs(df).collect()}
    sets = {k: shingles(t or "") for k, t in rows}
    keys = [k for k in sets if sets[k]]
    want = {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    want = {(min(p), max(p)) for p in want}
    near = {p for p in want if len(sets[p[0]] & sets[p[1]]) >= 0.65 * len(sets[p[0]] | sets[p[1]])}
    assert got <= want and near <= got and (0, 1000) in got and (1005, 1006) in got
    assert near_duplicates.near_duplicate_pairs(df.limit(0)).count() == 0


def test_a_third_of_all_rows_being_copies_stays_linear(spark):
    ts = texts(8, 10)
    rows = list(enumerate(ts)) + [(10_000 + i, ts[0]) for i in range(200)]
    df = spark.createDataFrame(rows, "page_key bigint, text string")
    got = [tuple(r) for r in near_duplicates.near_duplicate_pairs(df).collect()]
    stars = [p for p in got if p[1] >= 10_000]
    assert len(stars) == 200 and {p[0] for p in stars} == {0}
    links, members = near_duplicates.near_duplicate_links(df)
    assert members.count() == len(rows) and members.where("cls = 0").count() == 201


def test_every_pair_at_the_threshold_shares_a_shingle_of_its_prefixes(spark):
    rng = random.Random(11)
    rows = []
    for k in range(400):  # 300 shingles each way, 75 of them changed: similarity 0.6 to 0.62
        base = [f"x{k}_{i}" for i in range(302)]
        other = base[:227] + [f"y{k}_{i}" for i in range(rng.choice([72, 73, 74, 75]))]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    want = {(2 * k, 2 * k + 1) for k in range(400) if (n := len(shingles(rows[2 * k][1]) & shingles(rows[2 * k + 1][1]))) >= 0.6 * (len(shingles(rows[2 * k][1])) + len(shingles(rows[2 * k + 1][1])) - n)}
    got = {tuple(r) for r in near_duplicates.near_duplicate_pairs(spark.createDataFrame(rows, "page_key bigint, text string")).collect()}
    assert got == want and len(want) > 200


def test_split_postings_give_the_same_links(spark):
    """A template shared by all pages: its shingles are hot, and pages made of little else meet only through them."""
    rng = random.Random(4)
    template = [f"t{i}" for i in range(120)]
    rows = []
    for k in range(120):
        t = list(template)
        for _ in range(rng.choice([0, 3, 12, 25])):
            t[rng.randrange(len(t))] = f"own{k}_{rng.random()}"
        rows.append((k, " ".join(t)))
    df = spark.createDataFrame(rows, "page_key bigint, text string")
    links = lambda hot: {tuple(r) for r in near_duplicates.near_duplicate_links(df, hot=hot)[0].collect()}
    assert links(10) == links(10**6) and len(links(10)) > 300


def test_postings_are_small_and_keep_long_pages(spark, monkeypatch):
    """A row of an index holds no more than three values; places that do not fit into it lose no pair."""
    from docquarry.llm.near_duplicates import _postings

    rng = random.Random(6)
    rows = [(k, " ".join([f"s{k // 2}_{i}" for i in range(200)] + [f"own{k}_{rng.random()}" for _ in range(rng.choice([20, 60]))])) for k in range(60)]
    df = spark.createDataFrame(rows, "page_key bigint, text string")
    sigs = near_duplicates.signatures(df, "page_key", "text", 3, 80)
    (batch,) = list(_postings(False)(iter(sigs.toArrow().combine_chunks().to_batches())))
    assert batch.schema.names == ["key", "id", "n", "parts"] and batch["key"].null_count == 0
    links = lambda: {tuple(r) for r in near_duplicates.near_duplicate_links(df)[0].collect()}
    want = links()
    assert len(want) > 10
    monkeypatch.setattr(near_duplicates, "ANY", 63)
    assert links() == want


def vectors(n=1500, d=32, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, d))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(scale=0.25, size=(n, d))
    return (x * rng.uniform(0.1, 9, (n, 1))).astype(np.float32)


def true_pairs(x, k=10, least=0.8):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -1)
    kth = -np.sort(-s, axis=1)[:, k - 1]
    i, j = np.nonzero((s >= least) & (s >= kth[:, None] - 1e-9))
    return {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, config_name string, embedding array<float>")


@pytest.mark.parametrize("shard", [4096, 200, 40])
def test_recall_against_brute_force(spark, shard):
    x = vectors()
    df = frame(spark, [(i, "c", v.tolist()) for i, v in enumerate(x)])
    config = spark.createDataFrame([("c", 32), ("other", 8), (None, 3)], "config_name string, dimensions int")
    got = {tuple(r) for r in similar_vectors.similar_pairs(df, config, shard=shard).collect()}
    want = true_pairs(x)
    assert len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.05 * len(got)


def test_unusable_vectors_and_copies(spark):
    rng = np.random.default_rng(4)
    good = rng.normal(size=(30, 8)).astype(np.float32)
    rows = [(i, "c", v.tolist()) for i, v in enumerate(good)] + [(100 + i, "c", good[0].tolist()) for i in range(90)]
    rows += [(500, "c", None), (501, "c", []), (502, "c", [0.0] * 8), (503, "c", [float("nan")] * 8), (504, "c", [1.0] * 7), (505, None, good[0].tolist()), (506, "x", good[0].tolist()), (507, "c", [None] + [1.0] * 7), (508, "d", good[0].tolist()), (509, "d", (2 * good[0]).tolist())]
    df = frame(spark, rows).withColumn("h", F.lit("clash"))
    config = spark.createDataFrame([("c", 8), ("d", 8)], "config_name string, dimensions int")
    got = {tuple(r) for r in similar_vectors.similar_pairs(df, config).collect()}
    assert {(0, 100 + i) for i in range(90)} <= got and (508, 509) in got
    assert not any(500 <= a <= 507 or 500 <= b <= 507 for a, b in got) and len([p for p in got if p[0] >= 100 and p[1] < 500]) == 0
    assert similar_vectors.similar_pairs(df.limit(0), config).count() == 0


def test_graph_search_recall():
    x = vectors(2500, 24, 7)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = Graph(x[:2000])
    ids, cos = g.search(x[2000:], 10, ef=48)
    truth = np.argsort(-(x[2000:] @ x[:2000].T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), truth.tolist())]) >= 0.9
    assert (np.diff(cos, axis=1) <= 1e-6).all() and len(g.levels) > 1
    assert Graph(x[:1]).search(x[1:2], 3)[0].tolist() == [[0, -1, -1]] and _nearest(x[:1], 2)[0].tolist() == [[-1, -1]]


def test_members_are_searched_in_graphs_built_of_blocks(monkeypatch):
    from docquarry.llm import hnsw

    monkeypatch.setattr(hnsw, "BLOCK", 256)
    x = vectors(3000, 16, 9)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, cos = Graph(x).search_members(10, ef=48)
    truth = np.argsort(-(x @ x.T - 9 * np.eye(len(x))), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), truth.tolist())]) >= 0.9
    assert not (ids == np.arange(len(x))[:, None]).any() and ids.shape == (3000, 10)


def test_two_levels_of_centroids_lose_no_vector(spark, monkeypatch):
    x = vectors(2000, 12, 5)
    df = frame(spark, [(i, "c", v.tolist()) for i, v in enumerate(x)])
    config = spark.createDataFrame([("c", 12)], "config_name string, dimensions int")
    routers = similar_vectors.fit_centroids(df, {"c": 12}, "vec_id", "embedding", "config_name", 100, 400, root=4)
    assert routers["c"].coarse is not None and routers["c"].first[-1] >= 10
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    to = routers["c"].nearest(unit, 2)
    assert (to >= 0).all() and (to[:, 0] != to[:, 1]).all() and np.bincount(to[:, 0]).max() < 1000
    plain = similar_vectors.fit_centroids
    monkeypatch.setattr(similar_vectors, "fit_centroids", lambda *a: plain(*a, root=4))
    got = {tuple(r) for r in similar_vectors.similar_pairs(df, config, k=5, least=0.5, probes=3, shard=150, sample=600).collect()}
    cos = unit @ unit.T - 9 * np.eye(len(x))
    near = np.argsort(-cos, axis=1)[:, :5]
    want = {(min(i, int(j)), max(i, int(j))) for i in range(len(x)) for j in near[i] if cos[i, j] >= 0.5}
    assert len(got & want) >= 0.9 * len(want)


def test_many_shards_lose_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(11)
    x = np.repeat(rng.normal(size=(1000, 32)), 3, axis=0) + 0.3 * rng.normal(size=(3000, 32))
    df = frame(spark, [(i, "c", v.tolist()) for i, v in enumerate(x.astype(np.float32))])
    config = spark.createDataFrame([("c", 32)], "config_name string, dimensions int")
    plain = similar_vectors.fit_centroids
    monkeypatch.setattr(similar_vectors, "fit_centroids", lambda *a: plain(*a, root=16))
    got = {tuple(r) for r in similar_vectors.similar_pairs(df, config, shard=20, sample=3000).collect()}
    want = true_pairs(x)
    assert len(want) > 2000 and len(want & got) >= 0.98 * len(want) and len(got - want) <= 0.01 * len(got)


def test_every_pair_of_copies_on_request(spark):
    rows = [(i, "c", [1.0, 2.0]) for i in range(70)] + [(100, "c", [2.0, 3.0])]
    config = spark.createDataFrame([("c", 2)], "config_name string, dimensions int")
    star = similar_vectors.similar_pairs(frame(spark, rows), config, k=100)
    every = similar_vectors.similar_pairs(frame(spark, rows), config, k=100, expand=None)
    assert star.count() == 70 and every.count() == 70 * 69 // 2 + 70


def test_plans_place_everything_tightly():
    rng = random.Random(1)
    histogram = {s: rng.randint(1, 30) for s in rng.sample(range(1, 8193), 900)}
    capacities = [512, 2048, 8192]
    patterns = packing.plan(histogram, capacities)
    placed = {}
    for p in patterns:
        assert p.fill <= capacities[p.tier] and p.times > 0
        for s, m in p.parts.items():
            placed[s] = placed.get(s, 0) + m * p.times
    assert placed == histogram
    for tier, low in ((2, 2048), (1, 512)):
        assert all(max(p.parts) > low for p in patterns if p.tier == tier)
    long = [p for p in patterns if p.tier == 2]
    assert sum(p.fill * p.times for p in long) / sum(8192 * p.times for p in long) > 0.95


def test_packing_of_tables(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["word"] * rng.randint(1, 300)), "x") for i in range(300)] + [(900, None, "x"), (901, "", "x"), (902, "word " * 2100, "x"), (5, "word again", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, container_no string").repartition(5)
    boxes = spark.createDataFrame([("s", 128), ("m", 512), ("l", 1024), (None, 9), ("bad", 0)], "container_type string, capacity_tokens int")
    got = packing.pack_documents(docs, boxes, step=4).toPandas()
    assert set(got["doc_id"]) == {r[0] for r in rows} and got.loc[got["doc_id"].isin([900, 901]), "container_no"].isna().all()
    used = got.dropna(subset=["container_no"])
    fill = used.groupby(["container_type", "container_no"])["n_tokens"].sum()
    room = {"s": 128, "m": 512, "l": 1024}
    assert all(v <= room[t] for (t, _), v in fill.items())
    pieces = got[got["doc_id"] == 902].sort_values("piece_no")
    assert len(pieces) == 3 and (pieces["start_token"].tolist(), pieces["n_tokens"].tolist()[:2]) == ([0, 1024, 2048], [1024, 1024])
    assert (got.groupby("doc_id").size().drop([902, 5]) == 1).all()
    groups = used.groupby(["container_type", "step_group"])["container_no"].nunique()
    assert groups.max() <= 4
    report = {r["container_type"]: r["fill"] for r in packing.packing_report(packing.pack_documents(docs, boxes), boxes).collect()}
    assert report["l"] > 0.95 and report["m"] > 0.95
    assert packing.pack_documents(docs.limit(0), boxes).count() == 0
    assert packing.pack_documents(docs, boxes.limit(0)).where("container_no IS NULL").count() == len(rows)
