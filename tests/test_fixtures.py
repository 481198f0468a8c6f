"""Golden values of the text, retrieval, evaluation, index and agreement operators."""

import pytest
from pyspark.sql import functions as F

from docquarry.functions import text as T
from docquarry.operators import agreement, chunking, evidence, financial, index, reports, retrieval


def values(spark, column, texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r["x"] for r in df.select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


def test_normalize_text(spark):
    assert values(spark, T.normalize_text, ["a\x00b", " a \t b ", "a\n\n\n\nb", None, "", "\xa0x\xa0"]) == ["a b", "a b", "a\n\nb", None, "", "x"]


def test_accents_keep_the_stroke_unless_folded(spark):
    assert values(spark, T.strip_accents, ["phát đồng", "ﬁ ５", None]) == ["phat đong", "fi 5", None]
    assert values(spark, T.strip_accents_exact, ["phát đồng", "½", None]) == ["phat đong", "1⁄2", None]
    assert values(spark, T.fin_normalize, ["  Tổng  Cộng\tTài Sản đồng "]) == ["tong cong tai san dong"]


def test_tokenize_adds_plain_forms(spark):
    got = values(spark, T.tokenize, ["Phát thải CO2-e 5.5% m³ đồng", "", None])
    assert got[0] == ["phát", "phat", "thải", "thai", "co2-e", "5", "5", "m³", "m3", "đồng", "đong"]
    assert got[1:] == [[], None]


def test_content_terms(spark):
    assert values(spark, T.content_terms, ["The policy of 12 kg and ab x1 phát"])[0] == ["policy", "12", "kg", "x1", "phat"]


def test_hash_buckets():
    assert {t: T.token_bucket(t, 1024) for t in ("esg", "co2e", "phát", "total", "assets")} == {"esg": (589, 1.0), "co2e": (943, -1.0), "phát": (672, -1.0), "total": (504, -1.0), "assets": (867, -1.0)}
    e = T.embed_batch(["esg co2e esg", "", None], 1024)
    assert e[0, 589] == pytest.approx(2 / 5**0.5) and e[0, 943] == pytest.approx(-1 / 5**0.5) and not e[1:].any()


@pytest.mark.parametrize(
    "n, size, overlap, want",
    [(0, 5, 2, []), (5, 5, 2, [(0, 5)]), (6, 5, 2, [(0, 5), (3, 6)]), (9, 5, 2, [(0, 5), (3, 8), (6, 9)]), (12, 5, 2, [(0, 5), (3, 8), (6, 11), (9, 12)]), (651, 650, 100, [(0, 650), (550, 651)])],
)
def test_windows(spark, n, size, overlap, want):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "page_key int, text string")
    got = [(r["first_token"], r["first_token"] + r["n_tokens"]) for r in chunking.split_text(df, size, overlap).orderBy("window_no").collect()]
    assert got == want


def test_windows_are_exact_substrings(spark):
    df = spark.createDataFrame([(1, "  a\t b\n\nc\xa0d  e "), (2, None)], "page_key int, text string")
    assert [r["chunk"] for r in chunking.split_text(df, 3, 1).orderBy("window_no").collect()] == ["a\t b\n\nc", "c\xa0d  e"]
    with pytest.raises(ValueError):
        chunking.split_text(df, 3, 3)


def test_chunk_ids_count_within_reports(spark):
    rows = [(k, "A", 2020 if k < 5 else None, k, "f1" if k < 5 else "f2", "x " * 7) for k in range(9)]
    df = spark.createDataFrame(rows, "page_key int, company string, year int, page_number int, source_file string, text string")
    got = chunking.chunk_reports(df, 5, 2, "FIN_")
    ids = [r["chunk_id"] for r in got.orderBy("source_file", "page_key", "window_no").collect()]
    assert ids[:3] == ["A_2020_FIN_000001", "A_2020_FIN_000002", "A_2020_FIN_000003"] and ids[10] == "A_unknown_FIN_000001" and len(set(ids)) == len(ids) == 18


def bm25(spark, query):
    docs = spark.createDataFrame([("d0", "carbon emission report emission"), ("d1", "board meeting report"), ("d2", "carbon board carbon")], "chunk_id string, text string")
    terms = retrieval.query_terms(spark.createDataFrame([("q", query)], "query_id string, query string"))
    return {r["chunk_id"]: round(r["bm25_score"], 6) for r in retrieval.bm25_scores(retrieval.build_index(docs), terms).collect()}


def test_bm25(spark):
    assert bm25(spark, "carbon emission") == {"d0": 1.747745, "d2": 0.693732}
    assert bm25(spark, "carbon carbon") == {"d0": 0.862392, "d2": 1.387465}
    assert bm25(spark, "zzz") == {}


def test_zero_scores_fill_lists(spark):
    docs = spark.createDataFrame([("d0", "a"), ("d1", None), ("d2", "b")], "chunk_id string, text string")
    queries = spark.createDataFrame([("q", "b")], "query_id string, query string")
    ix = retrieval.build_index(docs)
    full = retrieval.with_zero_scores(retrieval.bm25_top_k(ix, retrieval.query_terms(queries), 3), ix.documents, queries, (), 2)
    assert [r["chunk_id"] for r in full.orderBy("bm25_rank").collect()] == ["d2", "d0"]


def test_fusion(spark):
    b = spark.createDataFrame([("q", "x", 1.0, 1), ("q", "y", 0.9, 3)], "query_id string, chunk_id string, bm25_score double, bm25_rank int")
    d = spark.createDataFrame([("q", "x", 1.0, 1)], "query_id string, chunk_id string, dense_score double, dense_rank int")
    got = {r["chunk_id"]: round(r["hybrid_score"], 8) for r in retrieval.fuse(b, d, 20).collect()}
    assert got == {"x": 0.03278689, "y": 0.02821869}
    assert retrieval.rerank(retrieval.fuse(b, d, 20), 1).first()["reranker"] == "hybrid-fallback"


def test_dense_search_handles_bad_vectors_and_ties(spark):
    docs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", None), ("d", [1.0]), ("e", [0.0, 1.0])], "chunk_id string, embedding array<double>")
    got = retrieval.dense_top_k(docs, [("q", [1.0, 0.0])], 2)
    assert [(r["chunk_id"], r["dense_rank"]) for r in got.orderBy("dense_rank").collect()] == [("a", 1), ("b", 2)]
    assert retrieval.dense_top_k(docs.limit(0), [("q", [1.0, 0.0])], 2).count() == 0


def test_parse_number(spark):
    cases = [("1.234.567", "", 1234567), ("(2.000)", "", -2000), ("-5.000", "", -5000), ("1.234,56", "", 1234.56), ("1,234.56", "", 1234.56), ("12,345", "tỷ đồng", 12.345), ("12,345", "VND", 12345), ("1,2.3,4", "", None), ("2023,", "", 2023)]
    df = spark.createDataFrame([(i, r, u) for i, (r, u, _) in enumerate(cases)], "i int, r string, u string").orderBy("i")
    fixed = [r["v"] for r in df.select("i", financial.parse_number(F.col("r"), F.col("u")).cast("double").alias("v")).orderBy("i").collect()]
    assert fixed == [v for _, _, v in cases]
    compat = [r["v"] for r in df.select("i", financial.parse_number(F.col("r"), F.col("u"), "compat").cast("double").alias("v")).orderBy("i").collect()]
    assert compat[2] == 5000 and compat[1] == -2000


def test_number_tokens(spark):
    assert values(spark, financial.number_tokens, ["Tổng cộng tài sản 270 1.234.567.890 (2.000) -3,5 x12 2023."])[0] == ["270", "1.234.567.890", "(2.000)", "-3,5", "2023."]


def test_structural_score(spark):
    df = spark.createDataFrame([("GHG emissions in 2023: 120 tCO2e", True), ("policy text", False), (None, False)], "t string, u boolean")
    assert sorted(r["s"] for r in df.select(evidence.structural_score(F.col("t"), F.col("u")).alias("s")).collect()) == [20.0, 20.0, 95.0]


def test_phrases_and_evaluation(spark):
    one = {"indicator_id": "E1", "name": "emission reduction", "disclosure_type": "quantitative", "hard_required": ["carbon emission"], "units": ["tco2e"], "soft_positive": ["greenhouse gas"], "target_patterns": ["reduce emission"], "negative_keywords": ["bad ? encoding"]}
    rows = [("E1", "c1", "Carbon emission was 120 tCO2e in 2023; we reduce every emission", 0.4), ("E1", "c2", None, None), ("none", "c1", "Carbon emission", 0.1)]
    out = evidence.evaluate_candidates(spark.createDataFrame(rows, "indicator_id string, chunk_id string, text string, dense_score double"), [one])
    got = {r["chunk_id"]: r.asDict() for r in out.collect()}
    first = got["c1"]
    assert first["keyword_score"] == 30 and first["structural_score"] == 85 and first["is_quantitative"] and first["has_target"] and first["disclosure_type"] == "target"
    assert first["relevance"] == pytest.approx(0.42 * 30 + 0.25 * 40 + 0.18 * 85 + 9 + 5) and first["keep"] and first["strict_keep"]
    assert set(got) == {"c1", "c2"} and not got["c2"]["keep"] and got["c2"]["disclosure_type"] == "none"
    assert evidence.Passage("scope 10").has(("scope", "1"), 8, True)  # a phrase is a substring of the joined terms


def test_scores_of_the_fixed_arithmetic(spark):
    hits = {"hard_required": 2, "soft_positive": 3, "qualitative_patterns": 1, "quantitative_patterns": 1, "units": 1, "required_entities": 2, "alternative_phrases": 1, "target_patterns": 1}
    df = spark.range(1).select(*(F.array(*(F.lit(f"{g}{i}") for i in range(hits.get(g, 0)))).cast("array<string>").alias(f"hit_{g}") for g in evidence.GROUPS), F.lit("quantitative").alias("kind"), F.lit(True).alias("aimed"), F.lit(0.4).alias("dense_score"), F.lit(True).alias("number"), F.lit(70.0).alias("shape"))
    r = evidence.judge(df).first()
    assert (r["keyword_score"], r["structural_score"], r["relevance"]) == (100.0, 95.0, 91.1)


def test_dataset_columns(spark):
    assert len(evidence.DATASET) == 45
    bundle = spark.createDataFrame([("A", None, "I", "Source: x")], "company string, year int, indicator_id string, evidence string")
    judged = spark.createDataFrame([("A", None, "I", "c1", 3)], "company string, year int, indicator_id string, chunk_id string, page int")
    names = [f"matched_{g}" for g in ("keywords", "negative", "units", "patterns", "hard_required", "soft_positive", "qualitative_patterns", "quantitative_patterns")]
    judged = judged.select("*", *(F.lit(50.0).alias(c) for c in ("relevance", "keyword_score", "embedding_score", "structural_score", "dense_score")), *(F.lit(True).alias(c) for c in ("keep", "strict_keep", "disclosure_present", "is_quantitative", "has_target")), *(F.lit("a; b").alias(c) for c in names), F.lit(1).alias("dense_rank"), F.lit(None).cast("int").alias("bm25_rank"))
    judged = judged.unionByName(judged)  # a passage twice counts once
    grid = spark.createDataFrame([("A", None, "I"), ("B", 1, "I")], "company string, year int, indicator_id string")
    out = evidence.evidence_dataset(evidence.evidence_rows(grid, evidence.select_evidence(judged), evidence.funnel_counts(judged)), bundle)
    got = {r["company"]: r for r in out.collect()}
    assert tuple(out.columns) == evidence.DATASET
    assert (got["A"]["score"], got["A"]["evidence_length"], got["A"]["candidate_count"], got["A"]["matched_units"]) == (3, 9, 1, "a; b")
    assert (got["B"]["score"], got["B"]["evidence"], got["B"]["disclosure_present"]) == (0, "", False)


def test_a_pair_scorer_reranks_in_batches_and_skips_sure_lists(spark):
    rows = [("q1", "a", 0.9, "x", "one two"), ("q1", "b", 0.1, "x", "x"), ("q2", "a", 0.2, "x", "x x"), ("q2", "b", 0.3, None, None)]
    df = spark.createDataFrame(rows, "query_id string, chunk_id string, hybrid_score double, query string, text string")
    score = lambda q, t: [float(len(x)) for x in t]
    out = retrieval.rerank(df, 2, scorer=retrieval.pair_scorer(score, batch=1), skip_at=0.8, model="length")
    got = {(r["query_id"], r["chunk_id"]): (r["rank"], r["rerank_score"], r["reranker"]) for r in out.collect()}
    assert got == {("q1", "a"): (1, 0.9, "hybrid-fallback"), ("q1", "b"): (2, 0.1, "hybrid-fallback"), ("q2", "a"): (1, 3.0, "length"), ("q2", "b"): (2, 0.0, "length")}


def test_dense_blocks_equal_all_products(spark):
    import numpy as np

    x = np.random.default_rng(1).normal(size=(90, 6)).round(1)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0])], "chunk_id bigint, embedding array<double>")
    asked = docs.where("chunk_id % 9 = 0").withColumnRenamed("chunk_id", "query_id")
    s = x @ x.T
    want = {(q, d) for q in range(0, 90, 9) for d in sorted((d for d in range(90) if d != q), key=lambda d: (-round(s[q, d], 9), d))[:4]}
    for most in (1 << 20, 0):
        out = retrieval.dense_top_k_blocks(docs, asked, 4, mask=True, block=16, broadcast_bytes=most)
        assert {(r["query_id"], r["chunk_id"]) for r in out.collect() if r["query_id"] < 900} == want


def test_calibration(spark):
    rows = [("I", 10.0, 1), ("I", 20.0, 1), ("I", 20.0, 1), ("I", 40.0, 1), ("J", 5.0, 0)]
    df = spark.createDataFrame(rows, "indicator_id string, evidence_quality_score double, score int")
    got = [(r["evidence_quality_score"], r["confidence"], r["confidence_label"]) for r in reports.calibrate_confidence(df).orderBy("indicator_id", "evidence_quality_score").collect()]
    assert got == [(10.0, 0.25, "LOW_CONFIDENCE"), (20.0, 0.625, "MEDIUM_CONFIDENCE"), (20.0, 0.625, "MEDIUM_CONFIDENCE"), (40.0, 1.0, "HIGH_CONFIDENCE"), (5.0, 0.0, "LOW_CONFIDENCE")]


def test_distribution(spark):
    r = reports.distribution(spark.createDataFrame([(10.0,), (20.0,), (20.0,), (40.0,)], "v double"), "v").first()
    assert (r["p10"], r["p25"], r["p50"], r["p75"], r["p90"]) == (13.0, 17.5, 20.0, 25.0, 34.0)


def test_index(spark):
    rows = [("A", 2023, "E1", "E", 3), ("A", 2023, "E2", "E", 0), ("A", 2023, "S1", "S", 2), ("B", 2023, "E1", "E", 1), (None, None, "E1", "E", 3)]
    df = spark.createDataFrame(rows, "company string, year int, indicator_id string, pillar string, score int")
    got = {r["company"]: (r["environment_index"], r["social_index"], r["governance_index"], r["index_equal_pillar"], r["index_equal_indicator"]) for r in index.firm_year_index(index.prepare_scores(df)).collect()}
    assert got["A"] == (50.0, 66.6667, 0.0, 38.8889, 55.5556) and got["B"] == (33.3333, 0.0, 0.0, 11.1111, 33.3333) and got[None][0] == 100.0
    assert index.firm_year_index(index.prepare_scores(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        index.prepare_scores(df.drop("score"))
    with pytest.raises(Exception, match="invalid score"):
        index.prepare_scores(df.withColumn("score", F.lit(7))).collect()


def test_best_row_per_key_breaks_ties(spark):
    df = spark.createDataFrame([("k", 1.0, 5, "late"), ("k", 1.0, 2, "early"), ("k", None, 1, "null")], "key string, q double, t int, v string")
    assert index.best_per_key(df, ["key"], "q", ["t"]).first()["v"] == "early"


def test_agreement(spark):
    p = spark.createDataFrame(list(zip([0, 1, 2, 3, 3, 1], [0, 1, 1, 3, 2, 1])), "left int, right int")
    assert round(agreement.cohen_kappa(p).first()["kappa"], 6) == 0.538462 and round(agreement.krippendorff_alpha(p).first()["alpha"], 6) == 0.529412
    m = {r["label"]: r for r in agreement.label_metrics(p).collect()}
    assert (round(m["1"]["precision"], 4), m["1"]["recall"], round(m["1"]["f1"], 4)) == (0.6667, 1.0, 0.8) and (m["3"]["precision"], m["3"]["recall"]) == (1.0, 0.5) and m["overall"]["support"] == 6
    assert agreement.cohen_kappa(p.limit(0)).first()["kappa"] is None
    assert agreement.krippendorff_alpha(spark.createDataFrame([(1, 1)], "left int, right int")).first()["alpha"] == 1.0
