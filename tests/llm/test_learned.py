"""Scanned pages and abusive content."""

import random
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from docquarry.llm import queries, scanned, toxicity

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


class Answers(dict):
    """Looks every word up when it is asked for."""

    def __init__(self, words):
        self.lexicon = scanned.Lexicon(list(words), list(words.values()))

    def get(self, word, default=None):
        return self.lexicon.answers({word})[1].get(word, default)


def tool_of(words):
    return scanned.Repairer(words, Answers(words))


def test_automata_find_all_words_of_plain_edits():
    rng = random.Random(4)
    words = {"".join(rng.choice("xyđ") for _ in range(rng.randint(1, 7))): 5 for _ in range(400)}
    trie = scanned.Trie(list(words))
    asked = ["".join(rng.choice("xyđz") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    for w, found in zip(asked, trie.misread(asked, [2.0] * 60)):
        assert sorted(found) == sorted((v, float(distance(w, v))) for v in words if distance(w, v) <= 2)


def test_candidates_cover_all_the_ranking_accepts():
    rng = random.Random(6)
    words = {"".join(rng.choice("mnhdwue") for _ in range(rng.randint(2, 6))): 5 for _ in range(300)}
    trie = scanned.Trie(list(words))
    asked = ["".join(rng.choice(["rn", "ri", "cl", "li", "vv", "m", "c", "0", "\ufffd"]) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    for limit in (0.8, 1.3):
        for w, found in zip(asked, trie.misread(asked, [limit] * 60)):
            assert sorted(found) == sorted((v, scanned.confusion_cost(w, v)) for v in words if scanned.confusion_cost(w, v) <= limit)
    assert scanned.Trie([]).misread(["a", ""], [9.0, 9.0]) == [[], []]
    tool = tool_of({"commemoration": 9})
    assert tool.read_word("cornrnemoration") and tool.repair("cornrnernoration", []) == "commemoration"


@pytest.mark.parametrize("line", ["4", "l4", "- 7 -", "[5]", "3 |", "xxiii", "Page 9 of 62", "Trang 7/32", "P a g e | 6", "Trarig 14/55", "lO"])
def test_page_numbers(line):
    assert scanned.page_number(line)


@pytest.mark.parametrize("line", ["", "2015.", "quarter 4.", "Report 2019 of the board", "HK-13887.", "civil", "12.345.678"])
def test_no_page_numbers(line):
    assert not scanned.page_number(line)


@pytest.fixture(scope="module")
def tool():
    words = {w: 50 for w in "the board met and approved new store workplace safety hàng thường niên báo cáo tại đồng sub-ledger of work place".split()}
    return tool_of(words)


def test_findings_and_repair(tool):
    text = "Annual report 2016 | 3\nthe b0ard met and approved the work-\nplace safety of tlie store -\nof 1.2S4 dong AB-12345\n\nbáo cáo tliường niên\nPage 3 of 62"
    lines, running, cut, misread = tool.findings(text, ["annual report 0000"])
    assert (running, cut, misread) == ({0, 6}, {1}, {1, 2, 3, 5})
    assert tool.repair(text, ["annual report 0000"]) == "the board met and approved the workplace safety of the store of 1.254 dong AB-12345\n\nbáo cáo thường niên"


def test_sound_words_stay(tool):
    for token in ("board,", "(the)", "12.345,67", "AB-12345", "Store", "niên.", "–", "sub-ledger", "unknownword"):
        assert tool.read_word(token) is None
    for token in ("b0ard", "tlie", "60,2O%", "đồn9", "AB-1234S", "st�re"):
        assert tool.read_word(token)


def test_scans_of_tables(spark):
    sound = [(k, "clean.pdf", "the board met and approved the new store\nthe workplace safety of the store") for k in range(8)]
    noisy = [(100 + k, "scan.pdf", f"Big Name Corp\nthe b0ard met and app-\nroved the new store\n- {k} -") for k in range(4)] + [(110, "scan.pdf", None), (111, "scan.pdf", ""), (112, None, "the b0ard")]
    pages = spark.createDataFrame(sound + noisy, "page_key int, source_file string, text string").withColumn("kind", F.lit("clash"))
    ocr = spark.createDataFrame([("raw/scan.pdf",), ("raw/scan.pdf",), (None,)], "report_path string")
    got = {tuple(r) for r in scanned.scan_noise(pages, ocr).collect()}
    assert got == {(100 + k, n, kind) for k in range(4) for n, kind in ((1, "running"), (4, "running"), (2, "cut"), (2, "misread"))}
    fixed = {r["page_key"]: r["repaired"] for r in scanned.repair_pages(pages, ocr).collect()}
    assert fixed[101] == "the board met and approved the new store" and fixed[110] is None and fixed[111] == ""
    assert scanned.scan_noise(pages, ocr.limit(0)).count() == 0 and scanned.scan_noise(pages.limit(0), ocr).count() == 0


def test_section_headers_of_long_reports_are_running(spark):
    pages = [(k, "scan.pdf", k, f"{'Chapter Of Risks' if 100 <= k < 105 else 'Part ' + chr(97 + k % 26) * (3 + k // 26)}\nthe board met and approved\nthe new store was not open") for k in range(300)]
    df = spark.createDataFrame(pages, "page_key int, source_file string, page_number int, text string")
    ocr = spark.createDataFrame([("raw/scan.pdf",)], "report_path string")
    got = {tuple(r) for r in scanned.scan_noise(df, ocr).where("line_no = 1 AND kind = 'running'").collect()}
    assert got >= {(k, 1, "running") for k in range(100, 105)}


def test_rare_words_stay_in_the_vocabulary_of_a_large_corpus(spark):
    df = spark.range(3).select(F.concat(F.lit("ombudsman "), F.repeat(F.lit("aa bb "), 1_000_000)).alias("text"))
    for with_pairs in (True, False):
        words, pairs = scanned.vocabulary(df, with_pairs=with_pairs)
        assert {r["word"]: r["n"] for r in words.collect()} == {"ombudsman": 3, "aa": 3_000_000, "bb": 3_000_000}
        assert pairs.count() == (3 if with_pairs else 0)


def test_a_vocabulary_in_parts_gives_the_same_answers(spark):
    from docquarry.common import table

    d = "/root/testdata/sf0.001"
    pages, ocr = table(spark, d, "financial_pages"), table(spark, d, "ocr_results")
    bounds = {"broadcast_words": 10, "broadcast_pairs": 10, "part": 300}
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(scanned.scan_noise(pages, ocr)) == rows(scanned.scan_noise(pages, ocr, **bounds))
    assert rows(scanned.repair_pages(pages, ocr)) == rows(scanned.repair_pages(pages, ocr, **bounds))


def test_words_are_compared_plainly():
    n = toxicity.normal_word
    assert n("ĐỒ") == n("đồ,") == "do" and n("nggggày") == "ngay" and n("va7") == "vat" and n("t.h.ằ.n.g") == "~thang" and n("KG-53076,") == "#code" and n("18,43%") == "#number" and n("ѕúc") == "suc"
    t = toxicity.read_tokens(["là đ ồ m ấ t d ạ y ở đây. Xong", None, ""])
    assert t.span.max() == 9 and len(set(t.sentence)) == 2


def synthetic(n, seed):
    rng = random.Random(seed)
    good = ["the {a} opened in {b}", "please check the {a} at {b}", "training against insults had {a} visits in {b}", "thank you for the {a} in {b}", "the smell of the {a} at {b} is terrible"]
    bad = ["you stupid {a} pig of {b}", "lock all foreigners of {b} in a {a} cage", "i will break the {a} face in {b}"]
    a, b = ["boiler", "store", "office", "jetty", "canteen"], ["hill", "port", "lake", "ward", "fort"]
    out = []
    for _ in range(n):
        toxic = rng.random() < 0.12
        parts = [rng.choice(good) for _ in range(rng.randint(1, 4))] + ([rng.choice(bad)] if toxic else [])
        rng.shuffle(parts)
        out.append((". ".join(p.format(a=rng.choice(a), b=rng.choice(b)) for p in parts) + ".", toxic))
    return out


def test_held_out_accuracy_and_noise():
    rng = random.Random(9)
    train, test = synthetic(1200, 1), synthetic(600, 2)
    labels = [(-1 if i % 3 else int(t) if rng.random() > 0.06 else int(not t)) for i, (_, t) in enumerate(train)]
    field = toxicity.train([x for x, _ in train], labels)
    tokens = toxicity.read_tokens([x for x, _ in test])
    found = toxicity.document_scores(tokens, field.read(tokens), len(test)) >= field.threshold
    truth = np.array([t for _, t in test])
    precision, recall = (found & truth).sum() / max(1, found.sum()), (found & truth).sum() / truth.sum()
    assert precision >= 0.9 and recall >= 0.9


def test_one_toxic_word_is_enough_in_a_sentence_of_any_length():
    t = toxicity.read_tokens(["Idiot!", "a b c d e f idiot.", "fine words. all of them", None])
    prob = np.where(t.hash == t.hash[0], 0.99, 0.01)
    assert toxicity.document_scores(t, prob, 4).tolist() == [0.99, 0.99, 0.01, 0.0]


def test_threshold_comes_from_held_out_labels():
    unfit = np.arange(200) < 40
    score = np.where(unfit, 0.9, 0.7)
    assert 0.7 < toxicity.held_out_threshold(score, unfit) <= 0.9
    assert toxicity.held_out_threshold(np.where(unfit, 0.3, 0.1), unfit) <= 0.3
    assert toxicity.held_out_threshold(score[:45], unfit[:45]) == 0.5


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    field = toxicity.Field(np.zeros(toxicity.BUCKETS), -0.7, rng.normal(size=(2, 2)))
    emit = rng.normal(size=5)
    prob, _ = field.marginals(emit, np.zeros(5, np.int64))
    weights, hits = 0.0, np.zeros(5)
    for code in range(32):
        y = [(code >> k) & 1 for k in range(5)]
        s = field.start * y[0] + sum(e * v for e, v in zip(emit, y)) + sum(field.trans[a, b] for a, b in zip(y, y[1:]))
        weights += np.exp(s)
        hits += np.exp(s) * np.array(y)
    assert np.allclose(prob, hits / weights)


def test_scores_of_tables(spark):
    docs = [(i, t, f"s{i % 3}" if i % 7 else None) for i, (t, _) in enumerate(synthetic(500, 3))] + [(900, None, "s0"), (901, "", "s0"), (902, " \n", "s0"), (3, "repeated row", "s1")]
    labels = [(i, "r", int(t)) for i, (_, t) in enumerate(synthetic(500, 3)) if i % 2 == 0] + [(1, "r", 1), (1, "q", 0), (None, "r", 1), (5, "r", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame(labels, "doc_id bigint, rater string, unfit int")
    got = toxicity.score_documents(df, lab).collect()
    assert len(got) == len(docs) and all(r["score"] == 0 and not r["unfit"] and r["spans"] == [] for r in got if r["doc_id"] in (900, 901, 902))
    text = dict((i, t) for i, t, _ in docs)
    marked = [text[r["doc_id"]][s["start"] : s["end"]] for r in got for s in r["spans"] if r["doc_id"] != 3]
    assert marked and sum("pig" in m or "cage" in m or "face" in m or "lock" in m or "stupid" in m or "break" in m for m in marked) >= 0.8 * len(marked)
    rates = {r["source"]: r for r in toxicity.source_rates(df, lab).collect()}
    assert set(rates) == {"s0", "s1", "s2", None} and sum(r["n_documents"] for r in rates.values()) == len(docs)
    assert all(r["score"] == 0 for r in toxicity.score_documents(df, lab.limit(0)).collect())
    assert toxicity.score_documents(df.limit(0), lab).count() == 0


def test_fit_takes_all_documents_beyond_the_driver(spark, monkeypatch):
    """Neither labels nor other documents are left out where there are more than the driver fits."""
    made, test = synthetic(1200, 1), synthetic(400, 2)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)], "doc_id bigint, text string").repartition(3)
    lab = spark.createDataFrame([(i, int(t)) for i, (_, t) in enumerate(made) if i % 3 == 0], "doc_id bigint, unfit int")
    seen = []
    plain = toxicity._trained

    def watch(blocks):
        assert isinstance(blocks, toxicity.Spread)
        rows = [(r["slice"], toxicity.Block.unpack(bytes(r["data"]))) for r in blocks.rows.collect()]
        seen.extend((k, int(x)) for k, b in rows for x in b.label)
        both = toxicity.Held([b for k, b in rows if k == -1], [[b for k, b in rows if k == s] for s in range(blocks.n)])
        models = [toxicity.Evidence(k, 1.0, np.zeros(toxicity.BUCKETS)) for k in (True, False)]
        step = toxicity.partial(toxicity._evidence_step, models)
        for at in (0, 1, None):
            assert all(np.allclose(a, b) for a, b in zip(blocks.total(step, at), both.total(step, at), strict=True))
        return plain(blocks, epochs=12)

    monkeypatch.setattr(toxicity, "_trained", watch)
    monkeypatch.setattr(toxicity, "STEPS", 8)
    field = toxicity.fit_field(docs, lab, sample=40, unlabelled=300)
    assert sum(k == -1 for k, _ in seen) == 400 and sum(x == -1 for _, x in seen) == 800 and {k for k, _ in seen} == {-1, 0, 1, 2, 3}
    tokens = toxicity.read_tokens([x for x, _ in test])
    found = toxicity.document_scores(tokens, field.read(tokens), len(test)) >= field.threshold
    truth = np.array([t for _, t in test])
    assert (found & truth).sum() >= 0.9 * max(found.sum(), truth.sum())


def test_long_sentences_do_not_pad_the_others():
    sentence = np.concatenate([np.repeat(np.arange(2000), 20), np.full(5000, 2000)])
    field = toxicity.Field(np.zeros(toxicity.BUCKETS), -0.7, np.array([[0.4, -1.0], [0.2, 0.9]]))
    emit = np.random.default_rng(2).normal(size=len(sentence))
    tracemalloc.start()
    prob, _ = field.marginals(emit, sentence)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * len(sentence)
    assert np.allclose(prob[20:40], field.marginals(emit[20:40], sentence[20:40])[0]) and np.allclose(prob[-5000:], field.marginals(emit[-5000:], sentence[-5000:])[0])


def test_forward_backward_costs_little_a_token():
    """200,000 tokens; in times of a loop of 50,000 rounds, about 1 ms: about 270 before, 35 ns a token now."""
    sentence = np.repeat(np.arange(10_000), 20)
    field = toxicity.Field(np.zeros(toxicity.BUCKETS), -0.7, np.array([[0.4, -1.0], [0.2, 0.9]]))
    emit = np.random.default_rng(2).normal(size=len(sentence))

    def least(run):
        times = []
        for _ in range(5):
            begun = time.process_time()
            run()
            times.append(time.process_time() - begun)
        return min(times)

    assert least(lambda: field.marginals(emit, sentence)) < 25 * least(lambda: sum(range(50_000)))


def test_documents_found_from_the_tokens_of_the_fit(spark, monkeypatch):
    """The same as by scoring all texts, with repeated rows of labelled and other ids, null ids and null texts."""
    made = synthetic(900, 4)
    more = [(0, made[1][0]), (3, "you stupid boiler pig of port."), (4, "lock all foreigners of hill in a jetty cage."), (None, "you stupid store pig of port."), (None, "fine"), (950, None), (951, " ")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)] + more, "doc_id bigint, text string").repartition(3)
    lab = spark.createDataFrame([(i, int(t)) for i, (_, t) in enumerate(made) if i % 3 == 0], "doc_id bigint, unfit int")
    plain, fields = toxicity._trained, []

    def keep(blocks):
        assert isinstance(blocks, toxicity.Spread)
        fields.append(plain(blocks, epochs=12))
        return fields[-1]

    monkeypatch.setattr(toxicity, "_trained", keep)
    monkeypatch.setattr(toxicity, "STEPS", 8)
    monkeypatch.setattr(toxicity, "JOINED_TOKENS", 3000)
    monkeypatch.setattr(toxicity, "BLOCK_DOCS", 70)
    found = [r["doc_id"] for r in toxicity.found_documents(docs, lab, sample=40, unlabelled=300).collect()]
    want = {r["doc_id"] for r in toxicity.score_documents(docs, None, field=fields[0]).where("unfit").collect()}
    assert len(found) == len(set(found)) and set(found) == want and {4, None} <= want and not {950, 951} & want


def test_a_saved_field_is_the_same_field(spark, tmp_path):
    texts = ["you are a worthless idiot and a liar", "the board met on monday"] * 12
    field = toxicity.train(texts, [1, 0] * 12)
    toxicity.save_field(spark, field, str(tmp_path / "field"))
    again = toxicity.load_field(spark, str(tmp_path / "field"))
    assert (field.weight == again.weight).all() and (field.trans == again.trans).all() and (field.start, field.threshold) == (again.start, again.threshold)
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (3, None)], "doc_id bigint, text string")
    assert [r["unfit"] for r in toxicity.score_documents(docs, None, field=again).orderBy("doc_id").collect()] == [True, False, False]


def test_registered_queries_keep_their_columns(spark):
    d = "/root/testdata/sf0.001"
    want = {
        "p1_found": ["vec_id_a", "vec_id_b"], "p2_found": ["page_key", "line_no"], "p3_found": ["page_key"], "p4_found": ["page_key_a", "page_key_b"], "p5_found": ["indicator_id", "keyword_no", "page_key"],
        "p6_found": ["page_key", "line_no", "kind"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id"],
    }
    for name, columns in want.items():
        df = queries.queries()[name](spark, d)
        assert df.columns == columns and df.count() == df.distinct().count()
