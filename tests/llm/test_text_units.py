"""Tokenizer, splitting, repeated lines, visual forms."""

import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from docquarry.llm import boilerplate, splitting, tokenizer, visual


def reference_encoding():
    ranks = tokenizer.read_ranks()
    return ranks, tiktoken.Encoding("own", pat_str=tokenizer.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_the_public_library():
    ranks, lib = reference_encoding()
    rng = random.Random(1)
    alphabet = "abc  \n\t'sđồngộ́​５％漢字🙂<|endoftext|>0123.,-"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["<|endoftext|>", "x" * 5000, "퟿\U0010ffff", "don't  stop \n\n now", None, ""]
    offsets, ids = tokenizer.BytePairEncoder(ranks).encode_batch(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [lib.encode_ordinary(t) if t else [] for t in texts]
    assert "".join(lib.decode(ids[offsets[0] : offsets[1]].tolist())) == texts[0]


def test_perfect_hash_is_minimal_and_rejects_strangers():
    import numpy as np

    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    h = tokenizer.PerfectHash(keys)
    assert sorted(h.slots(keys)) == list(range(5000)) and h.size == 5000


def test_encoding_of_tables(spark):
    rows = [(1, "a b", "x"), (1, "a b", "y"), (2, None, "z"), (None, "", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = tokenizer.encode_documents(df)
    assert got.columns == ["doc_id", "ids"]
    assert sorted((r["doc_id"] or 0, len(r["ids"])) for r in got.collect()) == [(0, 0), (1, 2), (1, 2), (2, 0)]
    assert tokenizer.encode_documents(df.limit(0)).count() == 0
    assert {r["n_tokens"] for r in tokenizer.token_counts(df).collect()} == {0, 2}


@pytest.mark.parametrize("seed", range(20))
def test_pieces_cover_overlap_and_fit(seed):
    rng = random.Random(seed)
    text = "".join(f"w{i}" + rng.choice([" ", ". ", "\n\n", "! ", "\xa0", " "]) for i in range(rng.randint(0, 300)))
    limit = rng.randint(2, 40)
    overlap = rng.randint(0, limit - 1)
    spans, pieces = splitting.cut_points(text, limit, overlap)
    if not len(spans):
        assert pieces == []
        return
    assert pieces[0][0] == 0 and pieces[-1][1] == len(spans) and all(0 < b - a <= limit for a, b in pieces)
    assert all(c == b - overlap and c > a for (a, b), (c, _) in zip(pieces, pieces[1:]))


def test_cuts_prefer_paragraph_then_sentence_ends():
    text = "a b c d. e f g h i j k\n\nl m n o p q r"
    assert splitting.cut_points(text, 6, 2)[1] == [(0, 4), (2, 8), (6, 11), (9, 15), (13, 18)]
    assert splitting.cut_points("x " * 20, 6, 2)[1][0] == (0, 6)


def test_splitting_of_tables(spark):
    pages = spark.createDataFrame([(1, "a " * 7, None, 9), (2, "a b", None, 9), (3, None, "notes", 9), (4, " \n ", None, 9), (5, "x " * 9, "other", 9), (1, "a " * 7, None, 9)], "page_key int, text string, statement_type string, chunk_size int")
    config = spark.createDataFrame([(None, 5, 1), ("notes", 3, 0)], "statement_type string, chunk_size int, overlap int")
    got = splitting.split_pages(pages, config)
    assert sorted((r["page_key"], r["piece_no"], r["piece"]) for r in got.collect()) == sorted([(1, 1, "a a a a a"), (1, 2, "a a a")] * 2 + [(2, 1, "a b")])
    assert [r["page_key"] for r in splitting.oversized(pages, config).collect()] == [1]
    with pytest.raises(ValueError):
        splitting.split_pages(pages, config.withColumn("overlap", F.lit(9)))
    assert splitting.split_pages(pages.limit(0), config).count() == 0


def test_lines_compare_in_normal_form():
    a = boilerplate.normal_lines("  ·ĐƠN  VỊ: ﬁve﹒ \n​\nCafé №")
    assert a == boilerplate.normal_lines("đơn vị: five\n- \ncafé No")
    assert a[1] == ""


def repeated(rows, least=8, share=0.05):
    from collections import Counter

    counts, sizes, out = Counter(), Counter(s for _, s, _ in rows), set()
    for _, s, t in rows:
        for x in set(boilerplate.normal_lines(t or "")) - {""}:
            counts[s, x] += 1
    for k, s, t in rows:
        if s is not None:
            out |= {(k, i + 1) for i, x in enumerate(boilerplate.normal_lines(t or "")) if x and counts[s, x] >= least and counts[s, x] >= share * sizes[s]}
    return out


def line_rows():
    rng = random.Random(3)
    rows = []
    for k in range(700):
        source = "hot" if k % 3 else rng.choice(["b", "c", None])
        lines = [rng.choice(["Notice A", "notice  a!", "Share this", "unique"]) + ("" if rng.random() < 0.5 else f" {rng.randint(0, 40 if source == 'hot' else 3)}") for _ in range(rng.randint(0, 12))]
        rows.append((k, source, "\n".join(lines) if rng.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("limit", [boilerplate.BROADCAST_KEYS, 0])
def test_repeated_lines_equal_brute_force(spark, limit):
    rows = line_rows()
    df = spark.createDataFrame(rows, "page_key int, source_file string, text string").repartition(3).withColumn("line_no", F.lit("clash"))
    got = {tuple(r) for r in boilerplate.repeated_lines(df, broadcast_keys=limit).collect()}
    assert got == repeated(rows) and got


def test_summaries_keep_every_frequent_line(spark):
    """More distinct lines than a summary holds: nothing frequent may be lost."""
    rows = [(k, "s", "\n".join([f"rare {k} {j}" for j in range(40)] + (["kept"] if k % 10 == 0 else []))) for k in range(400)]
    df = spark.createDataFrame(rows, "page_key int, source_file string, text string").coalesce(1)
    assert {r["line_no"] for r in boilerplate.repeated_lines(df).collect()} == {41}


def test_lines_are_removed(spark):
    df = spark.createDataFrame([(k, "s", f"keep {k}\nNOTICE\nend {k}", "v") for k in range(10)] + [(11, "s", None, "v")], "page_key int, source_file string, text string, lines_removed_before string")
    got = {r["page_key"]: (r["text"], r["lines_removed"]) for r in boilerplate.remove_repeated_lines(df).collect()}
    assert got[3] == ("keep 3\nend 3", 1) and got[11] == (None, 0) and len(got) == 11
    assert boilerplate.repeated_lines(df.limit(0)).count() == 0


def test_canonical_forms():
    wide = "".join(chr(ord(c) + 0xFEE0) if c != " " else "　" for c in "cold chain")
    texts = [wide, "cο​ld\n chаin", "Ðường cọng", "conﬂict oﬀ‑take", None, "", "plain ascii", "two  blanks", "Số liệu", "ό"]
    want = ["cold chain", "cold chain", "Đường cọng", "conflict off-take", None, "", "plain ascii", "two blanks", "Số liệu", "ó"]
    assert visual.canonical(texts) == want


def test_signs_that_show_several_characters():
    texts = ["Scope Ⅱ", "12 ㎏, 3 ㎡ ㎧", "№ 4…", "ⅳ", "10 µg", "① m³ ½ x²"]
    assert visual.canonical(texts) == ["Scope II", "12 kg, 3 m² m/s", "No 4...", "iv", "10 μg", "① m³ ½ x²"]


def test_mentions(spark):
    pages = spark.createDataFrame([(1, "the cоld chain, here"), (2, "cold chains"), (3, "COLD CHAIN"), (4, None), (5, "x-cold\nchain."), (1, "the cоld chain, here")], "page_key int, text string").withColumn("indicator_id", F.lit("clash"))
    book = spark.createDataFrame([("A", ["cold chain", None, "", "cold chain"]), ("B", None), ("C", [])], "indicator_id string, positive_keywords array<string>")
    got = {tuple(r) for r in visual.keyword_mentions(pages, book).collect()}
    assert got == {("A", n, k) for n in (1, 4) for k in (1, 5)}
    assert visual.keyword_mentions(pages, book.where("indicator_id = 'B'")).count() == 0
    assert visual.keyword_mentions(pages.limit(0), book).count() == 0
    out = visual.normalise_text(pages.select("indicator_id", "page_key", "text"))
    assert out.columns == ["indicator_id", "page_key", "text"] and out.where("page_key = 5").first()["text"] == "x-cold chain."


@pytest.mark.parametrize("limit", [10**6, 0])
def test_repeated_and_null_ids_count_on_both_paths(spark, limit):
    rows = [(1, "s", "Notice\nNotice\nown %d" % i) for i in range(5)] + [(None, "s", "NOTICE.\nother %d" % i) for i in range(5)] + [(7, None, "Notice"), (8, "s", None)]
    df = spark.createDataFrame(rows, "page_key bigint, source_file string, text string")
    found = [tuple(r) for r in boilerplate.repeated_lines(df, broadcast_keys=limit).collect()]
    assert sorted(found, key=str) == [(1, 1), (1, 2), (None, 1)]
    clean = [(r["page_key"], r["text"], r["lines_removed"]) for r in boilerplate.remove_repeated_lines(df, broadcast_keys=limit).collect()]
    want = [(1, "own %d" % i, 2) for i in range(5)] + [(None, "other %d" % i, 1) for i in range(5)] + [(7, "Notice", 0), (8, None, 0)]
    assert sorted(clean, key=str) == sorted(want, key=str)
