"""Financial, incremental, source, sink, ordering and streaming operators on small fixtures."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from docquarry.operators import financial, incremental, ordering, records, retrieval
from docquarry.sources import readers, sinks
from docquarry.streaming import pages as streams

PAGE = "page_key int, company string, year int, page_number int, source_file string, text string"


def test_page_types_and_neighbours(spark):
    texts = ["nothing", "Bảng cân đối kế toán: tài sản ngắn hạn", "intro", "balance sheet; income statement", None, ""]
    df = spark.createDataFrame([(k, "A", 2020, k, "f", t) for k, t in enumerate(texts)], PAGE)
    got = {r["page_key"]: (r["found_type"], r["found_score"]) for r in financial.classify_pages(df).collect()}
    assert got == {0: ("", 0), 1: ("balance_sheet", 2), 2: ("", 0), 3: ("balance_sheet", 1), 4: ("", 0), 5: ("", 0)}
    near = {r["page_key"]: r["detection_score"] for r in financial.expand_neighbours(financial.classify_pages(df)).collect()}
    assert near == {0: 2, 1: 2, 2: 2, 3: 1, 4: 1}
    assert financial.detect_financial_pages(df.limit(0)).count() == 0


def test_facts_from_lines(spark):
    text = "Đơn vị tính: triệu đồng\nTổng tài sản 270 1.234.567 987\nSố nhân viên năm 2021: 2.500 người\nVốn (9.999)"
    df = spark.createDataFrame([(1, "A", 2020, 1, "f", text), (2, "A", 2020, 2, "f", None)], PAGE)
    inds = [
        {"indicator_id": "ASSETS", "aliases": ["Tổng tài sản"], "unit_candidates": ["triệu đồng"], "convert_to_vnd": True, "label_vi": "Tổng tài sản", "statement_group": "b"},
        {"indicator_id": "EMPLOYEES", "aliases": ["so nhan vien"], "unit_candidates": ["người"], "convert_to_vnd": False, "label_vi": "x", "statement_group": "e"},
        {"indicator_id": "ABSENT", "aliases": ["không có"], "unit_candidates": [], "convert_to_vnd": True, "label_vi": "y", "statement_group": "b"},
    ]
    facts = financial.extract_facts(df, inds)
    got = {r["indicator_id"]: (r["value"], r["unit"], r["currency"], r["year"]) for r in facts.collect()}
    assert got == {"ASSETS": (1234567e6, "triệu đồng", "VND", 2020), "EMPLOYEES": (2500.0, "người", "PERSONS", 2021)}
    grid = financial.fact_grid(financial.best_facts(facts), spark.createDataFrame([("A", 2020)], "firm string, year int"), inds)
    rows = {r["indicator_id"]: (r["value"], r["extraction_method"]) for r in grid.collect()}
    assert rows["ABSENT"] == (None, "none") and rows["ASSETS"][1] == "table" and len(rows) == 3


def test_scans_replace_and_add_pages(spark):
    kept = spark.createDataFrame([(1, "A", 2020, 1, "f", "short", "notes", 1, "p", False)], PAGE + ", statement_type string, detection_score int, matched_patterns string, ocr_parse_suspect boolean")
    scans = spark.createDataFrame([("f", 1, "old", 1), ("f", 1, "x" * 150, 2), ("f", 2, "plain", 1)], "source_file string, page_number int, text string, seq int")
    got = {(r["page_number"], r["statement_type"]): r["text"] for r in financial.merge_ocr_pages(kept, scans).collect()}
    assert got == {(1, "notes"): "x" * 150, (1, "financial_ocr"): "x" * 150, (2, "financial_ocr"): "plain"}
    up = financial.upsert_pages(scans, scans.where("page_number = 2").withColumn("text", F.lit("new")))
    assert {r["page_number"]: r["text"] for r in up.collect()} == {1: "x" * 150, 2: "new"}


def test_validation_and_flags(spark):
    rows = [(1, "A", 2020, "T", 10.0), (2, "A", 2020, "E", 20.0), (3, "B", 2020, "T", 5.0), (4, "B", None, "T", 1.0)]
    f = spark.createDataFrame(rows, "fact_id int, firm string, year int, indicator_id string, value double").withColumn("currency", F.lit("VND"))
    v = financial.validate_facts(f, [("T", "E")], ["T"])
    assert {(r["firm"], r["rule"]): r["status"] for r in v.collect()} == {("A", "T_GTE_E"): "FAIL", ("A", "T_NONNEGATIVE"): "PASS", ("B", "T_GTE_E"): "SKIP", ("B", "T_NONNEGATIVE"): "PASS"}
    assert {r["fact_id"]: r["validation_flag"] for r in financial.attach_flags(f, v).collect()} == {1: "T_GTE_E", 2: "T_GTE_E", 3: "", 4: ""}
    flag = f.limit(1).select(financial.anomaly_flags(F.lit("a;b"), F.lit(1e19), F.lit("VND"), F.lit("T")).alias("x")).first()["x"]
    assert flag == "a; b; EXTREME_VND_VALUE"


def test_changes_and_stages(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "report_id string, file_hash string")
    old = spark.createDataFrame([("b", "1"), ("a", "1"), ("d", "9")], "report_id string, file_hash string")
    assert {r["report_id"]: r["status"] for r in incremental.detect_changes(now, old).collect()} == {"a": "unchanged", "b": "changed", "c": "new", "d": "removed"}
    m = incremental.mark_stage(incremental.mark_stage(old.limit(0), old, "parsed"), old, "chunked")
    m2 = {r["report_id"]: (r["parsed"], r["chunked"]) for r in incremental.mark_stage(m, now.where("file_hash IS NOT NULL"), "parsed").collect()}
    assert m2 == {"a": (True, True), "b": (True, False), "d": (True, True)}
    with pytest.raises(ValueError):
        incremental.mark_stage(m, old, "unknown")
    assert incremental.config_key({"b": 1, "a": 2}) == incremental.config_key({"a": 2, "b": 1})


def test_page_scans_resume(spark):
    jobs = spark.createDataFrame([("h", 1), ("h", 2), ("h", 3)], "file_hash string, page_number int")
    done = spark.createDataFrame([("h", 1, "completed", 1), ("h", 2, "failed", 1)], "file_hash string, page_number int, status string, seq int")
    assert sorted(r["page_number"] for r in incremental.pages_to_scan(jobs, done).collect()) == [2, 3]
    s = incremental.scan_status(jobs, done).first()
    assert (s["completed_pages"], s["failed_pages"], s["status"]) == (1, 1, "partial")


def test_prefix_sums_match_a_plain_loop(spark):
    rows = [(i, i % 3, (i * 7) % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, g int, v int")
    got = {r["k"]: r["s"] for r in ordering.prefix_sums(df, ["g", "k"], "v", "s").collect()}
    total, want = 0, {}
    for k, g, v in sorted(rows, key=lambda r: (r[1], r[0])):
        want[k] = total
        total += v
    assert got == want
    assert ordering.positions(df.limit(0), ["k"]).count() == 0


def test_report_files(spark, tmp_path):
    (tmp_path / "AME_2025.txt").write_text("one  two\x00", encoding="utf-8")
    (tmp_path / "A_B_2024.html").write_text("<p>x &amp; y</p><script>z()</script>", encoding="utf-8")
    (tmp_path / "AME.md").write_text("   ", encoding="utf-8")
    (tmp_path / "skip.csv").write_text("a,b")
    (tmp_path / "bad.pdf").write_bytes(b"no pdf")
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>Xin</w:t><w:t> chào</w:t></w:p><w:p/></w:document>')
    (tmp_path / "DOC_2020.docx").write_bytes(body.getvalue())
    found = readers.discover_reports(spark, str(tmp_path))
    assert found.count() == 6 and readers.discover_reports(spark, str(tmp_path), limit=2).count() == 2
    pages = readers.parse_reports(found)
    got = {r["source_file"]: (r["company"], r["year"], r["text"]) for r in pages.where("error IS NULL").collect()}
    assert got == {"AME_2025.txt": ("AME", 2025, "one two"), "A_B_2024.html": ("A_B", 2024, "x & y\nz()"), "DOC_2020.docx": ("DOC", 2020, "Xin chào")}
    assert {r["report"] for r in readers.parse_errors(pages).collect()} == {"bad.pdf", "broken.docx"}
    assert readers.html_text("<p>x</p><script>z()</script>", drop_script=True) == "x"


def test_pipeline_from_files_to_index(spark, tmp_path):
    from docquarry.plans import pipelines

    (tmp_path / "AAA_2023.txt").write_text("Carbon emission was 120 tCO2e in 2023. We plan a reduction of carbon emission. " * 3, encoding="utf-8")
    (tmp_path / "BBB_2023.txt").write_text("Weather report without any content of note.", encoding="utf-8")
    pages, chunks, errors = pipelines.corpus(spark, str(tmp_path))
    chunks = chunks.select("chunk_id", "company", "year", "source_file", F.col("page_number").alias("page"), F.col("chunk").alias("text"))
    entry = readers.prepare_ontology({"indicator_id": "E1", "name": "carbon emission", "pillar": "E", "disclosure_type": "quantitative", "required_entities": ["carbon emission"], "units": "tco2e"})
    book = spark.createDataFrame([("E1", "E", "carbon emission")], "indicator_id string, pillar string, indicator_name string")
    rows = pipelines.evidence_from_chunks(chunks, [entry], book, dims=64)
    got = {r["company"]: r["score"] for r in rows.collect()}
    assert got == {"AAA": 2, "BBB": 0} and errors.count() == 0
    _, _, index = pipelines.disclosure_index(rows, str(tmp_path / "out"))
    assert {r["company"]: r["index_equal_indicator"] for r in index.collect()} == {"AAA": 66.6667, "BBB": 0.0}
    assert spark.read.parquet(str(tmp_path / "out" / "index.parquet")).count() == 2


def test_ontology_preparation():
    e = readers.prepare_ontology({"disclosure_type": "policy", "qualitative_patterns": ["Policy", "water plan"], "units": ["%", "m3"], "positive_keywords": "water"}, {"keywords_vi": "nước|m; water"})
    assert e["qualitative_patterns"] == ["water plan", "code of conduct", "risk management system", "management system"] and e["quantitative_patterns"] == ["m3"]
    assert e["positive_keywords"] == ["water", "nước", "m"] and readers.as_list(None) == [] and readers.as_list("x") == ["x"]


def test_prompts(tmp_path):
    meta, system, user = readers.read_prompt("version: v1\n---\nSYSTEM:\nbe fair\nUSER:\nscore {x}\n")
    assert (meta, system, user) == ({"version": "v1"}, "be fair", "score {x}")
    with pytest.raises(ValueError):
        readers.read_prompt("nothing")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, f"I{i % 2}", "n") for i in range(7)], "fact_id int, indicator_id string, name string")
    manifest = sinks.export_batches(df, ["fact_id"], 3, str(tmp_path / "b"), sinks.prompt_lines(F.col("indicator_id"), F.col("name"), []), "{batch_id}:\n{lines}", "indicator_id")
    assert [(r["batch_no"], r["record_count"], r["first"], r["last"]) for r in manifest.orderBy("batch_no").collect()] == [(1, 3, "I0", "I0"), (2, 3, "I1", "I1"), (3, 1, "I0", "I0")]
    assert spark.read.parquet(str(tmp_path / "b/prompts.parquet")).where("batch_no = 3").first()["prompt"] == "batch_003:\n- I0 | n"
    with pytest.raises(ValueError):
        sinks.with_batches(df, ["fact_id"], 0)
    path, note = str(tmp_path / "v.parquet"), str(tmp_path / "v.json")
    assert sinks.write_if_changed(df, path, note, "fact_id") and not sinks.write_if_changed(df.orderBy(F.desc("fact_id")), path, note, "fact_id") and sinks.write_if_changed(df.limit(3), path, note, "fact_id")
    assert sinks.write_jsonl(df, str(tmp_path / "j")) == 7 and readers.read_jsonl(spark, str(tmp_path / "j")).count() == 7
    sinks.write_table(df, str(tmp_path / "c"))
    assert readers.read_table(spark, str(tmp_path / "c")).count() == 7 and sinks.read_json(str(tmp_path / "none.json")) == {}
    sinks.write_run_manifest(str(tmp_path / "run.json"), {"pages": 3})
    assert json.loads((tmp_path / "run.json").read_text())["pages"] == 3
    sinks.replace_table(df, "facts_of_test")
    assert spark.table("facts_of_test").count() == 7


def test_answers(spark):
    df = spark.createDataFrame([("A", 1, "i", "2", "0.5", "e", "r"), ("B", 1, "i", "7", "0.5", "e", "r"), ("C", 1, "i", "1", "0.5", " ", "r"), ("D", 1, "i", "0", "x", None, "r")], "company string, year int, indicator_id string, score string, confidence string, evidence string, reasoning string")
    assert {r["company"]: r["problem"] for r in records.review_queue(df).collect()} == {"B": "score not in 0..3", "C": "positive score without evidence", "D": "confidence not in 0..1"}
    assert records.audit_text("T", {"A": [], "B": ["x"]}).count("- ") == 2


def test_cache_split(spark):
    want, have = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (2,)], "k int")
    hits, misses = retrieval.split_by_cache(want, have, ["k"])
    assert hits.count() == 1 and misses.count() == 2


def test_streams(spark, tmp_path):
    schema = "source_file string, page_number int, text string, ingested_at timestamp"
    src = spark.sql("SELECT 'f' source_file, 1 page_number, 'same' text, timestamp'2024-01-01 00:00:00' ingested_at UNION ALL SELECT 'f', 1, 'same', timestamp'2024-01-01 01:00:00' UNION ALL SELECT 'f', 2, 'other', timestamp'2024-01-01 01:00:00'")
    src.write.parquet(str(tmp_path / "in"))
    seen = []
    stream = streams.first_deliveries(streams.page_stream(spark, str(tmp_path / "in"), schema))
    streams.run_into(stream, lambda df, _: seen.extend(df.collect()), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r["page_number"] for r in seen) == [1, 2]
    events = spark.sql("SELECT timestamp'2024-01-01 00:10:00' ts, 'a' event_type, 1.5D value UNION ALL SELECT timestamp'2024-01-01 00:50:00', 'a', 2.0D UNION ALL SELECT timestamp'2024-01-01 01:00:00', 'a', 1.0D")
    assert sorted((r["n"], r["total"]) for r in streams.window_counts(events).collect()) == [(1, 1.0), (2, 3.5)]
