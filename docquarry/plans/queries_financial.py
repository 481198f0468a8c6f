"""Queries over financial pages and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquarry.common import table
from docquarry.functions.text import page_suspect
from docquarry.operators import financial
from docquarry.operators.retrieval import plain_tokens
from docquarry.plans.queries_text import _BM25, _DENSE, W, pages

SHARES, STAFF = ["CIRCULATING_SHARES", "HELD_SHARES"], ["HEADCOUNT"]
AT_LEAST = [("GROSS_RESOURCES", "OWN_FUNDS"), ("GROSS_RESOURCES", "BANK_LOANS")]
NONNEGATIVE = ["NET_SALES", "HEADCOUNT"]


def indicators(spark, d) -> list[dict]:
    return [r.asDict() for r in table(spark, d, "financial_indicators").orderBy("indicator_id").collect()]


def facts(spark, d):
    return table(spark, d, "financial_facts")


def page_classifier(spark, d):
    return financial.classify_pages(pages(spark, d)).select("page_key", "found_type", "found_score", "found_patterns")


def neighbour_pages(spark, d):
    return financial.expand_neighbours(financial.classify_pages(pages(spark, d))).select("page_key", "statement_type", "detection_score")


def detected_pages(spark, d):
    return financial.detect_financial_pages(pages(spark, d)).select("page_key", "source_file", "page_number", "statement_type", "ocr_parse_suspect")


def suspect_pages(spark, d):
    t = table(spark, d, "financial_pages")
    return t.select("page_key", page_suspect(F.col("text"), F.coalesce("detection_score", F.lit(0))).alias("suspect"))


def ocr_candidates(spark, d):
    return financial.ocr_candidates(table(spark, d, "financial_pages").where("statement_type IS NOT NULL"), 1)


def _scans(spark, d):
    """Scans: the delivered texts of pages of scanned reports, the order given by their delivery."""
    t = table(spark, d, "financial_pages").where("text IS NOT NULL AND page_number IS NOT NULL")
    reports = table(spark, d, "ocr_results").select(F.element_at(F.split("report_path", "/"), -1).alias("source_file")).distinct()
    return t.join(reports, "source_file", "left_semi").select("source_file", "page_number", "text", F.col("page_key").alias("seq"))


def ocr_page_merge(spark, d):
    t = table(spark, d, "financial_pages").where("statement_type IS NOT NULL")
    kept = financial.first_per_key(t, financial.PAGE_KEY, F.struct("page_key"))
    out = financial.merge_ocr_pages(kept, _scans(spark, d))
    return out.select("source_file", "page_number", "statement_type", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))


def ocr_upsert(spark, d):
    s = _scans(spark, d)
    return financial.upsert_pages(s, s.withColumn("text", F.upper("text"))).select("source_file", "page_number", "seq", F.md5(F.col("text").cast("binary")).alias("digest"))


def page_quality(spark, d):
    return financial.page_quality(table(spark, d, "financial_pages"), pages(spark, d).where("text IS NOT NULL"))


def statement_units(spark, d):
    return pages(spark, d).select("page_key", financial.statement_unit(F.col("text")).alias("unit"))


def number_tokens(spark, d):
    n = financial.number_tokens(F.col("evidence"))
    return facts(spark, d).select("fact_id", F.size(n).alias("n"), F.array_join(n, " ").alias("tokens"))


def parsed_numbers(spark, d):
    n = financial.number_tokens(F.col("evidence"))
    last = F.when(F.size(n) > 0, F.element_at(n, -1))
    return facts(spark, d).select("fact_id", financial.parse_number(last, F.coalesce("unit", F.lit(""))).cast("double").alias("value"))


def scaled_values(spark, d):
    return facts(spark, d).select("fact_id", (F.col("value") * financial.money_factor(F.coalesce("unit", F.lit("")))).alias("scaled"))


def extracted_facts(spark, d):
    return financial.extract_facts(pages(spark, d), indicators(spark, d)).select("page_key", "indicator_id", "firm", "year", "value", "unit", "currency", "confidence")


def fact_grid(spark, d):
    found = financial.best_facts(financial.extract_facts(pages(spark, d), indicators(spark, d)))
    cells = pages(spark, d).select(F.col("company").alias("firm"), "year").distinct()
    return financial.fact_grid(found, cells, indicators(spark, d)).select("firm", "report_year", "indicator_id", "value", "currency", "confidence", "extraction_method")


def _statement_warehouse(spark, d):
    return financial.statement_warehouse(pages(spark, d).withColumns({"company": F.coalesce("company", F.lit("")), "year": F.coalesce("year", F.lit(0))}), table(spark, d, "financial_indicators"), 10, 15, 64, "md5", plain_tokens)


def statement_warehouse(spark, d):
    """The pages chosen for every firm-year and statement group."""
    return _statement_warehouse(spark, d).select("warehouse_group", "company", "year", "page_key", F.round("retrieval_score", 8).alias("retrieval_score"), "financial_rank")


def warehouse_facts(spark, d):
    """The best fact of every firm-year and indicator among the first eight pages of its statement group."""
    from docquarry.common import materialise

    docs = pages(spark, d).withColumns({"company": F.coalesce("company", F.lit("")), "year": F.coalesce("year", F.lit(0))})
    out = financial.warehouse_facts(docs, materialise(_statement_warehouse(spark, d)), indicators(spark, d))
    return out.select("firm", "report_year", "indicator_id", "page_key", "value", "unit", "confidence")


def group_queries(spark, d):
    return financial.group_queries(table(spark, d, "financial_indicators"))


def validation_rules(spark, d):
    return financial.validate_facts(facts(spark, d), AT_LEAST, NONNEGATIVE)


def flagged_facts(spark, d):
    out = financial.attach_flags(facts(spark, d), validation_rules(spark, d))
    flag = financial.anomaly_flags(F.col("validation_flag"), F.col("value"), F.col("currency"), F.col("indicator_id"), SHARES, STAFF)
    return out.select("fact_id", flag.alias("validation_flag"))


def coerced_facts(spark, d):
    out = financial.coerce_facts(facts(spark, d))
    return out.select("fact_id", "firm", "year", "unit", "currency", "page", "value", "cache_hit")


def fact_quality(spark, d):
    return financial.fact_quality(facts(spark, d), validation_rules(spark, d), digits=10)


def null_diagnosis(spark, d):
    return financial.null_diagnosis(facts(spark, d), table(spark, d, "financial_pages"), indicators(spark, d))


NAMES = [
    "page_classifier", "neighbour_pages", "detected_pages", "suspect_pages", "ocr_candidates", "ocr_page_merge", "ocr_upsert", "page_quality", "statement_units", "number_tokens", "parsed_numbers", "scaled_values", "extracted_facts",
    "fact_grid", "statement_warehouse", "warehouse_facts", "group_queries", "validation_rules", "flagged_facts", "coerced_facts", "fact_quality", "null_diagnosis",
]
QUERIES = {n: globals()[n] for n in NAMES}

_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_SLIM = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")


def _fold(c: str) -> str:
    """The folded form in DuckDB: wide letters and ligatures spelled out, lower case, accents and d-stroke dropped, blanks collapsed."""
    x = f"translate(coalesce({c}, ''), '{_WIDE}', '{_SLIM}')"
    for code, plain in ((0xFB00, "ff"), (0xFB01, "fi"), (0xFB02, "fl"), (0xFB03, "ffi"), (0xFB04, "ffl")):
        x = f"replace({x}, chr({code}), '{plain}')"
    return f"trim(regexp_replace(replace(strip_accents(lower({x})), 'đ', 'd'), '{W}+', ' ', 'g'))"


_HITS = ", ".join("list_filter([" + ", ".join(f"'{p}'" for p in ps) + f"], lambda x: contains(plain, x)) AS {t}" for t, ps in financial.PAGE_PATTERNS.items())
_TYPES = list(financial.PAGE_PATTERNS)
_BEST = "greatest(" + ", ".join(f"len({t})" for t in _TYPES) + ")"
_PICK = " ".join(f"WHEN len({t}) = best THEN '{t}'" for t in _TYPES)
_PICKED = " ".join(f"WHEN len({t}) = best THEN array_to_string({t}, '; ')" for t in _TYPES)
_CLASSED = f"""plain AS (SELECT page_key, source_file, page_number, text, {_fold('text')} AS plain FROM financial_pages), hits AS (SELECT *, {_HITS} FROM plain), b AS (SELECT *, {_BEST} AS best FROM hits),
classed AS (SELECT page_key, source_file, page_number, text, CASE WHEN best = 0 THEN '' {_PICK} END AS found_type, CAST(best AS INTEGER) AS found_score, CASE WHEN best = 0 THEN '' {_PICKED} END AS found_patterns FROM b)"""
_NEAR = f"""{_CLASSED}, placed AS (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY page_number, page_key) AS pos FROM classed),
near AS (SELECT p.page_key, p.source_file, p.page_number, p.text, h.found_type AS statement_type, h.found_score AS detection_score FROM placed p JOIN placed h ON p.source_file = h.source_file AND h.found_score > 0 AND abs(p.pos - h.pos) <= 1
  QUALIFY row_number() OVER (PARTITION BY p.page_key ORDER BY h.found_score DESC, h.pos) = 1)"""


def _suspect(text: str, score: str) -> str:
    t = f"coalesce({text}, '')"
    odd = f"len(regexp_extract_all({t}, '[?\\x{{fffd}}]'))"
    return f"((length({t}) < 250 AND {score} > 0) OR (length({t}) - length(replace({t}, chr(10), '')) < 2 AND length({t}) < 600 AND {score} > 0) OR {odd} > greatest(length({t}) * 0.02, 5))"


_VALUES = ", ".join(f"arg_min(value, fact_id) FILTER (indicator_id = '{i}' AND value IS NOT NULL) AS {i}" for i in sorted({x for p in AT_LEAST for x in p} | set(NONNEGATIVE)))
_RULES = " UNION ALL ".join(
    [f"SELECT firm, year, '{a}_GTE_{b}' AS rule, CASE WHEN {a} IS NULL OR {b} IS NULL THEN 'SKIP' WHEN {a} >= {b} THEN 'PASS' ELSE 'FAIL' END AS status FROM wide" for a, b in AT_LEAST]
    + [f"SELECT firm, year, '{a}_NONNEGATIVE' AS rule, CASE WHEN {a} IS NULL THEN 'SKIP' WHEN {a} >= 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM wide" for a in NONNEGATIVE]
)
_VALID = f"wide AS (SELECT firm, year, {_VALUES} FROM financial_facts WHERE firm IS NOT NULL AND year IS NOT NULL GROUP BY firm, year), valid AS ({_RULES})"
_SCANS = "scans AS (SELECT source_file, page_number, text, page_key AS seq FROM financial_pages WHERE text IS NOT NULL AND page_number IS NOT NULL AND source_file IN (SELECT string_split(report_path, '/')[-1] FROM ocr_results))"
_TOKENS = r"regexp_extract_all(coalesce(evidence, ''), '(^|[^\p{L}\p{N}_])(-?\(?\d[\d.,]*\)?)', 2)"
_UNIT = f"regexp_replace({_fold('unit')}, '^ +| +$', '', 'g')"
_FACTOR = "CASE " + " ".join(f"WHEN u = '{u}' THEN {f}" for u, f in financial.MONEY.items() if u != "đong") + " ELSE 1 END"

_HEAD = "CASE statement_group " + " ".join(f"WHEN '{g}' THEN '{w}'" for g, w in financial.GROUP_WORDS.items()) + " ELSE statement_group END"
_STATED = f"CASE WHEN contains(h, 'nghin dong') THEN 'nghìn đồng' WHEN contains(h, 'trieu dong') THEN 'triệu đồng' WHEN contains(h, 'ty dong') THEN 'tỷ đồng' WHEN contains(h, 'vnd') OR contains(h, 'dong viet nam') THEN 'VND' END"
_HAS = lambda *ws: "(" + " OR ".join(f"contains(pad, '{w}')" for w in ws) + ")"
_FACTS = f"""book AS (SELECT indicator_id, statement_group, convert_to_vnd AS vnd, coalesce(aliases, [label_vi]) AS aliases, list_sort(list_transform(unit_candidates, lambda u, i: {{'n': -length(u), 'i': i, 'u': u}})) AS us FROM financial_indicators),
al AS (SELECT indicator_id, unnest(aliases) AS a, generate_subscripts(aliases, 1) AS no FROM book), alf AS (SELECT *, {_fold('a')} AS f FROM al),
un AS (SELECT indicator_id, no, x.u AS u, {_fold('x.u')} AS f FROM (SELECT indicator_id, unnest(us) AS x, generate_subscripts(us, 1) AS no FROM book)),
pg AS (SELECT page_key, company AS firm, year AS ry, {_STATED} AS stated, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{W}+|{W}+$', '', 'g')), lambda x: x <> '') AS ls FROM (SELECT *, {_fold('substr(text, 1, 1500)')} AS h FROM financial_pages WHERE text IS NOT NULL)),
ln AS (SELECT page_key, firm, ry, stated, unnest(d) AS line, generate_subscripts(d, 1) - 1 AS line_no FROM (SELECT *, list_filter(ls, lambda x, i: list_position(ls, x) = i) AS d FROM pg)), lf AS (SELECT *, {_fold('line')} AS plain FROM ln),
nm AS (SELECT page_key, line_no, indicator_id, arg_min(instr(plain, f) + length(f), no) AS pe FROM lf JOIN alf ON contains(plain, f) GROUP BY ALL),
raw_e AS (SELECT page_key, line_no, n.indicator_id, min(CASE WHEN instr(lower(line), lower(a)) > 0 THEN instr(lower(line), lower(a)) + length(a) END) AS e FROM nm n JOIN lf USING (page_key, line_no) JOIN al USING (indicator_id) GROUP BY ALL),
hit AS (SELECT l.*, n.indicator_id, b.vnd, b.statement_group, ' ' || plain || ' ' AS pad, CASE WHEN r.e IS NOT NULL THEN substr(line, r.e) ELSE substr(plain, n.pe) END AS tail,
  (SELECT arg_min(u, no) FROM un WHERE un.indicator_id = n.indicator_id AND contains(l.plain, un.f)) AS own FROM nm n JOIN lf l USING (page_key, line_no) JOIN raw_e r USING (page_key, line_no, indicator_id) JOIN book b USING (indicator_id)),
hu AS (SELECT *, coalesce(CASE WHEN vnd THEN stated END, own, CASE WHEN vnd THEN CASE WHEN {_HAS('nghin dong', 'thousand vnd')} THEN 'nghìn đồng' WHEN {_HAS('trieu dong', 'million vnd')} THEN 'triệu đồng' WHEN {_HAS('ty dong', 'billion vnd')} THEN 'tỷ đồng'
  WHEN {_HAS(' vnd ', ' dong ')} THEN 'VND' END ELSE CASE WHEN {_HAS('co phieu', 'shares')} THEN 'cổ phiếu' WHEN {_HAS('nguoi', 'employees', 'persons', 'lao dong')} THEN 'người' END END, 'VND') AS unit FROM hit),
hf AS (SELECT *, {_fold('unit')} AS u, list_filter(string_split_regex(line, '[^\\p{{L}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '(20|19)\\d{{2}}')) AS ys, {_TOKENS.replace("coalesce(evidence, '')", 'tail')} AS toks FROM hu),
tk AS (SELECT page_key, line_no, indicator_id, u, vnd, unnest(toks) AS raw, generate_subscripts(toks, 1) AS no FROM hf),
t2 AS (SELECT *, starts_with(raw, '-') OR (starts_with(raw, '(') AND ends_with(raw, ')')) AS neg, regexp_replace(raw, '[^0-9.,]', '', 'g') AS d FROM tk),
t3 AS (SELECT *, CASE WHEN contains(d, ',') AND contains(d, '.') AND instr(reverse(d), ',') < instr(reverse(d), '.') THEN replace(replace(d, '.', ''), ',', '.') WHEN contains(d, ',') AND contains(d, '.') THEN replace(d, ',', '')
  WHEN u IN ('ty dong', 'billion vnd') AND regexp_full_match(d, '\\d+[,.]\\d{{1,3}}') THEN replace(d, ',', '.') ELSE regexp_replace(d, '[.,]', '', 'g') END AS s FROM t2),
t4 AS (SELECT *, CASE WHEN regexp_full_match(s, '\\d+(\\.\\d*)?') AND length(s) < 32 THEN CASE WHEN neg THEN -CAST(s AS DOUBLE) ELSE CAST(s AS DOUBLE) END END AS v FROM t3),
best AS (SELECT page_key, line_no, indicator_id, arg_max(v * CASE WHEN vnd THEN {_FACTOR} ELSE 1 END, (abs(v), -no)) AS value FROM t4 WHERE v IS NOT NULL AND NOT (abs(v) BETWEEN 1900 AND 2099 OR abs(v) < 1000) GROUP BY ALL),
fc AS (SELECT page_key, indicator_id, statement_group, firm, coalesce(CAST(list_max(ys) AS INTEGER), ry) AS year, ry, value, unit, CASE WHEN vnd THEN 'VND' WHEN unit IN ('cổ phiếu', 'shares') THEN 'SHARES' WHEN unit IN ('người', 'employees', 'persons') THEN 'PERSONS' WHEN contains(plain, 'usd') THEN 'USD' ELSE 'VND' END AS currency,
  round_even(0.8 + CASE WHEN contains(plain, u) THEN 0.15 ELSE 0 END + CASE WHEN len(ys) > 0 THEN 0.05 ELSE 0 END, 4) AS confidence, line_no FROM hf JOIN best USING (page_key, line_no, indicator_id)),
facts AS (SELECT * FROM fc QUALIFY row_number() OVER (PARTITION BY page_key, indicator_id ORDER BY confidence DESC, line_no) = 1)"""

_WAREHOUSE = f"""q AS (SELECT statement_group AS query_id, concat_ws(' ', {_HEAD}, string_agg(concat_ws(' ', label_vi, array_to_string(aliases, ' '), array_to_string(retrieval_queries, ' ')), ' ' ORDER BY indicator_id)) AS query FROM financial_indicators GROUP BY statement_group),
{_BM25.replace('upper(company) AS company, year', "coalesce(company, '') AS company, coalesce(year, 0) AS year").replace('text FROM financial_pages', 'text FROM financial_pages WHERE text IS NOT NULL')},
wb AS (SELECT query_id, chunk_id, company, year, row_number() OVER (PARTITION BY query_id, company, year ORDER BY round(s, 9) DESC, chunk_id) AS br FROM hits QUALIFY br <= 15), {_DENSE},
wa AS (SELECT query_id, d.chunk_id, company, year, coalesce(s, 0) AS s FROM (SELECT query_id FROM q) CROSS JOIN docs d LEFT JOIN dot USING (query_id, chunk_id)),
we AS (SELECT query_id, chunk_id, company, year, row_number() OVER (PARTITION BY query_id, company, year ORDER BY round(s, 9) DESC, chunk_id) AS er FROM wa QUALIFY er <= 10),
wf AS (SELECT query_id, chunk_id, company, year, 1 / (60 + coalesce(br, 16)) + 1 / (60 + coalesce(er, 16)) AS h FROM wb FULL JOIN we USING (query_id, chunk_id, company, year)),
wh AS (SELECT *, CAST(substr(chunk_id, 2) AS BIGINT) AS page_key, row_number() OVER (PARTITION BY query_id, company, year ORDER BY round(h, 12) DESC, chunk_id) AS hr FROM wf QUALIFY hr <= 15)"""

ORACLES = {
    "statement_warehouse": f"WITH {_WAREHOUSE} SELECT query_id AS warehouse_group, company, year, page_key, round(h, 8) AS retrieval_score, CAST(hr AS INTEGER) AS financial_rank FROM wh",
    "warehouse_facts": f"""WITH {_WAREHOUSE}, {_FACTS}, s AS (SELECT coalesce(firm, '') AS firm, coalesce(ry, 0) AS report_year, indicator_id, facts.page_key, value, unit, hr, least(1, confidence * 0.75 + least(greatest(h * 35, 0), 1) * 0.25)::DOUBLE AS sure
        FROM facts JOIN wh ON wh.query_id = statement_group AND wh.page_key = facts.page_key AND hr <= 8)
        SELECT firm, report_year, indicator_id, page_key, value, unit, round_even(sure, 4)::DOUBLE AS confidence FROM s QUALIFY row_number() OVER (PARTITION BY firm, report_year, indicator_id ORDER BY round(sure, 9) DESC, hr, page_key) = 1""",
    "extracted_facts": f"WITH {_FACTS} SELECT page_key, indicator_id, firm, year, value, unit, currency, confidence::DOUBLE AS confidence FROM facts",
    "fact_grid": f"""WITH {_FACTS}, b AS (SELECT *, round_even(least(1, confidence * 0.75), 4) AS c FROM facts QUALIFY row_number() OVER (PARTITION BY firm, ry, indicator_id ORDER BY confidence DESC, page_key) = 1),
        cells AS (SELECT DISTINCT company, year FROM financial_pages)
        SELECT c.company AS firm, c.year AS report_year, k.indicator_id, value, coalesce(currency, CASE WHEN vnd THEN 'VND' ELSE '' END) AS currency, coalesce(b.c, 0)::DOUBLE AS confidence, CASE WHEN b.firm IS NULL AND b.page_key IS NULL THEN 'none' ELSE 'table' END AS extraction_method
        FROM cells c CROSS JOIN book k LEFT JOIN b ON b.firm IS NOT DISTINCT FROM c.company AND b.ry IS NOT DISTINCT FROM c.year AND b.indicator_id = k.indicator_id""",
    "page_classifier": f"WITH {_CLASSED} SELECT page_key, found_type, found_score, found_patterns FROM classed",
    "neighbour_pages": f"WITH {_NEAR} SELECT page_key, statement_type, detection_score FROM near",
    "detected_pages": f"""WITH {_NEAR} SELECT page_key, source_file, page_number, statement_type, {_suspect("trim(text, ' ')", 'detection_score')} AS ocr_parse_suspect FROM near
        QUALIFY row_number() OVER (PARTITION BY source_file, page_number, statement_type ORDER BY page_key) = 1""",
    "suspect_pages": f"SELECT page_key, {_suspect('text', 'coalesce(detection_score, 0)')} AS suspect FROM financial_pages",
    "ocr_candidates": """SELECT DISTINCT source_file, CAST(p AS INTEGER) AS page_number FROM (SELECT source_file, unnest(range(greatest(1, page_number - 1), page_number + 2)) AS p FROM financial_pages WHERE statement_type IS NOT NULL AND page_number IS NOT NULL)""",
    "ocr_page_merge": f"""WITH {_CLASSED}, {_SCANS}, kept AS (SELECT * FROM financial_pages WHERE statement_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_file, page_number, statement_type ORDER BY page_key) = 1),
        last AS (SELECT * FROM scans QUALIFY row_number() OVER (PARTITION BY source_file, page_number ORDER BY seq DESC) = 1),
        typed AS (SELECT l.source_file, l.page_number, CASE WHEN c.found_score > 0 THEN c.found_type ELSE 'financial_ocr' END AS statement_type, l.text FROM last l JOIN classed c ON c.page_key = l.seq)
        SELECT k.source_file, k.page_number, k.statement_type, md5(coalesce(CASE WHEN l.text IS NOT NULL AND length(l.text) >= greatest(length(coalesce(k.text, '')) * 0.7, 100) THEN l.text ELSE k.text END, '')) AS digest
        FROM kept k LEFT JOIN last l ON k.source_file = l.source_file AND k.page_number = l.page_number
        UNION ALL SELECT source_file, page_number, statement_type, md5(text) FROM typed t WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.source_file = t.source_file AND k.page_number = t.page_number AND k.statement_type = t.statement_type)""",
    "ocr_upsert": f"WITH {_SCANS} SELECT source_file, page_number, seq, md5(upper(text)) AS digest FROM scans QUALIFY row_number() OVER (PARTITION BY source_file, page_number ORDER BY seq DESC) = 1",
    "page_quality": """SELECT company, year, count(DISTINCT page_number) AS financial_pages, CAST(sum(CASE WHEN ocr_parse_suspect THEN 1 ELSE 0 END) AS BIGINT) AS suspect_pages,
        array_to_string(list_sort(list(DISTINCT coalesce(statement_type, ''))), '; ') AS statement_types, count(text) AS financial_chunks FROM financial_pages GROUP BY company, year""",
    "statement_units": f"""SELECT page_key, CASE WHEN contains(p, 'nghin dong') THEN 'nghìn đồng' WHEN contains(p, 'trieu dong') THEN 'triệu đồng' WHEN contains(p, 'ty dong') THEN 'tỷ đồng'
        WHEN contains(p, 'vnd') OR contains(p, 'dong viet nam') THEN 'VND' END AS unit FROM (SELECT page_key, {_fold('substr(text, 1, 1500)')} AS p FROM financial_pages)""",
    "number_tokens": f"SELECT fact_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, ' ') AS tokens FROM (SELECT fact_id, {_TOKENS} AS t FROM financial_facts)",
    "parsed_numbers": f"""WITH n AS (SELECT fact_id, {_fold('unit')} AS u, {_TOKENS}[-1] AS raw FROM financial_facts), b AS (SELECT *, starts_with(raw, '-') OR (starts_with(raw, '(') AND ends_with(raw, ')')) AS neg, regexp_replace(raw, '[^0-9.,]', '', 'g') AS d FROM n),
        c AS (SELECT *, CASE WHEN contains(d, ',') AND contains(d, '.') AND length(d) - instr(reverse(d), ',') > length(d) - instr(reverse(d), '.') THEN replace(replace(d, '.', ''), ',', '.')
        WHEN contains(d, ',') AND contains(d, '.') THEN replace(d, ',', '') WHEN u IN ('ty dong', 'billion vnd') AND regexp_full_match(d, '\\d+[,.]\\d{{1,3}}') THEN replace(d, ',', '.') ELSE regexp_replace(d, '[.,]', '', 'g') END AS s FROM b)
        SELECT fact_id, CASE WHEN regexp_full_match(s, '\\d+(\\.\\d*)?') THEN CASE WHEN neg THEN -CAST(s AS DOUBLE) ELSE CAST(s AS DOUBLE) END END AS value FROM c""",
    "scaled_values": f"SELECT fact_id, value * ({_FACTOR}) AS scaled FROM (SELECT fact_id, value, {_UNIT} AS u FROM financial_facts)",
    "group_queries": f"""SELECT statement_group, concat_ws(' ', {_HEAD}, string_agg(concat_ws(' ', label_vi, array_to_string(aliases, ' '), array_to_string(retrieval_queries, ' ')), ' ' ORDER BY indicator_id)) AS query FROM financial_indicators GROUP BY statement_group""",
    "validation_rules": f"WITH {_VALID} SELECT firm, year, rule, status FROM valid",
    "flagged_facts": f"""WITH {_VALID}, bad AS (SELECT firm, year, list_sort(list(DISTINCT rule)) AS r FROM valid WHERE status = 'FAIL' GROUP BY firm, year)
        SELECT fact_id, array_to_string(list_concat(coalesce(r, []), list_filter([CASE WHEN currency = 'VND' AND abs(value) > 1e18 THEN 'EXTREME_VND_VALUE' END, CASE WHEN indicator_id IN ('CIRCULATING_SHARES', 'HELD_SHARES') AND abs(value) > 1e11 THEN 'EXTREME_SHARE_COUNT' END,
        CASE WHEN indicator_id = 'HEADCOUNT' AND abs(value) > 1e7 THEN 'EXTREME_EMPLOYEE_COUNT' END], lambda x: x IS NOT NULL)), '; ') AS validation_flag FROM financial_facts f LEFT JOIN bad b ON f.firm = b.firm AND f.year = b.year""",
    "coerced_facts": "SELECT fact_id, coalesce(firm, '') AS firm, year, coalesce(unit, '') AS unit, coalesce(currency, '') AS currency, coalesce(CAST(page AS VARCHAR), '') AS page, value, coalesce(cache_hit, false) AS cache_hit FROM financial_facts",
    "fact_quality": f"""WITH {_VALID} SELECT indicator_id, count(*) AS observations, count(value) AS extracted, round_even(avg(confidence), 10) AS avg_confidence, count(*) FILTER (extraction_method = 'table') AS table_extractions,
        round_even(count(value) / count(*), 10) AS coverage, round_even(avg(CAST(cache_hit AS INTEGER)), 6) AS cache_hit_rate, round_even(avg(CAST(warehouse_hit AS INTEGER)), 6) AS warehouse_hit_rate, CAST(NULL AS VARCHAR) AS rule, CAST(NULL AS BIGINT) AS failed_count FROM financial_facts GROUP BY indicator_id
        UNION ALL SELECT 'VALIDATION', (SELECT count(*) FROM financial_facts), NULL, NULL, NULL, NULL, NULL, NULL, rule, count(*) FROM valid WHERE status = 'FAIL' GROUP BY rule""",
    "null_diagnosis": f"""WITH al AS (SELECT indicator_id, {_fold('alias')} AS f FROM (SELECT indicator_id, unnest(aliases) AS alias FROM financial_indicators)), pg AS (SELECT company, year, {_fold('text')} AS p FROM financial_pages WHERE company IS NOT NULL AND year IS NOT NULL),
        has AS (SELECT DISTINCT company, year FROM pg WHERE p <> ''), seen AS (SELECT DISTINCT company, year, indicator_id FROM pg JOIN al ON contains(p, f))
        SELECT fact_id, firm, f.year, f.indicator_id, value IS NOT NULL AS value_present, s.company IS NOT NULL AS alias_present, CASE WHEN f.indicator_id NOT IN (SELECT indicator_id FROM financial_indicators) THEN 'unknown_indicator' WHEN value IS NOT NULL THEN 'extracted'
        WHEN h.company IS NULL THEN 'no_financial_pages_detected' WHEN s.company IS NOT NULL THEN 'alias_present_but_number_not_extracted' ELSE 'alias_absent_from_financial_pages' END AS null_reason
        FROM financial_facts f LEFT JOIN has h ON h.company = firm AND h.year = f.year LEFT JOIN seen s ON s.company = firm AND s.year = f.year AND s.indicator_id = f.indicator_id""",
}

