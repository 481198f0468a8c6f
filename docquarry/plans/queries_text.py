"""Queries over page texts: normalisation, windows, tokens, retrieval, fusion, evidence."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.common import spread, table
from docquarry.functions import text as T
from docquarry.operators import chunking, evidence, retrieval

DIMS = 64


def pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "financial_pages").select("page_key", "company", "year", "page_number", "source_file", "text")


def passages(spark: SparkSession, d: str) -> DataFrame:
    """Pages as passages: company, year and page of the delivered table, the id as text of fixed width."""
    return pages(spark, d).select(
        F.format_string("P%09d", "page_key").alias("chunk_id"), F.upper("company").alias("company"), "year", F.col("page_number").alias("page"), "source_file", "text"
    )


def ontology_rows(spark: SparkSession, d: str) -> list[dict]:
    """The indicator dictionary (some dozen rows) on the driver, in the shape of the matcher."""
    rows = table(spark, d, "indicator_ontology").collect()
    return [r.asDict() | {"hard_required": [r["name"]], "soft_positive": list(r["positive_keywords"] or ()), "alternative_phrases": [r["name_vi"]] if r["name_vi"] else []} for r in rows]


def indicator_queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "indicator_ontology").select(F.col("indicator_id").alias("query_id"), F.concat_ws(" ", "name", "name_vi", F.concat_ws(" ", "positive_keywords")).alias("query"))


def normalized_text(spark, d):
    return pages(spark, d).select("page_key", F.md5(T.normalize_text("text").cast("binary")).alias("digest"))


def token_counts(spark, d):
    return pages(spark, d).select("page_key", F.coalesce(T.count_tokens("text"), F.lit(0)).alias("n_tokens"))


def chunk_windows(spark, d):
    w = chunking.split_text(pages(spark, d), 200, 40)
    return w.select("page_key", "window_no", "first_token", "n_tokens", F.md5(F.regexp_replace("chunk", r"(?U)\s+", " ").cast("binary")).alias("digest"))


def chunk_ids(spark, d):
    return chunking.chunk_reports(pages(spark, d), 200, 40).select("page_key", "window_no", "chunk_id")


def tokenized(spark, d):
    t = retrieval.plain_tokens("text")
    return pages(spark, d).select("page_key", F.coalesce(F.size(t), F.lit(0)).alias("n"), F.md5(F.array_join(F.coalesce(t, F.array().cast("array<string>")), " ").cast("binary")).alias("digest"))


def tokens_with_plain_forms(spark, d):
    return pages(spark, d).where("text IS NOT NULL").select("page_key", F.size(T.tokenize("text")).alias("n_tokens"), F.size(T.content_terms("text")).alias("n_content_terms"))


def folded_names(spark, d):
    """Indicator labels folded for matching."""
    rows = table(spark, d, "financial_indicators").select("indicator_id", F.explode("aliases").alias("alias"))
    return rows.select("indicator_id", "alias", T.fin_normalize("alias").alias("folded"))


def split_keywords(spark, d):
    """Ordered distinct terms of a delimited list, with corrupt entries marked."""
    rows = table(spark, d, "indicator_ontology").select("indicator_id", F.concat_ws(" ; ", F.concat_ws("|", "positive_keywords"), "name").alias("terms"))
    terms = F.array_distinct(T.split_terms("terms"))
    return rows.select("indicator_id", F.size(terms).alias("n"), F.array_join(terms, "#").alias("terms"), T.looks_corrupt("terms").alias("corrupt"))


def hash_embeddings(spark, d):
    """BLAKE2b hashing embeddings of all pages: length and number of used buckets."""
    e = spread(pages(spark, d)).select("page_key", T.hash_embed("text", 1024).alias("e"))
    norm = F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x)
    return e.select("page_key", F.round(norm, 6).alias("norm"), F.size(F.filter("e", lambda x: x != 0)).alias("used"))


def hash_embeddings_md5(spark, d):
    """MD5 hashing embeddings as (page, bucket, weight); weights are those of the vectors of unit length."""
    e = spread(pages(spark, d)).where("text IS NOT NULL").select("page_key", F.posexplode(T.hash_embed("text", DIMS, "md5")).alias("bucket", "weight"))
    return e.where("weight <> 0").select("page_key", "bucket", F.round("weight", 6).alias("weight"))


def bm25_topk(spark, d):
    terms = retrieval.query_terms(indicator_queries(spark, d), tokens=retrieval.plain_tokens("query"))
    index = retrieval.build_index(passages(spark, d), tokens=retrieval.plain_tokens("text"), terms=terms)
    return retrieval.bm25_top_k(index, terms, 10).select("query_id", "chunk_id", F.round("bm25_score", 6).alias("bm25_score"), "bm25_rank")


def term_statistics(spark, d):
    """The whole inverted index: how many passages hold a term, and how often."""
    index = retrieval.build_index(passages(spark, d), tokens=retrieval.plain_tokens("text"))
    return index.postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max("tf").alias("most"))


def _by_name(spark, d):
    queries = table(spark, d, "indicator_ontology").select(F.col("indicator_id").alias("query_id"), F.col("name").alias("query"))
    return queries, retrieval.query_terms(queries, tokens=retrieval.plain_tokens("query"))


def bm25_grouped_topk(spark, d):
    """Per firm-year and indicator: the three best passages, padded with passages of score 0."""
    groups = ("company", "year")
    docs = passages(spark, d).withColumns({"company": F.coalesce("company", F.lit("")), "year": F.coalesce("year", F.lit(0))})
    queries, terms = _by_name(spark, d)
    index = retrieval.build_index(docs, groups=groups, tokens=retrieval.plain_tokens("text"), terms=terms)
    ranked = retrieval.bm25_top_k(index, terms, 3, groups)
    out = retrieval.with_zero_scores(ranked, index.documents, queries, groups, 3)
    return out.select("query_id", "company", "year", "chunk_id", F.round("bm25_score", 6).alias("bm25_score"), "bm25_rank")


def any_year_topk(spark, d):
    """Per firm-year and indicator the three best passages with a term; a cell of unknown year is answered from all years."""
    groups = ("company", "year")
    docs = passages(spark, d)
    _, terms = _by_name(spark, d)
    index = retrieval.build_index(docs, groups=groups, tokens=retrieval.plain_tokens("text"), terms=terms)
    scored = retrieval.any_year(retrieval.bm25_scores(index, terms, groups), docs.select("company", "year"))
    out = retrieval.top_k(scored.where("company IS NOT NULL"), ["query_id", *groups], "bm25_score", 3, "bm25_rank")
    return out.select("query_id", "company", "year", "chunk_id", F.round("bm25_score", 6).alias("bm25_score"), "bm25_rank")


def dense_topk(spark, d):
    """The five nearest vectors of every vector whose id is divisible by 20, by exact dot product."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")
    asked = e.where("chunk_id % 20 = 0").withColumnRenamed("chunk_id", "query_id")
    out = retrieval.dense_top_k_blocks(e, asked, 5, mask=True)
    return out.select("query_id", "chunk_id", F.round("dense_score", 6).alias("dense_score"), "dense_rank")


def _searches(spark, d, k=20):
    docs, queries = passages(spark, d), indicator_queries(spark, d)
    terms = retrieval.query_terms(queries, tokens=retrieval.plain_tokens("query"))
    bm25 = retrieval.bm25_top_k(retrieval.build_index(docs, tokens=retrieval.plain_tokens("text"), terms=terms), terms, k)
    rows = queries.collect()
    vectors = T.embed_batch([r["query"] for r in rows], DIMS, "md5")
    embedded = spread(docs).where("text IS NOT NULL").select("chunk_id", T.hash_embed("text", DIMS, "md5").alias("embedding"))
    dense = retrieval.dense_top_k(embedded, [(r["query_id"], v.tolist()) for r, v in zip(rows, vectors)], k)
    return bm25, dense


def hybrid_rrf(spark, d):
    bm25, dense = _searches(spark, d)
    return retrieval.fuse(bm25, dense, 20).select("query_id", "chunk_id", F.round("hybrid_score", 8).alias("hybrid_score"), "hybrid_rank")


def rerank_fallback(spark, d):
    bm25, dense = _searches(spark, d)
    out = retrieval.rerank(retrieval.fuse(bm25, dense, 20), 5)
    return out.select("query_id", "chunk_id", F.round("rerank_score", 8).alias("rerank_score"), "rank", "reranker")


def structural_scores(spark, d):
    units = F.coalesce(F.col("text"), F.lit("")).rlike("(tấn|kWh|đồng)")
    return pages(spark, d).select("page_key", evidence.structural_score(F.col("text"), units).alias("structural_score"))


def _evaluated(spark, d):
    """Dense and keyword candidates of every firm-year and indicator, evaluated against the ontology."""
    docs = passages(spark, d).withColumns({"company": F.coalesce("company", F.lit("")), "year": F.coalesce("year", F.lit(0))})
    groups = ("company", "year")
    queries = indicator_queries(spark, d)
    terms = retrieval.query_terms(queries)
    keyword = retrieval.bm25_top_k(retrieval.build_index(docs, groups=groups, terms=terms), terms, 80, groups)
    rows = queries.collect()
    vectors = T.embed_batch([r["query"] for r in rows], 256)
    embedded = spread(docs).where("text IS NOT NULL").select("chunk_id", *groups, T.hash_embed("text", 256).alias("embedding"))
    dense = retrieval.dense_top_k(embedded, [(r["query_id"], v.tolist()) for r, v in zip(rows, vectors)], 30, groups)
    merged = retrieval.merge_candidates(dense, keyword, ["query_id", *groups, "chunk_id"]).withColumnRenamed("query_id", "indicator_id")
    full = merged.join(docs.select("chunk_id", "page", "source_file", "text"), "chunk_id")
    return evidence.evaluate_candidates(full, ontology_rows(spark, d))


def candidate_evaluation(spark, d):
    out = _evaluated(spark, d)
    return out.select("indicator_id", "company", "year", "chunk_id", "keep", "strict_keep", F.round("relevance", 4).alias("relevance"), "keyword_score", "disclosure_type", "matched_keywords", "matched_units")


def _keyword_candidates(spark, d):
    """The 20 best passages of every firm-year and indicator by keyword search alone, with their texts."""
    groups = ("company", "year")
    docs = passages(spark, d).withColumns({"company": F.coalesce("company", F.lit("")), "year": F.coalesce("year", F.lit(0))})
    terms = retrieval.query_terms(indicator_queries(spark, d), tokens=retrieval.plain_tokens("query"))
    found = retrieval.bm25_top_k(retrieval.build_index(docs, groups=groups, tokens=retrieval.plain_tokens("text"), terms=terms), terms, 20, groups)
    found = found.select(F.col("query_id").alias("indicator_id"), *groups, "chunk_id", "bm25_rank", F.lit(None).cast("double").alias("dense_score"), F.lit(None).cast("int").alias("dense_rank"))
    return found.join(docs.select("chunk_id", "page", "source_file", "text"), "chunk_id")


def keyword_evaluation(spark, d):
    """Keyword candidates judged against the ontology."""
    out = evidence.evaluate_candidates(_keyword_candidates(spark, d), ontology_rows(spark, d))
    return out.select(
        "indicator_id", "company", "year", "chunk_id", "keep", "strict_keep", F.round("relevance", 4).alias("relevance"), "keyword_score", "structural_score", "disclosure_type", "is_quantitative", "matched_keywords", "matched_negative",
        "matched_units",
    )


def _grid(spark, d):
    cells = passages(spark, d).select(F.coalesce("company", F.lit("")).alias("company"), F.coalesce("year", F.lit(0)).alias("year")).distinct()
    about = table(spark, d, "indicator_ontology").select("indicator_id", "pillar", F.col("name").alias("indicator_name"), "domain", "subdomain", evidence.fallback_definition(F.col("name"), F.col("name_vi")).alias("definition"))
    return cells.crossJoin(F.broadcast(about))  # firm-years x a dictionary of indicators: one row per cell is the result


def keyword_evidence(spark, d):
    """Evidence rows of every cell from keyword candidates: scores, quality, label, matches, funnel."""
    from docquarry.common import materialise

    done = materialise(evidence.evaluate_candidates(_keyword_candidates(spark, d), ontology_rows(spark, d)))
    rows = evidence.evidence_rows(_grid(spark, d), evidence.select_evidence(done), evidence.funnel_counts(done))
    return rows.select(
        "company", "year", "indicator_id", "score", "disclosure_type", F.round("evidence_quality_score", 2).alias("quality"), "confidence_label", "evidence_quality", "chunk_count", "page_count", "page_numbers",
        F.round("retrieval_score", 4).alias("retrieval_score"), "keyword_score", "structural_score", "matched_units", "merged_candidate_count", "after_relaxed_filter_count", "after_strict_filter_count", "final_candidate_count",
    )


def _evidence(spark, d):
    from docquarry.common import materialise

    done = materialise(_evaluated(spark, d))
    selected = materialise(evidence.select_evidence(done))
    return selected, evidence.evidence_rows(_grid(spark, d), selected, evidence.funnel_counts(done))


def evidence_dataset(spark, d):
    """The evidence dataset in all its columns, with the selected passages of each cell as one text."""
    selected, rows = _evidence(spark, d)
    docs = passages(spark, d).select("chunk_id", "text")
    chosen = selected.select("company", "year", "indicator_id", "chunk_id", "rank", "page", "source_file", F.col("relevance").alias("rerank_score")).join(docs, "chunk_id")
    return evidence.evidence_dataset(rows, evidence.evidence_bundles(chosen, ["company", "year", "indicator_id"]))


def evidence_index(spark, d):
    """The whole path: retrieval, evaluation, calibration, firm-year index."""
    from docquarry.common import materialise
    from docquarry.operators import index, reports

    rows = materialise(reports.calibrate_confidence(_evidence(spark, d)[1]))
    return index.firm_year_index(index.prepare_scores(rows))


def evidence_bundles(spark, d):
    """The three longest pages of every report as one bundle."""
    docs = passages(spark, d).where("text IS NOT NULL").withColumn("length", F.length("text"))
    best = retrieval.top_k(docs, ["source_file"], "length", 3, "rank").withColumns({"rerank_score": F.col("length"), "report": F.col("source_file")})
    out = evidence.evidence_bundles(best, ["report"])
    return out.select("report", F.md5(F.col("evidence").cast("binary")).alias("digest"), F.size("chunk_ids").alias("n_chunks"), F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("page_numbers"))


def evidence_pages(spark, d):
    rows = evidence_bundles(spark, d).select("report", "page_numbers")
    return evidence.explode_pages(rows).select("report", "page")


def ocr_need(spark, d):
    n = F.coalesce(T.count_tokens("text"), F.lit(0))
    r = pages(spark, d).groupBy("source_file").agg(F.count("*").alias("page_count"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars"), F.sum(n).alias("words"))
    return r.select("source_file", "page_count", "chars", "words", T.needs_ocr(F.col("chars"), F.col("words"), F.col("page_count"), least_words=150).alias("needs_ocr"))


def report_records(spark, d):
    """Per report: pages, text length and chunks, as kept in the report cache."""
    n = F.size(chunking.window_starts(F.coalesce(T.count_tokens("text"), F.lit(0)), 650, 100))
    return pages(spark, d).groupBy("source_file").agg(F.count("*").alias("page_count"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("text_length"), F.sum(n).alias("chunk_count"))


def file_names(spark, d):
    """Company and year from report names."""
    from docquarry.sources.readers import company_year

    company, year = company_year(F.regexp_replace("source_file", r"\.[^.]*$", ""))
    return pages(spark, d).select("source_file").distinct().select("source_file", company.alias("company"), year.alias("year"))


NAMES = [
    "normalized_text", "token_counts", "chunk_windows", "chunk_ids", "tokenized", "tokens_with_plain_forms", "folded_names", "split_keywords", "hash_embeddings", "hash_embeddings_md5", "bm25_topk", "bm25_grouped_topk", "term_statistics", "any_year_topk", "keyword_evaluation", "keyword_evidence",
    "dense_topk", "hybrid_rrf", "rerank_fallback", "structural_scores", "candidate_evaluation", "evidence_dataset", "evidence_index", "evidence_bundles", "evidence_pages", "ocr_need", "report_records", "file_names",
]
QUERIES = {n: globals()[n] for n in NAMES}

W = r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NW = W.replace("[", "[^", 1)
TOK = r"[\p{L}\p{N}_\-]+"
_WINDOWS = f"""t AS (SELECT page_key, source_file, page_number, regexp_extract_all(coalesce(text, ''), '{NW}+') AS toks FROM financial_pages),
w AS (SELECT *, unnest(range(0, CAST(1 + greatest(0, ceil((len(toks) - 200) / 160)) AS BIGINT))) AS k FROM t WHERE len(toks) > 0)"""
_BM25 = f"""docs AS (SELECT 'P' || lpad(CAST(page_key AS VARCHAR), 9, '0') AS chunk_id, upper(company) AS company, year, coalesce(regexp_extract_all(lower(text), '{TOK}'), []) AS toks, text FROM financial_pages),
tot AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM docs), posts AS (SELECT chunk_id, company, year, len(toks) AS dl, term, count(*) AS tf FROM (SELECT chunk_id, company, year, toks, unnest(toks) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM posts GROUP BY term), qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest(regexp_extract_all(lower(query), '{TOK}')) AS term FROM q) GROUP BY ALL),
hits AS (SELECT query_id, chunk_id, company, year, sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.5) / (tf + 1.5 * (0.25 + 0.75 * greatest(dl, 1) / avgdl))) AS s FROM qt JOIN df USING (term) JOIN posts USING (term), tot GROUP BY ALL)"""
_Q = "q AS (SELECT indicator_id AS query_id, concat_ws(' ', name, name_vi, array_to_string(positive_keywords, ' ')) AS query FROM indicator_ontology)"
_SIGNED = "(CAST('0x' || substr(md5(t), 1, 6) AS INTEGER) % 64) AS bucket, CASE WHEN substr(md5(t), 7, 1) < '8' THEN 1 ELSE -1 END AS s"
_DENSE = f"""dw AS (SELECT chunk_id, bucket, CAST(sum(s) AS DOUBLE) AS w FROM (SELECT chunk_id, {_SIGNED} FROM (SELECT chunk_id, unnest(toks) AS t FROM docs WHERE text IS NOT NULL)) GROUP BY ALL),
dn AS (SELECT chunk_id, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY chunk_id)) AS w FROM dw QUALIFY sum(w * w) OVER (PARTITION BY chunk_id) > 0),
qw AS (SELECT query_id, bucket, CAST(sum(s) AS DOUBLE) AS w FROM (SELECT query_id, {_SIGNED} FROM (SELECT query_id, unnest(regexp_extract_all(lower(query), '{TOK}')) AS t FROM q)) GROUP BY ALL),
qn AS (SELECT query_id, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY query_id)) AS w FROM qw),
dot AS (SELECT query_id, chunk_id, sum(dn.w * qn.w) AS s FROM dn JOIN qn USING (bucket) GROUP BY ALL)"""
_HYBRID = f"""{_Q}, {_BM25}, b AS (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, chunk_id) AS br FROM hits QUALIFY br <= 20),
{_DENSE},
every AS (SELECT query_id, d.chunk_id, coalesce(s, 0) AS s FROM (SELECT query_id FROM q) CROSS JOIN (SELECT chunk_id FROM docs WHERE text IS NOT NULL) d LEFT JOIN dot USING (query_id, chunk_id)),
e AS (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, chunk_id) AS er FROM every QUALIFY er <= 20),
f AS (SELECT query_id, chunk_id, 1 / (60 + coalesce(br, 21)) + 1 / (60 + coalesce(er, 21)) AS h FROM b FULL JOIN e USING (query_id, chunk_id)),
fused AS (SELECT query_id, chunk_id, h, row_number() OVER (PARTITION BY query_id ORDER BY round(h, 12) DESC, chunk_id) AS hr FROM f QUALIFY hr <= 20)"""
_FROM, _TO = (x.replace("'", "''") for x in T._decomposition(False))


def _plain(c: str) -> str:
    """Accents and compatibility forms undone in DuckDB, d-stroke kept."""
    x = f"regexp_replace(translate({c}, '{_FROM}', '{_TO}'), '\\p{{Mn}}+', '', 'g')"
    for code in range(0xFB00, 0xFB07):
        x = f"replace({x}, chr({code}), '{unicodedata.normalize('NFKD', chr(code))}')"
    return x


_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
_INFORMATIVE = lambda t: f"(list_contains({_LIST(T.INFORMATIVE)}, {t}) OR length({t}) >= 6 OR (regexp_matches({t}, '\\p{{Nd}}') AND regexp_matches({t}, '\\p{{L}}')))"


def _content(c: str) -> str:
    """Content terms in DuckDB."""
    return f"list_filter(regexp_extract_all(lower({_plain(c)}), '{TOK}'), lambda t: NOT list_contains({_LIST(T.STOPWORDS)}, t) AND (length(t) >= 3 OR regexp_full_match(t, '\\p{{Nd}}+') OR {_INFORMATIVE('t')}))"


_case = lambda cond, points: f"CASE WHEN {cond} THEN {points} ELSE 0 END"
_NUMBER, _YEAR = (rf"regexp_matches(x, '(^|[^\p{{L}}\p{{N}}_]){what}')" for what in (r"\p{Nd}", r"20\p{Nd}{2}($|[^\p{L}\p{N}_])"))
_MARKS = r"(regexp_matches(x, '[%|:]') OR contains(x, '\t'))"
_JUDGED = f"""{_Q}, {_BM25}, cand AS (SELECT query_id AS indicator_id, chunk_id, coalesce(company, '') AS company, coalesce(year, 0) AS year FROM hits QUALIFY row_number() OVER (PARTITION BY query_id, coalesce(company, ''), coalesce(year, 0) ORDER BY round(s, 9) DESC, chunk_id) <= 20),
raw AS (SELECT indicator_id, 1 AS g, 1 AS no, name AS phrase, 8 AS w, true AS alone FROM indicator_ontology UNION ALL SELECT indicator_id, 4, 1, name_vi, 8, true FROM indicator_ontology
  UNION ALL SELECT indicator_id, g, no, phrase, 8, g <> 5 FROM (SELECT indicator_id, unnest([2, 3]) AS g, unnest([positive_keywords, positive_keywords]) AS l FROM indicator_ontology UNION ALL SELECT indicator_id, 5, negative_keywords FROM indicator_ontology), LATERAL (SELECT unnest(l) AS phrase, generate_subscripts(l, 1) AS no)
  UNION ALL SELECT indicator_id, 6, generate_subscripts(units, 1), unnest(units), 4, true FROM indicator_ontology),
phrases AS (SELECT * FROM (SELECT indicator_id, g, no, w, alone, {_content('phrase')} AS p FROM raw WHERE phrase IS NOT NULL AND NOT regexp_matches(phrase, '[?\\x{{fffd}}ÄÂ]')) WHERE len(p) > 0),
shown AS (SELECT chunk_id, text, {_content('text')} AS t FROM docs WHERE chunk_id IN (SELECT chunk_id FROM cand)), tj AS (SELECT *, array_to_string(t, ' ') AS j FROM shown),
asked AS (SELECT DISTINCT chunk_id, p, w, alone FROM cand JOIN phrases USING (indicator_id)),
met AS (SELECT a.chunk_id, p, w, alone FROM asked a JOIN tj USING (chunk_id) WHERE CASE WHEN len(p) = 1 THEN alone AND {_INFORMATIVE('p[1]')} AND list_contains(t, p[1]) WHEN contains(j, array_to_string(p, ' ')) THEN true WHEN NOT list_has_all(t, p) THEN false
  ELSE len(list_filter(range(1, len(t) + 1), lambda i: t[i] = p[1] AND list_has_all(t[i:i + w], p[2:]))) > 0 END),
hit AS (SELECT indicator_id, company, year, chunk_id, count(*) FILTER (g = 1) AS hard, count(*) FILTER (g = 2) AS soft, count(*) FILTER (g = 3) AS pos, count(*) FILTER (g = 4) AS alt, count(*) FILTER (g = 5) AS neg, count(*) FILTER (g = 6) AS nu,
  coalesce(list(array_to_string(p, ' ') ORDER BY g, no) FILTER (g <= 4), []) AS lk, coalesce(list(array_to_string(p, ' ') ORDER BY no) FILTER (g = 5), []) AS ln, coalesce(list(array_to_string(p, ' ') ORDER BY no) FILTER (g = 6), []) AS lu
  FROM cand JOIN phrases USING (indicator_id) JOIN met USING (chunk_id, p, w, alone) GROUP BY ALL),
full_ AS (SELECT c.*, coalesce(hard, 0) AS hard, coalesce(soft, 0) AS soft, coalesce(pos, 0) AS pos, coalesce(alt, 0) AS alt, coalesce(neg, 0) AS neg, coalesce(nu, 0) AS nu, coalesce(lk, []) AS lk, coalesce(ln, []) AS ln, coalesce(lu, []) AS lu,
  coalesce(text, '') AS x, o.disclosure_type AS dt FROM cand c LEFT JOIN hit USING (indicator_id, company, year, chunk_id) JOIN tj USING (chunk_id) JOIN indicator_ontology o USING (indicator_id)),
sig AS (SELECT *, {_NUMBER} AS num, hard + soft + pos + alt > 0 AS speaks, least(100.0, hard * 18 + soft * 10 + alt * 5 + nu * 12)::DOUBLE AS keyword_score FROM full_),
sg2 AS (SELECT *, nu > 0 OR (num AND dt = 'quantitative' AND speaks) AS measured, speaks AND dt IN ('policy', 'governance', 'certification') AS worded, speaks OR nu > 0 AS solid, hard = 0 AND nu = 0 AS bare,
  least(100.0, 20.0 + {_case('num', 30)} + {_case('nu > 0', 25)} + {_case(_YEAR, 10)} + {_case(_MARKS, 10)} + {_case('length(x) >= 240', 5)})::DOUBLE AS structural_score FROM sig),
pt AS (SELECT *, round(0.42 * keyword_score + 0.18 * structural_score + {_case('worded', 8)} + {_case('measured', 9)} - least(8 * neg, 24), 6) AS pts FROM sg2),
judged AS (SELECT *, pts >= 12 AND solid AS keep, solid AND pts >= 28 AND NOT (bare AND neg > 0 AND pts < 40) AS strict_keep, greatest(least(pts, 100), 0)::DOUBLE AS relevance FROM pt),
ev AS (SELECT *, CASE WHEN NOT keep THEN 'none' WHEN measured THEN 'quantitative' ELSE 'qualitative' END AS disclosure_type FROM judged)"""
_FIRSTS = lambda c: f"array_to_string(list_filter({c}, lambda q, i: list_position({c}, q) = i), '; ')"
_BUNDLE = f"""p AS (SELECT source_file, 'P' || lpad(CAST(page_key AS VARCHAR), 9, '0') AS chunk_id, page_number AS page, text, length(text) AS len FROM financial_pages WHERE text IS NOT NULL),
best AS (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY len DESC, chunk_id) AS rank, regexp_replace(text, '^{W}+|{W}+$', '', 'g') AS t FROM p QUALIFY rank <= 3),
b AS (SELECT source_file AS report, md5(string_agg('Source: ' || source_file || chr(10) || 'Page: ' || page || chr(10) || 'Chunk ID: ' || chunk_id || chr(10) || 'Reranker score: ' || len || chr(10) || 'Evidence:' || chr(10) || t,
  chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS digest, CAST(count(*) AS INTEGER) AS n_chunks, list(page ORDER BY rank) AS pl FROM best WHERE t <> '' GROUP BY source_file),
bundle AS (SELECT report, digest, n_chunks, array_to_string(list_transform(list_filter(pl, lambda x, i: list_position(pl, x) = i), lambda x: CAST(x AS VARCHAR)), ',') AS page_numbers FROM b)"""

ORACLES = {
    "normalized_text": f"""SELECT page_key, md5(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(0), ' '), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^{W}+|{W}+$', '', 'g')) AS digest FROM financial_pages""",
    "token_counts": f"SELECT page_key, CAST(coalesce(len(regexp_extract_all(text, '{NW}+')), 0) AS INTEGER) AS n_tokens FROM financial_pages",
    "chunk_windows": f"""WITH {_WINDOWS} SELECT page_key, CAST(k + 1 AS INTEGER) AS window_no, CAST(k * 160 AS INTEGER) AS first_token, CAST(least(200, len(toks) - k * 160) AS INTEGER) AS n_tokens,
        md5(array_to_string(toks[k * 160 + 1 : k * 160 + 200], ' ')) AS digest FROM w""",
    "chunk_ids": f"""WITH {_WINDOWS}, n AS (SELECT page_key, source_file, k, row_number() OVER (PARTITION BY source_file ORDER BY page_number, page_key, k) AS r FROM w)
        SELECT page_key, CAST(k + 1 AS INTEGER) AS window_no, coalesce(company, '') || '_' || coalesce(CAST(year AS VARCHAR), 'unknown') || '_' || lpad(CAST(r AS VARCHAR), 6, '0') AS chunk_id FROM n JOIN (SELECT page_key, company, year FROM financial_pages) USING (page_key)""",
    "tokenized": f"SELECT page_key, CAST(coalesce(len(regexp_extract_all(lower(text), '{TOK}')), 0) AS INTEGER) AS n, md5(array_to_string(coalesce(regexp_extract_all(lower(text), '{TOK}'), []), ' ')) AS digest FROM financial_pages",
    "tokens_with_plain_forms": f"""WITH p AS (SELECT page_key, regexp_extract_all(lower(text), '{TOK}') AS t, len({_content('text')}) AS c FROM financial_pages WHERE text IS NOT NULL), w AS (SELECT page_key, unnest(t) AS x FROM p),
        d AS (SELECT x, {_plain('x')} <> x AS two FROM (SELECT DISTINCT x FROM w)), n AS (SELECT page_key, count(*) FILTER (two) AS more FROM w JOIN d USING (x) GROUP BY page_key)
        SELECT page_key, CAST(len(t) + coalesce(more, 0) AS INTEGER) AS n_tokens, CAST(c AS INTEGER) AS n_content_terms FROM p LEFT JOIN n USING (page_key)""",
    "term_statistics": f"WITH {_BM25} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, max(tf) AS most FROM posts GROUP BY term",
    "any_year_topk": f"""WITH q AS (SELECT indicator_id AS query_id, name AS query FROM indicator_ontology), {_BM25}, cells AS (SELECT DISTINCT company, year FROM docs WHERE company IS NOT NULL)
        SELECT query_id, c.company, c.year, chunk_id, round(s, 6) AS bm25_score, CAST(row_number() OVER (PARTITION BY query_id, c.company, c.year ORDER BY round(s, 9) DESC, chunk_id) AS INTEGER) AS bm25_rank
        FROM hits h JOIN cells c ON h.company = c.company AND (c.year IS NULL OR c.year = h.year) QUALIFY bm25_rank <= 3""",
    "keyword_evaluation": f"""WITH {_JUDGED} SELECT indicator_id, company, year, chunk_id, keep, strict_keep, round(relevance, 4) AS relevance, keyword_score, structural_score, disclosure_type, measured AS is_quantitative,
        {_FIRSTS('lk')} AS matched_keywords, {_FIRSTS('ln')} AS matched_negative, {_FIRSTS('lu')} AS matched_units FROM ev""",
    "keyword_evidence": f"""WITH {_JUDGED}, funnel AS (SELECT company, year, indicator_id, count(*) AS merged, count(*) FILTER (keep) AS kept, count(*) FILTER (keep AND strict_keep) AS strict FROM ev GROUP BY ALL),
        best AS (SELECT e.*, page_number AS page, row_number() OVER (PARTITION BY e.company, e.year, indicator_id ORDER BY relevance DESC, chunk_id) AS rank FROM ev e JOIN financial_pages f ON chunk_id = 'P' || lpad(CAST(page_key AS VARCHAR), 9, '0') WHERE keep QUALIFY rank <= 5),
        agg AS (SELECT company, year, indicator_id, count(*) AS n, count(DISTINCT page) AS np, max(relevance) AS r, max(keyword_score) AS k, max(structural_score) AS st, bool_or(measured) AS quant,
        list(CAST(page AS VARCHAR) ORDER BY rank) AS pl, flatten(list(lu ORDER BY rank)) AS us FROM best GROUP BY ALL),
        cells AS (SELECT DISTINCT coalesce(upper(company), '') AS company, coalesce(year, 0) AS year FROM financial_pages),
        j AS (SELECT c.company, c.year, o.indicator_id, coalesce(n, 0) AS n, coalesce(np, 0) AS np, coalesce(r, 0) AS r, coalesce(k, 0) AS k, coalesce(st, 0) AS st, coalesce(quant, false) AS quant, pl, us, coalesce(merged, 0) AS merged, coalesce(kept, 0) AS kept, coalesce(strict, 0) AS strict
        FROM cells c CROSS JOIN indicator_ontology o LEFT JOIN agg a ON a.company = c.company AND a.year = c.year AND a.indicator_id = o.indicator_id LEFT JOIN funnel f ON f.company = c.company AND f.year = c.year AND f.indicator_id = o.indicator_id),
        s AS (SELECT *, CASE WHEN n = 0 THEN 0 WHEN quant THEN 2 ELSE 1 END AS score, 0.4 * r + 0.2 * k + 0.1 * st AS q FROM j)
        SELECT company, year, indicator_id, CAST(score AS INTEGER) AS score, ['none', 'qualitative', 'quantitative'][score + 1] AS disclosure_type, round(round_even(q, 3), 2) AS quality, CASE WHEN q >= 70 THEN 'HIGH_CONFIDENCE' WHEN q >= 40 THEN 'MEDIUM_CONFIDENCE' ELSE 'LOW_CONFIDENCE' END AS confidence_label,
        CASE WHEN n < 2 THEN 'LOW_EVIDENCE' ELSE 'OK' END AS evidence_quality, n AS chunk_count, np AS page_count, array_to_string(list_filter(coalesce(pl, []), lambda x, i: list_position(pl, x) = i), ',') AS page_numbers, round(r, 4) AS retrieval_score, CAST(k AS DOUBLE) AS keyword_score,
        CAST(st AS DOUBLE) AS structural_score, array_to_string(list_filter(coalesce(us, []), lambda x, i: list_position(us, x) = i), '; ') AS matched_units, merged AS merged_candidate_count, kept AS after_relaxed_filter_count, strict AS after_strict_filter_count, least(kept, 5) AS final_candidate_count FROM s""",
    "folded_names": "SELECT indicator_id, alias, trim(regexp_replace(replace(strip_accents(lower(alias)), 'đ', 'd'), '\\s+', ' ', 'g')) AS folded FROM (SELECT indicator_id, unnest(aliases) AS alias FROM financial_indicators)",
    "split_keywords": """WITH r AS (SELECT indicator_id, concat_ws(' ; ', array_to_string(positive_keywords, '|'), name) AS terms FROM indicator_ontology),
        s AS (SELECT indicator_id, terms, list_filter(list_transform(string_split_regex(terms, '[|;]'), lambda x: trim(x)), lambda x: x <> '') AS l FROM r), u AS (SELECT *, list_filter(l, lambda x, i: list_position(l, x) = i) AS d FROM s)
        SELECT indicator_id, CAST(len(d) AS INTEGER) AS n, array_to_string(d, '#') AS terms, regexp_matches(terms, '[?\\x{fffd}ÄÂ]') AS corrupt FROM u""",
    "hash_embeddings_md5": f"""WITH w AS (SELECT page_key, bucket, CAST(sum(s) AS DOUBLE) AS w FROM (SELECT page_key, {_SIGNED} FROM (SELECT page_key, unnest(regexp_extract_all(lower(text), '{TOK}')) AS t FROM financial_pages)) GROUP BY ALL HAVING sum(s) <> 0)
        SELECT page_key, CAST(bucket AS INTEGER) AS bucket, round(w / sqrt(sum(w * w) OVER (PARTITION BY page_key)), 6) AS weight FROM w""",
    "bm25_topk": f"WITH {_Q}, {_BM25} SELECT query_id, chunk_id, round(s, 6) AS bm25_score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, chunk_id) AS INTEGER) AS bm25_rank FROM hits QUALIFY bm25_rank <= 10",
    "bm25_grouped_topk": f"""WITH q AS (SELECT indicator_id AS query_id, name AS query FROM indicator_ontology), {_BM25},
        every AS (SELECT query_id, coalesce(d.company, '') AS company, coalesce(d.year, 0) AS year, d.chunk_id, coalesce(s, 0) AS s FROM (SELECT query_id FROM q) CROSS JOIN docs d LEFT JOIN hits USING (query_id, chunk_id))
        SELECT query_id, company, year, chunk_id, round(s, 6) AS bm25_score, CAST(row_number() OVER (PARTITION BY query_id, company, year ORDER BY round(s, 9) DESC, chunk_id) AS INTEGER) AS bm25_rank FROM every QUALIFY bm25_rank <= 3""",
    "dense_topk": """WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS chunk_id, list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS s FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0 AND q.vec_id <> e.vec_id)
        SELECT query_id, chunk_id, round(s, 6) AS dense_score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, chunk_id) AS INTEGER) AS dense_rank FROM s QUALIFY dense_rank <= 5""",
    "hybrid_rrf": f"WITH {_HYBRID} SELECT query_id, chunk_id, round(h, 8) AS hybrid_score, CAST(hr AS INTEGER) AS hybrid_rank FROM fused",
    "rerank_fallback": f"WITH {_HYBRID} SELECT query_id, chunk_id, round(h, 8) AS rerank_score, CAST(hr AS INTEGER) AS rank, 'hybrid-fallback' AS reranker FROM fused WHERE hr <= 5",
    "structural_scores": r"""WITH p AS (SELECT page_key, coalesce(text, '') AS t FROM financial_pages) SELECT page_key, least(100.0, 20.0 + CASE WHEN regexp_matches(t, '(^|[^\p{L}\p{N}_])\p{Nd}') THEN 30 ELSE 0 END
        + CASE WHEN regexp_matches(t, '(tấn|kWh|đồng)') THEN 25 ELSE 0 END + CASE WHEN regexp_matches(t, '(^|[^\p{L}\p{N}_])20\p{Nd}{2}($|[^\p{L}\p{N}_])') THEN 10 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[%|:]') OR contains(t, '\t') THEN 10 ELSE 0 END + CASE WHEN length(t) >= 240 THEN 5 ELSE 0 END)::DOUBLE AS structural_score FROM p""",
    "evidence_bundles": f"WITH {_BUNDLE} SELECT * FROM bundle",
    "evidence_pages": f"WITH {_BUNDLE} SELECT report, unnest(string_split(page_numbers, ',')) AS page FROM bundle",
    "ocr_need": f"""SELECT source_file, page_count, chars, words, chars < 500 OR words / greatest(page_count, 1) < 150 AS needs_ocr FROM (SELECT source_file, count(*) AS page_count, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS chars,
        CAST(sum(coalesce(len(regexp_extract_all(text, '{NW}+')), 0)) AS BIGINT) AS words FROM financial_pages GROUP BY source_file)""",
    "report_records": f"""SELECT source_file, count(*) AS page_count, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS text_length, CAST(sum(CASE WHEN n > 0 THEN 1 + greatest(0, ceil((n - 650) / 550)) ELSE 0 END) AS BIGINT) AS chunk_count
        FROM (SELECT source_file, text, coalesce(len(regexp_extract_all(text, '{NW}+')), 0) AS n FROM financial_pages) GROUP BY source_file""",
    "file_names": r"""WITH s AS (SELECT DISTINCT source_file, regexp_replace(source_file, '\.[^.]*$', '') AS stem FROM financial_pages)
        SELECT source_file, CASE WHEN regexp_matches(stem, '^(.+?)_(\d{4})$') THEN regexp_extract(stem, '^(.+?)_(\d{4})$', 1) ELSE stem END AS company, CAST(nullif(regexp_extract(stem, '^(.+?)_(\d{4})$', 2), '') AS INTEGER) AS year FROM s""",
}
