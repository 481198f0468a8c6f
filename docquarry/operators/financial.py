"""Financial pages and facts: page classification, neighbour pages, extraction of figures, validation, quality.

All of it is column expressions and aggregates; dictionaries of patterns and indicators (some dozen entries) are
literals in the plan. Extraction explodes only lines that name an indicator.

Defined results: null texts classify as nothing and yield nothing; ties between page types go to the first type in the
fixed order; a cell of the grid without a value keeps a row with a null value; a null year is a year of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.common import spread
from docquarry.functions.text import fin_normalize, page_suspect, strip_accents, tokenize
from docquarry.operators.ordering import positions, within

#: Accent-free phrases by page type, in the order in which ties are decided.
PAGE_PATTERNS = {
    "balance_sheet": [
        "bang can doi ke toan", "bao cao tinh hinh tai chinh", "tai san ngan han", "tai san dai han", "no phai tra", "von chu so huu", "tong cong tai san", "balance sheet", "statement of financial position",
    ],
    "income_statement": [
        "bao cao ket qua hoat dong kinh doanh", "ket qua hoat dong kinh doanh", "doanh thu thuan", "gia von hang ban", "loi nhuan gop", "loi nhuan sau thue", "income statement", "statement of profit or loss",
    ],
    "cash_flow": [
        "bao cao luu chuyen tien te", "luu chuyen tien thuan", "luu chuyen tien tu hoat dong", "tien va tuong duong tien cuoi nam", "cash flow statement", "statement of cash flows",
    ],
    "notes": ["thuyet minh bao cao tai chinh", "cac khoan phai thu", "hang ton kho", "vay va no thue tai chinh", "notes to the financial statements"],
    "shares_employees": [
        "co phieu dang luu hanh", "co phieu quy", "von dieu le", "nguoi lao dong", "so lao dong", "outstanding shares", "treasury shares", "charter capital", "employees",
    ],
}
#: Factors of money units, accent-free.
MONEY = {"vnd": 1, "dong": 1, "đong": 1, "nghin dong": 10**3, "thousand vnd": 10**3, "trieu dong": 10**6, "million vnd": 10**6, "ty dong": 10**9, "billion vnd": 10**9}
#: Words naming the unit of a statement, tested in this order.
STATEMENT_UNITS = [("nghìn đồng", ["nghin dong"]), ("triệu đồng", ["trieu dong"]), ("tỷ đồng", ["ty dong"]), ("VND", ["vnd", "dong viet nam"])]
NUMBER = r"(?U)(?<!\w)-?\(?\d[\d.,]*\)?"
SHARES, TREASURY, STAFF = "OUTSTANDING_SHARES", "TREASURY_SHARES", "EMPLOYEES"
PAGE_KEY = ["source_file", "page_number", "statement_type"]


def classify_pages(pages: DataFrame, patterns: dict[str, list[str]] = PAGE_PATTERNS, text_col: str = "text") -> DataFrame:
    """The pages with found_type, found_score (patterns present) and found_patterns; a type of '' where nothing fits."""
    plain = fin_normalize(F.coalesce(F.col(text_col), F.lit("")))
    out = spread(pages).withColumn("__plain", plain)
    hits = F.array(*(F.filter(F.array(*map(F.lit, ps)), lambda p: F.contains(F.col("__plain"), p)) for ps in patterns.values()))
    out = out.withColumn("__hits", hits)
    sizes = F.transform("__hits", lambda h: F.size(h))
    best = F.array_max(sizes)
    at = F.array_position(sizes, best).cast("int")
    some = best > 0
    return out.withColumns(
        {
            "found_type": F.when(some, F.element_at(F.array(*map(F.lit, patterns)), at)).otherwise(F.lit("")), "found_score": best,
            "found_patterns": F.when(some, F.array_join(F.element_at("__hits", at), "; ")).otherwise(F.lit("")),
        }
    ).drop("__plain", "__hits")


def expand_neighbours(classified: DataFrame, window: int = 1) -> DataFrame:
    """Detected pages and those up to ``window`` places away in their report; the highest score wins, then the earlier page.

    Places are taken in the order of page number within the report; neighbours meet by an equi-join on the place.
    """
    placed = positions(classified.select("page_key", "source_file", "page_number", "found_type", "found_score", "found_patterns"), ["source_file", "page_number", "page_key"])
    hits = placed.where("found_score > 0").select("source_file", "position", "found_type", "found_score", "found_patterns")
    near = hits.select("*", F.explode(F.sequence(F.col("position") - window, F.col("position") + window)).alias("place"))
    order = F.struct(F.col("found_score"), (-F.col("position")).alias("p"))
    best = near.groupBy("source_file", "place").agg(F.max_by(F.struct("found_type", "found_score", "found_patterns"), order).alias("x"))
    best = best.select(F.col("source_file").alias("__s"), "place", "x.*")
    spots = placed.select("page_key", F.col("source_file").alias("__t"), "position")
    chosen = spots.join(best, spots["__t"].eqNullSafe(best["__s"]) & (spots["position"] == best["place"]))
    chosen = chosen.select("page_key", F.col("found_type").alias("statement_type"), F.col("found_score").alias("detection_score"), F.col("found_patterns").alias("matched_patterns"))
    rest = [c for c in classified.columns if c not in ("found_type", "found_score", "found_patterns", "statement_type", "detection_score", "matched_patterns", "ocr_parse_suspect")]
    out = classified.select(*rest).join(chosen, "page_key")
    return out.withColumn("ocr_parse_suspect", page_suspect(F.trim("text"), F.col("detection_score")))


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One whole row per key, the least in ``order``; an aggregate, no sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(*keys, "__r.*").select(*df.columns)


def detect_financial_pages(pages: DataFrame, window: int = 1, patterns: dict[str, list[str]] = PAGE_PATTERNS) -> DataFrame:
    """Classify, add neighbours, keep one page per (report, page number, type)."""
    return first_per_key(expand_neighbours(classify_pages(pages, patterns), window), PAGE_KEY, F.struct("page_key"))


def merge_ocr_pages(pages: DataFrame, ocr: DataFrame) -> DataFrame:
    """Pages with the text of their latest scan where that is long enough, and scanned pages not yet there.

    ocr: (source_file, page_number, text, seq), seq orders the scans. A scan replaces a text if it has 70 % of its
    length and at least 100 characters. Unclassified scans get the type ``financial_ocr`` and score 1.
    """
    scans = last_per_key(ocr, ["source_file", "page_number"], F.struct("seq"))
    scan = scans.select("source_file", "page_number", F.col("text").alias("__scan"))
    joined = pages.join(scan, ["source_file", "page_number"], "left")
    use = F.col("__scan").isNotNull() & (F.length("__scan") >= F.greatest(F.length(F.coalesce("text", F.lit(""))) * 0.7, F.lit(100.0)))
    replaced = joined.withColumns(
        {"text": F.when(use, F.col("__scan")).otherwise(F.col("text")), "ocr_parse_suspect": F.when(use, page_suspect(F.trim("__scan"), F.col("detection_score"))).otherwise(F.col("ocr_parse_suspect"))}
    ).drop("__scan")
    fresh = classify_pages(scans)
    typed = fresh.withColumns(
        {
            "statement_type": F.when(F.col("found_score") > 0, F.col("found_type")).otherwise("financial_ocr"), "detection_score": F.greatest("found_score", F.lit(1)),
            "matched_patterns": F.when(F.col("found_score") > 0, F.col("found_patterns")).otherwise("targeted_ocr_page"),
        }
    )
    typed = typed.join(pages.select(*PAGE_KEY).distinct(), PAGE_KEY, "left_anti")
    typed = typed.withColumn("ocr_parse_suspect", page_suspect(F.trim("text"), F.col("detection_score")))
    return replaced.unionByName(typed.select(*[c for c in replaced.columns if c in typed.columns]), allowMissingColumns=True)


def ocr_candidates(detected: DataFrame, window: int = 1) -> DataFrame:
    """Page numbers worth scanning again: detected pages and their neighbours, from 1."""
    near = F.explode(F.sequence(F.greatest(F.lit(1), F.col("page_number") - window), F.col("page_number") + window)).alias("page_number")
    return detected.where("page_number IS NOT NULL").select("source_file", near).distinct()


def upsert_pages(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new scans, the new one where both have a page; within a side the higher seq stays."""
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    return last_per_key(both, ["source_file", "page_number"], F.struct("__side", "seq")).drop("__side")


def page_quality(pages: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """Per (company, year): distinct pages, suspect pages, sorted types, chunks."""
    out = pages.groupBy("company", "year").agg(
        F.countDistinct("page_number").alias("financial_pages"), F.sum(F.coalesce(F.col("ocr_parse_suspect").cast("int"), F.lit(0))).alias("suspect_pages"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("statement_type", F.lit("")))), "; ").alias("statement_types"),
    )
    if chunks is None:
        return out
    counts = chunks.groupBy(F.col("company").alias("__c"), F.col("year").alias("__y")).agg(F.count("*").alias("__n"))
    out = out.join(counts, F.col("company").eqNullSafe(F.col("__c")) & F.col("year").eqNullSafe(F.col("__y")), "left")
    return out.withColumn("financial_chunks", F.coalesce("__n", F.lit(0))).drop("__c", "__y", "__n")


def statement_unit(text: Column) -> Column:
    """The money unit stated in the first 1,500 characters, null if none."""
    plain = fin_normalize(F.substring(F.coalesce(text, F.lit("")), 1, 1500))
    out = None
    for unit, needles in STATEMENT_UNITS:
        cond = None
        for n in needles:
            cond = plain.contains(n) if cond is None else cond | plain.contains(n)
        out = F.when(cond, unit) if out is None else out.when(cond, unit)
    return out


def parse_number(raw: Column, unit: Column | None, sign_mode: str = "fixed", plain_unit: Column | None = None) -> Column:
    """The value of a number token; null if it is none.

    Parentheses and a leading minus are negative; with ``sign_mode='compat'`` a leading minus is undone a second time.
    With both separators the last is decimal; in units of billions one separator with up to three digits is decimal;
    otherwise separators group. plain_unit: the folded unit where it is known already.
    """
    text = F.trim(raw)
    negative = text.startswith("-") | (text.startswith("(") & text.endswith(")"))
    body = F.regexp_replace(F.regexp_replace(text, r"^[()]+|[()]+$", ""), r"[^\d.,-]", "")
    digits = F.regexp_replace(body, "-", "")
    comma, dot = F.length(digits) - F.instr(F.reverse(digits), ","), F.length(digits) - F.instr(F.reverse(digits), ".")
    both = digits.contains(",") & digits.contains(".")
    billions = F.coalesce((fin_normalize(unit) if plain_unit is None else plain_unit).isin("ty dong", "billion vnd"), F.lit(False))
    cleaned = (
        F.when(both & (comma > dot), F.regexp_replace(F.regexp_replace(digits, r"\.", ""), ",", "."))
        .when(both, F.regexp_replace(digits, ",", ""))
        .when(billions & digits.rlike(r"^\d+[,.]\d{1,3}$"), F.regexp_replace(digits, ",", "."))
        .otherwise(F.regexp_replace(digits, "[.,]", ""))
    )
    value = F.when(cleaned.rlike(r"^\d+(\.\d*)?$"), cleaned.try_cast("decimal(38,6)"))
    if sign_mode == "compat":
        negative = negative & ~F.regexp_replace(text, r"^\(+", "").startswith("-")
    return F.when(negative, -value).otherwise(value)


def money_factor(unit: Column, folded: bool = False) -> Column:
    """Factor of a money unit; 1 for unknown ones."""
    factors = F.create_map(*(x for name, f in MONEY.items() for x in (F.lit(name), F.lit(f).cast("bigint"))))
    return F.coalesce(factors[unit if folded else fin_normalize(unit)], F.lit(1).cast("bigint"))


def number_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMBER), F.lit(0))


def _indicator_table(spark, indicators: list[dict]) -> DataFrame:
    rows = []
    for r in indicators:
        aliases = [a for a in (r.get("aliases") or [r.get("label_vi")]) if a]
        units = sorted(r.get("unit_candidates") or [], key=len, reverse=True)
        rows.append((r["indicator_id"], r.get("label_vi") or "", r.get("statement_group") or "", aliases, units, bool(r.get("convert_to_vnd"))))
    book = spark.createDataFrame(rows, "indicator_id string, indicator_name string, warehouse_group string, aliases array<string>, units array<string>, to_vnd boolean")
    return book.withColumns({"folded": F.transform("aliases", fin_normalize), "folded_units": F.transform("units", fin_normalize)})


#: Points of the parts of extraction confidence (name, value, unit on the line, line of a table, year on the line).
POINTS = {"name": 0.35, "value": 0.25, "unit": 0.15, "table": 0.20, "year": 0.05}
#: Share of extraction and retrieval in the confidence of a fact; what a fused score counts for.
SHARE, RETRIEVAL_SHARE, RETRIEVAL_FACTOR = 0.75, 0.25, 35
#: Figures that are years, and the least figure that is an amount.
YEARS, LEAST_AMOUNT = (1900, 2099), 1000


def _named_lines(pages: DataFrame, book: DataFrame, keep: list[str]) -> DataFrame:
    """A row per line and indicator it names: line_no, line, plain (folded). A page is folded once, line breaks kept; white
    space is looked at only in lines that name an indicator. A line that recurs on its page comes again with a later number.
    """
    names = [(r["indicator_id"], [f for f in r["folded"] if f]) for r in book.select("indicator_id", "folded").collect()]
    plain = F.regexp_replace(strip_accents(F.lower("text"), fold_d=True), r"(?U)[\s&&[^\n]]+", " ")
    pairs = F.arrays_zip(F.split("text", "\n").alias("line"), F.split(plain, "\n").alias("plain"))
    rows = spread(pages.where("text IS NOT NULL")).select(*keep, statement_unit(F.col("text")).alias("stated"), pairs.alias("__pairs"))  # per page, before its lines
    lines = rows.select(*keep, "stated", F.posexplode("__pairs").alias("line_no", "__x")).select(*keep, "stated", "line_no", "__x.line", F.col("__x")["plain"].alias("plain"))
    shows = lambda fs: reduce(lambda a, b: a | b, (F.col("plain").contains(f) for f in fs), F.lit(False))
    found = lines.select("*", F.explode(F.array_compact(F.array(*(F.when(shows(fs), i) for i, fs in names)))).alias("indicator_id"))
    return found.withColumns({"line": F.regexp_replace("line", r"(?U)^\s+|\s+$", ""), "plain": F.trim("plain")})


def extract_facts(pages: DataFrame, indicators: list[dict], sign_mode: str = "fixed") -> DataFrame:
    """(page_key, firm, year, indicator_id, value, unit, currency, confidence, evidence, ...): the best line of each page.

    A line is a candidate if its folded form contains an alias; since sentences never reach over line breaks, every
    sentence with an alias lies in such a line, so lines decide alone and the method is ``table``.
    """
    book = _indicator_table(pages.sparkSession, indicators)
    about = pages.select("page_key", F.col("company").alias("firm"), F.col("year").alias("report_year"), "source_file", "page_number", "text")
    lines = _named_lines(about, book, ["page_key", "firm", "report_year", "source_file", "page_number"]).join(F.broadcast(book), "indicator_id")
    low = F.lower("line")
    ends = F.filter(F.transform("aliases", lambda a: F.when(F.instr(low, F.lower(a)) > 0, F.instr(low, F.lower(a)) + F.length(a))), lambda x: x.isNotNull())
    plain_ends = F.filter(F.transform("folded", lambda a: F.when(F.instr(F.col("plain"), a) > 0, F.instr(F.col("plain"), a) + F.length(a))), lambda x: x.isNotNull())
    after = F.when(F.size(ends) > 0, F.expr("substring(line, __end)")).when(F.size("__pends") > 0, F.expr("substring(plain, __pends[0])")).otherwise(F.col("line"))
    lines = lines.withColumn("__end", F.coalesce(F.array_min(ends), F.lit(1))).withColumn("__pends", plain_ends).withColumn("__tail", after)
    own = F.filter(F.arrays_zip("units", "folded_units"), lambda u: F.contains(F.col("plain"), u["folded_units"]))
    own = F.when(F.size(own) > 0, F.element_at(own, 1)["units"])
    padded = F.concat(F.lit(" "), F.col("plain"), F.lit(" "))
    has = lambda *ws: reduce(lambda a, b: a | b, (padded.contains(w) for w in ws))
    money = F.when(has("nghin dong", "thousand vnd"), "nghìn đồng").when(has("trieu dong", "million vnd"), "triệu đồng").when(has("ty dong", "billion vnd"), "tỷ đồng").when(has(" vnd ", " dong "), "VND")
    count = F.when(has("co phieu", "shares"), "cổ phiếu").when(has("nguoi", "employees", "persons", "lao dong"), "người")
    spare = F.when(F.col("indicator_id") == STAFF, "người").when(F.col("indicator_id").isin(SHARES, TREASURY), "cổ phiếu").otherwise("VND")
    unit = F.coalesce(F.when(F.col("to_vnd"), F.col("stated")), own, F.when(F.col("to_vnd"), money).otherwise(count), spare)
    lines = lines.withColumn("unit", unit).withColumn("__unit", fin_normalize("unit"))
    factor = F.when(F.col("to_vnd"), money_factor(F.col("__unit"), folded=True)).otherwise(F.lit(1).cast("bigint"))
    lines = lines.withColumn("__factor", factor)
    counts = F.col("indicator_id").isin(SHARES, TREASURY, STAFF)
    parsed = F.filter(F.transform(number_tokens(F.col("__tail")), lambda n: parse_number(n, None, sign_mode, F.col("__unit"))), lambda v: v.isNotNull())
    usable = F.filter(parsed, lambda v: counts | ~(F.abs(v).between(*YEARS) | (F.abs(v) < LEAST_AMOUNT)))
    lines = lines.withColumn("__values", F.transform(usable, lambda v: v.cast("double") * F.col("__factor"))).where(F.size("__values") > 0)
    larger = F.aggregate("__values", F.element_at("__values", 1), lambda a, v: F.when(F.abs(v) > F.abs(a), v).otherwise(a))
    smaller = F.aggregate("__values", F.element_at("__values", 1), lambda a, v: F.when(F.abs(v) < F.abs(a), v).otherwise(a))
    value = F.when(F.col("indicator_id") == TREASURY, smaller).when(F.col("indicator_id").isin(STAFF, SHARES), F.array_max("__values")).otherwise(larger)
    years = F.regexp_extract_all("line", F.lit(r"(?U)\b(20\d{2}|19\d{2})\b"), F.lit(1))
    year = F.when(F.size(years) > 0, F.array_max(years).cast("int"))
    unit_hit = F.contains(F.col("plain"), F.col("__unit"))
    sure = POINTS["name"] + POINTS["value"] + F.when(unit_hit, POINTS["unit"]).otherwise(0.0) + POINTS["table"] + F.when(year.isNotNull(), POINTS["year"]).otherwise(0.0)
    confidence = F.least(F.lit(1.0), F.bround(sure, 4))
    currency = F.when(F.col("to_vnd"), "VND").when(F.col("unit").isin("cổ phiếu", "shares"), "SHARES").when(F.col("unit").isin("người", "employees", "persons"), "PERSONS").when(F.col("plain").contains("usd"), "USD").otherwise("VND")
    facts = lines.select(
        "page_key", "firm", F.coalesce(year, F.col("report_year")).alias("year"), "report_year", "indicator_id", "indicator_name", value.alias("value"), currency.alias("currency"), "unit",
        F.col("source_file").alias("source_report"), F.col("page_number").alias("page"), confidence.alias("confidence"), F.substring("line", 1, 2500).alias("evidence"), F.lit("table").alias("extraction_method"), "warehouse_group", "line_no",
    )
    rest = [c for c in facts.columns if c not in ("page_key", "indicator_id")]
    best = facts.groupBy("page_key", "indicator_id").agg(F.max_by(F.struct(*rest), F.struct("confidence", (-F.col("line_no")).alias("l"))).alias("r"))
    return best.select("page_key", "indicator_id", "r.*").drop("line_no")


def best_facts(facts: DataFrame, retrieval_score: Column | None = None, rank: Column | None = None) -> DataFrame:
    """One fact per (firm, report_year, indicator): extraction and retrieval confidence weighed; on ties the better rank of
    the passage where there is one, else the lower page id."""
    score = F.coalesce(retrieval_score, F.lit(0.0)) if retrieval_score is not None else F.lit(0.0)
    sure = F.least(F.lit(1.0), F.col("confidence") * SHARE + F.least(F.greatest(score * RETRIEVAL_FACTOR, F.lit(0.0)), F.lit(1.0)) * RETRIEVAL_SHARE)
    rows = facts.withColumns({"__sure": sure, "__rank": -rank if rank is not None else F.lit(0)}).withColumn("confidence", F.bround("__sure", 4))
    keys = ["firm", "report_year", "indicator_id"]
    rest = [c for c in facts.columns if c not in keys]
    order = F.struct(F.round("__sure", 9).alias("s"), "__rank", (-F.col("page_key")).alias("k"))
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return out.select(*keys, "r.*")


def statement_warehouse(pages: DataFrame, indicators: DataFrame, dense_k: int = 30, keyword_k: int = 40, dims: int = 1024, digest: str = "blake2b", tokens=None) -> DataFrame:
    """(warehouse_group, company, year, chunk_id, page_key, retrieval_score, financial_rank): the ``keyword_k`` best pages of
    every firm-year for every statement group, by reciprocal ranks of one keyword and one dense search per group.

    One search serves all indicators of a group. pages: (page_key, company, year, text, ...). A firm-year without pages
    has no rows; a page that one search does not find counts as ranked behind its last one. tokens: how a column becomes
    terms, by default with accent-free forms.
    """
    from docquarry.functions.text import embed_batch, hash_embed
    from docquarry.operators import retrieval as R

    groups = ("company", "year")
    docs = pages.where("text IS NOT NULL").select(F.format_string("P%020d", F.col("page_key")).alias("chunk_id"), "page_key", *groups, "text")
    asked = group_queries(indicators).select(F.col("statement_group").alias("query_id"), "query")
    split = tokens or tokenize
    terms = R.query_terms(asked, tokens=split("query"))
    keyword = R.bm25_top_k(R.build_index(docs, groups=groups, tokens=split("text"), terms=terms), terms, keyword_k, groups)
    rows = asked.collect()  # statement groups: a handful
    vectors = embed_batch([r["query"] for r in rows], dims, digest)
    embedded = spread(docs.select("chunk_id", *groups, "text")).select("chunk_id", *groups, hash_embed("text", dims, digest).alias("embedding"))
    dense = R.dense_top_k(embedded, [(r["query_id"], v.tolist()) for r, v in zip(rows, vectors)], dense_k, groups)
    fused = R.fuse(keyword, dense, keyword_k, groups)
    return fused.select(
        F.col("query_id").alias("warehouse_group"), *groups, "chunk_id", F.expr("CAST(substring(chunk_id, 2) AS BIGINT)").alias("page_key"), F.col("hybrid_score").alias("retrieval_score"), F.col("hybrid_rank").alias("financial_rank")
    )


def warehouse_facts(pages: DataFrame, warehouse: DataFrame, indicators: list[dict], top_k: int = 8, sign_mode: str = "fixed") -> DataFrame:
    """The best fact of every (firm, year, indicator) among the ``top_k`` first pages of its statement group.

    Pages no group chose are left out before extraction; facts of a page count only for groups that chose it.
    """
    chosen = warehouse.where(F.col("financial_rank") <= top_k)
    wanted = pages.join(chosen.select("page_key").distinct(), "page_key", "left_semi")
    facts = extract_facts(wanted, indicators, sign_mode)
    facts = facts.join(chosen.select("warehouse_group", "page_key", "retrieval_score", "financial_rank"), ["warehouse_group", "page_key"])
    return best_facts(facts, F.col("retrieval_score"), F.col("financial_rank"))


def fact_grid(facts: DataFrame, firm_years: DataFrame, indicators: list[dict]) -> DataFrame:
    """A row per (firm, year) and indicator: the fact, or a row without value and with confidence 0."""
    book = _indicator_table(facts.sparkSession, indicators)
    grid = firm_years.select("firm", F.col("year").alias("report_year")).distinct().crossJoin(F.broadcast(book.select("indicator_id", "indicator_name", "warehouse_group", "to_vnd")))
    f = facts.drop("indicator_name", "warehouse_group").withColumnsRenamed({"firm": "__f", "report_year": "__y", "indicator_id": "__i"})
    out = grid.join(f, F.col("firm").eqNullSafe(F.col("__f")) & F.col("report_year").eqNullSafe(F.col("__y")) & (F.col("indicator_id") == F.col("__i")), "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return out.select(
        "firm", F.coalesce("year", "report_year").alias("year"), "report_year", "indicator_id", "indicator_name", "value", F.coalesce("currency", F.when(F.col("to_vnd"), "VND").otherwise("")).alias("currency"),
        *(text(c) for c in ("unit", "source_report", "page")), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), text("evidence"), F.coalesce("extraction_method", F.lit("none")).alias("extraction_method"), "warehouse_group",
    )


#: Words that open the search text of a statement group; any other group opens with its own name.
GROUP_WORDS = {
    "balance_sheet": "bảng cân đối kế toán balance sheet tài sản nợ phải trả vốn chủ sở hữu",
    "income_statement": "báo cáo kết quả hoạt động kinh doanh income statement doanh thu lợi nhuận chi phí",
    "shares": "cổ phiếu đang lưu hành cổ phiếu quỹ outstanding shares treasury shares",
    "employees": "lao động nhân viên chi phí đào tạo employees training expense",
}


def group_queries(indicators: DataFrame) -> DataFrame:
    """One search text per statement group: its words, then labels, aliases and queries of its members in id order."""
    one = F.concat_ws(" ", "label_vi", F.array_join("aliases", " "), F.array_join("retrieval_queries", " "))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("indicator_id", one.alias("t")))), lambda x: x["t"])
    head = F.coalesce(*(F.when(F.col("statement_group") == g, words) for g, words in GROUP_WORDS.items()), F.col("statement_group"))
    return indicators.groupBy("statement_group").agg(F.array_join(parts, " ").alias("__parts")).select("statement_group", F.concat_ws(" ", head, "__parts").alias("query"))


def validate_facts(facts: DataFrame, at_least: list[tuple[str, str]], nonnegative: list[str]) -> DataFrame:
    """(firm, year, rule, status): PASS, FAIL or SKIP (a value is missing) for every firm-year and rule.

    The wide row per firm-year holds only the indicators the rules name.
    """
    used = sorted({x for pair in at_least for x in pair} | set(nonnegative))
    wide = facts.where(F.col("firm").isNotNull() & F.col("year").isNotNull()).groupBy("firm", "year")
    wide = wide.agg(*(F.min_by(F.when(F.col("indicator_id") == i, F.col("value")), F.when((F.col("indicator_id") == i) & F.col("value").isNotNull(), F.col("fact_id"))).alias(i) for i in used))
    status = lambda ok, *cs: F.when(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in cs)), "SKIP").when(ok, "PASS").otherwise("FAIL")
    rules = [F.struct(F.lit(f"{a}_GTE_{b}").alias("rule"), status(F.col(a) >= F.col(b), a, b).alias("status")) for a, b in at_least]
    rules += [F.struct(F.lit(f"{a}_NONNEGATIVE").alias("rule"), status(F.col(a) >= 0, a).alias("status")) for a in nonnegative]
    return wide.select("firm", "year", F.explode(F.array(*rules)).alias("r")).select("firm", "year", "r.rule", "r.status")


def attach_flags(facts: DataFrame, validation: DataFrame) -> DataFrame:
    """validation_flag of every fact: the failed rules of its firm-year, by name, joined; '' without any."""
    bad = validation.where("status = 'FAIL'").groupBy(F.col("firm").alias("__f"), F.col("year").alias("__y")).agg(F.array_join(F.array_sort(F.collect_set("rule")), "; ").alias("__flag"))
    out = facts.drop("validation_flag").join(bad, (F.col("firm") == F.col("__f")) & (F.col("year") == F.col("__y")), "left")
    return out.withColumn("validation_flag", F.coalesce("__flag", F.lit(""))).drop("__f", "__y", "__flag")


def anomaly_flags(flag: Column, value: Column, currency: Column, indicator: Column, shares: list[str] = (SHARES, TREASURY), staff: list[str] = (STAFF,)) -> Column:
    """The flag with marks for implausibly large values, each once."""
    old = F.filter(F.transform(F.split(F.coalesce(flag, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    size = F.abs(value)
    new = F.array_compact(
        F.array(
            F.when((currency == "VND") & (size > 1e18), "EXTREME_VND_VALUE"), F.when(indicator.isin(list(shares)) & (size > 1e11), "EXTREME_SHARE_COUNT"),
            F.when(indicator.isin(list(staff)) & (size > 1e7), "EXTREME_EMPLOYEE_COUNT"),
        )
    )
    return F.array_join(F.array_distinct(F.concat(old, new)), "; ")


def coerce_facts(facts: DataFrame) -> DataFrame:
    """Text columns without nulls, numbers cast or null, flags without nulls."""
    text = ("firm", "indicator_id", "indicator_name", "currency", "unit", "source_report", "page", "evidence", "extraction_method", "warehouse_group", "validation_flag")
    cols = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text if c in facts.columns}
    cols |= {c: F.col(c).try_cast("double") for c in ("value", "confidence", "retrieval_score") if c in facts.columns}
    cols |= {c: F.coalesce(F.col(c).try_cast("boolean"), F.lit(False)) for c in ("cache_hit", "warehouse_hit") if c in facts.columns}
    return facts.withColumns(cols).withColumn("year", F.col("year").try_cast("int"))


def fact_quality(facts: DataFrame, validation: DataFrame, digits: int = 4) -> DataFrame:
    """Per indicator: rows, extracted values, mean confidence, table rows, coverage, hit rates; a row per failed rule below."""
    rate = lambda c: F.bround(F.avg(F.col(c).cast("double")), 6).alias(f"{c}_rate")
    out = facts.groupBy("indicator_id").agg(
        F.count("*").alias("observations"), F.count("value").alias("extracted"), F.bround(F.avg("confidence"), digits).alias("avg_confidence"), F.count_if(F.col("extraction_method") == "table").alias("table_extractions"),
        F.bround(F.count("value") / F.count("*"), digits).alias("coverage"), rate("cache_hit"), rate("warehouse_hit"),
    )
    failed = validation.where("status = 'FAIL'").groupBy("rule").agg(F.count("*").alias("failed_count"))
    total = facts.agg(F.count("*").alias("observations"))
    failed = failed.crossJoin(F.broadcast(total)).select(F.lit("VALIDATION").alias("indicator_id"), "observations", "rule", "failed_count")
    return out.unionByName(failed, allowMissingColumns=True)


def null_diagnosis(facts: DataFrame, pages: DataFrame, indicators: list[dict]) -> DataFrame:
    """Why a fact has no value, from the pages of its firm-year.

    Per page only the ids of the indicators it names are kept; they are united per firm-year, so no text is gathered.
    """
    spark = facts.sparkSession
    names = _indicator_table(spark, indicators).select(F.col("indicator_id").alias("i"), F.explode("folded").alias("f")).where("f <> ''").collect()
    plain = spread(pages).select(F.col("company").alias("__f"), F.col("year").alias("__y"), fin_normalize(F.coalesce("text", F.lit(""))).alias("p"))
    seen = F.array_distinct(F.array_compact(F.array(*(F.when(F.col("p").contains(r["f"]), r["i"]) for r in names))))
    firm = plain.where("p <> ''").select("__f", "__y", F.explode_outer(seen).alias("i")).groupBy("__f", "__y").agg(F.collect_set("i").alias("__seen"))
    known = [r["indicator_id"] for r in indicators]
    out = facts.join(firm, (F.col("firm") == F.col("__f")) & (F.col("year") == F.col("__y")), "left")
    present = F.coalesce(F.array_contains("__seen", F.col("indicator_id")), F.lit(False)) & F.col("indicator_id").isin(known)
    reason = (
        F.when(~F.coalesce(F.col("indicator_id").isin(known), F.lit(False)), "unknown_indicator").when(F.col("value").isNotNull(), "extracted").when(F.col("__seen").isNull(), "no_financial_pages_detected")
        .when(present, "alias_present_but_number_not_extracted").otherwise("alias_absent_from_financial_pages")
    )
    return out.select("fact_id", "firm", "year", "indicator_id", F.col("value").isNotNull().alias("value_present"), present.alias("alias_present"), reason.alias("null_reason"))


def number_within(df: DataFrame, group: list[str], order: list[str], out: str = "number") -> DataFrame:
    """A counter from 1 within groups, in a total order that starts with the group."""
    placed = positions(df, [*group, *order], "__at")
    return within(placed, group, "__at", "__n").withColumn(out, F.col("__n") + 1).drop("__at", "__n")
