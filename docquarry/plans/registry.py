"""All queries of the core library, by name, and the SQL they are checked against."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.common import table


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.operators.quantities import agreeing_facts

    return agreeing_facts(table(spark, d, "financial_facts"), table(spark, d, "financial_indicators"), table(spark, d, "fx_rates"))


def p7_normalised(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.operators.quantities import normalise_facts

    out = normalise_facts(table(spark, d, "financial_facts"), table(spark, d, "financial_indicators"), table(spark, d, "fx_rates"))
    amount = F.when(F.abs("amount") < 1e9, F.round("amount", 4)).otherwise(F.col("amount"))
    return out.select("fact_id", "firm", "year", "indicator_id", amount.alias("amount"), "common_unit", "unit_from", F.round("unit_confidence", 4).alias("unit_confidence"), "status")


def p7_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """The unit classifier on facts whose known unit is hidden from it (ids divisible by 20)."""
    from docquarry.operators.quantities import unit_accuracy

    return unit_accuracy(table(spark, d, "financial_facts"), table(spark, d, "financial_indicators"), table(spark, d, "fx_rates"))


def _amounts_sql() -> str:
    """Common amounts in DuckDB: unit from evidence or column, figure from value or evidence, rates of the year."""
    from docquarry.operators.quantities import UNITS
    from docquarry.plans.queries_financial import _fold
    from docquarry.plans.queries_text import W

    quote = lambda x: x.replace("'", "''")
    units = [(u, k, f) for k, us in UNITS.items() for u, f in us.items()]
    rows = ", ".join(f"('{quote(u)}', '{k}', '{'VND' if k in ('USD', 'EUR') else k}', {float(f)!r}::DOUBLE)" for u, k, f in units)
    ends = r"[^\p{L}\p{N}]"
    pattern = quote(rf"(^|{ends})(" + "|".join(u.replace(".", r"\.") for u, _, _ in sorted(units, key=lambda x: -len(x[0]))) + rf")($|{ends})")
    fold = lambda c: f"translate({_fold(c)}, '²³’‘', '23' || chr(39) || chr(39))"
    figure = r"(^|[^\p{L}\p{N}.,])(\(?-?\d[\d.,]*\d\)?|\(?-?\d\)?)($|[^\p{L}\p{N}])"
    return rf"""u(unit, measure, kind, factor) AS (VALUES {rows}),
    cand AS (SELECT indicator_id, convert_to_vnd, generate_subscripts(unit_candidates, 1) AS no, {fold('unnest(unit_candidates)')} AS unit FROM financial_indicators WHERE indicator_id IS NOT NULL),
    kind AS (SELECT indicator_id, CASE WHEN bool_or(convert_to_vnd) THEN 'VND' ELSE arg_min(kind, no) END AS kind FROM cand JOIN u USING (unit) GROUP BY indicator_id),
    al AS (SELECT indicator_id, {fold('a')} AS a FROM (SELECT indicator_id, unnest(list_append(coalesce(aliases, []), label_vi)) AS a FROM financial_indicators) WHERE a IS NOT NULL AND trim(a) <> ''),
    alias AS (SELECT indicator_id, string_agg(DISTINCT regexp_escape(a), '|' ORDER BY length(regexp_escape(a)) DESC, regexp_escape(a)) AS p FROM al GROUP BY indicator_id),
    f1 AS (SELECT f.*, k.kind, CASE WHEN a.p IS NULL OR k.kind IS NULL THEN {fold('evidence')} ELSE regexp_replace({fold('evidence')}, a.p, ' # ', 'g') END AS said, regexp_replace({fold('unit')}, '^[ .]+|[ .]+$', '', 'g') AS cu
      FROM financial_facts f LEFT JOIN kind k ON f.indicator_id = k.indicator_id LEFT JOIN alias a ON f.indicator_id = a.indicator_id),
    f2 AS (SELECT *, nullif(regexp_extract(said, '{pattern}', 2), '') AS in_text, CASE WHEN cu IN (SELECT unit FROM u) THEN cu WHEN cu || '.' IN (SELECT unit FROM u) THEN cu || '.' END AS in_column,
      regexp_replace(regexp_replace(said, '{pattern}', '\1 \3', 'g'), '{pattern}', '\1 \3', 'g') AS digits FROM f1),
    f3 AS (SELECT f2.*, CASE WHEN t.kind = f2.kind THEN in_text WHEN c.kind = f2.kind THEN in_column END AS un, regexp_extract_all(regexp_replace(digits, '([^\p{{L}}\p{{N}}.,()-])', '\1\1', 'g'), '{figure}', 2)[-1] AS raw
      FROM f2 LEFT JOIN u t ON t.unit = in_text LEFT JOIN u c ON c.unit = in_column),
    f4 AS (SELECT *, regexp_replace(raw, '[ ()+-]', '', 'g') AS s FROM f3),
    f5 AS (SELECT *, CASE WHEN contains(s, '.') AND contains(s, ',') THEN CASE WHEN instr(reverse(s), ',') < instr(reverse(s), '.') THEN replace(replace(s, '.', ''), ',', '.') ELSE replace(s, ',', '') END
      WHEN length(regexp_replace(s, '[^.,]', '', 'g')) > 1 OR regexp_full_match(s, '[1-9]\d{{0,2}}[.,]\d{{3}}') THEN regexp_replace(s, '[.,]', '', 'g') ELSE replace(s, ',', '.') END AS n FROM f4),
    f6 AS (SELECT *, CASE WHEN value IS NOT NULL AND NOT isnan(value) THEN value WHEN regexp_matches(raw, '^ *(\(|-)') THEN -TRY_CAST(n AS DOUBLE) ELSE TRY_CAST(n AS DOUBLE) END AS figure FROM f5),
    fx AS (SELECT currency AS c, year AS y, avg(vnd_per_unit) AS rate FROM fx_rates GROUP BY ALL),
    amounts AS (SELECT f6.*, figure * factor * CASE WHEN measure IN ('USD', 'EUR') THEN rate ELSE 1 END AS amount FROM f6 LEFT JOIN u ON u.unit = un LEFT JOIN fx ON c = measure AND y = year)"""


def _p7_oracles() -> dict[str, str]:
    amounts = _amounts_sql()
    return {
        "p7_normalised": f"""WITH {amounts} SELECT fact_id, firm, year, indicator_id, CASE WHEN abs(amount) < 1e9 THEN round(amount, 4) ELSE amount END AS amount, kind AS common_unit, CASE WHEN un IS NULL THEN NULL WHEN un = in_text THEN 'evidence' ELSE 'column' END AS unit_from,
            CASE WHEN un IS NOT NULL THEN 1.0::DOUBLE END AS unit_confidence, CASE WHEN amount IS NULL THEN 'review' ELSE 'converted' END AS status FROM amounts""",
        "p7_found": f"""WITH {amounts}, ok AS (SELECT fact_id, firm, year, indicator_id, amount FROM amounts WHERE firm IS NOT NULL AND year IS NOT NULL AND indicator_id IS NOT NULL AND amount IS NOT NULL AND NOT isnan(amount))
            SELECT DISTINCT a.fact_id AS fact_id_a, b.fact_id AS fact_id_b FROM ok a JOIN ok b ON a.firm = b.firm AND a.year = b.year AND a.indicator_id = b.indicator_id AND a.fact_id < b.fact_id
            WHERE abs(a.amount - b.amount) <= 0.01 * greatest(abs(a.amount), abs(b.amount)) * (1 + 1e-9)""",
    }


_MODULES = ("queries_scores", "queries_text", "queries_financial", "queries_incremental")


def _all(name: str) -> dict:
    from importlib import import_module

    out: dict = {}
    for module in _MODULES:
        out |= getattr(import_module(f"docquarry.plans.{module}"), name)
    return out


def queries() -> dict:
    return _all("QUERIES") | {"p7_found": p7_found, "p7_normalised": p7_normalised, "p7_accuracy": p7_accuracy}


def oracle_sql() -> dict[str, str]:
    return _all("ORACLES") | _p7_oracles()
