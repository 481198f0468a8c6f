"""One common unit per kind of quantity, whatever unit and notation a fact was recorded in.

A unit stated in the evidence prevails over the unit column. Rows with neither get their unit from a random forest over
magnitude, currency, category, source format and neighbouring rows (the same firm's known amounts); its confidence is
calibrated by isotonic regression on held-out rows, confident assignments are converted, the rest goes to review.

Parsing, conversion and features are column expressions; only the fit sees a sample, of at most ``SAMPLE`` rows.

Defined results: a row whose figure or unit stays unknown, whose rate is missing or whose indicator is not listed has
a null amount and status ``review``; an empty table gives an empty result; repeated rows are rows of their own; ties
between amounts are equal amounts; extra columns are kept by ``normalise_facts``, except where their names start with
two underscores.
"""

from __future__ import annotations

import re
import unicodedata
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.common import materialise, small
from docquarry.operators.pairs import EXPAND

SAMPLE, CONFIDENT = 40_000, 0.9
#: Units without case and accents, by kind of quantity, with their factor to the common unit of the kind.
UNITS = {
    "VND": {"vnd": 1, "dong": 1, "nghin dong": 1e3, "ngan dong": 1e3, "'000 vnd": 1e3, "thousand vnd": 1e3, "trieu dong": 1e6, "tr.d": 1e6, "million vnd": 1e6, "vnd mn": 1e6,
            "ty dong": 1e9, "ti dong": 1e9, "billion vnd": 1e9, "vnd bn": 1e9},
    "USD": {"usd": 1, "nghin usd": 1e3, "ngan usd": 1e3, "thousand usd": 1e3, "trieu usd": 1e6, "million usd": 1e6},
    "EUR": {"eur": 1, "nghin eur": 1e3, "thousand eur": 1e3, "trieu eur": 1e6, "million eur": 1e6},
    "shares": {"co phieu": 1, "co phan": 1, "shares": 1, "nghin co phieu": 1e3, "ngan co phieu": 1e3, "thousand shares": 1e3, "trieu co phieu": 1e6, "million shares": 1e6},
    "persons": {"nguoi": 1, "persons": 1, "nghin nguoi": 1e3, "ngan nguoi": 1e3, "thousand persons": 1e3},
    "GJ": {"kwh": 0.0036, "mwh": 3.6, "gwh": 3600.0, "gj": 1, "tj": 1e3, "trieu kwh": 3600.0},
    "tCO2e": {"tco2e": 1, "kg co2e": 1e-3, "kt co2e": 1e3, "nghin tan co2e": 1e3, "ngan tan co2e": 1e3, "tan co2e": 1, "tan co2 tuong duong": 1, "nghin tan co2 tuong duong": 1e3},
    "m3": {"m3": 1, "lit": 1e-3, "nghin m3": 1e3, "ngan m3": 1e3, "ml": 1e3, "trieu m3": 1e6},
}
_OF_UNIT = {unit: (kind, float(factor)) for kind, units in UNITS.items() for unit, factor in units.items()}


def _fold_table() -> tuple[str, str]:
    """Latin letters with accents and the plain letter they carry, by their decomposition; superscript digits likewise."""
    pairs = {"đ": "d", "’": "'", "‘": "'", "\xa0": " "}
    for code in (*range(0xB2, 0x250), *range(0x1E00, 0x1F00), *range(0x2070, 0x208A)):
        plain = unicodedata.normalize("NFKD", chr(code).lower())[:1]
        if plain.isascii() and plain.isalnum() and plain != chr(code):
            pairs[chr(code)] = plain
    return "".join(pairs), "".join(pairs.values())


def folded(c: Column) -> Column:
    """Lower case, without accents, single blanks: the form in which units and names are compared."""
    source, target = _fold_table()
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(F.lower(c), r"\p{M}+", ""), source, target), r"(?U)\s+", " "))


def _fold(text: str) -> str:
    """The same on the driver, for dictionary entries."""
    source, target = _fold_table()
    plain = "".join(x for x in text.lower().translate(str.maketrans(source, target)) if not unicodedata.combining(x))
    return " ".join(plain.split())


def _unit_pattern(units: list[str]) -> str:
    return r"(?<![\p{L}\p{N}])(" + "|".join(re.escape(u).replace("\\ ", " ") for u in sorted(units, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"


def parse_figure(c: Column) -> Column:
    """The value of a figure in either notation: the last of two different separators is decimal, a repeated one groups,
    a single one groups if exactly three digits follow one to three others that are not 0; parentheses are negative."""
    s = F.regexp_replace(c, r"[\s()+-]", "")
    dots, commas = F.length(F.regexp_replace(s, "[^.]", "")), F.length(F.regexp_replace(s, "[^,]", ""))
    decimal_comma = F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", ".")
    decimal_dot = F.regexp_replace(s, ",", "")
    grouped = F.regexp_replace(s, "[.,]", "")
    plain = (
        F.when((dots > 0) & (commas > 0), F.when(F.instr(F.reverse(s), ",") < F.instr(F.reverse(s), "."), decimal_comma).otherwise(decimal_dot))
        .when(dots + commas > 1, grouped)
        .when(s.rlike(r"^[1-9]\d{0,2}[.,]\d{3}$"), grouped)
        .otherwise(F.regexp_replace(s, ",", "."))
    )
    number = plain.try_cast("double")
    return F.when(c.rlike(r"^\s*(\(|-)"), -number).otherwise(number)


def _stated(facts: DataFrame, indicators: DataFrame, rates: DataFrame) -> DataFrame:
    """Facts with __figure, __kind, __unit (stated in evidence or column), __factor, __amount in the common unit."""
    listed = indicators.where("indicator_id IS NOT NULL").dropDuplicates(["indicator_id"]).collect()
    kinds, names = {}, {}
    for r in listed:
        found = [_OF_UNIT[_fold(u)][0] for u in r["unit_candidates"] or () if u and _fold(u) in _OF_UNIT]
        kinds[r["indicator_id"]] = ("VND" if r["convert_to_vnd"] or found[0] in ("VND", "USD", "EUR") else found[0]) if found else None
        names[r["indicator_id"]] = sorted({_fold(x) for x in [*(r["aliases"] or ()), r["label_vi"]] if x and x.strip()}, key=len, reverse=True)
    spark = facts.sparkSession
    rows = [(i, k, "|".join(re.escape(x).replace("\\ ", " ") for x in names[i]) or "(?!)") for i, k in kinds.items() if k]
    about = spark.createDataFrame(rows, "indicator_id string, __kind string, __alias string")
    by_unit = spark.createDataFrame([(u, k, f) for u, (k, f) in _OF_UNIT.items()], "__unit string, __measure string, __factor double")
    out = facts.join(F.broadcast(about), "indicator_id", "left")  # one row per listed indicator
    said = folded(F.coalesce("evidence", F.lit("")))
    out = out.withColumn("__said", said)
    out = out.withColumn("__said", F.when(F.col("__alias").isNull(), F.col("__said")).otherwise(F.regexp_replace("__said", F.col("__alias"), F.lit(" # "))))
    every = _unit_pattern(list(_OF_UNIT))
    in_text = F.nullif(F.regexp_extract("__said", every, 1), F.lit(""))
    column = F.regexp_replace(folded(F.coalesce("unit", F.lit(""))), r"^[\s.]+|[\s.]+$", "")
    column = F.when(column.isin(list(_OF_UNIT)), column).when(F.concat(column, F.lit(".")).isin(list(_OF_UNIT)), F.concat(column, F.lit(".")))
    out = out.withColumns({"__in_text": in_text, "__in_column": column})
    group = F.create_map(*(F.lit(x) for u, (k, _) in _OF_UNIT.items() for x in (u, "VND" if k in ("VND", "USD", "EUR") else k)))
    ok = lambda c: F.when(group[F.col(c)] == F.col("__kind"), F.col(c))
    out = out.withColumn("__unit", F.coalesce(ok("__in_text"), ok("__in_column")))
    digits = F.regexp_replace("__said", every, " ")
    figures = F.regexp_extract_all(digits, F.lit(r"(?<![\p{L}\p{N}.,])(\(?-?\d[\d.,]*\d\)?|\(?-?\d\)?)(?![\p{L}\p{N}])"), F.lit(1))
    last = F.when(F.size(figures) > 0, F.element_at(figures, -1))
    out = out.withColumn("__figure", F.coalesce(F.when(~F.isnan("value"), F.col("value")), parse_figure(last)))
    out = out.join(F.broadcast(by_unit), "__unit", "left")
    fx = rates.groupBy(F.col("currency").alias("__measure"), F.col("year").alias("__fx_year")).agg(F.avg("vnd_per_unit").alias("__rate"))
    fx = small(fx)
    out = out.join(fx, (out["__measure"] == fx["__measure"]) & (out["year"] == fx["__fx_year"]), "left").drop(fx["__measure"])
    rate = F.when(F.col("__measure").isin("USD", "EUR"), F.col("__rate")).otherwise(F.lit(1.0))
    return out.withColumn("__amount", F.col("__figure") * F.col("__factor") * rate).drop("__fx_year")


#: Features of the classifier; each is a number that may be missing.
_NUMBERS = ["__mag", "__near_year", "__near_firm", "__near_all", "__whole", "__money", "__table"]


def _features(stated: DataFrame) -> DataFrame:
    """Magnitude, neighbouring amounts (leaving the row itself out) and source fields of every row."""
    known = F.when(F.col("__amount").isNotNull() & (F.col("__amount") != 0), F.log10(F.abs("__amount")))
    out = stated.withColumns({"__log": known, "__mag": F.when(F.col("__figure") != 0, F.log10(F.abs("__figure")))})

    def others(keys: list[str], name: str) -> DataFrame:
        # Sums per key are combined map-side; a key holding a third of all rows costs one row per task.
        return out.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.sum("__log").alias(f"{name}_s"), F.count("__log").alias(f"{name}_n"))

    full = out
    for keys, name in ((["firm", "year", "indicator_id"], "__near_year"), (["firm", "indicator_id"], "__near_firm"), (["indicator_id"], "__near_all")):
        sums = others(keys, name)
        cond = [full[k].eqNullSafe(sums[f"__k{i}"]) for i, k in enumerate(keys)]
        full = full.join(small(sums) if len(keys) == 1 else sums, cond, "left").drop(*(f"__k{i}" for i in range(len(keys))))
        own = F.when(F.col("__log").isNotNull(), 1).otherwise(0)
        mean = (F.col(f"{name}_s") - F.coalesce("__log", F.lit(0.0))) / F.nullif(F.col(f"{name}_n") - own, F.lit(0))
        full = full.withColumn(name, mean - F.col("__mag")).drop(f"{name}_s", f"{name}_n")
    return full.withColumns(
        {
            "__whole": (F.col("__figure") == F.floor("__figure")).cast("double"),
            "__money": F.when(F.col("currency") == "USD", 1.0).when(F.col("currency") == "EUR", 2.0).when(F.col("currency") == "VND", 0.0).otherwise(-1.0),
            "__table": (F.col("extraction_method") == "table").cast("double"),
        }
    )


def _predict(rows: DataFrame, sample: int, trees: int = 40, depth: int = 10) -> DataFrame:
    """(fact id, unit class, calibrated confidence) of the rows without a stated unit."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    empty = rows.select("fact_id", F.lit(None).cast("string").alias("__label"), F.lit(None).cast("double").alias("__confidence")).limit(0)
    label = F.concat_ws(":", "__measure", F.col("__factor").cast("string"))
    if not rows.where("__unit IS NULL AND __kind IS NOT NULL AND __figure <> 0").limit(1).count():
        return empty
    rows = materialise(_features(rows))
    lean = rows.where(F.col("__mag").isNotNull() & F.col("__kind").isNotNull()).select(
        "fact_id", "__kind", "indicator_id", *(F.coalesce(F.col(c), F.lit(-99.0)).alias(c) for c in _NUMBERS), F.when(F.col("__unit").isNotNull(), label).alias("__label")
    )
    known = lean.where("__label IS NOT NULL").orderBy(F.xxhash64("fact_id"), "fact_id").limit(sample)
    known = materialise(known)
    if known.select("__label").distinct().limit(2).count() < 2:
        return empty
    held = F.pmod(F.xxhash64("fact_id", F.lit(7)), F.lit(4)) == 0
    fit, test = known.where(~held), known.where(held)
    stages = [
        StringIndexer(inputCol="indicator_id", outputCol="__cat", handleInvalid="keep"),
        StringIndexer(inputCol="__label", outputCol="__y", handleInvalid="skip", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=["__cat", *_NUMBERS], outputCol="__x"),
    ]
    prepared = Pipeline(stages=stages).fit(fit)
    labels = prepared.stages[1].labels
    places = prepared.stages[0].labels
    forest = RandomForestClassifier(featuresCol="__x", labelCol="__y", numTrees=trees, maxDepth=depth, maxBins=max(64, len(places) + 2), seed=11)
    model = forest.fit(prepared.transform(fit).select("__x", "__y").repartition(4))
    shape = Pipeline(stages=[prepared.stages[0], prepared.stages[2]]).fit(fit)

    def scored(df: DataFrame) -> DataFrame:
        p = vector_to_array(F.col("probability"))
        out = model.transform(shape.transform(df))
        # Classes of another kind of quantity than the indicator's are impossible.
        kind_of = F.array(*(F.lit("VND" if x.split(":")[0] in ("USD", "EUR") else x.split(":")[0]) for x in labels))
        fair = F.zip_with(p, kind_of, lambda a, k: F.when(k == F.col("__kind"), a).otherwise(F.lit(0.0)))
        return out.withColumns({"__fair": fair}).withColumns({"__top": F.array_max("__fair") / F.greatest(F.aggregate("__fair", F.lit(0.0), lambda a, b: a + b), F.lit(1e-9)), "__guess": F.element_at(F.array(*map(F.lit, labels)), F.array_position("__fair", F.array_max("__fair")).cast("int"))})

    checked = scored(test).select(F.col("__top").alias("__score"), (F.col("__guess") == F.col("__label")).cast("double").alias("__right"))
    new = scored(lean.where("__label IS NULL")).select("fact_id", F.col("__guess").alias("__label"), F.col("__top").alias("__score"))
    if not test.limit(1).count():
        return new.select("fact_id", "__label", F.col("__score").alias("__confidence"))
    iso = IsotonicRegression(featuresCol="__score", labelCol="__right", predictionCol="__confidence").fit(checked)
    return iso.transform(new).select("fact_id", "__label", "__confidence")


_NEEDED = ["fact_id", "firm", "year", "indicator_id", "currency", "extraction_method"]
_MADE = ["__figure", "__kind", "__unit", "__measure", "__factor", "__amount", "__in_text"]


def normalise_facts(facts: DataFrame, indicators: DataFrame, rates: DataFrame, confident: float = CONFIDENT, sample: int = SAMPLE, keep: list[str] | None = None) -> DataFrame:
    """The facts with amount, common_unit, unit_from (evidence, column, predicted), unit_confidence and status.

    keep: the columns of the facts to carry on, all of them by default.
    """
    names = facts.columns if keep is None else keep
    rows = materialise(_stated(facts, indicators, rates).select(*(F.col(f"`{c}`") for c in dict.fromkeys([*names, *_NEEDED, *_MADE]))))
    guess = _predict(rows, sample)
    split = F.split("__label", ":")
    fx = rates.groupBy(F.col("currency").alias("__m2"), F.col("year").alias("__y")).agg(F.avg("vnd_per_unit").alias("__r"))
    guess = guess.groupBy("fact_id").agg(F.first("__label").alias("__label"), F.max("__confidence").alias("__confidence"))
    guess = guess.select("fact_id", split[0].alias("__m"), split[1].cast("double").alias("__f"), "__confidence")
    out = rows.join(guess, "fact_id", "left")
    out = out.join(small(fx), (F.col("__m") == F.col("__m2")) & (F.col("year") == F.col("__y")), "left")
    rate = F.when(F.col("__m").isin("USD", "EUR"), F.col("__r")).otherwise(F.lit(1.0))
    sure = F.col("__unit").isNull() & (F.col("__confidence") >= confident)
    amount = F.when(F.col("__unit").isNotNull(), F.col("__amount")).when(sure, F.col("__figure") * F.col("__f") * rate)
    origin = F.when(F.col("__unit").isNull(), F.when(sure, "predicted")).when(F.col("__unit") == F.col("__in_text"), "evidence").otherwise("column")
    out = out.withColumns({"__final": amount, "__from": origin})
    return out.select(
        *(F.col(f"`{c}`") for c in names), F.col("__final").alias("amount"), F.col("__kind").alias("common_unit"), F.col("__from").alias("unit_from"),
        F.when(F.col("__unit").isNotNull(), 1.0).otherwise(F.col("__confidence")).alias("unit_confidence"), F.when(F.col("__final").isNull(), "review").otherwise("converted").alias("status"),
    )


def unit_accuracy(facts: DataFrame, indicators: DataFrame, rates: DataFrame, every: int = 20, confident: float = CONFIDENT, sample: int = SAMPLE) -> DataFrame:
    """How well the classifier finds units that are known but hidden from it: those of the facts whose id is divisible by
    ``every``. Per kind of quantity: hidden, converted (confidence of at least ``confident``), right among the converted,
    right among all, accuracy of the converted, share sent to review. Kinds without hidden facts have no row.
    """
    rows = materialise(_stated(facts, indicators, rates).select(*_NEEDED, *_MADE))
    known = F.col("__unit").isNotNull() & F.col("__kind").isNotNull() & (F.col("__figure") != 0)
    hide = known & (F.pmod("fact_id", F.lit(every)) == 0)
    truth = rows.where(hide).select("fact_id", "__kind", F.concat_ws(":", "__measure", F.col("__factor").cast("string")).alias("__true")).dropDuplicates(["fact_id"])
    blind = rows.withColumns({c: F.when(~F.coalesce(hide, F.lit(False)), F.col(c)) for c in ("__unit", "__measure", "__factor", "__amount")})
    guess = _predict(blind, sample).groupBy("fact_id").agg(F.first("__label").alias("__label"), F.max("__confidence").alias("__confidence"))
    out = truth.join(guess, "fact_id", "left")
    right, sure = F.coalesce(F.col("__label") == F.col("__true"), F.lit(False)), F.coalesce(F.col("__confidence") >= confident, F.lit(False))
    out = out.groupBy(F.col("__kind").alias("common_unit")).agg(F.count("*").alias("hidden"), F.count_if(sure).alias("converted"), F.count_if(sure & right).alias("converted_right"), F.count_if(right).alias("all_right"))
    ratio = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 4)
    return out.select("*", ratio("converted_right", "converted").alias("accuracy"), F.round(1 - F.col("converted") / F.col("hidden"), 4).alias("review_share"))


def agreeing_facts(facts: DataFrame, indicators: DataFrame, rates: DataFrame, tolerance: float = 0.01, expand: int | None = EXPAND) -> DataFrame:
    """Pairs (fact_id_a, fact_id_b) of one firm, year and indicator whose amounts differ by at most ``tolerance`` of the larger.

    Rows meet through buckets of relative width ``tolerance``, each looking into its own bucket and the next one, so a key
    with many rows is joined by amount and never compared row by row. Rows equal in amount, figure, unit, currency and
    evidence are copies; of more than ``expand`` copies the one with the smallest id stands for all in pairs with others
    and is paired with each of them (None: all pairs). All other pairs are written.
    """
    facts = facts.withColumn("__copy", F.xxhash64("value", "unit", "currency", F.coalesce("evidence", F.lit(""))))
    rows = normalise_facts(facts, indicators, rates, keep=["fact_id", "firm", "year", "indicator_id", "__copy"])
    rows = rows.where("amount IS NOT NULL AND year IS NOT NULL AND firm IS NOT NULL AND indicator_id IS NOT NULL AND NOT isnan(amount)")
    keys = ["firm", "year", "indicator_id"]
    rows = rows.select("fact_id", *keys, "amount", "__copy")
    star = None
    if expand is not None:
        rows = materialise(rows)
        large = rows.groupBy(*keys, "amount", "__copy").agg(F.count("*").alias("__n"), F.min("fact_id").alias("__low")).where(F.col("__n") > expand).drop("__n")
        many = large.count()
        if many:
            rows = rows.join(F.broadcast(large) if many <= 500_000 else large, [*keys, "amount", "__copy"], "left")
            star = rows.where(F.col("fact_id") > F.col("__low")).select(F.col("__low").alias("fact_id_a"), F.col("fact_id").alias("fact_id_b"))
            rows = rows.where(F.col("__low").isNull() | (F.col("fact_id") == F.col("__low")))
    width = -log(1 - tolerance) * (1 + 1e-6)
    bucket = F.when(F.col("amount") == 0, F.lit(-(1 << 40))).otherwise(F.floor(F.log(F.abs("amount")) / width)).cast("bigint")
    base = rows.select("fact_id", *keys, "amount", F.signum("amount").alias("sign"), bucket.alias("bucket"))
    left = base.select(*keys, "sign", F.posexplode(F.array(F.col("bucket"), F.col("bucket") + 1)).alias("next", "bucket"), F.col("fact_id").alias("a"), F.col("amount").alias("x"))
    right = base.select(*keys, "sign", "bucket", F.col("fact_id").alias("b"), F.col("amount").alias("y"))
    near = F.abs(F.col("x") - F.col("y")) <= tolerance * F.greatest(F.abs("x"), F.abs("y")) * (1 + 1e-9)
    met = left.join(right, [*keys, "sign", "bucket"]).where(near & F.when(F.col("next") == 0, F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")))
    pairs = met.select(F.least("a", "b").alias("fact_id_a"), F.greatest("a", "b").alias("fact_id_b"))
    return (pairs.unionByName(star) if star is not None else pairs).distinct()
