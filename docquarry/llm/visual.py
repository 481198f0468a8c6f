"""One consistent form for text that looks the same but differs in its characters.

Every Arrow partition runs through an embedded DuckDB, Arrow in and Arrow out, whose SQL strips invisible characters,
spells out ligatures, Roman numerals, squared units, ellipses and other signs that show several letters, translates
compatibility forms and look-alike letters, composes accents (``nfc_normalize``) and makes every run of white space one
space. Letter case and accents stay significant, and so does what a reader sees: raised, lowered and circled characters
and fractions stay as they are.

Defined results: null stays null, empty stays empty; repeated rows each give a row; keywords that are null, empty or
blank match nothing; a null keyword array has no keywords; extra columns are kept by ``normalise_text``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.common import spread
from docquarry.llm.boilerplate import INVISIBLE
from docquarry.llm.splitting import WHITE

#: Letters of other scripts whose shape is that of a Latin letter, each followed by that letter.
LOOK_ALIKE = (
    # Greek
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa νv οo ρp υu ιi κk "
    # Cyrillic
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ҮY ԌG ԚQ ԜW ԛq ԝw аa еe оo рp сc уy хx ѕs іi јj һh ԁd ɡg "
    # Armenian and others
    "օo սu հh ոn զq յj ÐĐ ƉĐ"
).split()
#: Dashes shown as a hyphen.
DASHES = "".join(map(chr, (0x2010, 0x2011, 0x2012, 0x2212, 0xFE63, 0xFF0D)))


#: Blocks of letters shown in another width or font, and of signs that show letters side by side.
FORMS = (*range(0xFF01, 0xFFEF), *range(0x2100, 0x2150), *range(0x2160, 0x2180), *range(0x1D400, 0x1D800), *range(0xFE50, 0xFE6C), 0xB5)
SIGNS = (*range(0x132, 0x134), 0x149, *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4), *range(0x2024, 0x2027), *range(0x2100, 0x2150), *range(0x2160, 0x2180), *range(0x3371, 0x33E0), *range(0xFB00, 0xFB07))


def _shown(code: int) -> str:
    """What a compatibility form shows, one step of its decomposition; '' for raised, lowered, circled and other forms."""
    kind, _, rest = unicodedata.decomposition(chr(code)).partition(" ")
    return "".join(chr(int(x, 16)) for x in rest.split()) if kind in ("<wide>", "<narrow>", "<font>", "<compat>", "<small>", "<square>") else ""


def _translation() -> tuple[str, str]:
    """Pairs of single characters: compatibility forms, look-alikes, accented look-alikes."""
    pairs = {x[0]: x[1] for x in LOOK_ALIKE} | {c: "-" for c in DASHES} | {"\u2215": "/"}
    for code in FORMS:
        plain = _shown(code)
        if len(plain) == 1:
            pairs.setdefault(chr(code), pairs.get(plain, plain))
    for code in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):
        whole = unicodedata.normalize("NFD", chr(code))
        if len(whole) > 1 and whole[0] in pairs:
            made = unicodedata.normalize("NFC", pairs[whole[0]] + whole[1:])
            if len(made) == 1:
                pairs.setdefault(chr(code), made)
    return "".join(pairs), "".join(pairs.values())


def _ligatures() -> dict[str, str]:
    """Signs that show several characters side by side and what they show (fractions are no such signs)."""
    shown = {chr(c): "".join(_shown(ord(x)) or x for x in _shown(c)).replace("\u2215", "/") for c in SIGNS}
    return {c: x for c, x in shown.items() if len(x) > 1}


def _class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


def canonical_sql(column: str = "text") -> str:
    """The DuckDB expression that brings a string column to its canonical form."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    expr = f"regexp_replace({column}, '{_class(INVISIBLE)}', '', 'g')"
    many = _ligatures()
    spelled = expr
    for letter, letters in many.items():
        spelled = f"replace({spelled}, {quote(letter)}, {quote(letters)})"
    expr = f"CASE WHEN regexp_matches({column}, '{_class(''.join(many))}') THEN {spelled} ELSE {expr} END"
    source, target = _translation()
    expr = f"CASE WHEN regexp_matches({column}, '{_class(source)}') THEN translate({expr}, {quote(source)}, {quote(target)}) ELSE {expr} END"
    return f"CASE WHEN regexp_full_match({column}, '[!-~]*( [!-~]+)*') THEN {column} ELSE regexp_replace(nfc_normalize({expr}), '{_class(WHITE)}+', ' ', 'g') END"


class _Embedded:
    """A DuckDB connection of one thread and bounded memory, made in the worker."""

    def __init__(self) -> None:
        import duckdb

        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.sql = f"SELECT {canonical_sql('text')} AS text FROM given"

    def __call__(self, texts: pa.Array) -> pa.Array:
        self.con.register("given", pa.table({"text": texts}))
        out = self.con.sql(self.sql).to_arrow_table()["text"].cast(pa.string()).combine_chunks()
        self.con.unregister("given")
        return out


def canonical(texts: list[str | None]) -> list[str | None]:
    """The canonical form of a few texts, on the caller's side."""
    return _Embedded()(pa.array(texts, pa.string())).to_pylist()


def normalise_text(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``text_col`` in canonical form; all other columns, their order and names stay."""
    schema = rows.schema
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        duck = _Embedded()
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                columns = list(part.columns)
                columns[at] = duck(part.column(at))
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return spread(rows).mapInArrow(run, schema)


def keyword_mentions(pages: DataFrame, ontology: DataFrame, id_col: str = "page_key", text_col: str = "text") -> DataFrame:
    """(indicator_id, keyword_no, id_col) for every page that shows a keyword, not as part of a longer word.

    The keyword list is a dictionary of some hundred phrases and goes to the workers as a whole; pages are read once.
    """
    rows = ontology.select("indicator_id", F.posexplode("positive_keywords").alias("no", "keyword")).where("keyword IS NOT NULL").collect()
    forms = [None if x is None else x.strip(" ") for x in canonical([r["keyword"] for r in rows])]
    named: dict[str, list[tuple[str, int]]] = {}
    for row, form in zip(rows, forms):
        if form:
            named.setdefault(form, []).append((row["indicator_id"], row["no"] + 1))
    kinds = dict(pages.dtypes)
    schema = f"indicator_id string, keyword_no int, id {kinds[id_col]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        duck = _Embedded()
        finder = ahocorasick.Automaton()
        for form in named:
            finder.add_word(form, form)
        if named:
            finder.make_automaton()
        inside = lambda c: c.isalnum() or unicodedata.category(c)[0] == "M"
        for batch in batches if named else ():
            ids, names, numbers = [], [], []
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                for i, text in enumerate(duck(part.column("text")).to_pylist()):
                    if not text:
                        continue
                    shown = set()
                    for end, form in finder.iter(text):
                        start = end + 1 - len(form)
                        if form not in shown and not (start and inside(text[start - 1]) and inside(form[0])) and not (end + 1 < len(text) and inside(text[end + 1]) and inside(form[-1])):
                            shown.add(form)
                    for form in shown:
                        for indicator, no in named[form]:
                            ids.append(k + i)
                            names.append(indicator)
                            numbers.append(no)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int32()), batch.column("id").take(pa.array(ids, pa.int64()))], ["indicator_id", "keyword_no", "id"])

    src = spread(pages.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    return src.mapInArrow(run, schema).distinct().withColumnRenamed("id", id_col)
