"""Readers: reports as files, tables, JSON lines, codebooks, ontologies, prompt templates.

Files are listed and hashed by the binary-file source and parsed in Arrow tasks, one row per page. A file that cannot
be parsed yields one row with ``error`` set and no text, so one broken report never fails a job. PDF and OCR need
optional engines, found at run time or given as functions; without one, such a file gives an error row.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from pathlib import Path
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions.text import normalize_text

SUFFIXES = ("pdf", "txt", "docx", "html", "htm", "md")
PAGE_SCHEMA = "report_id string, file_hash string, source_file string, company string, year int, page_number int, text string, error string"


def discover_reports(spark: SparkSession, folder: str, glob: str = "*", limit: int | None = None, recursive: bool = False) -> DataFrame:
    """(path, source_file, report_id, file_hash, size, content) of report files, by path; the limit is a feature of the source."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    files = files.where(F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*SUFFIXES))
    # Two files of one stem are different reports: the id carries a hash of the path.
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    out = files.select("path", name.alias("source_file"), F.concat_ws("-", stem, F.substring(F.sha2("path", 256), 1, 8)).alias("report_id"), F.sha2("content", 256).alias("file_hash"), F.col("length").alias("size"), "content")
    return out.orderBy("path").limit(limit) if limit is not None else out


def company_year(stem: Column) -> tuple[Column, Column]:
    """Company and year of a report name ``COMPANY_2024``; the whole name and null where it ends otherwise."""
    year = F.nullif(F.regexp_extract(stem, r"^(.+?)_(\d{4})$", 2), F.lit(""))
    return F.when(year.isNull(), stem).otherwise(F.regexp_extract(stem, r"^(.+?)_(\d{4})$", 1)), year.cast("int")


class _Text(HTMLParser):
    def __init__(self, drop: bool):
        super().__init__()
        self.pieces: list[str] = []
        self.drop, self.inside = drop, 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.inside -= tag in ("script", "style") and self.inside > 0

    def handle_data(self, data):
        if not (self.drop and self.inside):
            self.pieces.append(data)


def html_text(html: str, drop_script: bool = False) -> str:
    """Text pieces of a page joined by line breaks; bodies of script and style stay unless ``drop_script``."""
    parser = _Text(drop_script)
    parser.feed(html)
    parser.close()
    return "\n".join(parser.pieces)


def docx_text(raw: bytes) -> str:
    """Paragraphs of a DOCX file, one per line."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml"))
    return "\n".join("".join(t.text or "" for t in p.iter(f"{w}t")) for p in root.iter(f"{w}p"))


def pdf_pages(raw: bytes) -> list[str]:
    """Text of each page, if pdfplumber is installed."""
    import pdfplumber

    with pdfplumber.open(io.BytesIO(raw)) as pdf:
        return [page.extract_text() or "" for page in pdf.pages]


def parse_reports(reports: DataFrame, ocr: Callable[[bytes], list[str]] | None = None, drop_script: bool = False) -> DataFrame:
    """Pages of reports as ``PAGE_SCHEMA``; page numbers count from 1, blank pages are left out and leave gaps.

    ocr: an engine from file content to page texts, asked for PDFs without any text.
    """

    def pages(name: str, raw: bytes) -> list[str]:
        kind = name.rsplit(".", 1)[-1].lower()
        if kind == "pdf":
            found = pdf_pages(raw)
            return found if any(t.strip() for t in found) or ocr is None else ocr(raw)
        if kind == "docx":
            return [docx_text(raw)]
        if kind not in SUFFIXES:
            raise ValueError(f"unsupported report type: .{kind}")
        text = raw.decode("utf-8", errors="ignore")
        return [html_text(text, drop_script) if kind in ("html", "htm") else text]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                stem = r.source_file.rsplit(".", 1)[0]
                m = re.fullmatch(r"(.+?)_(\d{4})", stem)
                about = (r.report_id, r.file_hash, r.source_file, m.group(1) if m else stem, int(m.group(2)) if m else None)
                try:
                    rows += [(*about, k, t, None) for k, t in enumerate(pages(r.source_file, bytes(r.content)), 1) if t.strip()]
                except Exception as e:  # noqa: BLE001 - recorded per report
                    rows.append((*about, None, None, f"{type(e).__name__}: {e}"))
            out = pd.DataFrame(rows, columns=["report_id", "file_hash", "source_file", "company", "year", "page_number", "text", "error"])
            out["year"], out["page_number"] = out["year"].astype("Int32"), out["page_number"].astype("Int32")
            yield out

    src = reports.select("report_id", "file_hash", "source_file", "content")
    return src.mapInPandas(run, PAGE_SCHEMA).withColumn("text", normalize_text("text")).where("error IS NOT NULL OR text <> ''")


def parse_errors(pages: DataFrame, stage: str = "parse") -> DataFrame:
    """(report, stage, error_type, message) of the rows that failed."""
    return pages.where("error IS NOT NULL").select(F.col("source_file").alias("report"), F.lit(stage).alias("stage"), F.substring_index("error", ":", 1).alias("error_type"), F.trim(F.expr("substring(error, instr(error, ':') + 1)")).alias("message"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet by suffix, else CSV with header."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; blank lines are skipped, unreadable ones give nulls."""
    reader = spark.read.option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).json(path)


def read_codebook(spark: SparkSession, path: str, required: list[str], optional: list[str] = ("definition",)) -> DataFrame:
    """The required and the optional columns of a codebook; a missing required one is an error."""
    book = read_table(spark, path)
    missing = [c for c in required if c not in book.columns]
    if missing:
        raise ValueError(f"codebook lacks columns: {', '.join(missing)}")
    return book.select(*required, *(c for c in optional if c in book.columns))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """A score file or a folder of CSV files, put together by name."""
    return read_table(spark, path)


def as_list(value) -> list[str]:
    """Null to an empty list, a text to one entry, blanks dropped."""
    if value is None:
        return []
    return [str(x).strip() for x in (value if isinstance(value, (list, tuple)) else [value]) if str(x).strip()]


def read_yaml(path: str) -> dict:
    import yaml

    try:
        data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except yaml.YAMLError as e:
        raise ValueError(f"unreadable YAML: {path}") from e
    if not isinstance(data, dict):
        raise ValueError(f"not a mapping: {path}")
    return data


def read_financial_indicators(path: str) -> list[dict]:
    """Financial indicators of a YAML file in the shape of the extraction: ids, label, group, lists, whether money is converted."""
    out = []
    for name, item in read_yaml(path).items():
        item = item or {}
        lists = {k: as_list(item.get(k)) for k in ("aliases", "retrieval_queries", "unit_candidates")}
        to_vnd = bool((item.get("normalization_rules") or {}).get("convert_to_vnd", False))
        out.append({"indicator_id": str(name), "label_vi": str(item.get("label_vi", name)), "statement_group": str(item.get("statement_group", "general")), **lists, "convert_to_vnd": to_vnd})
    return out


def by_group(indicators: list[dict]) -> dict[str, list[dict]]:
    """Financial indicators by statement group, in the order of the file."""
    return {g: [r for r in indicators if r["statement_group"] == g] for g in dict.fromkeys(r["statement_group"] for r in indicators)}


def file_metadata(spark: SparkSession, folder: str, chunk_count: int | None = None, chunks_per_report: int = 25) -> dict:
    """Files and MB of a folder, rows of its CSV files, and its chunks: as counted, else estimated per report."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    r = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b"), F.count_if(F.lower("path").endswith(".csv")).alias("csv")).first()
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").csv(folder).count() if r["csv"] else 0
    return {"files": r["n"], "size_mb": round(r["b"] / 1e6, 4), "csv_rows": rows, "chunks": chunk_count if chunk_count is not None else r["n"] * chunks_per_report}


#: Lists of an indicator's ontology file.
ONTOLOGY_LISTS = (
    "frameworks", "required_entities", "positive_keywords", "negative_keywords", "alternative_phrases", "units", "target_patterns", "required_evidence_patterns", "false_positive_patterns", "hard_required", "soft_positive",
    "qualitative_patterns", "quantitative_patterns",
)
#: Words too general to count as evidence by themselves.
GENERAL_NUMBERS = ("%", "amount", "total", "ratio", "rate", "number", "volume", "value")
GENERAL_WORDS = (
    "policy", "commitment", "management", "program", "procedure", "governance", "committee", "oversight", "strategy", "training", "risk management", "system", "mechanism", "initiative", "practice", "disclosure", "chinh sach",
    "cam ket", "quan ly", "chuong trinh", "quy trinh", "uy ban", "giam sat", "dao tao",
)
#: Patterns every policy indicator has; fields of a codebook row that name terms.
POLICY_DEFAULTS = ("code of conduct", "risk management system", "management system")
BOOK_FIELDS = ("retrieval_query", "keywords_vi", "keywords_en", "indicator_name_vi", "definition")


def _once(*lists) -> list[str]:
    return list(dict.fromkeys(x.strip() for xs in lists for x in xs if x and x.strip()))


def prepare_ontology(raw: dict, book: dict | None = None) -> dict:
    """An ontology entry ready for matching: codebook terms added, general words taken out, fallbacks applied.

    Without an entry of its own an indicator is described by its codebook row alone.
    """
    out = dict(raw) | {k: as_list(raw.get(k)) for k in ONTOLOGY_LISTS}
    out["score_patterns"] = {k: as_list(v) for k, v in (raw.get("score_patterns") or {}).items()}
    terms = [t.strip() for f in BOOK_FIELDS for t in re.split(r"[|;]", str((book or {}).get(f) or "")) if t.strip()]
    for k in ("positive_keywords", "alternative_phrases"):
        out[k] = _once(out[k], terms) if book is not None else out[k]
    kind = out["disclosure_type"] = str(raw.get("disclosure_type") or "policy")
    policy = kind in ("policy", "governance", "certification")
    out["hard_required"] = out["hard_required"] or out["required_entities"]
    out["soft_positive"] = _once(out["soft_positive"], out["positive_keywords"], out["alternative_phrases"])
    worded = [x for x in out["qualitative_patterns"] or out["score_patterns"].get("qualitative", []) if x.lower() not in GENERAL_WORDS]
    numbers = out["units"] if policy else out["quantitative_patterns"] or out["units"] + out["score_patterns"].get("quantitative", [])
    numbers = _once(x for x in numbers if x.lower() not in GENERAL_NUMBERS)
    mild = {x.lower() for x in worded}
    out["quantitative_patterns"] = numbers if policy else [x for x in numbers if x.lower() not in mild or x in out["units"]]
    out["qualitative_patterns"] = _once(worded, POLICY_DEFAULTS if policy else ())
    return out


def read_ontology(folder: str, codebook: list[dict]) -> list[dict]:
    """One prepared entry per codebook row, from ``{indicator_id}.yaml`` where there is one."""
    out = []
    for row in codebook:
        path = Path(folder) / f"{row['indicator_id']}.yaml"
        base = read_yaml(str(path)) if path.exists() else {"name": row.get("indicator_name_vi"), "pillar": row.get("pillar")}
        out.append(prepare_ontology({"indicator_id": row["indicator_id"]} | base, row))
    return out


def expanded_terms(entry: dict) -> list[str]:
    """Ordered distinct phrases of all groups that widen a search."""
    groups = ("hard_required", "soft_positive", "required_entities", "positive_keywords", "alternative_phrases", "units", "qualitative_patterns", "quantitative_patterns", "target_patterns")
    return _once(*(entry.get(g, ()) for g in groups), entry.get("score_patterns", {}).get("target", ()))


def read_prompt(raw: str) -> tuple[dict[str, str], str, str]:
    """(metadata, system, user) of a template: ``key: value`` lines up to ``---``, then ``SYSTEM:`` and ``USER:`` sections."""
    head, sep, body = raw.partition("\n---")
    meta = dict((k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in head.splitlines() if ":" in line)) if sep else {}
    found = re.search(r"SYSTEM:\s*(.*?)\s*USER:\s*(.*)", body if sep else raw, re.S)
    if not found:
        raise ValueError("a prompt needs SYSTEM: and USER: sections")
    return meta, found.group(1).strip(), found.group(2).strip()


