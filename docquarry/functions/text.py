"""Text functions as column expressions; the few that need Unicode decomposition or BLAKE2 are Arrow UDFs.

Regular expressions use (?U): without it the JVM's \\w, \\s and \\S are ASCII only.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no content in retrieval (English, then accent-free Vietnamese syllables).
STOPWORDS = (
    "and", "or", "of", "the", "to", "in", "for", "on", "with", "by",
    "ve", "va", "cac", "cua", "cho", "trong", "ngoai", "cong", "bo", "muc", "tong", "don", "vi", "hoat", "dong", "chinh", "sach", "doanh", "thu", "hao", "quy", "tri", "chi", "sinh", "khu", "mua", "cam",
)
#: Single terms that may stand alone as evidence.
INFORMATIVE = (
    "ghg", "co2e", "tco2e", "ems", "ltifr", "ohs", "hse", "iso14001", "iso", "tcfd", "sbti", "csr", "esg", "vnd", "vnđ", "usd", "kwh", "mwh", "gj", "mj", "m3", "m³", "kg", "ton", "ha", "ml", "scope", "pham", "tu",
)


#: A word token: letters, digits, underscores and hyphens of any script.
TOKEN = r"[\p{L}\p{N}_\-]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """NUL to blank, runs of blanks and tabs to one blank, three or more newlines to two, stripped. Null stays null."""
    out = F.translate(_col(c), "\x00", " ")
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return F.regexp_replace(out, r"(?U)^\s+|\s+$", "")


def tokens(c: Column | str) -> Column:
    """The longest runs of characters that are not white space."""
    return F.regexp_extract_all(_col(c), F.lit(r"(?U)\S+"), F.lit(0))


def count_tokens(c: Column | str) -> Column:
    return F.size(F.regexp_extract_all(_col(c), F.lit(r"(?U)\S+"), F.lit(0)))


@lru_cache(maxsize=2)
def _decomposition(fold_d: bool) -> tuple[str, str]:
    """Characters whose compatibility decomposition without marks is one other character, by that rule."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        if 0xAC00 <= code < 0xE000 or unicodedata.combining(chr(code)):
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != chr(code):
            source.append(chr(code))
            target.append(plain)
    return "".join(source) + ("đ" if fold_d else ""), "".join(target) + ("d" if fold_d else "")


def strip_accents(c: Column | str, fold_d: bool = False) -> Column:
    """Compatibility letters to plain ones and accents dropped, JVM-side; "đ" stays unless ``fold_d``.

    Equals ``strip_accents_exact`` for all characters but those that decompose into several, of which only the Latin
    ligatures are spelled out here.
    """
    plain = F.regexp_replace(F.translate(_col(c), *_decomposition(fold_d)), r"\p{Mn}+", "")
    spelled = plain
    for code in range(0xFB00, 0xFB07):
        spelled = F.replace(spelled, F.lit(chr(code)), F.lit(unicodedata.normalize("NFKD", chr(code))))
    return F.when(plain.rlike(f"[{chr(0xFB00)}-{chr(0xFB06)}]"), spelled).otherwise(plain)


def strip_accents_exact(c: Column | str) -> Column:
    """NFKD without combining marks, for every character; an Arrow UDF."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        plain = lambda t: t if t.isascii() else "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x))
        return s.map(plain, na_action="ignore")

    return fold(_col(c))


def fin_normalize(c: Column | str) -> Column:
    """Lower case, d-stroke to d, accents dropped, white space collapsed and stripped."""
    plain = strip_accents(F.lower(_col(c)), fold_d=True)
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def tokenize(c: Column | str) -> Column:
    """Lower-case word tokens; a token whose accent-free form differs is followed by that form."""
    found = F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN), F.lit(0))
    return F.flatten(F.transform(found, lambda x: F.when(strip_accents(x) == x, F.array(x)).otherwise(F.array(x, strip_accents(x)))))


def is_informative(t: Column) -> Column:
    """Terms that may stand alone: listed ones, mixtures of digit and letter, and those of six characters or more."""
    return t.isin(*INFORMATIVE) | (t.rlike(r"\p{Nd}") & t.rlike(r"\p{L}")) | (F.length(t) >= 6)


def content_terms(c: Column | str) -> Column:
    """Tokens of the accent-free text without stopwords and without short terms that say nothing."""
    found = F.regexp_extract_all(F.lower(strip_accents(_col(c))), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*STOPWORDS) & ((F.length(t) >= 3) | t.rlike(r"^\p{Nd}+$") | is_informative(t)))


def looks_corrupt(c: Column | str) -> Column:
    return _col(c).rlike("[?\ufffdÄÂ]")


def token_bucket(token: str, dimensions: int, digest: str = "blake2b") -> tuple[int, float]:
    """Bucket and sign of a token. BLAKE2b: bytes 0-3 little endian, sign by byte 4; MD5: hexadecimal digits 1-6, sign by the 7th."""
    raw = token.encode("utf-8")
    if digest == "md5":
        h = hashlib.md5(raw).hexdigest()
        return int(h[:6], 16) % dimensions, 1.0 if h[6] < "8" else -1.0
    h = hashlib.blake2b(raw, digest_size=8).digest()
    return int.from_bytes(h[:4], "little") % dimensions, 1.0 if h[4] % 2 == 0 else -1.0


_PYTHON_TOKEN = re.compile(r"[\w\-]+")


def embed_batch(texts: list[str], dimensions: int, digest: str = "blake2b") -> np.ndarray:
    """Signed counts of hashed tokens, a row of unit length per text; zero for a text without tokens."""
    flat: list[str] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = _PYTHON_TOKEN.findall(text.lower()) if text else []
        counts[i] = len(found)
        flat += found
    out = np.zeros((len(texts), dimensions))
    if flat:
        code, names = pd.factorize(np.array(flat, dtype=object))
        place = [token_bucket(t, dimensions, digest) for t in names]
        bucket, sign = np.array([b for b, _ in place]), np.array([s for _, s in place])
        row = np.repeat(np.arange(len(texts)), counts)
        out = np.bincount(row * dimensions + bucket[code], weights=sign[code], minlength=len(texts) * dimensions).reshape(len(texts), dimensions)
        length = np.sqrt((out * out).sum(axis=1, keepdims=True))
        out = np.divide(out, length, out=np.zeros_like(out), where=length > 0)
    return out


def hash_embed(c: Column | str, dimensions: int = 1024, digest: str = "blake2b") -> Column:
    """Hashing embedding as array<double>; null text counts as empty."""

    @F.pandas_udf("array<double>")
    def embed(s: pd.Series) -> pd.Series:
        return pd.Series(list(embed_batch(s.tolist(), dimensions, digest)))

    return embed(_col(c))


def unique_ordered(c: Column) -> Column:
    """Trimmed, non-empty entries in first-seen order."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""))


def split_terms(c: Column | str) -> Column:
    """Entries between vertical bars and semicolons, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), r"[|;]"), lambda x: F.trim(x)), lambda x: x != "")


def join_parts(*parts: Column, sep: str = " ") -> Column:
    """Parts that are neither null, empty nor the text ``nan``, joined."""
    return F.concat_ws(sep, *(F.when((p != "") & (p != "nan"), p) for p in parts))


def needs_ocr(chars: Column, words: Column, page_count: Column, forced: bool = False, least_chars: int = 500, least_words: int = 20) -> Column:
    """Whether a report has too little text: few characters, or few words a page."""
    return F.lit(forced) | (chars < least_chars) | (words / F.greatest(page_count, F.lit(1)) < least_words)


def page_suspect(text: Column, score: Column) -> Column:
    """Whether a page looks badly parsed: short, without line breaks, or full of question and replacement marks."""
    text = F.coalesce(text, F.lit(""))
    n, lines, odd = F.length(text), F.regexp_count(text, F.lit("\n")), F.regexp_count(text, F.lit("[?\ufffd]"))
    return ((n < 250) & (score > 0)) | ((lines < 2) & (n < 600) & (score > 0)) | (odd > F.greatest(n * 0.02, F.lit(5.0)))


def python_round(c: Column, digits: int) -> Column:
    """Half-even rounding, as used for every published figure."""
    return F.bround(c, digits)

