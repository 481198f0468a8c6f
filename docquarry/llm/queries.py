"""Queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.common import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.similar_vectors import similar_pairs

    return similar_pairs(table(spark, d, "chunk_vectors"), table(spark, d, "embedding_config"))


def p1_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The ten most similar classes of every class of equal vectors, named by the smallest id of each."""
    from docquarry.llm.similar_vectors import similar_classes

    lists, members = similar_classes(table(spark, d, "chunk_vectors"), table(spark, d, "embedding_config"))
    names = members.groupBy("cls").agg(F.min("id").alias("id"))
    out = lists.join(names.select(F.col("cls").alias("h"), F.col("id").alias("vec_id")), "h")
    out = out.join(names.select(F.col("cls").alias("near"), F.col("id").alias("near_id")), "near")
    return out.select("vec_id", "near_id", F.round("cosine", 6).alias("cosine"), "rank")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.boilerplate import repeated_lines

    return repeated_lines(table(spark, d, "financial_pages"))


def p2_cleaned(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.boilerplate import remove_repeated_lines

    return remove_repeated_lines(table(spark, d, "financial_pages").select("page_key", "source_file", "text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.splitting import oversized

    return oversized(table(spark, d, "financial_pages"), table(spark, d, "chunking_config"))


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.splitting import split_pages

    return split_pages(table(spark, d, "financial_pages"), table(spark, d, "chunking_config"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.near_duplicates import near_duplicate_pairs

    return near_duplicate_pairs(table(spark, d, "financial_pages"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.visual import keyword_mentions

    return keyword_mentions(table(spark, d, "financial_pages"), table(spark, d, "indicator_ontology"))


def p5_normalised(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.visual import normalise_text

    return normalise_text(table(spark, d, "financial_pages").select("page_key", "text"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.scanned import scan_noise

    return scan_noise(table(spark, d, "financial_pages"), table(spark, d, "ocr_results"))


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.scanned import repair_pages

    return repair_pages(table(spark, d, "financial_pages"), table(spark, d, "ocr_results"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.tokenizer import encode_documents

    return encode_documents(table(spark, d, "documents"))


def p9_packing(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.packing import pack_documents

    return pack_documents(table(spark, d, "documents"), table(spark, d, "containers"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.packing import packing_report

    return packing_report(p9_packing(spark, d), table(spark, d, "containers"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.toxicity import found_documents

    return found_documents(table(spark, d, "documents"), table(spark, d, "moderation_labels"))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.toxicity import score_documents

    return score_documents(table(spark, d, "documents"), table(spark, d, "moderation_labels"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    from docquarry.llm.toxicity import source_rates

    return source_rates(table(spark, d, "documents"), table(spark, d, "moderation_labels"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit()}


_WHITE = r"[\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def oracle_sql() -> dict[str, str]:
    word = _WHITE.replace("[", "[^", 1)
    return {
        "p3_found": f"""
            SELECT DISTINCT p.page_key FROM financial_pages p JOIN chunking_config c ON p.statement_type IS NOT DISTINCT FROM c.statement_type
            WHERE len(regexp_extract_all(p.text, '{word}+')) > c.chunk_size""",
        # Every group of one text has fewer rows than are written as a star at the size of the comparison.
        "p4_found": f"""
            WITH w AS (SELECT page_key, regexp_extract_all(lower(text), '{word}+') AS l FROM financial_pages), long AS (SELECT * FROM w WHERE len(l) >= 80),
            s AS (SELECT DISTINCT page_key, unnest(list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2])) AS g FROM long), n AS (SELECT page_key, count(*) AS n FROM s GROUP BY page_key),
            met AS (SELECT a.page_key AS a, b.page_key AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.page_key < b.page_key GROUP BY ALL)
            SELECT a AS page_key_a, b AS page_key_b FROM met JOIN n x ON x.page_key = a JOIN n y ON y.page_key = b WHERE c >= 0.6 * (x.n + y.n - c)""",
    }
