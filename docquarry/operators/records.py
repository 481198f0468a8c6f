"""Small record shapes: explanations, review rows, checks of returned answers, audit texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.operators.evidence import supporting_quotes


def explanations(results: DataFrame) -> DataFrame:
    """(company, year, indicator_id, score, reasoning, quotes, pages) from scored rows with their evidence bundle.

    Quotes are the answer's own, else the first blocks of the bundle; a null answer counts as none.
    """
    return results.select(
        "company", "year", "indicator_id", "score", F.coalesce("reasoning", F.lit("")).alias("reasoning"), supporting_quotes(F.col("answer"), F.coalesce("evidence", F.lit(""))).alias("quotes"),
        F.array_join(F.transform(F.coalesce("pages", F.array()), lambda x: x.cast("string")), ",").alias("pages"),
    )


def answer_problem(score: Column, confidence: Column, evidence: Column, reasoning: Column) -> Column:
    """What is wrong with a returned answer, null if nothing: score 0..3, confidence 0..1, evidence for a positive score, reasoning."""
    s, c = score.try_cast("int"), confidence.try_cast("double")
    blank = lambda x: F.length(F.trim(F.coalesce(x, F.lit("")))) == 0
    return (
        F.when(s.isNull() | ~s.between(0, 3), "score not in 0..3").when(c.isNull() | ~c.between(0, 1), "confidence not in 0..1").when((s > 0) & blank(evidence), "positive score without evidence")
        .when(blank(reasoning), "no reasoning")
    )


def review_queue(answers: DataFrame) -> DataFrame:
    """Answers that need a person, with the reason; the others are left out."""
    why = answer_problem(*(F.col(c) for c in ("score", "confidence", "evidence", "reasoning")))
    return answers.withColumn("problem", why).where("problem IS NOT NULL").select("company", "year", "indicator_id", "problem")


def bullet_list(items: list[str]) -> str:
    return "\n".join(f"- {x}" for x in items) if items else "- none"


def audit_text(title: str, sections: dict[str, list[str]]) -> str:
    """A Markdown report of headed bullet lists."""
    return f"# {title}\n" + "".join(f"\n## {head}\n\n{bullet_list(items)}\n" for head, items in sections.items())
