"""A deterministic rubric for prompt batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.functions.numbers import rate
from textgauge.functions.text import contains_any

# The phrases that earn a point, per dimension.
SPECIFICITY_TERMS = ("exactly", "include", "with constraints", "vs alternatives")
STRUCTURE_TERMS = ("checklist", "bullets", "sections", "outline", "matrix", "step-by-step")
AUDIENCE_PHRASES = ("for a ", "aimed at a ")
EVALUATION_TERMS = ("criteria", "metrics", "assessment", "risks", "pitfalls", "mitigations")

# The dimensions in their order, with the advice for a miss.
GUIDANCE = {
    "specificity": "Add concrete constraints such as an exact count, required sections, or explicit inclusions.",
    "structure": "Ask for a clear output structure such as a checklist, bullets, sections, outline, or matrix.",
    "audience": "Name the target audience so the response can tune depth, tone, and examples.",
    "evaluation_ready": "Request criteria, metrics, risks, assessment questions, pitfalls, or mitigations.",
}

# The lowest score of each grade.
STRONG_FROM = 3
USABLE_FROM = 2

TOP = 5


def dimensions(prompt: Column, audience: Column | None = None) -> dict[str, Column]:
    """The four 0/1 points of a prompt."""
    low = F.lower(prompt)
    addressed = contains_any(low, AUDIENCE_PHRASES)
    if audience is not None:
        addressed = (F.coalesce(audience, F.lit("")) != "") | addressed
    return {
        "specificity": contains_any(low, SPECIFICITY_TERMS).cast("int"),
        "structure": contains_any(low, STRUCTURE_TERMS).cast("int"),
        "audience": addressed.cast("int"),
        "evaluation_ready": contains_any(low, EVALUATION_TERMS).cast("int"),
    }


def grade(score: Column) -> Column:
    return F.when(score >= STRONG_FROM, "strong").when(score >= USABLE_FROM, "usable").otherwise("thin")


def recommendations(rubric: Column) -> Column:
    """The advice for every missed dimension, in dimension order."""
    advice = [F.when(rubric[name] == 0, F.lit(text)) for name, text in GUIDANCE.items()]
    return F.array_compact(F.array(*advice))


def score_prompts(df: DataFrame, prompt_col: str = "prompt", audience_col: str = "audience") -> DataFrame:
    """Append ``rubric``, ``score``, ``grade`` and ``recommendations``.

    All input columns pass through; an absent audience column is ignored.
    """
    audience = F.col(audience_col) if audience_col in df.columns else None
    points = dimensions(F.col(prompt_col), audience)
    rubric = F.struct(*[value.alias(name) for name, value in points.items()])
    kept = [c for c in df.columns if c not in ("rubric", "score", "grade", "recommendations")]
    total = sum((F.col("rubric")[name] for name in GUIDANCE), F.lit(0))
    return (
        df.select(*kept, rubric.alias("rubric"))
        .select("*", total.alias("score"))
        .select("*", grade(F.col("score")).alias("grade"), recommendations(F.col("rubric")).alias("recommendations"))
    )


def grade_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).orderBy("grade")


def average_score(scored: DataFrame, digits: int = 3) -> DataFrame:
    """Number of records and their mean score, 0 for an empty batch."""
    return scored.agg(
        F.count(F.lit(1)).alias("records"),
        rate(F.coalesce(F.sum("score"), F.lit(0)), F.count(F.lit(1)), digits).alias("average_score"),
    )


def coverage(scored: DataFrame, digits: int = 3) -> DataFrame:
    """Share of records with the point, one row per dimension."""
    n = F.count(F.lit(1))
    sums = scored.agg(
        *[rate(F.coalesce(F.sum(f"rubric.{name}"), F.lit(0)), n, digits).alias(name) for name in GUIDANCE]
    )
    pairs = [F.struct(F.lit(name).alias("dimension"), F.col(name).alias("coverage")) for name in GUIDANCE]
    return sums.select(F.inline(F.array(*pairs)))


def top_prompts(scored: DataFrame, limit: int = TOP, tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """Best prompts first; equal scores by prompt text."""
    return scored.orderBy(F.desc("score"), "prompt", *tie_cols).limit(limit)


def needs_attention(scored: DataFrame, limit: int = TOP, tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """Of the lowest prompts, those with advice: the limit comes first."""
    return scored.orderBy("score", "prompt", *tie_cols).limit(limit).where(F.size("recommendations") > 0)
