"""Prompt generation and scoring in one job, without a file in between."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from textgauge.operators import prompts, rubric


def prompt_batch(df: DataFrame, key_cols: Sequence[str], seed: int | None = None, **options) -> dict[str, DataFrame]:
    """``prompts``, ``scored`` and the tables of the batch summary.

    Generation and scoring are projections over the topic rows; only the
    summaries shuffle, and a seed asks for a global sort.
    """
    generated = prompts.generate(df, key_cols, **options)
    scored = rubric.score_prompts(generated)
    ties = (*key_cols, "ordinal")
    return {
        "prompts": generated if seed is None else prompts.seeded_order(generated, seed, *ties),
        "scored": scored,
        "average": rubric.average_score(scored),
        "grades": rubric.grade_counts(scored),
        "coverage": rubric.coverage(scored),
        "top_prompts": rubric.top_prompts(scored, tie_cols=ties),
        "needs_attention": rubric.needs_attention(scored, tie_cols=ties),
    }
