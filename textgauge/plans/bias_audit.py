"""The bias audit of a text table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.operators.lexicon import CATEGORY_CAPS, Lexicon
from textgauge.operators.matching import CONTEXT_WINDOW, with_hits
from textgauge.operators.scoring import (
    MIN_SCORE,
    corpus_summary,
    flagged_rows,
    group_metrics,
    score_rows,
    term_counts,
    top_terms,
)
from textgauge.sources.sinks import append_run, write_details, write_flagged_csv


def bias_audit(
    df: DataFrame,
    id_col: str,
    text_col: str = "text",
    group_col: str | None = None,
    lexicon: Lexicon | None = None,
    allowlist: Sequence[str] = (),
    denylist: Sequence[str] = (),
    caps: Mapping[str, float] | None = CATEGORY_CAPS,
    min_score: float = MIN_SCORE,
    window: int = CONTEXT_WINDOW,
) -> dict[str, DataFrame]:
    """All tables of an audit, none of them computed yet.

    ``rows`` (scores with hits), ``flagged``, ``summary``, ``top_terms`` and,
    with a group column, ``group_stats``.
    """
    lexicon = lexicon or Lexicon.builtin()
    scored = score_rows(df, lexicon, text_col, allowlist, denylist, caps, min_score)
    tables = {
        "rows": with_hits(scored, lexicon, text_col, allowlist, denylist, window),
        "flagged": flagged_rows(scored),
        "summary": corpus_summary(scored),
        "top_terms": top_terms(term_counts(df, lexicon, id_col, text_col, allowlist, denylist)),
    }
    if group_col and group_col in df.columns:
        tables["group_stats"] = group_metrics(scored, group_col)
    return tables


def write_bias_audit(
    df: DataFrame, id_col: str, path: str, run_id: str, generated_at: str, text_col: str = "text", **options
) -> dict[str, DataFrame]:
    """Write the detailed rows, the flagged CSV and the summary of one run.

    The summary is read off the written rows, so the texts are scored once.
    """
    tables = bias_audit(df, id_col, text_col, **options)
    write_details(tables["rows"], f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    write_flagged_csv(rows, f"{path}/flagged", id_col, text_col)
    summary = corpus_summary(rows).select(
        F.lit(run_id).alias("run_id"), F.lit(generated_at).alias("generated_at_utc"), "*"
    )
    append_run(summary, f"{path}/runs")
    return tables | {"rows": rows}
