"""Scoring texts and prompts as they arrive.

The row operators neither aggregate nor join, so a streaming DataFrame passes
through them without state or watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from textgauge.operators.lexicon import Lexicon
from textgauge.operators.scoring import score_rows


def flagged_stream(texts: DataFrame, lexicon: Lexicon, **options) -> DataFrame:
    """The flagged rows of a text stream."""
    return score_rows(texts, lexicon, **options).where("flagged")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder until its present input is used up.

    ``checkpoint`` is the stream's own folder: a later run with the same one
    goes on where this one ended and appends nothing twice.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
