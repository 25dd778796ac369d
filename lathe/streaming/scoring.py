"""Scoring a stream with a fitted preparation and model.

The fitted preparation is a projection with literals and a fitted model's
``transform`` is row-wise, so both apply unchanged to a streaming DataFrame;
predictions go to a sink per micro-batch (``foreachBatch``) or to any
streaming sink. No state is kept, so no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lathe.operators.prep import FittedPrep


def score_stream(stream: DataFrame, prep: FittedPrep | None, model, keep: list[str]) -> DataFrame:
    prepared = prep.apply(stream) if prep is not None else stream
    return model.transform(prepared).select(*keep, "prediction")


def start_scoring(
    stream: DataFrame,
    prep: FittedPrep | None,
    model,
    keep: list[str],
    sink: Callable[[DataFrame, int], None],
    checkpoint_location: str,
) -> StreamingQuery:
    """Score every micro-batch and hand it to ``sink(batch_df, batch_id)``."""
    scored = score_stream(stream, prep, model, keep)
    return scored.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_location).start()
