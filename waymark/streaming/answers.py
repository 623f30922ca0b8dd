"""Check answers of a model while they arrive, one decision per answer.

The frames to answer are a static table, so this is a stream-static join without state; the
first valid attempt and the memory chain need all attempts and stay with the batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from waymark.operators.traces import FRAME, validate_responses


def validate_stream(eligible: DataFrame, responses: DataFrame) -> DataFrame:
    """Key, attempt and reason (null: valid) of every streamed answer to an eligible frame."""
    return validate_responses(eligible, responses).select(*FRAME, "attempt", "reason")


def write_checked(checked: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append decisions as Parquet, each answer once, until all that is there is read."""
    return (
        checked.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
