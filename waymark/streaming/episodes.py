"""Live generation on a stream of frames: episodes go on as their frames arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from waymark.operators.chain import Responder, frame_cards, walk_episodes


def generate_stream(
    numbered: DataFrame, responder: Responder, policy: str = "skip", max_retries: int = 3, waits: bool = True
) -> DataFrame:
    """Outcome, memory, anchor and trace of every streamed frame when its turn is over.

    ``numbered``: eligible frames with ``turn``, their number in the episode from 1.  Frames may
    come in any order and over any number of micro-batches.  With ``waits`` a failed attempt is
    repeated after its pause, by a timer, while other episodes go on.
    """
    return walk_episodes(frame_cards(numbered), responder, policy, max_retries, waits)


def write_walked(walked: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append finished turns as Parquet, each once: until all that is there is read, or
    ``every`` so often until stopped, which timers need."""
    writer = walked.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
