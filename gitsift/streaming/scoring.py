"""Streams: score arriving commits into the log, keep the log's label counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gitsift.operators.scoring import Scorer, score
from gitsift.sources import history


def log_batch(
    model: str, scorers: Mapping[str, Scorer], log: history.Log, source: str
) -> Callable[[DataFrame, int], None]:
    """What to do with each micro-batch of ``commit_id, ts, message, diff``.

    A batch that is replayed after a failure replaces what it has left in the log, and
    nothing of the log is read. The model is registered by its first batch.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch = batch.dropDuplicates(["commit_id"])  # a commit may be delivered twice
        scored = score(batch, model, scorers).drop("probs")
        rows = batch.select("commit_id", "ts", "message", "diff").join(scored, "commit_id").select(
            F.col("commit_id").alias("id"), "ts", "model", F.lit(None).cast("bigint").alias("batch_run_id"),
            "message", "diff", "label", "confidence", "probabilities", F.lit(source).alias("source"))
        log.write(rows, number)

    return handle


def score_stream(
    commits: DataFrame, model: str, scorers: Mapping[str, Scorer], log: history.Log,
    checkpoint: str, source: str = "stream", available_now: bool = True,
) -> StreamingQuery:
    """Scores a stream into the log. One checkpoint belongs to one writer of the log."""
    writer = commits.writeStream.foreachBatch(
        log_batch(model, scorers, log, source)
    ).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def label_counts_stream(log: DataFrame) -> DataFrame:
    """Running label counts of a log read as a stream; state is one counter per label."""
    return log.groupBy(F.col("predicted_label").alias("label")).agg(F.count("*").alias("n"))
