"""Prediction history: models, batch runs and predictions as three tables.

The registry of models is a folder with one small file a model, named by its id. Ids are
claimed one after the other by creating the file, which the file system lets only one
writer do; whoever loses reads the winner's row and tries the next number. So two writers
never give one id to two models, nor one model two ids.

The log is a folder a writer and batch. Writing a batch replaces its folder, so a batch
that is run again after a failure leaves what it left before, and writers never meet. No
writer reads the log. Readers see every id once, by its earliest batch.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions.text import iso_seconds, preview
from gitsift.session import file_sizes, materialise, write_once

MODELS = """model_id int, name string, version string, trained_at timestamp,
  accuracy_test double, macro_f1_test double, notes string"""

LOG_ROWS = """id bigint, ts timestamp, model_id int, batch_run_id bigint, message_preview string,
  diff_preview string, predicted_label string, confidence double, probabilities map<string,double>,
  source string"""


def empty_models(spark) -> DataFrame:
    return spark.createDataFrame([], MODELS)


def add_missing_models(models: DataFrame, used: DataFrame) -> DataFrame:
    """Get-or-create: rows for names in ``used(model, ts)`` that ``models`` lacks.

    Names are few, and only new ones are numbered, in order of first use.
    """
    first_use = used.groupBy("model").agg(F.min("ts").alias("trained_at"))
    fresh = first_use.join(models, F.col("model") == F.col("name"), "left_anti")
    top = models.agg(F.coalesce(F.max("model_id"), F.lit(0)).alias("top"))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("trained_at", "model"))
    added = fresh.join(F.broadcast(top)).select(
        (rank + F.col("top")).cast("int").alias("model_id"), F.col("model").alias("name"),
        F.lit(fv.MODEL_VERSION).alias("version"), "trained_at",
        F.lit(None).cast("double").alias("accuracy_test"),
        F.lit(None).cast("double").alias("macro_f1_test"), F.lit("").alias("notes"))
    return models.unionByName(added)


def register_metrics(models: DataFrame, metrics: DataFrame, now) -> DataFrame:
    """Upsert by name: only non-null values overwrite, ``trained_at`` is refreshed.

    ``metrics`` has ``name, accuracy_test, macro_f1_test, version``.
    """
    known = add_missing_models(models, metrics.select(F.col("name").alias("model"), now.alias("ts")))
    new = metrics.select("name", F.col("accuracy_test").alias("a"), F.col("macro_f1_test").alias("f"),
                         F.col("version").alias("v"), F.lit(True).alias("given"))
    joined = known.join(new, "name", "left")
    return joined.select(
        "model_id", "name", F.coalesce("v", "version").alias("version"),
        F.when(F.col("given"), now).otherwise(F.col("trained_at")).alias("trained_at"),
        F.coalesce("a", "accuracy_test").alias("accuracy_test"),
        F.coalesce("f", "macro_f1_test").alias("macro_f1_test"), "notes")


def read_models(spark: SparkSession, registry: str) -> DataFrame:
    """The stored models; none if nothing is stored yet."""
    if not file_sizes(spark, registry):
        return empty_models(spark)
    return spark.read.schema(MODELS).json(registry, timestampFormat=_TIMES).filter("model_id IS NOT NULL")


_TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: How long a claimed number may stay without its row; its writer is then taken for lost
#: and the number stays unused.
CLAIM_SECONDS = 30


def _settled(spark: SparkSession, registry: str) -> int:
    """The highest number claimed, once every claim has its row or is given up."""
    until = time.monotonic() + CLAIM_SECONDS
    while True:
        sizes = {name: n for name, n in file_sizes(spark, registry).items() if name.endswith(".json")}
        if all(sizes.values()) or time.monotonic() > until:
            return max((int(name.split(".")[0]) for name in sizes), default=0)
        time.sleep(0.05)


def registered(used: DataFrame, registry: str) -> DataFrame:
    """Get-or-create, stored: the registry after the names in ``used(model, ts)`` have joined it.

    Names are few: those that are new go through the driver, in order of first use.
    """
    spark = used.sparkSession
    while True:
        top = _settled(spark, registry)
        models = read_models(spark, registry)
        first_use = used.groupBy("model").agg(F.min("ts").alias("ts"))
        fresh = first_use.join(models, F.col("model") == F.col("name"), "left_anti").select(
            "model", F.date_format(F.to_utc_timestamp("ts", F.current_timezone()),
                                   "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts")).orderBy("ts", "model").collect()
        for number, row in enumerate(fresh, top + 1):
            stored = {"model_id": number, "name": row.model, "version": fv.MODEL_VERSION,
                      "trained_at": f"{row.ts}Z", "notes": ""}
            if not write_once(spark, f"{registry}/{number:09d}.json", json.dumps(stored)):
                break  # another writer was here first; see what it has stored
        else:
            return read_models(spark, registry)


def prediction_rows(scored: DataFrame, models: DataFrame) -> DataFrame:
    """Log rows of scored commits: previews cut, model named by its stored id.

    ``scored`` has ``id, ts, model, batch_run_id, message, diff, label, confidence,
    probabilities, source``. A prediction of a model that is not in ``models`` stays,
    without an id; ``log_batch`` registers models first.
    """
    names = models.select("model_id", F.col("name").alias("model"))
    return scored.join(names, "model", "left").select(
        "id", "ts", "model_id", "batch_run_id",
        preview(F.col("message")).alias("message_preview"),
        preview(F.col("diff")).alias("diff_preview"),
        F.col("label").alias("predicted_label"), "confidence", "probabilities", "source")


def append_predictions(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_batch(rows: DataFrame, path: str, writer: str, batch: int) -> None:
    """One batch of a writer into the log, in place of what that batch left before; an id once."""
    rows.dropDuplicates(["id"]).write.mode("overwrite").parquet(f"{path}/writer={writer}/batch={batch}")


def read_log(spark: SparkSession, path: str, schema=LOG_ROWS) -> DataFrame:
    """The log of all writers, ``schema`` without the folders' columns; every id once.

    An id that several batches hold, as after a start without the old checkpoint, is
    taken from the first, by batch and then writer.
    """
    stored = spark.createDataFrame([], schema).schema.add("writer", "string").add("batch", "long")
    try:
        log = spark.read.schema(stored).option("basePath", path).parquet(path)
    except AnalysisException as exc:  # nothing has been logged yet
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], schema)
    columns = [c for c in log.columns if c not in ("writer", "batch")]
    first = F.min_by(F.struct(*columns), F.struct("batch", "writer"))
    return log.groupBy("id").agg(first.alias("row")).select("row.*")


@dataclass(frozen=True)
class Log:
    """Where predictions are logged, and which writer logs them."""

    registry: str
    path: str
    writer: str

    def write(self, scored: DataFrame, batch: int = 0) -> None:
        """Registers the models of ``scored`` (see ``prediction_rows``) and logs its rows."""
        shown = {c: preview(F.col(c)) for c in ("message", "diff")}  # all that the log keeps of them
        scored = materialise(scored.withColumns(shown), "log-batch")  # scoring is dear, and read twice
        models = registered(scored.select("model", "ts"), self.registry)
        write_batch(prediction_rows(scored, models), self.path, self.writer, batch)


def batch_run_rows(requests: DataFrame, models: DataFrame) -> DataFrame:
    names = models.select("model_id", F.col("name").alias("model"))
    return requests.join(names, "model").select(
        F.col("batch_run_id").alias("id"), "ts", "repo_path", "n_commits", "model_id")


def recent_predictions(predictions: DataFrame, models: DataFrame, limit: int = 25) -> DataFrame:
    """Newest first: the top-n runs before the join, so only n rows meet the models."""
    newest = predictions.orderBy(F.desc("id")).limit(limit)
    return newest.join(models.select("model_id", "name"), "model_id").select(
        "id", iso_seconds(F.col("ts")).alias("ts"), F.col("name").alias("model"),
        F.col("predicted_label").alias("label"), "confidence",
        F.col("message_preview").alias("message"), "source").orderBy(F.desc("id"))


def recent_batch_runs(runs: DataFrame, models: DataFrame, limit: int = 25) -> DataFrame:
    newest = runs.orderBy(F.desc("id")).limit(limit)
    return newest.join(models.select("model_id", "name"), "model_id").select(
        "id", iso_seconds(F.col("ts")).alias("ts"), F.col("repo_path").alias("repo"), "n_commits",
        F.col("name").alias("model")).orderBy(F.desc("id"))


def with_batch_run(predictions: DataFrame, runs: DataFrame) -> DataFrame:
    """Predictions with their batch run, where they have one."""
    named = runs.select(F.col("id").alias("batch_run_id"), "repo_path", "n_commits")
    # Most predictions have no run; as one null key they would meet in one task.
    alone = predictions.filter("batch_run_id IS NULL")
    joined = predictions.filter("batch_run_id IS NOT NULL").join(named, "batch_run_id", "left")
    nothing = {c: F.lit(None).cast(named.schema[c].dataType) for c in ("repo_path", "n_commits")}
    return joined.unionByName(alone.withColumns(nothing))


def label_distribution(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy(F.col("predicted_label").alias("label")).agg(F.count("*").alias("n"))
