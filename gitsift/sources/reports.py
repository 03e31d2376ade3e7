"""Evaluation reports as JSON files, and the tables read back from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = """
  model_name string, n_samples bigint, accuracy double, macro_f1 double, weighted_f1 double,
  macro_precision double, macro_recall double, confusion_matrix array<array<bigint>>,
  labels_order array<string>,
  per_class map<string, struct<precision: double, recall: double, f1: double, support: bigint>>"""


def save_reports(report: DataFrame, path: str, name: str) -> None:
    """One folder of JSON per report, named after the column ``name``."""
    from gitsift.functions.probabilities import class_array

    out = report.withColumn("model_name", F.col(name)).withColumn("labels_order", class_array())
    columns = [c.split()[0] for c in (
        "model_name", "n_samples", "accuracy", "macro_f1", "weighted_f1", "macro_precision",
        "macro_recall", "confusion_matrix", "labels_order", "per_class")]
    out.select(F.col(name).alias("report"), *columns).write.mode("overwrite").partitionBy(
        "report").json(path)


def load_reports(
    spark: SparkSession, path: str, pattern: str = "*", skip_suffix: str | None = "_val"
) -> DataFrame:
    """Reports whose name fits ``pattern``, without those ending in ``skip_suffix``."""
    df = (
        spark.read.schema(REPORT_SCHEMA + ", report string")
        .option("basePath", path)
        .json(f"{path}/report={pattern}")
    )
    if skip_suffix:
        df = df.filter(~F.col("report").endswith(skip_suffix))
    return df


def write_run_documents(
    summary: DataFrame, report: DataFrame, rows: DataFrame, keys: Sequence[str], path: str
) -> None:
    """``{summary, full_report}`` per run, and its rows beside them.

    A run may have any number of rows, so they are a table partitioned like the
    documents and not an array inside one record.
    """
    ids = list(keys)
    packed = summary.select(*ids, F.struct(*summary.columns).alias("summary")).join(
        report.select(*ids, F.struct(*report.columns).alias("full_report")), ids)
    packed.write.mode("overwrite").json(f"{path}/documents")
    rows.write.mode("overwrite").partitionBy(*ids).json(f"{path}/rows")


def read_run_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/documents")
