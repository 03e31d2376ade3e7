"""Append-only table of run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def append_summaries(summaries: DataFrame, path: str) -> None:
    """CSV parts each carry the header, so a reader never depends on append order."""
    summaries.write.mode("append").option("header", True).csv(path)


def read_summaries(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)
