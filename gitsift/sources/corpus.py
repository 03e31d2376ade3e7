"""Corpus tables: candidates, first-N reads, Parquet, CSV samples, metadata, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.operators.cleaning import class_index
from gitsift.session import shuffles_removed


def first_rows(df: DataFrame, limit: int) -> DataFrame:
    return df.limit(limit)


def try_load(
    spark: SparkSession, candidate: Mapping[str, str], sample: int | None = None
) -> DataFrame | None:
    """Read ``{"path", "format"}``; null when it cannot be read or has no row."""
    try:
        df = spark.read.format(candidate.get("format", "parquet")).load(candidate["path"])
        if df.isEmpty():
            return None
    except PySparkException:
        return None
    return df if sample is None else first_rows(df, sample)


def load_corpus(
    spark: SparkSession, candidates: Sequence[Mapping[str, str]], sample: int | None = None
) -> tuple[Mapping[str, str], DataFrame]:
    """The first candidate that can be read and is not empty."""
    for candidate in candidates:
        df = try_load(spark, candidate, sample)
        if df is not None:
            return candidate, df
    raise FileNotFoundError(f"no readable corpus among {[c['path'] for c in candidates]}")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet and read the written table back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv_sample(df: DataFrame, path: str, rows: int = fv.HEAD_SAMPLE_ROWS) -> None:
    text = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c)
            for c, t in df.dtypes]
    first_rows(df.select(*text), rows).write.mode("overwrite").csv(
        path, header=True, escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(
        path, schema=schema, header=True, multiLine=True, escape='"',
        nullValue="\u0000", emptyValue="",
    )


def describe_corpus(df: DataFrame, source: str, split: str, limit: int | None = None) -> DataFrame:
    """One row: source, split, row count, columns, whether a row cap was used."""
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(source).alias("source_dataset"), F.lit(split).alias("split"), "n_rows",
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        F.lit(limit is not None).alias("sample_mode"),
        F.lit(limit).cast("long").alias("row_limit"),
    )


def write_splits(df: DataFrame, path: str) -> None:
    """One table, a folder per split, so that reading one split prunes the others."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Splits with null texts as ``""`` and the class index; one split if named."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.filter(F.col("split") == split)
    return df.fillna("", ["message_clean", "diff_text"]).withColumn(
        "label_id", class_index(F.col("label"))
    )
