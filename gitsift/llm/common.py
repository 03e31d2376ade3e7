"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as white space in the word and line contracts, as a character class body.
ASCII_SPACE = "\\x20\\x09-\\x0D"
#: The same characters, to trim by.
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Bytes of a batch that a worker takes apart at once; Spark's own batches are counted in rows.
SLICE_BYTES = 8 << 20


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else.

    ``lower`` would also change É or İ, and is far quicker than ``translate``, so
    texts of plain ASCII, where both agree, take it.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id but different texts apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def one_of_equals(df: DataFrame) -> DataFrame:
    """Of rows equal in doc_id and text, one: that of the smallest hash of its other columns.

    The hash is taken of the columns as JSON, so any type may be among them.
    """
    rest = [name for name in df.columns if name not in ("doc_id", "text")]
    if not rest:
        return df.distinct()
    row = F.struct(*(F.col(f"`{name}`") for name in rest))
    chosen = df.groupBy("doc_id", "text").agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("_gs_row"))
    return chosen.select(*(F.col("_gs_row").getField(name).alias(name) if name in rest else F.col(name)
                           for name in df.columns))


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of that many bytes at most or of one row."""
    if batch.nbytes <= most or batch.num_rows < 2:
        yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), most)
    yield from slices(batch.slice(half), most)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` for a function of some rows, ``slices`` of a batch; ``None`` gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = function(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the half-open spans."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes a table that this library wrote to its work folder, once nothing reads it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
