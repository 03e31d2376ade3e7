"""Line dedup with DataFrame functions only.

Lines are exploded to (key digest, document, position), never with their text. One
aggregate with map-side combine finds for each key whether enough documents hold it
and which document is the first. A second pass joins the keys back; a key in a third
of all documents makes one large group on one side of that join only, which Spark's
skew handling splits. Texts move once, to meet the positions they lose.

* null or empty text: one empty line, which is never dropped.
* rows without doc_id: nothing says which document they are, so they neither count as
  holders of a line nor lose lines; ``kept`` is their text, null as empty.
* repeated rows: rows of one doc_id are one document; each comes back, equal ones
  alike. A line that only rows of one doc_id hold is not shared.
* ties: the smallest doc_id keeps all its lines of a key.
* further columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import SPACE_CHARS, lower_ascii, text_key

#: Keys shorter than this many code points are never dropped.
MIN_KEY_CHARS = 10
#: Documents that must hold a key.
MIN_DOCUMENTS = 2


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(df: DataFrame, min_key_chars: int) -> DataFrame:
    """doc_id, row, position, key: a 128-bit digest of every line that may be dropped."""
    lines = df.select("doc_id", text_key(F.col("text")).alias("row"),
                      F.posexplode(_lines(lower_ascii(F.col("text")))).alias("position", "line"))
    key = F.btrim("line", F.lit(SPACE_CHARS))
    return (lines.select("doc_id", "row", "position", key.alias("line"))
            .filter(F.char_length("line") >= min_key_chars)
            .select("doc_id", "row", "position", F.unhex(F.md5("line")).alias("key")))


def shared_keys(keys: DataFrame, min_documents: int) -> DataFrame:
    """key, keeper of the keys that at least ``min_documents`` documents hold."""
    if min_documents == 2:
        # Two documents are there exactly if the smallest doc_id isn't the largest.
        found = keys.groupBy("key").agg(F.min("doc_id").alias("keeper"),
                                        F.max("doc_id").alias("last"))
        return found.filter("keeper < last").select("key", "keeper")
    held = keys.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    found = held.groupBy("key").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n"))
    return found.filter(F.col("n") >= min_documents).select("key", "keeper")


def _with_kept(df: DataFrame, min_key_chars: int, min_documents: int) -> DataFrame:
    """The rows of ``df`` with _gs_lines, _gs_dropped and _gs_kept, the reassembled text."""
    docs = df.withColumn("_gs_row", text_key(F.col("text")))
    keys = line_keys(df.filter("doc_id IS NOT NULL"), min_key_chars)
    # Repeated rows hold equal positions, which one of them is enough to find.
    dropped = (keys.join(shared_keys(keys, min_documents), "key")
               .filter("doc_id > keeper")
               .groupBy(F.col("doc_id").alias("_gs_id"), F.col("row").alias("_gs_text"))
               .agg(F.collect_set("position").alias("_gs_drop")))
    lines = _lines(F.col("text"))
    size = F.size("_gs_split")
    # Linear in the number of lines: the places that stay, then the lines at those places.
    stay = F.array_except(F.sequence(F.lit(0), size - 1), F.col("_gs_drop"))
    picked = F.transform(F.array(F.struct(F.col("_gs_split").alias("lines"), stay.alias("stay"))), lambda s: F.transform(
        s["stay"], lambda i: F.get(s["lines"], i)))
    kept = (F.when(F.col("_gs_drop").isNull(), F.coalesce(F.col("text"), F.lit("")))
            .otherwise(F.array_join(F.get(picked, F.lit(0)), "\n")))
    joined = docs.join(dropped, (F.col("doc_id") == F.col("_gs_id")) & (F.col("_gs_row") == F.col("_gs_text")), "left")
    return (joined.drop("_gs_id", "_gs_text", "_gs_row").withColumn("_gs_split", lines)
            .withColumns({"_gs_lines": size.cast("long"), "_gs_kept": kept,
                          "_gs_dropped": F.coalesce(F.size("_gs_drop"), F.lit(0)).cast("long")})
            .drop("_gs_split", "_gs_drop"))


def drop_lines(df: DataFrame, min_key_chars: int = MIN_KEY_CHARS,
               min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept of every row; ``kept`` is the reassembled text."""
    found = _with_kept(df.select("doc_id", "text"), min_key_chars, min_documents)
    return found.select("doc_id", F.col("_gs_lines").alias("n_lines"),
                        F.col("_gs_dropped").alias("n_dropped"), F.col("_gs_kept").alias("kept"))


def replace_texts(df: DataFrame, min_key_chars: int = MIN_KEY_CHARS,
                  min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The rows of ``df``, all columns, with the reassembled texts; n_chars follows if there is one."""
    found = _with_kept(df, min_key_chars, min_documents)
    new = {"text": F.when(F.col("text").isNotNull(), F.col("_gs_kept"))}
    if "n_chars" in df.columns:
        new["n_chars"] = F.when(F.col("_gs_dropped") > 0, F.char_length("_gs_kept").cast("long")).otherwise(F.col("n_chars"))
    return found.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])
