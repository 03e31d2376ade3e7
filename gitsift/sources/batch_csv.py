"""Batch scoring of CSV files."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gitsift.functions.probabilities import as_json
from gitsift.functions.text import preview
from gitsift.operators.scoring import Scorer, score
from gitsift.session import materialise, measured
from gitsift.sources.history import Log

#: How the log names rows that come from files.
LOG_SOURCE = "cli-batch"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, number, record)``: the records of CSV files whose quoted fields may hold line breaks.

    Spark cannot split such a file, as it does not see from its middle whether a line break
    is quoted. Here lines are read, which it can split, in two passes. The first counts the
    quotes of each byte range; whether a range begins inside a quoted field is then known
    from the parity of all quotes before it (a doubled quote changes nothing). The second
    cuts the lines into records: one begins with every line that is not inside a field. So
    only the lines of one byte range are ever put in order by one task, and the table that
    carries parity and numbers over has a row a range.

    ``number`` counts the records of a file from 1 (the header). Line breaks inside fields
    stay as they are. Empty lines between records are no records.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"), F.col("value"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    one_range = Window.partitionBy("file", "range").orderBy("line")
    earlier_lines = one_range.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    blank = F.col("value").isin("", "\r")

    odd = measured(lines.groupBy("file", "range").agg(F.sum(quotes).alias("quotes")).select(
        "file", "range", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("before")), "parities")
    inside = (F.coalesce(F.sum(quotes).over(earlier_lines), F.lit(0)) + F.col("before")) % 2 == 1
    placed = lines.join(odd, ["file", "range"]).withColumn("inside", inside)
    kept = placed.filter(F.col("inside") | ~blank).withColumn("first", (~F.col("inside")).cast("int"))
    numbered = materialise(kept.withColumn("nth", F.sum("first").over(one_range)).select(
        "file", "range", "line", "value", "nth", "first"), "csv-lines")
    starts = measured(numbered.groupBy("file", "range").agg(F.sum("first").alias("n")).select(
        "file", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead")), "csv-ranges")
    whole = numbered.join(starts, ["file", "range"]).groupBy("file", (F.col("nth") + F.col("ahead")).alias("number"))
    parts = F.sort_array(F.collect_list(F.struct("range", "line", "value")))
    text = F.array_join(F.transform(parts, lambda x: x["value"]), "\n")
    return whole.agg(F.regexp_replace(text, "\r$", "").alias("record"))


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """``message`` and optional ``diff`` (else ``""``) of CSV files, each row with an id.

    Texts may hold line breaks; large files are split all the same. All files have the
    header of the first.
    """
    records = materialise(read_records(spark, path), "csv-records")
    header = records.filter(F.col("number") == 1).orderBy("file").first()
    names = next(csv.reader([header["record"]])) if header else []
    fields = ", ".join(f"c{i} string" for i in range(max(1, len(names))))
    options = {"escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    parsed = records.filter(F.col("number") > 1).select(F.from_csv("record", fields, options).alias("r"))
    columns = [F.coalesce(F.col(f"r.c{names.index(c)}"), F.lit("")).alias(c) if c in names else F.lit("").alias(c)
               for c in ("message", "diff")]
    # The id only joins scores back to their text, so any distinct number does; the
    # rows are fixed in a digest to stay the same when a lost task is run again.
    digest = F.sha2(F.concat("message", F.lit("\u0001"), "diff"), 256)
    return parsed.select(*columns).withColumn("commit_id", digest)


def score_csv(
    spark: SparkSession, path: str, model: str, scorers: Mapping[str, Scorer], out: str,
    log: Log | None = None, batch: int = 0,
) -> None:
    """CSV in, CSV out: message, predicted label, confidence (4 decimals), probabilities (JSON).

    Rows with equal text get equal answers, so each text is scored once, and logged once
    if a log is given: as that batch of its writer, by an id made of the text.
    """
    rows = read_commits(spark, path)
    texts = rows.dropDuplicates(["commit_id"])
    scored = score(texts, model, scorers)
    if log:
        scored = materialise(scored, "scored")
        # The log keeps previews, so whole texts are not moved for it.
        shown = rows.select("commit_id", *[preview(F.col(c)).alias(c) for c in ("message", "diff")])
        log.write(shown.dropDuplicates(["commit_id"]).join(scored, "commit_id").select(
            F.xxhash64("commit_id").alias("id"), F.current_timestamp().alias("ts"), "model",
            F.lit(None).cast("bigint").alias("batch_run_id"), "message", "diff", "label", "confidence",
            "probabilities", F.lit(LOG_SOURCE).alias("source")), batch)
    result = rows.select("commit_id", "message").join(scored, "commit_id").select(
        "message", F.col("label").alias("predicted_label"),
        F.format_string("%.4f", "confidence").alias("confidence"),
        as_json(F.col("probs")).alias("probabilities"))
    result.write.mode("overwrite").csv(
        out, header=True, escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
