"""Diff text: one text per commit, line statistics, line kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitsift import fixed_values as fv
from gitsift.functions.text import let, lines, strip


def _field(item: Column, names: set[str], *wanted: str) -> Column:
    present = [F.nullif(item[name], F.lit("")) for name in wanted if name in names]
    return F.coalesce(*present, F.lit(""))


def join_files(files: Column, names: set[str]) -> Column:
    """Multi-file diff as one text: a header per file, then its body if any."""

    def one(item: Column) -> Column:
        header = F.concat(
            F.lit("diff --git a/"), _field(item, names, "old_path", "filename"),
            F.lit(" b/"), _field(item, names, "new_path", "filename"),
        )
        body = _field(item, names, "diff", "patch")
        return F.when(body == "", header).otherwise(F.concat(header, F.lit("\n"), body))

    present = F.filter(files, lambda item: item.isNotNull())
    return F.coalesce(F.array_join(F.transform(present, one), "\n"), F.lit(""))


def normalise_diff(df: DataFrame, column: str) -> Column:
    """A text column as it is, a list of files joined, anything else ``""``."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(column), F.lit(""))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return join_files(F.col(column), set(kind.elementType.names))
    return F.lit("")


def diff_stats(text: Column, max_chars: int | None = None) -> Column:
    """Counts over the whole text, and the text, cut only if ``max_chars`` says so."""

    def counted(ls: Column) -> Column:
        def count(wanted: str, unwanted: str) -> Column:
            kept = F.filter(
                ls, lambda line: line.startswith(wanted) & ~line.startswith(unwanted)
            )
            return F.size(kept).cast("int")

        files = F.size(F.filter(ls, lambda line: line.startswith("diff --git")))
        return F.struct(
            F.when(text == "", 0).otherwise(F.greatest(files, F.lit(1))).cast("int")
            .alias("files_changed"),
            count("+", "+++").alias("lines_added"),
            count("-", "---").alias("lines_removed"),
        )

    stats = let(lines(text), counted)
    return F.struct(
        (text if max_chars is None else F.substring(text, 1, max_chars)).alias("diff_text"),
        stats["files_changed"].alias("files_changed"),
        stats["lines_added"].alias("lines_added"),
        stats["lines_removed"].alias("lines_removed"),
    )


def line_kind(line: Column) -> Column:
    header = line.startswith("+++") | line.startswith("---") | line.startswith("diff ")
    return (
        F.when(header, "context")
        .when(line.startswith("+"), "added")
        .when(line.startswith("-"), "removed")
        .otherwise("context")
    )


def diff_view(df: DataFrame, text_column: str, max_lines: int = fv.DIFF_VIEW_LINES) -> DataFrame:
    """One row per shown line: position from 0, line, kind. Blank diffs show nothing."""
    shown = F.slice(lines(F.col(text_column)), 1, max_lines)
    kept = [c for c in df.columns if c != text_column]
    return (
        df.filter(strip(F.col(text_column)) != "")
        .select(*kept, F.posexplode(shown).alias("line_no", "line"))
        .withColumn("kind", line_kind(F.col("line")))
    )
