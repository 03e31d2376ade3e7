"""Raw commits to clean commits: resolve columns, label, strip, count, filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions.diffs import diff_stats, normalise_diff
from gitsift.functions.text import commit_type, strip_prefix


def message_column(df: DataFrame) -> str:
    """The first message-like column present; an error when there is none."""
    for name in fv.MESSAGE_COLUMNS:
        if name in df.columns:
            return name
    raise KeyError(f"no message-like column among {df.columns}")


def diff_column(df: DataFrame) -> str | None:
    for name in fv.DIFF_COLUMNS:
        if name in df.columns:
            return name
    return None


def resolve_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns ``message`` and ``full_diff`` (text) whatever the corpus calls them."""
    found = diff_column(df)
    diff = normalise_diff(df, found) if found else F.lit("")
    return df.select(
        *(keep or []), F.col(message_column(df)).alias("message"), diff.alias("full_diff")
    )


def keep_targets(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label).isin(fv.TARGET_CLASSES))


def drop_empty_messages(df: DataFrame, message: str = "message_clean") -> DataFrame:
    return df.filter(F.length(message) > 0)


def features_of(df: DataFrame) -> DataFrame:
    """Clean whole texts and numeric features of (``message``, ``full_diff``), labels aside."""
    stats = diff_stats(F.col("full_diff"))
    kept = [c for c in df.columns if c not in ("message", "full_diff")]
    return df.select(
        *kept, strip_prefix(F.col("message")).alias("message_clean"), stats.alias("stats")
    ).select(*kept, "message_clean", "stats.*")


def clean_commits(df: DataFrame, id_column: str = "commit_id") -> DataFrame:
    """The fixed clean columns plus the stable id.

    The label filter runs before any diff work, so other rows cost only the
    first line of their message.
    """
    resolved = resolve_columns(df, keep=[id_column])
    labelled = keep_targets(resolved.withColumn("label", commit_type(F.col("message"))))
    featured = drop_empty_messages(features_of(labelled))
    return featured.select(id_column, *fv.CLEAN_COLUMNS)


def class_index(label: Column) -> Column:
    """Index 0..4 of a target class, null for anything else."""
    position = F.array_position(F.array(*map(F.lit, fv.TARGET_CLASSES)), label)
    return F.nullif(position, F.lit(0).cast("long")).cast("int") - 1


def class_name(index: Column) -> Column:
    return F.get(F.array(*map(F.lit, fv.TARGET_CLASSES)), index.cast("int"))


def or_fallback(label: Column) -> Column:
    """Unknown, blank or null labels count as the fallback class."""
    return F.when(label.isin(fv.TARGET_CLASSES), label).otherwise(fv.FALLBACK_CLASS)
