"""Label counts, fractions, class weights, histograms, overlap and conservation checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.operators.cleaning import class_index
from gitsift.session import measured


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def label_fractions(df: DataFrame, by: str = "split", label: str = "label") -> DataFrame:
    """Share of each label inside each split, 4 decimals."""
    counts = df.groupBy(by, label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(by))  # one row per label
    return counts.select(by, label, F.round(F.col("n") / total, 4).alias("fraction"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """n / (k * n_c) over the classes present; an absent class has no row."""
    counts = label_counts(df, label)
    every = Window.partitionBy(F.lit(0))  # one row per class
    return counts.select(
        label, "n",
        (F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))).alias("weight"),
    )


def attach_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    weights = measured(class_weights(df, label).select(label, "weight"), "class-weights")
    return df.join(weights, label)


def target_classes(spark: SparkSession) -> DataFrame:
    """The class dimension: ``class_idx, label``."""
    classes = F.array(*map(F.lit, fv.TARGET_CLASSES))
    return spark.range(1).select(F.posexplode(classes).alias("class_idx", "label"))


def label_histogram(df: DataFrame, label: str = "label") -> DataFrame:
    """All five classes with count (zero if unseen) and percent, 1 decimal."""
    counts = label_counts(df, label).withColumnRenamed(label, "label")
    filled = target_classes(df.sparkSession).join(counts, "label", "left").fillna(0, ["n"])
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # five rows
    return filled.select(
        "class_idx", "label", "n",
        F.round(F.when(total > 0, F.col("n") * 100 / total).otherwise(0.0), 1).alias("pct"),
    )


def histogram_summary(histogram: DataFrame) -> DataFrame:
    """Commits seen, dominant class (first in class order on a tie) and classes seen."""
    return histogram.agg(
        F.sum("n").alias("n_commits"),
        F.max_by("label", F.struct("n", -F.col("class_idx"))).alias("dominant"),
        F.count_if(F.col("n") > 0).alias("classes_seen"),
    )


def text_key(*columns: str) -> Column:
    """Digest of texts, so that comparing and shuffling keys stays narrow."""
    parts = [c for name in columns for c in (F.col(name), F.lit("\u0001"))]
    return F.sha2(F.concat(*parts), 256)


def split_overlap(df: DataFrame, left: str = "train", right: str = "test") -> DataFrame:
    """Distinct (message, diff) of ``right`` that also occur in ``left``, and their share."""
    key = text_key("message_clean", "diff_text").alias("key")
    test_keys = df.filter(F.col("split") == right).select(key).distinct()
    train_keys = df.filter(F.col("split") == left).select(key).distinct()
    shared = test_keys.join(train_keys.withColumn("shared", F.lit(1)), "key", "left")
    n, hit = F.count("*"), F.count("shared")
    return shared.agg(
        n.alias("n_keys"), hit.alias("n_shared"),
        F.round(hit / F.greatest(n, F.lit(1)), 6).alias("ratio"),
    )


def shared_keys(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct key tuples present on both sides."""
    return left.select(*columns).intersect(right.select(*columns))


def conservation(whole: DataFrame, parts: DataFrame, columns: list[str]) -> DataFrame:
    """Row counts of a table and of its parts, and rows missing on either side.

    One pass over the union, counted per digest, instead of two set differences.
    """
    key = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias("key")
    tagged = whole.select(key, F.lit(1).alias("side")).unionByName(
        parts.select(key, F.lit(-1).alias("side"))
    )
    per_key = tagged.groupBy("key").agg(
        F.count_if(F.col("side") == 1).alias("a"), F.count_if(F.col("side") == -1).alias("b")
    )
    return per_key.agg(
        F.sum("a").alias("n_whole"), F.sum("b").alias("n_parts"),
        F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("n_missing"),
        F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("n_extra"),
    )


def with_label_id(df: DataFrame, label: str = "label") -> DataFrame:
    return df.withColumn("label_id", class_index(F.col(label)))
