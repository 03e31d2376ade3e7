"""Reproducible splits and samples with no hot group.

Every "random" order is the md5 of seed and id. A sample keeps the rows whose
rank inside their class is at or below a cut. Ranking a class with a window
would send it whole to one task, so ranks are not computed: a count per (class,
hash bucket) finds the bucket a cut falls in, only that bucket is ranked, and
the key found there becomes a threshold. All rows are then placed by comparing
their key with a handful of thresholds joined by broadcast: the wide rows are
never shuffled, and no task holds a class.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.session import measured

BUCKET_HEX_DIGITS = 4  # 65,536 buckets per class


def hash_key(id_column: str, seed: int) -> Column:
    """Order key: md5 of ``seed|id``, the id behind it so that keys are distinct."""
    text = F.concat(F.lit(f"{seed}|"), F.col(id_column).cast("string"))
    return F.concat(F.md5(text.cast("binary")), F.lit("|"), F.col(id_column).cast("string"))


def rank_thresholds(
    df: DataFrame,
    group: str,
    id_column: str,
    seed: int,
    cuts: Callable[[Column, Column], Sequence[Column]],
) -> DataFrame:
    """Per group: its size and, for each cut, the key of the row ranked there.

    ``cuts(n, smallest)`` gives the ranks as columns of the group size and of the
    smallest group's size. Cut 0 gives ``""`` (below every key); a cut at or past
    the group size gives null (above every key).
    """
    keyed = df.select(F.col(group).alias("grp"), hash_key(id_column, seed).alias("key")).withColumn(
        "bucket", F.conv(F.substring("key", 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")
    )
    # At most 65,536 rows per class, used twice below: written so that df is read once for it.
    counts = measured(keyed.groupBy("grp", "bucket").agg(F.count("*").alias("cnt")), "bucket-counts")
    sizes = counts.groupBy("grp").agg(F.sum("cnt").alias("n"))
    smallest = F.min("n").over(Window.partitionBy(F.lit(0)))  # one row per group
    wanted = sizes.withColumn("smallest", smallest)
    ranks = [c.cast("long") for c in cuts(F.col("n"), F.col("smallest"))]
    wanted = wanted.withColumn("ranks", F.array(*ranks)).select(
        "grp", "n", F.posexplode("ranks").alias("cut_no", "rank")
    )
    up_to = Window.partitionBy("grp").orderBy("bucket")  # at most 65,536 rows per group
    spans = counts.withColumn("upto", F.sum("cnt").over(up_to))
    hit = measured(
        wanted.filter((F.col("rank") > 0) & (F.col("rank") < F.col("n")))
        .join(spans, "grp")
        .filter((F.col("rank") > F.col("upto") - F.col("cnt")) & (F.col("rank") <= F.col("upto")))
        .select(
            "grp", "cut_no", "bucket",
            (F.col("rank") - F.col("upto") + F.col("cnt")).alias("rank_in_bucket"),
        ),
        "cut-buckets",
    )
    in_bucket = Window.partitionBy("grp", "cut_no").orderBy("key")
    found = (
        keyed.join(hit, ["grp", "bucket"])
        .withColumn("r", F.row_number().over(in_bucket))
        .filter(F.col("r") == F.col("rank_in_bucket"))
        .select("grp", "cut_no", "key")
    )
    placed = wanted.join(found, ["grp", "cut_no"], "left").withColumn(
        "key", F.when(F.col("rank") <= 0, F.lit("")).otherwise(F.col("key"))
    )
    return placed.groupBy("grp").agg(
        F.first("n").alias("n"),
        F.transform(
            F.sort_array(F.collect_list(F.struct("cut_no", "key"))), lambda s: s["key"]
        ).alias("thresholds"),
    )


def place(
    df: DataFrame,
    group: str,
    id_column: str,
    seed: int,
    cuts: Callable[[Column, Column], Sequence[Column]],
) -> DataFrame:
    """Adds ``segment``: how many cuts lie below the row's rank in its group.

    The thresholds hold one row per class and are joined by their measured size.
    """
    thresholds = measured(rank_thresholds(df, group, id_column, seed, cuts), "thresholds")
    key = hash_key(id_column, seed)
    passed = F.size(F.filter("thresholds", lambda t: t.isNotNull() & (F.col("_key") > t)))
    return (
        df.withColumn("_key", key)
        .join(thresholds.withColumnRenamed("grp", group), group)
        .withColumn("segment", passed)
        .drop("_key", "thresholds", "n")
    )


def take_per_class(
    df: DataFrame,
    size: Callable[[Column, Column], Column],
    seed: int = fv.SEED,
    label: str = "label",
    id_column: str = "commit_id",
) -> DataFrame:
    """Per class the rows of lowest hash, as many as ``size(n, smallest)`` says."""
    placed = place(df, label, id_column, seed, lambda n, smallest: [size(n, smallest)])
    return placed.filter(F.col("segment") == 0).select(*df.columns)


def stratified_split(
    df: DataFrame, seed: int = fv.SEED, label: str = "label", id_column: str = "commit_id"
) -> DataFrame:
    """70/15/15 inside every class: whole twentieths of the class size, rounded down."""
    first, second = fv.TRAIN_TWENTIETHS, fv.TRAIN_TWENTIETHS + fv.VALIDATION_TWENTIETHS
    placed = place(
        df, label, id_column, seed,
        lambda n, _: [F.floor(n * first / 20), F.floor(n * second / 20)],
    )
    name = F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), F.col("segment") + 1)
    return placed.withColumn("split", name).select(*df.columns, "split")


def text_group(seed: int, columns: Sequence[str]) -> Column:
    """Order key of a group of rows with equal texts."""
    parts = [c for name in columns for c in (F.lit("\u0001"), F.coalesce(name, F.lit("")))][1:]
    return F.md5(F.concat(F.lit(f"{seed}|"), *parts).cast("binary"))


def weighted_thresholds(groups: DataFrame, cuts: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """Per class of ``groups(grp, key, size)``: for each cut, the last key placed below it.

    Groups lie one after the other in key order, as long as they have rows, and a group is
    below a cut if its middle is. ``cuts(n)`` gives the cuts as columns of the class size.
    As with ``rank_thresholds``, only the bucket in which a cut falls is put in order.
    """
    keyed = groups.withColumn("prefix", F.substring("key", 1, BUCKET_HEX_DIGITS))
    weights = measured(keyed.groupBy("grp", "prefix").agg(F.sum("size").alias("weight")), "bucket-weights")
    up_to = Window.partitionBy("grp").orderBy("prefix")  # at most 65,536 rows per class
    spans = weights.withColumn("upto", F.sum("weight").over(up_to)).withColumn(
        "before", F.col("upto") - F.col("weight"))
    sizes = weights.groupBy("grp").agg(F.sum("weight").alias("n"))
    wanted = sizes.select("grp", F.posexplode(F.array(*[c.cast("long") for c in cuts(F.col("n"))]))
                          .alias("cut_no", "cut"))
    hit = measured(wanted.join(spans, "grp").filter(
        (F.col("cut") > F.col("before")) & (F.col("cut") <= F.col("upto"))).select(
        "grp", "cut_no", "cut", "prefix", "before"), "cut-buckets")
    inside = Window.partitionBy("grp", "cut_no").orderBy("key")
    middle = 2 * (F.col("before") + F.sum("size").over(inside)) - F.col("size")
    below = keyed.join(hit, ["grp", "prefix"]).withColumn("middle", middle).groupBy("grp", "cut_no").agg(
        # The bare prefix comes before every key of its bucket and after all earlier ones.
        F.coalesce(F.max(F.when(F.col("middle") <= 2 * F.col("cut"), F.col("key"))), F.max("prefix")).alias("key"))
    placed = wanted.join(below, ["grp", "cut_no"], "left").withColumn("key", F.coalesce("key", F.lit("")))
    return placed.groupBy("grp").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("cut_no", "key"))), lambda t: t["key"]).alias("thresholds"))


def group_split(
    df: DataFrame, seed: int = fv.SEED, label: str = "label",
    texts: Sequence[str] = ("message_clean", "diff_text"),
) -> DataFrame:
    """70/15/15 inside every class, with rows of equal texts in one split.

    A group of equal texts belongs to the class that most of its rows have (the first by
    name on a tie) and goes whole to the split that holds its middle, in the order of the
    groups' hashes; so every share is right to within half a group. Groups are counted
    before they are moved, however many rows one has, and the rows themselves only meet
    the thresholds, and those groups that hold several classes.
    """
    first, second = fv.TRAIN_TWENTIETHS, fv.TRAIN_TWENTIETHS + fv.VALIDATION_TWENTIETHS
    keyed = df.withColumn("_key", text_group(seed, texts))
    counted = keyed.groupBy("_key", label).agg(F.count("*").alias("rows"))
    groups = measured(counted.groupBy(F.col("_key").alias("key")).agg(
        F.min_by(F.col(label), F.struct(-F.col("rows"), F.col(label))).alias("grp"),
        F.sum("rows").alias("size"), F.count("*").alias("classes")), "text-groups")
    thresholds = measured(weighted_thresholds(
        groups, lambda n: [F.floor(n * first / 20), F.floor(n * second / 20)]), "thresholds")
    mixed = measured(groups.filter(F.col("classes") > 1).select(
        F.col("key").alias("_key"), F.col("grp").alias("_class")), "mixed-groups")
    passed = F.size(F.filter("thresholds", lambda t: F.col("_key") > t))
    name = F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), passed + 1)
    return (keyed.join(mixed, "_key", "left")
            .withColumn("grp", F.coalesce("_class", F.col(label)))
            .join(thresholds, "grp").select(*df.columns, name.alias("split")))


def balanced_subsample(
    df: DataFrame,
    target_per_class: int | None = None,
    seed: int = fv.SEED,
    label: str = "label",
    id_column: str = "commit_id",
) -> DataFrame:
    """At most N rows per target class; N defaults to the smallest of all classes present."""

    def size(_: Column, smallest: Column) -> Column:
        return smallest if target_per_class is None else F.lit(target_per_class)

    taken = take_per_class(df, size, seed, label, id_column)
    return taken.filter(F.col(label).isin(fv.TARGET_CLASSES))


def budgeted_subsample(df: DataFrame, max_rows: int, **options) -> DataFrame:
    return balanced_subsample(df, max(64, max_rows // len(fv.TARGET_CLASSES)), **options)


def proportional_sample(
    df: DataFrame, max_rows: int, total: int | None = None, seed: int = fv.SEED,
    label: str = "label", id_column: str = "commit_id",
) -> DataFrame:
    """Exactly ``max_rows`` rows, each class keeping its share; all rows if fewer.

    Shares are whole by largest remainder; equal remainders go by class name.
    """
    n_total = df.count() if total is None else total
    if max_rows <= 0 or n_total <= max_rows:
        return df

    def size(n: Column, _: Column) -> Column:
        everything = Window.partitionBy(F.lit(0))  # one row per class
        whole = F.floor(n * max_rows / n_total)
        rest = F.row_number().over(everything.orderBy(F.desc((n * max_rows) % n_total), "grp"))
        return whole + (rest <= max_rows - F.sum(whole).over(everything)).cast("long")

    return take_per_class(df, size, seed, label, id_column)


def evaluation_sample(df: DataFrame, n: int, **options) -> DataFrame:
    """Equal parts of every target class: max(1, n // 5) each."""
    per_class = max(1, n // len(fv.TARGET_CLASSES))
    label = options.get("label", "label")
    targets = df.filter(F.col(label).isin(fv.TARGET_CLASSES))
    return take_per_class(targets, lambda *_: F.lit(per_class), **options)


def natural_sample(
    df: DataFrame, n: int, seed: int = fv.SEED, id_column: str = "commit_id"
) -> DataFrame:
    """``n`` rows of the natural distribution: those below one threshold, nothing sorted."""
    one = df.withColumn("_all", F.lit(0))
    return take_per_class(one, lambda *_: F.lit(n), seed, "_all", id_column).select(*df.columns)


def shuffled(df: DataFrame, seed: int = fv.SEED, id_column: str = "commit_id") -> DataFrame:
    """All rows in hash order: a range-partitioned sort that any cluster size can do."""
    return df.withColumn("shuffle_key", F.substring(hash_key(id_column, seed), 1, 32)).orderBy(
        hash_key(id_column, seed)
    )


def few_shot_pool(
    train: DataFrame, per_class: int = 1, seed: int = fv.SEED, id_column: str = "commit_id"
) -> DataFrame:
    """Examples for prompts, one row each: ``type, subject, diff`` in shuffled order."""
    from gitsift.functions.text import subject

    return evaluation_sample(
        train, per_class * len(fv.TARGET_CLASSES), seed=seed, id_column=id_column
    ).select(
        hash_key(id_column, seed).alias("order_key"), id_column,
        F.col("label").alias("type"),
        subject(F.col("message_clean"), fv.FEW_SHOT_SUBJECT_CHARS).alias("subject"),
        F.col("diff_text").alias("diff"),
    )


def as_examples(pool: DataFrame) -> DataFrame:
    """The pool as one row holding ``examples: array<struct<type,subject,diff>>``.

    The pool has a few rows per class by construction, so one row is bounded.
    """
    ordered = F.sort_array(F.collect_list(F.struct("order_key", "type", "subject", "diff")))
    return pool.agg(
        F.transform(
            ordered, lambda e: F.struct(e["type"].alias("type"), e["subject"].alias("subject"),
                                        e["diff"].alias("diff"))
        ).alias("examples")
    )
