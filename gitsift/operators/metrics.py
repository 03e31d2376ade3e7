"""Confusion matrix and the metrics read from it, for any number of runs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitsift import fixed_values as fv

K = len(fv.TARGET_CLASSES)
AVERAGES = ["macro_precision", "macro_recall", "macro_f1",
            "weighted_precision", "weighted_recall", "weighted_f1"]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _total(columns: Sequence[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def confusion_counts(
    df: DataFrame, keys: Sequence[str] = (), gold: str = "gold", pred: str = "pred"
) -> DataFrame:
    return df.groupBy(*keys, gold, pred).agg(F.count("*").alias("n"))


def confusion_matrix(
    df: DataFrame, keys: Sequence[str] = (), gold: str = "gold", pred: str = "pred"
) -> DataFrame:
    """25 rows per run, zero-filled, in class order."""
    counts = confusion_counts(df, keys, gold, pred)
    sums = [
        F.coalesce(F.sum(F.when((F.col(gold) == g) & (F.col(pred) == p), F.col("n"))), F.lit(0))
        for g in fv.TARGET_CLASSES for p in fv.TARGET_CLASSES
    ]
    cells = [
        F.struct(F.lit(g).alias("gold"), F.lit(p).alias("pred"), sums[i * K + j].alias("n"))
        for i, g in enumerate(fv.TARGET_CLASSES) for j, p in enumerate(fv.TARGET_CLASSES)
    ]
    return counts.groupBy(*keys).agg(F.array(*cells).alias("cells")).select(
        *keys, F.explode("cells").alias("cell")).select(*keys, "cell.*")


def metrics_from_counts(counts: DataFrame, keys: Sequence[str] = (), gold: str = "gold",
                        pred: str = "pred") -> DataFrame:
    """One row per run from (run, gold, pred, n): accuracy, averages, matrix, per class."""
    names = fv.TARGET_CLASSES

    def cell(g: str, p: str) -> Column:
        hit = (F.col(gold) == g) & (F.col(pred) == p)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    matrix = counts.groupBy(*keys).agg(
        F.sum("n").alias("n_samples"),
        F.sum(F.when(F.col(gold) == F.col(pred), F.col("n")).otherwise(0)).alias("n_right"),
        *[cell(g, p).alias(f"m{i}{j}") for i, g in enumerate(names) for j, p in enumerate(names)],
    )
    m = [[F.col(f"m{i}{j}") for j in range(K)] for i in range(K)]
    support = [_total(m[i]) for i in range(K)]
    named = [_total([m[i][j] for i in range(K)]) for j in range(K)]
    scored = matrix.select(
        *keys, "n_samples", "n_right",
        F.array(*[F.array(*row) for row in m]).alias("confusion_matrix"),
        *[_ratio(m[i][i], named[i]).alias(f"p{i}") for i in range(K)],
        *[_ratio(m[i][i], support[i]).alias(f"r{i}") for i in range(K)],
        *[_ratio(2 * m[i][i], named[i] + support[i]).alias(f"f{i}") for i in range(K)],
        *[support[i].alias(f"s{i}") for i in range(K)],
        _total([(support[i] + named[i] > 0).cast("int") for i in range(K)]).alias("n_present"),
    )
    weight = _total([F.col(f"s{i}") for i in range(K)])

    def macro(x: str) -> Column:
        return _total([F.col(f"{x}{i}") for i in range(K)]) / K

    def weighted(x: str) -> Column:
        return _ratio(_total([F.col(f"{x}{i}") * F.col(f"s{i}") for i in range(K)]), weight)

    def entry(p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("long").alias("support"))

    per_class = [
        x for i, name in enumerate(names)
        for x in (F.lit(name), entry(*[F.col(f"{c}{i}") for c in "prfs"]))
    ]
    return scored.select(
        *keys, "n_samples",
        (F.col("n_right") / F.col("n_samples")).alias("accuracy"),
        macro("p").alias("macro_precision"), macro("r").alias("macro_recall"),
        macro("f").alias("macro_f1"), weighted("p").alias("weighted_precision"),
        weighted("r").alias("weighted_recall"), weighted("f").alias("weighted_f1"),
        _ratio(_total([F.col(f"f{i}") for i in range(K)]), F.col("n_present"))
        .alias("macro_f1_present"),
        "confusion_matrix",
        F.create_map(
            *per_class,
            F.lit("macro avg"), entry(macro("p"), macro("r"), macro("f"), F.col("n_samples")),
            F.lit("weighted avg"),
            entry(weighted("p"), weighted("r"), weighted("f"), F.col("n_samples")),
        ).alias("per_class"),
    )


def evaluation_report(
    df: DataFrame, keys: Sequence[str] = (), gold: str = "gold", pred: str = "pred"
) -> DataFrame:
    """Counts per (run, gold, predicted) in one shuffle; the rest works on 25 cells a run."""
    return metrics_from_counts(confusion_counts(df, keys, gold, pred), keys, gold, pred)


def per_class_metrics(report: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The report's per-class map as rows, averages left out."""
    classes = F.array(*map(F.lit, fv.TARGET_CLASSES))
    return report.select(
        *keys, F.explode(classes).alias("label"), "per_class"
    ).select(*keys, "label", F.element_at("per_class", F.col("label")).alias("m")).select(
        *keys, "label", "m.*"
    )


def comparison(reports: DataFrame, model: str = "model") -> DataFrame:
    """Model comparison table at 4 decimals."""
    scores = ["accuracy", "macro_f1", "weighted_f1", "macro_precision", "macro_recall"]
    return reports.select(
        model, *[F.round(c, 4).alias(c) for c in scores], F.col("n_samples").alias("n_test")
    )
