"""Run summaries: last and best runs, leaderboards, leaders, baseline comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitsift.operators.metrics import comparison


def last_runs(runs: DataFrame, keys: Sequence[str], order: str = "run_seq") -> DataFrame:
    """The last row per key: an aggregate with map-side combine, no window over a hot key."""
    row = F.max_by(F.struct(*runs.columns), F.col(order))
    return runs.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(row.alias("r")).select("r.*")


def best_per_model(runs: DataFrame, metric: str = "type_exact_match") -> DataFrame:
    """The best run of each model; the lower strategy name wins a tie."""
    order = F.struct(-F.col(metric), F.col("strategy"))
    row = F.min_by(F.struct(*runs.columns), order)
    return runs.groupBy(F.col("model").alias("_model")).agg(row.alias("r")).select("r.*")


def leaderboard(runs: DataFrame, metric: str, ties: Sequence[str]) -> DataFrame:
    return runs.orderBy(F.desc(metric), *ties)


def classifier_board(reports: DataFrame) -> DataFrame:
    ranked = reports.orderBy(F.desc("macro_f1"), "model")
    return comparison(ranked)


def leaders(runs: DataFrame) -> DataFrame:
    """One row: best type match, lowest median latency, highest verifier agreement."""

    def tag(column: str, order: Column) -> Column:
        name = F.concat_ws(" / ", "model", "strategy")
        return F.min_by(name, F.struct(order, F.col("model"), F.col("strategy"))).alias(column)

    return runs.agg(
        tag("best", -F.col("type_exact_match")),
        tag("fastest", F.col("latency_ms_p50")),
        tag("most_agreed", -F.col("classifier_agreement")),
    )


def percent(value: Column, decimals: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{decimals}f", F.round(value * 100, decimals)), F.lit("%"))


def parse_outliers(runs: DataFrame, rate: float = 0.5) -> DataFrame:
    return runs.filter(F.col("parse_failure_rate") > rate)


SCORES = ["accuracy", "macro_f1", "weighted_f1"]


def baseline_of(reports: DataFrame, system: str) -> DataFrame:
    """One row: the name and scores of a stored report, to compare others with."""
    return reports.select(F.lit(system).alias("system"), *SCORES).limit(1)


def _beside(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """``df`` with the one-row baseline's scores as ``b_*``."""
    return df.join(F.broadcast(baseline.select(*[F.col(c).alias(f"b_{c}") for c in SCORES])))


def against_baseline(runs: DataFrame, baseline: DataFrame) -> DataFrame:
    """Runs at or above the baseline, or else the best run with its gap in points."""
    flagged = _beside(runs, baseline).withColumn("beats", F.col("accuracy") >= F.col("b_accuracy")).withColumn(
        "gap_points", F.round((F.col("b_accuracy") - F.col("accuracy")) * 100, 1)).drop(
        *[f"b_{c}" for c in SCORES])
    best = flagged.agg(
        F.max("accuracy").alias("top"), F.bool_or("beats").alias("any_beats"),
        F.min_by(F.struct(*flagged.columns),
                 F.struct(-F.col("accuracy"), F.col("model"), F.col("strategy"))).alias("r"))
    alone = best.filter(~F.col("any_beats")).select("r.*")
    return flagged.filter("beats").unionByName(alone)


def is_winner() -> Column:
    """No score below the baseline's, which stand beside them as ``b_*``."""
    no_less = [F.col(c) >= F.col(f"b_{c}") for c in SCORES]
    return F.coalesce(no_less[0] & no_less[1] & no_less[2], F.lit(False))


def pretty_generation(runs: DataFrame) -> DataFrame:
    """Leaderboard columns as shown to readers: percents, rounding, short names."""
    return runs.select(
        "model", "strategy", percent(F.col("type_exact_match")).alias("type-match"),
        percent(F.col("type_in_target")).alias("in-target"),
        percent(F.col("classifier_agreement")).alias("classif. agree"),
        percent(F.col("parse_failure_rate")).alias("parse fail"),
        F.round("bleu", 2).alias("bleu"), F.round("rouge_l_mean", 3).alias("rouge_L"),
        F.round("latency_ms_p50", 0).cast("int").alias("p50 ms"),
        F.round("completion_tokens_mean", 1).alias("tokens"),
    )


def pretty_classification(runs: DataFrame) -> DataFrame:
    return runs.select(
        "model", "strategy", F.col("sample_kind").alias("sample"), "n",
        percent(F.col("accuracy"), 2).alias("accuracy"), F.round("macro_f1", 4).alias("macro_F1"),
        F.round("weighted_f1", 4).alias("weighted_F1"),
        percent(F.col("parse_failure_rate")).alias("parse fail"),
        F.round("latency_ms_p50", 0).cast("int").alias("p50 ms"),
    )


def report_label(model: Column, strategy: Column) -> Column:
    return F.concat(F.split(model, ":", 2)[0], F.lit(" / "), strategy)


def systems_board(classify_runs: DataFrame, ensembles: DataFrame, baseline: DataFrame) -> DataFrame:
    """Baseline, runs and ensembles in one table by accuracy; only ensembles can win."""
    first = baseline.select("system", *SCORES, F.lit(True).alias("is_baseline"), F.lit(False).alias("is_winner"))
    runs = classify_runs.select(
        F.concat_ws(" · ", "model", "strategy").alias("system"), *SCORES,
        F.lit(False).alias("is_baseline"), F.lit(False).alias("is_winner"))
    short = F.replace(F.col("config"), F.lit("ensemble_"), F.lit(""))
    votes = _beside(ensembles.filter(F.col("accuracy").isNotNull()), baseline).select(
        F.concat(F.lit("ensemble · "), short).alias("system"), *SCORES,
        F.lit(False).alias("is_baseline"), is_winner().alias("is_winner"))
    return first.unionByName(runs).unionByName(votes).orderBy(F.desc("accuracy"), "system")
