"""Scoring runs of language-model answers: rows, rates, latencies, running accuracy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions import answers
from gitsift.functions.text import first_line
from gitsift.operators.cleaning import or_fallback
from gitsift.operators.metrics import evaluation_report
from gitsift.operators.text_metrics import corpus_bleu, rouge_l
from gitsift.session import materialise, measured

RUN = ["model", "strategy"]


#: Points of the grid that narrows a percentile whose first bracket missed it.
_GRID = 64


def _in_brackets(base: DataFrame, asked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values at the ranks around ``h``, and whether the bracket missed them.

    ``asked`` has, per key and point ``i``: the rank ``h`` from 0, the open interval (``lo``,
    ``hi``) in which it lies, null for no end, the ``skipped`` values below it, and the bracket
    ``low``, ``high``. Inside the bracket distinct values are counted; what lies below or above
    is one count and one extreme.
    """
    within = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (
        F.col("hi").isNull() | (F.col("v") < F.col("hi")))
    joined = (base.join(asked, list(keys)) if keys else base.join(F.broadcast(asked))).filter(within)
    zone = F.when(F.col("v") < F.col("low"), 0).when(F.col("v") <= F.col("high"), 1).otherwise(2)
    point = [*keys, "i", "h", "lo", "hi", "skipped", "low", "high"]
    grouped = joined.withColumn("zone", zone).groupBy(
        *point, "zone", F.when(F.col("zone") == 1, F.col("v")).alias("inside")).agg(
        F.count("*").alias("c"), F.max("v").alias("last"), F.min("v").alias("first"))
    upto = F.col("skipped") + F.sum("c").over(Window.partitionBy(*keys, "i").orderBy("zone", "inside"))
    ranked = grouped.select(
        *point, "zone", "c", upto.alias("upto"), (upto - F.col("c")).alias("before"),
        F.when(F.col("zone") == 0, F.col("last")).otherwise(F.col("first")).alias("v"))

    def holds(rank: Column) -> Column:
        return (rank + 1 > F.col("before")) & (rank + 1 <= F.col("upto"))

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(rank), F.col("v")))

    def deeper(rank: Column, zone: int) -> Column:
        """A rank in an outer zone, and not that of its value next to the bracket, which is exact."""
        inner = rank + 1 < F.col("upto") if zone == 0 else rank > F.col("before")
        return holds(rank) & (F.col("zone") == zone) & inner

    lower, upper = F.floor("h"), F.ceil("h")
    return ranked.groupBy(*point).agg(
        at(lower).alias("a"), at(upper).alias("b"),
        F.bool_or(deeper(lower, 0) | deeper(upper, 0)).alias("below"),
        F.bool_or(deeper(lower, 2) | deeper(upper, 2)).alias("above"),
        *[F.coalesce(F.sum(F.when(F.col("zone") == z, F.col("c"))), F.lit(0)).alias(f"c{z}") for z in (0, 1, 2)])


def _narrowed(base: DataFrame, missed: DataFrame, keys: Sequence[str], sketch: int) -> DataFrame:
    """New brackets for missed ranks, from a sketch of the side of the old one where each lies."""
    below = F.col("below")
    sides = missed.select(
        *keys, "i", "h", F.when(below, F.col("lo")).otherwise(F.col("high")).alias("lo"),
        F.when(below, F.col("low")).otherwise(F.col("hi")).alias("hi"),
        F.when(below, F.col("skipped")).otherwise(F.col("skipped") + F.col("c0") + F.col("c1")).alias("skipped"),
        F.when(below, F.col("c0")).otherwise(F.col("c2")).alias("m"))
    within = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (
        F.col("hi").isNull() | (F.col("v") < F.col("hi")))
    joined = (base.join(sides, list(keys)) if keys else base.join(F.broadcast(sides))).filter(within)
    points = [k / _GRID for k in range(_GRID + 1)]
    sketched = joined.groupBy(*sides.columns).agg(F.percentile_approx("v", points, sketch).alias("g"))
    place = (F.col("h") - F.col("skipped")) / F.greatest(F.col("m") - 1, F.lit(1)) * _GRID
    return sketched.select(
        *keys, "i", "h", "lo", "hi", "skipped",
        F.get("g", F.greatest(F.floor(place).cast("int") - 1, F.lit(0))).alias("low"),
        F.get("g", F.least(F.ceil(place).cast("int") + 1, F.lit(_GRID))).alias("high"))


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, points: Sequence[float], sketch: int = 10_000
) -> DataFrame:
    """Exact percentiles with linear interpolation, one array per key.

    A sketch of fixed size first brackets each percentile; then only values
    inside the bracket are kept apart, with their counts, and everything below
    or above is one count and one extreme. So a key's values are never gathered,
    and the rows ranked per key are about 4/10,000 of its distinct values. A
    percentile that lies outside its bracket, as a small sketch may have it, is
    looked for again on that side of it, with a larger sketch, until all are found.
    """
    base = df.select(*keys, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    slack = 2.0 / sketch
    low = F.percentile_approx("v", [max(0.0, p - slack) for p in points], sketch)
    high = F.percentile_approx("v", [min(1.0, p + slack) for p in points], sketch)
    bounds = base.groupBy(*keys).agg(F.count("*").alias("n"), low.alias("low"), high.alias("high"))
    rank = (F.col("n") - 1) * F.element_at(F.array(*map(F.lit, points)), F.col("i") + 1)
    no_end = F.lit(None).cast("double")
    asked = bounds.select(*keys, "n", F.posexplode(F.arrays_zip("low", "high")).alias("i", "x")).select(
        *keys, "i", rank.alias("h"), no_end.alias("lo"), no_end.alias("hi"),
        F.lit(0).cast("long").alias("skipped"), "x.low", "x.high")
    found = []
    while True:  # one pass, but where a sketch was too small
        tried = measured(_in_brackets(base, measured(asked, "brackets"), keys), "percentiles")
        missed = F.col("below") | F.col("above")
        found.append(tried.filter(~missed).select(*keys, "i", "h", "a", "b"))
        if tried.filter(missed).isEmpty():
            break
        sketch *= 16
        asked = _narrowed(base, tried.filter(missed), keys, min(sketch, 10_000))
    result = F.col("a") + (F.col("b") - F.col("a")) * (F.col("h") - F.floor("h"))
    pairs = F.sort_array(F.collect_list(F.struct(F.col("i"), result.alias("p"))))
    return reduce(DataFrame.unionByName, found).groupBy(*keys).agg(
        F.transform(pairs, lambda s: s["p"]).alias("percentiles"))


def latency_summary(rows: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    points = exact_percentiles(rows, keys, "latency_ms", [0.5, 0.95])
    means = rows.groupBy(*keys).agg(F.avg("latency_ms").alias("latency_ms_mean"))
    return points.join(means, list(keys)).select(
        *keys, F.col("percentiles")[0].alias("latency_ms_p50"),
        F.col("percentiles")[1].alias("latency_ms_p95"), "latency_ms_mean")


def produced(responses: DataFrame) -> DataFrame:
    """Answers that exist: failed generations (null text) are dropped."""
    return responses.filter(F.col("raw").isNotNull())


def generation_rows(responses: DataFrame) -> DataFrame:
    """Per-answer parse and 0/1 metrics of generated messages."""
    parsed = answers.parse_message(F.col("raw"), F.col("strategy"))
    rows = produced(responses).withColumn("parsed", parsed).select(
        *responses.columns, "parsed.parsed_type", "parsed.scope",
        F.col("parsed.subject").alias("pred_subject"))
    shown = F.when(F.col("pred_subject") != "", F.col("pred_subject")).otherwise(F.col("raw"))
    return rows.withColumns({
        "candidate": shown,
        "type_exact_match": F.coalesce(F.col("parsed_type") == F.col("gold"), F.lit(False)).cast("int"),
        "type_in_target": answers.in_target(F.col("parsed_type")).cast("int"),
        "parse_failed": F.col("parsed_type").isNull().cast("int"),
        "rouge_l": rouge_l(F.col("gold_subject"), shown),
    })


def run_rates(rows: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    """Rates of a run: every 0/1 column present, ROUGE-L and tokens as means."""
    named = {
        "type_exact_match": "type_exact_match", "type_in_target": "type_in_target",
        "agreement": "classifier_agreement", "parse_failed": "parse_failure_rate",
        "rouge_l": "rouge_l_mean", "completion_tokens": "completion_tokens_mean",
    }
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(name) for c, name in named.items() if c in rows.columns])


def generation_summary(rows: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    bleu = corpus_bleu(rows, keys, "candidate", "gold_subject")
    return run_rates(rows, keys).join(latency_summary(rows, keys), list(keys)).join(
        bleu.select(*keys, "bleu"), list(keys))


def classification_rows(responses: DataFrame) -> DataFrame:
    """Per-answer label. ``correct`` counts a failed parse as wrong, ``pred`` as the fallback."""
    predicted = answers.parse_class(F.col("raw"), F.col("strategy"))
    return responses.withColumn("predicted", predicted).withColumns({
        "correct": F.coalesce(F.col("predicted") == F.col("gold"), F.lit(False)).cast("int"),
        "parse_failed": F.col("predicted").isNull().cast("int"),
        "pred": or_fallback(F.col("predicted")),
        "raw": F.substring("raw", 1, fv.RAW_PREVIEW_CHARS),
    })


def classification_summary(rows: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    report = evaluation_report(rows, keys).select(
        *keys, F.col("n_samples").alias("n"), "accuracy", "macro_f1", "weighted_f1",
        "macro_precision", "macro_recall")
    rates = rows.groupBy(*keys).agg(
        F.avg("correct").alias("strict_accuracy"), F.avg("parse_failed").alias("parse_failure_rate"),
        F.avg("completion_tokens").alias("completion_tokens_mean"))
    return report.join(rates, list(keys)).join(latency_summary(rows, keys), list(keys))


def running_accuracy(
    rows: DataFrame, keys: Sequence[str], every: int, order: str = "commit_id", flag: str = "correct",
    parts: int | None = None,
) -> DataFrame:
    """``(keys, idx, accuracy)``: accuracy so far at each ``every``-th row of a run, in ``order``.

    The order may be of any type that sorts; rows of a run that tie in it are interchangeable.
    Rows are cut into ranges of the order, written, and numbered and summed inside each range
    and run; what lies in earlier ranges is added from one small table, a row a range and run.
    No task sees a whole run, and each row is parsed once.
    """
    spark = rows.sparkSession
    # Cutting into ranges looks at the rows before it moves them, so they are written first.
    slim = materialise(rows.select(*keys, F.col(order).alias("_at"), F.col(flag).cast("long").alias("_hit")), "flags")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = materialise(slim.repartitionByRange(parts, "_at").withColumn("_range", F.spark_partition_id()), "ranges")
    upto = Window.partitionBy(*keys, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    inside = ranges.select(*keys, "_range", F.count("*").over(upto).alias("n"), F.sum("_hit").over(upto).alias("hits"))
    totals = ranges.groupBy(*keys, "_range").agg(F.count("*").alias("n"), F.sum("_hit").alias("hits"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = measured(totals.select(*keys, "_range", *[
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "hits")]), "range-starts")
    same = [inside[c].eqNullSafe(before[c]) for c in (*keys, "_range")]
    idx = F.col("n") + F.col("n_before")
    return inside.join(before, same).filter(idx % every == 0).select(
        *[inside[c] for c in keys], idx.alias("idx"), ((F.col("hits") + F.col("hits_before")) / idx).alias("accuracy"))


def verifier_input(rows: DataFrame) -> DataFrame:
    """What the verifier reads of a generated message: subject, else the first raw line."""
    text = F.when(F.col("pred_subject") != "", F.col("pred_subject")).otherwise(
        first_line(F.col("raw")))
    return rows.withColumn("verifier_text", F.when(F.col("raw") == "", "").otherwise(text))
