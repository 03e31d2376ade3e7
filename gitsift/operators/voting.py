"""Combining models: aligned predictions, soft, hard and weighted votes, weight search.

A commit's votes are gathered by its key. A commit has as many votes as there
are members, so the gathered array is bounded by the member list, whatever the
number of commits.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions.probabilities import argmax, class_array, grid, one_hot
from gitsift.operators.cleaning import or_fallback
from gitsift.operators.metrics import evaluation_report, metrics_from_counts
from gitsift.session import measured


def alignment(predictions: DataFrame, n_members: int) -> DataFrame:
    """How many commits lack a member, and how many have differing gold labels.

    Members count by name, so one that is there twice does not stand in for another.
    """
    per_commit = predictions.groupBy("commit_id").agg(
        F.count_distinct("member").alias("members"), (F.min("gold") != F.max("gold")).alias("conflict")
    )
    return per_commit.agg(
        F.count("*").alias("n_commits"),
        F.count_if(F.col("members") != n_members).alias("n_incomplete"),
        F.count_if("conflict").alias("n_conflicts"),
    )


def attach_inputs(predictions: DataFrame, commits: DataFrame) -> DataFrame:
    """Message and diff of each predicted commit, with a flag where gold differs."""
    inputs = commits.select("commit_id", "message_clean", "diff_text", "label")
    return predictions.join(inputs, "commit_id").withColumn(
        "gold_differs", F.col("label") != F.col("gold")
    ).drop("label")


def stack(probabilities: DataFrame, carry: Sequence[str] = ("gold",)) -> DataFrame:
    """Per commit the members' probabilities in member order, and their names."""
    members = F.sort_array(F.collect_list(F.struct("member_idx", "member", "probs")))
    return probabilities.groupBy("commit_id").agg(
        *[F.first(c).alias(c) for c in carry], members.alias("stack")
    )


def soft_vote(
    probabilities: DataFrame, weights: DataFrame, carry: Sequence[str] = ("gold",)
) -> DataFrame:
    """Normalised weighted mean of probabilities; weights ``(member, weight)`` join by name."""
    joined = probabilities.join(weights.select("member", "weight"), "member")
    sums = [
        F.sum(F.col("weight") * F.col("probs")[c]).alias(f"s{c}")
        for c in range(len(fv.TARGET_CLASSES))
    ]
    summed = joined.groupBy("commit_id").agg(
        *[F.first(c).alias(c) for c in carry], F.sum("weight").alias("w"), *sums
    )
    combined = F.array(*[F.col(f"s{c}") / F.col("w") for c in range(len(fv.TARGET_CLASSES))])
    voted = summed.select("commit_id", *carry, combined.alias("probs"))
    return voted.withColumn("pred", F.get(class_array(), argmax(F.col("probs"))))


def equal_weights(df: DataFrame, members: Sequence[str]) -> DataFrame:
    return weights_table(df, {m: 1.0 / len(members) for m in members})


def weights_table(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(m).alias("member"),
                 F.lit(float(w)).alias("weight"))
        for i, (m, w) in enumerate(weights.items())
    ])
    return df.sparkSession.range(1).select(F.explode(rows).alias("w")).select("w.*")


#: Weight vectors that one pass may score; a finer search takes several passes.
MAX_CANDIDATES = 5_000


def grid_weights(spark: SparkSession, n_members: int, steps: int) -> DataFrame:
    """``units array<int>``: all ways to deal ``steps`` equal parts to the members, as a table."""
    dealt = spark.range(1).select(F.array().cast("array<int>").alias("units"), F.lit(steps).alias("left"))
    for _ in range(n_members - 1):
        dealt = dealt.select("units", "left", F.explode(F.sequence(F.lit(0), F.col("left"))).alias("u")).select(
            F.concat("units", F.array("u")).alias("units"), (F.col("left") - F.col("u")).alias("left"))
    return dealt.select(F.concat("units", F.array("left")).alias("units"))


def nearby_weights(best: DataFrame, n_members: int) -> DataFrame:
    """Vectors of parts half as large: each given one, and what one or two moves of a part make of it.

    No member gains or loses more than one part.
    """
    doubled = best.select(F.transform("units", lambda u: u * 2).alias("units"))
    moved = doubled.select("units", F.array().cast("array<int>").alias("d"))
    for _ in range(n_members):
        moved = moved.select("units", "d", F.explode(F.sequence(F.lit(-1), F.lit(1))).alias("x")).select(
            "units", F.concat("d", F.array("x")).alias("d")).filter(
            (F.size(F.filter("d", lambda x: x < 0)) <= 2) & (F.size(F.filter("d", lambda x: x > 0)) <= 2))
    whole = moved.filter(F.aggregate("d", F.lit(0), lambda x, y: x + y) == 0)
    summed = whole.select(F.zip_with("units", "d", lambda u, d: u + d).alias("units"))
    return summed.filter(F.forall("units", lambda u: u >= 0)).distinct()


def nearby_count(n_members: int) -> int:
    """How many vectors ``nearby_weights`` makes of one at most."""
    return 1 + n_members * (n_members - 1) + 6 * math.comb(n_members, 4)


def search_weights(
    probabilities: DataFrame, members: Sequence[str], steps: int = 10, candidates: DataFrame | None = None,
) -> DataFrame:
    """Macro-F1 of every candidate weight vector, in one pass.

    ``candidates(units)`` are parts of ``steps`` by member; without them, all there are.
    Members are found by name. A commit that lacks one is an error: scored by what is
    there, it would be scored with other weights than the candidate's. Each commit is scored
    under all candidates inside its task and only counts per (candidate, gold, predicted)
    are shuffled: 25 cells per candidate. Candidates are numbered with the one nearest to
    equal weights first.
    """
    spark, n = probabilities.sparkSession, len(members)
    if candidates is None:
        if math.comb(steps + n - 1, n - 1) > MAX_CANDIDATES:
            raise ValueError(f"more than {MAX_CANDIDATES} weight vectors; use refined_weights")
        candidates = grid_weights(spark, n, steps)
    uneven = F.aggregate("units", F.lit(0), lambda x, u: x + (u * n - steps) * (u * n - steps))
    fields = [f"w{k}" for k in range(n)]
    ordered = F.sort_array(F.collect_list(F.struct(uneven.alias("uneven"), "units")))
    numbered = F.transform(ordered, lambda x, i: F.struct(i.alias("candidate"), *[
        (x["units"][k] / steps).alias(w) for k, w in enumerate(fields)]))
    # One row, of at most MAX_CANDIDATES vectors; written, so that every pass sees the same one.
    table = measured(candidates.agg(numbered.alias("candidates")), "candidates")

    def of(member: str) -> Column:
        found = F.max(F.when(F.col("member") == member, F.col("probs")))
        lacking = F.raise_error(F.concat(F.lit(f"no answer of {member} for commit "),
                                         F.col("commit_id").cast("string")))
        return F.when(found.isNotNull(), found).otherwise(lacking.cast("array<double>"))

    by_name = probabilities.groupBy("commit_id").agg(
        F.first("gold").alias("gold"), *[of(m).alias(f"m{k}") for k, m in enumerate(members)])
    wide = by_name.select(
        "gold", *[
            F.col(f"m{k}")[c].alias(f"p{k}_{c}")
            for k in range(len(members)) for c in range(len(fv.TARGET_CLASSES))
        ],
    )
    scored = wide.join(F.broadcast(table)).select("*", F.explode("candidates").alias("x")).select(
        *wide.columns, "x.*")
    sums = []
    for c in range(len(fv.TARGET_CLASSES)):
        total = F.col("w0") * F.col(f"p0_{c}")
        for k in range(1, len(members)):
            total = total + F.col(f"w{k}") * F.col(f"p{k}_{c}")
        sums.append(grid(total).alias(f"t{c}"))
    weights = [f"w{k}" for k in range(len(members))]
    totals = scored.select("gold", "candidate", *weights, *sums)
    top = F.greatest(*[F.col(f"t{c}") for c in range(len(fv.TARGET_CLASSES))])
    pred = F.coalesce(*[
        F.when(F.col(f"t{c}") == top, name) for c, name in enumerate(fv.TARGET_CLASSES)
    ])
    keys = ["candidate", *weights]
    counts = totals.withColumn("pred", pred).groupBy(*keys, "gold", "pred").agg(
        F.count("*").alias("n"))
    report = metrics_from_counts(counts, keys)
    return report.select(
        "candidate", F.array(*weights).alias("weights"), "accuracy", "macro_f1", "weighted_f1")


def refined_weights(
    probabilities: DataFrame, members: Sequence[str], coarse: int = 5, rounds: int = 1, keep: int = 16,
) -> DataFrame:
    """Candidates and their scores, from a coarse grid and then halved steps around the best.

    A full grid of small steps grows with the power of the members. Here the first pass
    scores the coarse grid, and each round the best so far, ``keep`` of them or as many as
    one pass allows, with what lies around them. Returned are the candidates of the last
    round, which include the best of all before, so ``best_weights`` chooses among them.
    """
    n, steps = len(members), coarse
    keep = max(1, min(keep, MAX_CANDIDATES // nearby_count(n)))
    candidates = None
    for passed in range(rounds + 1):
        scored = measured(search_weights(probabilities, members, steps, candidates), "scored-weights")
        if passed == rounds:
            return scored
        best = scored.orderBy(F.desc(grid(F.col("macro_f1"))), "candidate").limit(keep).select(
            F.transform("weights", lambda w: F.round(w * steps).cast("int")).alias("units"))
        candidates, steps = nearby_weights(measured(best, "best-candidates"), n), 2 * steps


def best_weights(search: DataFrame, members: Sequence[str]) -> DataFrame:
    """``(member, weight)`` of the best candidate; on a tie the one nearest to equal.

    Written, so that joining it by member is planned from its real size.
    """
    chosen = search.agg(
        F.max_by("weights", F.struct(grid(F.col("macro_f1")), -F.col("candidate"))).alias("w"),
    )
    names = F.array(*map(F.lit, members))
    pairs = F.arrays_zip(names.alias("member"), F.col("w").alias("weight"))
    rows = chosen.select(F.posexplode(pairs).alias("position", "x")).select("position", "x.*")
    return measured(rows, "best-weights")


def order_changed(stored: DataFrame, members: Sequence[str]) -> DataFrame:
    """One row: stored and present member order, and whether they differ."""
    names = F.array(*map(F.lit, members))
    order = F.transform(F.sort_array(F.collect_list(F.struct("position", "member"))),
                        lambda s: s["member"])
    return stored.agg(order.alias("stored")).select(
        "stored", names.alias("present"), (F.col("stored") != names).alias("order_changed"))


def gathered_votes(predictions: DataFrame, carry: Sequence[str], weight: Column) -> DataFrame:
    votes = F.sort_array(F.collect_list(F.struct(
        F.col("member_idx"), F.coalesce("pred", F.lit("")).alias("pred"),
        weight.cast("double").alias("weight"))))
    return predictions.groupBy("commit_id").agg(
        *[F.first(c).alias(c) for c in carry], votes.alias("votes"))


def _score(votes: Column, label: Column) -> Column:
    mine = F.filter(votes, lambda v: v["pred"] == label)
    return F.aggregate(mine, F.lit(0.0), lambda acc, v: acc + v["weight"])


def winner(votes: Column) -> Column:
    """Label of the highest score; on a tie the one seen first in member order."""
    labels = F.array_distinct(F.transform(votes, lambda v: v["pred"]))
    scores = F.transform(labels, lambda label: _score(votes, label))
    return F.element_at(labels, F.array_position(scores, F.array_max(scores)).cast("int"))


def hard_vote(predictions: DataFrame, carry: Sequence[str] = ("gold",)) -> DataFrame:
    voted = gathered_votes(predictions, carry, F.lit(1.0))
    return voted.select("commit_id", *carry, winner(F.col("votes")).alias("vote"))


def weighted_vote(
    predictions: DataFrame, weights: DataFrame, carry: Sequence[str] = ("gold",)
) -> DataFrame:
    joined = predictions.join(weights.select("member", "weight"), "member")
    voted = gathered_votes(joined, carry, F.col("weight"))
    return voted.select("commit_id", *carry, winner(F.col("votes")).alias("vote"))


def vote_probabilities(
    predictions: DataFrame, weights: DataFrame, carry: Sequence[str] = ("gold",)
) -> DataFrame:
    """Share of the weight each class got; all zeros when no weight was cast."""
    joined = predictions.join(weights.select("member", "weight"), "member").withColumn(
        "pred", or_fallback(F.col("pred")))
    votes = F.col("votes")
    raw = F.transform(class_array(), lambda c: _score(votes, c))

    def shares(scores: Column) -> Column:
        total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s)
        return F.transform(scores, lambda s: s / F.when(total == 0, 1.0).otherwise(total))

    from gitsift.functions.text import let

    return gathered_votes(joined, carry, F.col("weight")).select(
        "commit_id", *carry, let(raw, shares).alias("probs"))


def label_probabilities(predictions: DataFrame) -> DataFrame:
    """A discrete label as one-hot probabilities."""
    return predictions.withColumn("probs", one_hot(F.col("pred")))


def member_scores(predictions: DataFrame) -> DataFrame:
    """Per member: accuracy on the labels as given, macro-F1 with blanks as the fallback.

    Macro-F1 averages the classes that occur in gold or predictions.
    """
    raw = predictions.groupBy("member").agg(
        F.avg((F.coalesce("pred", F.lit("")) == F.col("gold")).cast("int")).alias("accuracy"))
    filled = predictions.withColumn("pred", or_fallback(F.col("pred")))
    report = evaluation_report(filled, ["member"]).select(
        "member", F.col("macro_f1_present").alias("macro_f1"))
    return raw.join(report, "member")


def member_weights(
    scores: DataFrame, metric: str = "accuracy", boosts: Mapping[str, float] | None = None
) -> DataFrame:
    """Weight of a member = its score, multiplied for the boosted ones."""
    factor = F.lit(1.0)
    for name, boost in (boosts or {}).items():
        factor = F.when(F.col("member") == name, F.lit(float(boost))).otherwise(factor)
    return scores.withColumn("weight", F.col(metric) * factor)


def vote_report(
    predictions: DataFrame, mode: str = "weighted", metric: str = "accuracy",
    boosts: Mapping[str, float] | None = None,
) -> DataFrame:
    """Vote, count blank winners as the fallback class, and report."""
    if mode == "hard":
        voted = hard_vote(predictions)
    elif mode == "weighted":
        weights = measured(member_weights(member_scores(predictions), metric, boosts), "weights")
        voted = weighted_vote(predictions, weights)
    else:
        raise ValueError(f"mode must be hard or weighted, not {mode!r}")
    return evaluation_report(voted.withColumn("pred", or_fallback(F.col("vote"))))
