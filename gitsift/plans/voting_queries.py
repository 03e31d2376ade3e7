"""Metrics, votes, ensembles and stored reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions import probabilities as pr
from gitsift.operators import leaderboards, metrics, voting
from gitsift.operators.cleaning import or_fallback
from gitsift.plans import fixtures as fx
from gitsift.plans.registry import query
from gitsift.plans.registry import with_tables as sql
from gitsift.session import new_path
from gitsift.sources import corpus, reports

MEMBERS = fv.ENSEMBLE_CANDIDATES
AVERAGES = ["accuracy", *metrics.AVERAGES]
CLASSES_SQL = """
classes AS (SELECT unnest(['feat', 'fix', 'docs', 'refactor', 'test']) AS label,
  unnest([0, 1, 2, 3, 4]) AS ci)"""
FILLED_SQL = fx.MEMBERS_SQL + f""",
filled AS (SELECT commit_id, gold, member, member_idx,
  CASE WHEN pred IN {fx.TARGETS} THEN pred ELSE 'fix' END AS pred FROM mp)"""


def report_sql(source: str, keys: str) -> str:
    """CTEs ``pm`` (per class) and ``rep`` (one row per run) over ``source``."""
    using = f"USING ({keys})"
    return CLASSES_SQL + f""",
pc AS (SELECT {keys}, c.label, c.ci,
    count(*) FILTER (gold = c.label AND pred = c.label) AS tp,
    count(*) FILTER (gold = c.label) AS support, count(*) FILTER (pred = c.label) AS named
  FROM {source}, classes c GROUP BY {keys}, c.label, c.ci),
pm AS (SELECT *, CASE WHEN named > 0 THEN tp / named ELSE 0.0::DOUBLE END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall,
    CASE WHEN named + support > 0 THEN 2 * tp / (named + support) ELSE 0.0::DOUBLE END AS f1
  FROM pc),
rep AS (SELECT * FROM (
  SELECT {keys}, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
    avg(f1) AS macro_f1, sum(precision * support) / sum(support) AS weighted_precision,
    sum(recall * support) / sum(support) AS weighted_recall,
    sum(f1 * support) / sum(support) AS weighted_f1,
    avg(f1) FILTER (support + named > 0) AS macro_f1_present FROM pm GROUP BY {keys})
  JOIN (SELECT {keys}, count(*) AS n_samples, avg(CAST(gold = pred AS INT)) AS accuracy
    FROM {source} GROUP BY {keys}) {using})"""


ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in AVERAGES)


def rounded(df, columns=AVERAGES, decimals=6):
    return df.withColumns({c: F.round(c, decimals) for c in columns})


def filled(spark, sf_dir):
    return fx.member_predictions(spark, sf_dir).withColumn("pred", or_fallback(F.col("pred")))


@query("agg4_confusion_matrix", sql(FILLED_SQL + "," + CLASSES_SQL, """
SELECT f.member, g.label AS gold, p.label AS pred,
  count(*) FILTER (f.gold = g.label AND f.pred = p.label) AS n
FROM filled f, classes g, classes p GROUP BY 1, 2, 3"""))
def agg4(spark, sf_dir):
    return metrics.confusion_matrix(filled(spark, sf_dir), ["member"])


@query("agg5_per_class_metrics", sql(FILLED_SQL + "," + report_sql("filled", "member"), """
SELECT member, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, support FROM pm"""))
def agg5(spark, sf_dir):
    report = metrics.evaluation_report(filled(spark, sf_dir), ["member"])
    return rounded(metrics.per_class_metrics(report, ["member"]), ["precision", "recall", "f1"])


@query("agg6_evaluation_report", sql(FILLED_SQL + "," + report_sql("filled", "member"),
                                     f"SELECT member, n_samples, {ROUNDED} FROM rep"))
def agg6(spark, sf_dir):
    report = metrics.evaluation_report(filled(spark, sf_dir), ["member"])
    return rounded(report.select("member", "n_samples", *AVERAGES))


MEMBER_SCORES_SQL = FILLED_SQL + "," + report_sql("filled", "member") + """,
ms AS (SELECT member, accuracy, macro_f1 FROM (
  SELECT member, avg(CAST(gold = pred AS INT)) AS accuracy FROM mp GROUP BY member)
  JOIN (SELECT member, macro_f1_present AS macro_f1 FROM rep) USING (member))"""


@query("agg13_member_scores", sql(MEMBER_SCORES_SQL, """
SELECT member, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 FROM ms"""))
def agg13(spark, sf_dir):
    scores = voting.member_scores(fx.member_predictions(spark, sf_dir))
    return rounded(scores, ["accuracy", "macro_f1"])


# --- reports as JSON --------------------------------------------------------
COMPARISON = ("round(accuracy, 4) AS accuracy, round(macro_f1, 4) AS macro_f1, "
              "round(weighted_f1, 4) AS weighted_f1, round(macro_precision, 4) AS macro_precision, "
              "round(macro_recall, 4) AS macro_recall, n_samples AS n_test")


def stored_reports(spark, sf_dir):
    """A report per member, and the same once more under a ``_val`` name."""
    df = filled(spark, sf_dir)
    both = df.unionByName(df.withColumn("member", F.concat("member", F.lit("_val"))))
    path = new_path(spark, "reports")
    reports.save_reports(metrics.evaluation_report(both, ["member"]), path, "member")
    return path


@query("src10_report_files", sql(FILLED_SQL + "," + report_sql("filled", "member"), """
SELECT member AS model, round(accuracy, 4) AS accuracy, n_samples, round(macro_f1, 6) AS macro_f1,
  (SELECT round(f1, 6) FROM pm WHERE pm.member = rep.member AND label = 'docs') AS docs_f1,
  (SELECT support FROM pm WHERE pm.member = rep.member AND label = 'fix') AS fix_support
FROM rep"""))
def src10(spark, sf_dir):
    df = reports.load_reports(spark, stored_reports(spark, sf_dir))
    return df.select(
        F.col("model_name").alias("model"), F.round("accuracy", 4).alias("accuracy"), "n_samples",
        F.round("macro_f1", 6).alias("macro_f1"),
        F.round(F.col("per_class")["docs"]["f1"], 6).alias("docs_f1"),
        F.aggregate(F.col("confusion_matrix")[1], F.lit(0).cast("long"), lambda a, x: a + x)
        .alias("fix_support"))


@query("src11_ensemble_reports", sql(FILLED_SQL + "," + report_sql("filled", "member"), """
SELECT 'ensemble_' || member AS config, round(accuracy, 6) AS accuracy,
  round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1 FROM rep"""))
def src11(spark, sf_dir):
    """Only the reports named ``ensemble_*`` are read, by path."""
    df = filled(spark, sf_dir)
    both = df.unionByName(df.withColumn("member", F.concat(F.lit("ensemble_"), "member")))
    path = new_path(spark, "reports")
    reports.save_reports(metrics.evaluation_report(both, ["member"]), path, "member")
    df = reports.load_reports(spark, path, "ensemble_*", skip_suffix=None)
    return rounded(df.select(F.col("report").alias("config"), "accuracy", "macro_f1", "weighted_f1"),
                   ["accuracy", "macro_f1", "weighted_f1"])


@query("agg16_model_comparison", sql(FILLED_SQL + "," + report_sql("filled", "member"),
                                     f"SELECT member AS model, {COMPARISON} FROM rep"))
def agg16(spark, sf_dir):
    df = reports.load_reports(spark, stored_reports(spark, sf_dir))
    return metrics.comparison(df.withColumn("model", F.col("report")))


@query("top1_classifier_leaderboard", sql(FILLED_SQL + "," + report_sql("filled", "member"), f"""
SELECT member AS model, {COMPARISON} FROM rep ORDER BY rep.macro_f1 DESC, model"""))
def top1(spark, sf_dir):
    report = metrics.evaluation_report(filled(spark, sf_dir), ["member"])
    return leaderboards.classifier_board(report.withColumnRenamed("member", "model"))


# --- probabilities ----------------------------------------------------------
@query("str19_probability_maps", sql(fx.MEMBER_PROBS_SQL + "," + CLASSES_SQL, """
SELECT commit_id, member, label, round(probs[ci + 1], 6) AS p, round(probs[ci + 1], 4) AS p4,
  round(probs[ci + 1], 3) AS p3 FROM mprob, classes"""))
def str19(spark, sf_dir):
    probs = F.col("probs")
    df = fx.member_probabilities(spark, sf_dir).select(
        "commit_id", "member", pr.as_map(probs).alias("exact"), pr.as_map(probs, 4).alias("four"),
        F.from_json(pr.as_json(probs, 3), "map<string,double>").alias("three"))
    return df.select("commit_id", "member", "four", "three", F.explode("exact").alias("label", "p")) \
        .select("commit_id", "member", "label", F.round("p", 6).alias("p"),
                F.element_at("four", F.col("label")).alias("p4"),
                F.element_at("three", F.col("label")).alias("p3"))


ARGMAX = ("list_position(list_transform(probs, lambda p: round(p * 1e12)), "
          "list_max(list_transform(probs, lambda p: round(p * 1e12))))")
NAMES = "['feat', 'fix', 'docs', 'refactor', 'test']"


@query("top7_best_class", sql(fx.MEMBER_PROBS_SQL, f"""
SELECT commit_id, member, {NAMES}[{ARGMAX}] AS label, round(probs[{ARGMAX}], 6) AS confidence
FROM mprob"""))
def top7(spark, sf_dir):
    df = fx.member_probabilities(spark, sf_dir)
    df = df.select("commit_id", "member", pr.best(F.col("probs")).alias("b"))
    return rounded(df.select("commit_id", "member", "b.*"), ["confidence"])


@query("top8_ordered_probabilities", sql(fx.MEMBER_PROBS_SQL + "," + CLASSES_SQL, """
SELECT commit_id, member, string_agg(label, '>' ORDER BY probs[ci + 1] DESC, ci) AS ranking,
  round(list_max(any_value(probs)), 6) AS top FROM mprob, classes GROUP BY commit_id, member"""))
def top8(spark, sf_dir):
    df = fx.member_probabilities(spark, sf_dir).withColumn("o", pr.ordered(F.col("probs")))
    return df.select(
        "commit_id", "member",
        F.array_join(F.transform("o", lambda s: s["label"]), ">").alias("ranking"),
        F.round(F.col("o")[0]["p"], 6).alias("top"))


@query("src13_stored_probabilities", sql(fx.SPLIT_SQL + "," + fx.MEMBER_PROBS_SQL.replace(
    fx.COMMITS_SQL + ",", ""), """
SELECT commit_id, member AS model, split, round(probs[1], 6) AS p_feat, round(probs[2], 6) AS p_fix
FROM mprob JOIN splits USING (commit_id)"""))
def src13(spark, sf_dir):
    """Probabilities stored per model and split, and read back, each from its folder."""
    df = split_probabilities(spark, sf_dir).withColumnRenamed("member", "model")
    stored = corpus.write_table(df, new_path(spark, "probabilities"), ["model", "split"])
    return stored.select("commit_id", "model", "split", F.round(F.col("probs")[0], 6).alias("p_feat"),
                      F.round(F.col("probs")[1], 6).alias("p_fix"))


def split_probabilities(spark, sf_dir):
    splits = fx.splits(spark, sf_dir).select("commit_id", "split")
    return fx.member_probabilities(spark, sf_dir).join(splits, "commit_id")


# --- alignment --------------------------------------------------------------
@query("joi4_align_members", sql(fx.MEMBERS_SQL, """
SELECT count(*) AS n_commits, count(*) FILTER (c <> 4) AS n_incomplete,
  count(*) FILTER (lo <> hi) AS n_conflicts FROM (
  SELECT commit_id, count(*) AS c, min(gold) AS lo, max(gold) AS hi FROM mp
  WHERE NOT (member_idx = 3 AND pred = '') GROUP BY commit_id)"""))
def joi4(spark, sf_dir):
    """The last member left its blank answers out, so some commits are incomplete."""
    mp = fx.member_predictions(spark, sf_dir)
    return voting.alignment(mp.filter(~((F.col("member_idx") == 3) & (F.col("pred") == ""))), 4)


@query("joi5_attach_inputs", sql(fx.CLEAN_SQL + "," + fx.MEMBERS_SQL.replace(
    fx.COMMITS_SQL + ",", ""), """
SELECT commit_id, gold, member, pred, message_clean, md5(diff_text) AS diff_md5,
  label <> gold AS gold_differs FROM mp JOIN clean USING (commit_id)"""))
def joi5(spark, sf_dir):
    df = voting.attach_inputs(fx.member_predictions(spark, sf_dir), fx.clean(spark, sf_dir))
    return df.select("commit_id", "gold", "member", "pred", "message_clean",
                     F.md5(F.col("diff_text").cast("binary")).alias("diff_md5"), "gold_differs")


@query("joi6_stack_probabilities", sql(fx.MEMBER_PROBS_SQL, """
SELECT commit_id, gold, string_agg(member, ',' ORDER BY member_idx) AS members,
  string_agg(CAST(CAST(round(probs[2] * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY member_idx)
    AS p_fix FROM mprob GROUP BY commit_id, gold"""))
def joi6(spark, sf_dir):
    df = voting.stack(fx.member_probabilities(spark, sf_dir))
    return df.select(
        "commit_id", "gold",
        F.array_join(F.transform("stack", lambda s: s["member"]), ",").alias("members"),
        F.array_join(F.transform(
            "stack", lambda s: F.round(s["probs"][1] * 1000000).cast("long").cast("string")), ",")
        .alias("p_fix"))


# --- votes ------------------------------------------------------------------
SOFT_WEIGHTS = {"baseline_tfidf": 0.4, "cnn_text": 0.3, "distilbert": 0.2, "codebert": 0.6}


def soft_sql(weights: dict[str, float], source: str = "mprob") -> str:
    total = sum(weights.values())
    case = " ".join(f"WHEN '{m}' THEN {w}::DOUBLE" for m, w in weights.items())
    sums = ", ".join(
        f"sum((CASE member {case} END) * probs[{c}]) / {total}" for c in range(1, 6))
    return f"""
soft AS (SELECT commit_id, gold, [{sums}] AS probs FROM {source} GROUP BY commit_id, gold),
softp AS (SELECT commit_id, gold, probs, {NAMES}[{ARGMAX}] AS pred FROM soft)"""


@query("ens1_soft_vote", sql(fx.MEMBER_PROBS_SQL + "," + soft_sql(SOFT_WEIGHTS), """
SELECT commit_id, gold, pred, round(probs[1], 6) AS p_feat, round(probs[2], 6) AS p_fix,
  round(probs[5], 6) AS p_test FROM softp"""))
def ens1(spark, sf_dir):
    probs = fx.member_probabilities(spark, sf_dir)
    voted = voting.soft_vote(probs, voting.weights_table(probs, SOFT_WEIGHTS))
    return voted.select("commit_id", "gold", "pred", *[
        F.round(F.col("probs")[c], 6).alias(f"p_{fv.TARGET_CLASSES[c]}") for c in (0, 1, 4)])


SEARCH_SQL = fx.SPLIT_SQL + "," + fx.MEMBER_PROBS_SQL.replace(fx.COMMITS_SQL + ",", "") + """,
g AS (SELECT a, b, c, 10 - a - b - c AS d FROM range(11) x(a), range(11) y(b), range(11) z(c)
  WHERE a + b + c <= 10),
val AS MATERIALIZED (SELECT commit_id, gold, list(probs ORDER BY member_idx) AS ps FROM mprob
  JOIN splits USING (commit_id) WHERE split = 'val' GROUP BY commit_id, gold),
sums AS (SELECT a, b, c, d, gold, list_transform([1, 2, 3, 4, 5], lambda k:
    round((a / 10 * ps[1][k] + b / 10 * ps[2][k] + c / 10 * ps[3][k] + d / 10 * ps[4][k]) * 1e12))
    AS t FROM val, g),
cand AS MATERIALIZED (SELECT a, b, c, d, gold,
    ['feat', 'fix', 'docs', 'refactor', 'test'][list_position(t, list_max(t))] AS pred FROM sums),
""" + report_sql("cand", "a, b, c, d")


def validation_probabilities(spark, sf_dir):
    return split_probabilities(spark, sf_dir).filter(F.col("split") == "val")


@query("ens2_weight_search", sql(SEARCH_SQL, """
SELECT concat_ws(',', a, b, c, d) AS tenths, round(accuracy, 6) AS accuracy,
  round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1 FROM rep"""))
def ens2(spark, sf_dir):
    search = voting.search_weights(validation_probabilities(spark, sf_dir), MEMBERS)
    tenths = F.transform("weights", lambda w: F.round(w * 10).cast("int").cast("string"))
    return rounded(search.select(F.array_join(tenths, ",").alias("tenths"),
                                 "accuracy", "macro_f1", "weighted_f1"),
                   ["accuracy", "macro_f1", "weighted_f1"])


@query("ens2_best_weights", sql(SEARCH_SQL, """,
best AS (SELECT a, b, c, d FROM rep ORDER BY round(macro_f1 * 1e12) DESC,
  (4 * a - 10) ** 2 + (4 * b - 10) ** 2 + (4 * c - 10) ** 2 + (4 * d - 10) ** 2, a, b, c, d LIMIT 1)
SELECT unnest(['baseline_tfidf', 'cnn_text', 'distilbert', 'codebert']) AS member,
  unnest([0, 1, 2, 3]) AS position, unnest([a / 10, b / 10, c / 10, d / 10]) AS weight FROM best"""))
def ens2_best(spark, sf_dir):
    search = voting.search_weights(validation_probabilities(spark, sf_dir), MEMBERS)
    return voting.best_weights(search, MEMBERS)


@query("ens2_refined_weights", sql(SEARCH_SQL, """,
best AS (SELECT a, b, c, d, macro_f1 FROM rep ORDER BY round(macro_f1 * 1e12) DESC,
  (4 * a - 10) ** 2 + (4 * b - 10) ** 2 + (4 * c - 10) ** 2 + (4 * d - 10) ** 2, a, b, c, d LIMIT 1)
SELECT concat_ws(',', a, b, c, d) AS tenths, round(macro_f1, 6) AS macro_f1 FROM best"""))
def ens2_refined(spark, sf_dir):
    """Fifths, then tenths around the best: the winner is that of the full grid of tenths."""
    found = voting.refined_weights(validation_probabilities(spark, sf_dir), MEMBERS, 5, 1)
    best = found.orderBy(F.desc(pr.grid(F.col("macro_f1"))), "candidate").limit(1)
    tenths = F.transform("weights", lambda w: F.round(w * 10).cast("int").cast("string"))
    return rounded(best.select(F.array_join(tenths, ",").alias("tenths"), "macro_f1"), ["macro_f1"])


@query("ens3_apply_weights", sql(fx.SPLIT_SQL + "," + fx.MEMBER_PROBS_SQL.replace(
    fx.COMMITS_SQL + ",", "") + """,
tp AS (SELECT m.* FROM mprob m JOIN splits USING (commit_id) WHERE split = 'test'),"""
    + soft_sql(SOFT_WEIGHTS, "tp") + """,
one AS (SELECT 'ensemble [test]' AS model_name, gold, pred FROM softp),"""
    + report_sql("one", "model_name"),
    f"SELECT model_name, n_samples, true AS order_changed, {ROUNDED} FROM rep"))
def ens3(spark, sf_dir):
    """Stored weights are joined by member name, so a changed order does no harm."""
    path = new_path(spark, "weights")
    voting.weights_table(spark.range(1), dict(reversed(SOFT_WEIGHTS.items()))).write.parquet(path)
    stored = spark.read.parquet(path)
    test = split_probabilities(spark, sf_dir).filter(F.col("split") == "test")
    voted = voting.soft_vote(test, stored).withColumn("model_name", F.lit("ensemble [test]"))
    report = metrics.evaluation_report(voted, ["model_name"])
    flag = voting.order_changed(stored, MEMBERS).select("order_changed")
    return rounded(report.select("model_name", "n_samples", *AVERAGES)).join(F.broadcast(flag))


def vote_sql(weight: str) -> str:
    return f"""
tally AS (SELECT commit_id, gold, pred, sum({weight}) AS score, min(member_idx) AS first_seen
  FROM mp LEFT JOIN w USING (member) GROUP BY commit_id, gold, pred),
voted AS (SELECT commit_id, gold, pred AS vote FROM tally QUALIFY row_number() OVER
  (PARTITION BY commit_id ORDER BY round(score * 1e9) DESC, first_seen) = 1)"""


W_SQL = """
w AS (SELECT unnest(['baseline_tfidf', 'cnn_text', 'distilbert', 'codebert']) AS member,
  unnest([0.4::DOUBLE, 0.3::DOUBLE, 0.2::DOUBLE, 0.6::DOUBLE]) AS weight)"""


@query("ens4_hard_vote", sql(fx.MEMBERS_SQL + "," + W_SQL + "," + vote_sql("1"),
                             "SELECT commit_id, gold, vote FROM voted"))
def ens4(spark, sf_dir):
    return voting.hard_vote(fx.member_predictions(spark, sf_dir))


@query("ens5_weighted_vote", sql(fx.MEMBERS_SQL + "," + W_SQL + "," + vote_sql("weight"),
                                 "SELECT commit_id, gold, vote FROM voted"))
def ens5(spark, sf_dir):
    mp = fx.member_predictions(spark, sf_dir)
    return voting.weighted_vote(mp, voting.weights_table(mp, SOFT_WEIGHTS))


@query("ens6_boosted_vote_report", sql(MEMBER_SCORES_SQL.replace("pm AS", "pm0 AS").replace(
    "FROM pm ", "FROM pm0 ").replace("pc AS", "pc0 AS").replace("FROM pc)", "FROM pc0)").replace(
    "rep AS", "rep0 AS").replace("FROM rep)", "FROM rep0)") + """,
w AS (SELECT member, macro_f1 * CASE WHEN member = 'baseline_tfidf' THEN 2 ELSE 1 END AS weight
  FROM ms),""" + vote_sql("weight") + f""",
final AS (SELECT 'weighted' AS mode, gold,
  CASE WHEN vote IN {fx.TARGETS} THEN vote ELSE 'fix' END AS pred FROM voted),"""
    + report_sql("final", "mode").replace(CLASSES_SQL + ",", ""),
    f"SELECT mode, n_samples, {ROUNDED} FROM rep"))
def ens6(spark, sf_dir):
    report = voting.vote_report(fx.member_predictions(spark, sf_dir), "weighted", "macro_f1",
                                {"baseline_tfidf": 2.0})
    return rounded(report.select(F.lit("weighted").alias("mode"), "n_samples", *AVERAGES))


@query("ens7_vote_probabilities", sql(FILLED_SQL + "," + W_SQL + "," + CLASSES_SQL, """
SELECT commit_id, label, round(sum(CASE WHEN pred = label THEN weight ELSE 0 END) / sum(weight), 6)
    AS p FROM filled JOIN w USING (member), classes GROUP BY commit_id, label"""))
def ens7(spark, sf_dir):
    mp = fx.member_predictions(spark, sf_dir)
    shares = voting.vote_probabilities(mp, voting.weights_table(mp, SOFT_WEIGHTS))
    return shares.select("commit_id", F.posexplode("probs").alias("i", "p")).select(
        "commit_id", F.get(pr.class_array(), F.col("i")).alias("label"), F.round("p", 6).alias("p"))


@query("ens8_one_hot", sql(FILLED_SQL, """
SELECT commit_id, member, pred AS label, 1.0::DOUBLE AS confidence, 1.0::DOUBLE AS total FROM filled"""))
def ens8(spark, sf_dir):
    df = voting.label_probabilities(fx.member_predictions(spark, sf_dir))
    return df.select("commit_id", "member", pr.best(F.col("probs")).alias("b"), F.aggregate(
        "probs", F.lit(0.0), lambda a, x: a + x).alias("total")).select(
        "commit_id", "member", "b.*", "total")
