"""Cases that once lost, doubled or misplaced rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.operators import retrieval, scoring, voting
from gitsift.sources import history, repository
from gitsift.streaming.scoring import log_batch

PROBS = "commit_id long, gold string, member_idx int, member string, probs array<double>"


def test_scan_refuses_more_than_its_maximum(spark):
    rows = [(k, f"h{k}", "a", 1, k, "m") for k in range(300)]
    df = spark.createDataFrame(
        rows, "commit_id long, hash string, author string, n_parents int, t long, message string").select(
        "*", F.timestamp_seconds("t").alias("ts"),
        F.array().cast("array<struct<old_path:string,new_path:string,diff:string>>").alias("files"))
    assert repository.scan(df, last_n=250).count() == 250
    with pytest.raises(ValueError):
        repository.scan(df, last_n=250, maximum=200)


def test_every_query_gets_k_neighbours(spark):
    vectors = "commit_id long, idx array<int>, weight array<double>"
    corpus = spark.createDataFrame([(3, [0], [1.0]), (1, [1], [1.0]), (2, [], [])], vectors)
    asked = spark.createDataFrame([(10, [0], [1.0]), (11, [], [])], vectors)
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in retrieval.nearest(asked, corpus, 2, 3).collect()}
    assert got == {(10, 1): (3, 1.0), (10, 2): (1, 0.0), (10, 3): (2, 0.0),
                   (11, 1): (1, 0.0), (11, 2): (2, 0.0), (11, 3): (3, 0.0)}


def test_alignment_counts_members_by_name(spark):
    df = spark.createDataFrame([(1, "a", "fix"), (1, "a", "fix"), (2, "a", "fix"), (2, "b", "fix")],
                               "commit_id long, member string, gold string")
    assert voting.alignment(df, 2).first().asDict() == {"n_commits": 2, "n_incomplete": 1, "n_conflicts": 0}


def test_weight_search_takes_members_by_name(spark):
    sure, other = [0.0, 1.0, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0, 0.0]
    rows = [(k, "fix", m, name, sure if name == "good" else other)
            for k in range(4) for m, name in enumerate(("bad", "good"))]
    df = spark.createDataFrame(rows, PROBS)
    best = voting.best_weights(voting.search_weights(df, ["good", "bad"]), ["good", "bad"]).collect()
    assert {r.member: r.weight for r in best}["good"] > 0.5
    with pytest.raises(PySparkException):
        voting.search_weights(df.filter("NOT (commit_id = 2 AND member = 'bad')"), ["good", "bad"]).collect()


def scored_rows(spark, rows):
    df = spark.createDataFrame(rows, "id long, model string")
    return df.select("id", F.timestamp_seconds(F.col("id")).alias("ts"), "model",
                     F.lit(None).cast("long").alias("batch_run_id"), F.lit("m").alias("message"),
                     F.lit("d").alias("diff"), F.lit("fix").alias("label"), F.lit(1.0).alias("confidence"),
                     F.create_map(F.lit("fix"), F.lit(1.0)).alias("probabilities"), F.lit("cli").alias("source"))


def models_by_id(spark, log):
    models = {r.model_id: r.name for r in history.read_models(spark, log.registry).collect()}
    return {(r.id, models.get(r.model_id)) for r in history.read_log(spark, log.path).collect()}


def log_at(tmp_path, writer="w"):
    return history.Log(str(tmp_path / "registry"), str(tmp_path / "log"), writer)


def test_unregistered_models_lose_no_prediction(spark, tmp_path):
    rows = scored_rows(spark, [(1, "a"), (2, "b")])
    assert history.prediction_rows(rows, history.empty_models(spark)).count() == 2
    log = log_at(tmp_path)
    log.write(rows)
    assert models_by_id(spark, log) == {(1, "a"), (2, "b")}


def test_repeated_ids_are_logged_once(spark, tmp_path):
    log = log_at(tmp_path)
    for batch in (0, 0, 1):
        log.write(scored_rows(spark, [(1, "a"), (1, "a"), (2, "a")]), batch)
    assert sorted(r.id for r in history.read_log(spark, log.path).collect()) == [1, 2]


def test_two_writers_with_new_models_get_different_ids(spark, tmp_path):
    """At the same time, several models each, some of them the same; then all once more."""
    from concurrent.futures import ThreadPoolExecutor

    batches = [[(10 * w + i, f"model-{(w + i) % 5}") for i in range(3)] for w in range(4)]
    logs = [log_at(tmp_path, f"w{w}") for w in range(4)]
    for _ in range(2):
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda x: x[0].write(scored_rows(spark, x[1])), zip(logs, batches)))
        stored = history.read_models(spark, logs[0].registry).collect()
        assert sorted(r.name for r in stored) == [f"model-{i}" for i in range(5)]
        assert sorted(r.model_id for r in stored) == [1, 2, 3, 4, 5]
        assert models_by_id(spark, logs[0]) == {x for some in batches for x in some}


def test_a_claim_without_a_row_is_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "CLAIM_SECONDS", 0)
    log = log_at(tmp_path)
    log.write(scored_rows(spark, [(1, "a")]))
    (tmp_path / "registry" / "000000002.json").touch()
    log.write(scored_rows(spark, [(2, "b")]), 1)
    assert models_by_id(spark, log) == {(1, "a"), (2, "b")}
    assert {r.model_id for r in history.read_models(spark, log.registry).collect()} == {1, 3}


def test_registered_models_keep_their_time_in_any_zone(spark, tmp_path):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        found = history.registered(scored_rows(spark, [(7, "a"), (5, "a")]).select("model", "ts"), str(tmp_path / "r"))
        assert found.select(F.unix_seconds("trained_at")).first()[0] == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_commit_delivered_twice_is_logged_once(spark, tmp_path):
    batch = spark.createDataFrame([(1, "fix: a", ""), (1, "fix: a", ""), (2, "x", "")],
                                  "commit_id long, message string, diff string").withColumn(
        "ts", F.timestamp_seconds("commit_id"))
    same = spark.createDataFrame([(1, [0.0, 1.0, 0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0, 0.0])],
                                 "commit_id long, probs array<double>")
    log = log_at(tmp_path)
    for number in (0, 0, 1):
        log_batch("cnn_text", {"cnn_text": scoring.table_scorer(same)}, log, "s")(batch, number)
    assert sorted((r.id, r.predicted_label) for r in history.read_log(spark, log.path).collect()) == [
        (1, "fix"), (2, "feat")]


def test_predictions_without_a_batch_run_stay(spark):
    predictions = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id long, batch_run_id long")
    runs = spark.createDataFrame([(5, "r", 7)], "id long, repo_path string, n_commits int")
    got = {r.id: (r.repo_path, r.n_commits) for r in history.with_batch_run(predictions, runs).collect()}
    assert got == {1: ("r", 7), 2: (None, None), 3: (None, None)}


def test_composed_scorers(spark):
    df = spark.createDataFrame([(1, "m", ""), (2, "m", "")], "commit_id long, message_clean string, diff_text string")
    one = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0, 0.0, 1.0])],
                                "commit_id long, probs array<double>")
    two = one.withColumn("probs", F.array(*map(F.lit, [0.0, 1.0, 0.0, 0.0, 0.0])))
    members = {"a": scoring.table_scorer(one), "b": scoring.table_scorer(two)}
    weights = spark.createDataFrame([("b", 3.0), ("a", 1.0)], "member string, weight double")
    mixed = {r.commit_id: r.probs for r in scoring.ensemble_scorer(members, weights)(df).collect()}
    assert mixed == {1: [0.25, 0.75, 0.0, 0.0, 0.0], 2: [0.0, 0.75, 0.0, 0.0, 0.25]}
    with pytest.raises(FileNotFoundError):
        scoring.ensemble_scorer({"a": members["a"]}, weights)
    answers = spark.createDataFrame([(1, "docs", "few_shot", "x")], "commit_id long, raw string, strategy string, model string")
    told = {r.commit_id: r.probs for r in scoring.answer_scorer(answers)(df).collect()}
    fix = fv.TARGET_CLASSES.index("fix")
    assert told[1][fv.TARGET_CLASSES.index("docs")] == 1.0 and told[2][fix] == 1.0
    both = scoring.answer_ensemble_scorer(answers, members["a"], {"x": 0.6}, 0.7, 2.0)(df)
    shares = {r.commit_id: [round(p, 3) for p in r.probs] for r in both.collect()}
    assert shares[1] == [0.7, 0.0, 0.3, 0.0, 0.0] and shares[2] == [0.0, 0.3, 0.0, 0.0, 0.7]


def test_times_are_shown_in_utc_whatever_the_session_zone(spark):
    from gitsift.functions.text import day, iso_seconds

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            ts = F.timestamp_seconds(F.lit(1704067200))
            row = spark.range(1).select(iso_seconds(ts).alias("a"), day(ts).alias("b")).first()
            assert (row.a, row.b) == ("2024-01-01T00:00:00", "2024-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
