"""Prediction history and the streams that feed and read it."""

from __future__ import annotations

from pyspark.sql import functions as F

from gitsift.functions import probabilities as pr
from gitsift.plans import fixtures as fx
from gitsift.plans.model_queries import OUTSIDE_SQL, outside_scorers
from gitsift.plans.registry import query
from gitsift.plans.registry import with_tables as sql
from gitsift.plans.voting_queries import ARGMAX, NAMES
from gitsift.session import measured, new_path
from gitsift.sources import history
from gitsift.streaming import scoring as streaming

MODELS_SQL = fx.SCORED_EVENTS_SQL + """,
models AS (SELECT CAST(row_number() OVER (ORDER BY min(ts), model) AS INTEGER) AS model_id, model AS name,
  min(ts) AS trained_at FROM scored_events GROUP BY model),
predictions AS (SELECT event_id AS id, ts, model_id, model, batch_run_id,
  substring(message, 1, 280) AS message_preview, substring(diff, 1, 280) AS diff_preview,
  label AS predicted_label, confidence, source FROM scored_events JOIN models ON name = model)"""


def models_of(spark, sf_dir):
    """The models table, stored: its size on disk decides how it is joined."""
    used = fx.scored_events(spark, sf_dir)
    return measured(history.add_missing_models(history.empty_models(spark), used), "models")


def scored_of(spark, sf_dir):
    return fx.scored_events(spark, sf_dir).withColumnRenamed("event_id", "id").withColumn(
        "probabilities", pr.as_map(F.col("probs")))


def predictions_of(spark, sf_dir):
    return history.prediction_rows(scored_of(spark, sf_dir), models_of(spark, sf_dir))


@query("src15_prediction_log", sql(MODELS_SQL, """
SELECT id, ts, model_id, batch_run_id, message_preview, diff_preview, predicted_label, confidence,
  CASE WHEN predicted_label = 'fix' THEN confidence ELSE round((1 - confidence) / 4, 8) END AS p_fix,
  source FROM predictions"""))
def src15(spark, sf_dir):
    """Logged by two writers whose rows overlap, one of which is run again; no id is there twice."""
    scored = scored_of(spark, sf_dir)
    registry, path = new_path(spark, "registry"), new_path(spark, "log")
    history.Log(registry, path, "all").write(scored)
    again = history.Log(registry, path, "some")
    for _ in range(2):
        again.write(scored.filter(F.col("source") != "gui"))
    log = history.read_log(spark, path)
    return log.withColumn("p_fix", F.round(F.col("probabilities")["fix"], 8)).drop("probabilities")


@query("src16_batch_runs", sql(MODELS_SQL + "," + fx.BATCH_RUNS_SQL, """
SELECT batch_run_id AS id, ts, repo_path, n_commits, model_id
FROM batch_requests JOIN models ON name = model"""))
def src16(spark, sf_dir):
    runs = history.batch_run_rows(fx.batch_run_requests(spark, sf_dir), models_of(spark, sf_dir))
    path = new_path(spark, "batch-runs")
    history.append_predictions(runs, path)
    return spark.read.schema(runs.schema).parquet(path)


@query("joi1_recent_predictions", sql(MODELS_SQL, """
SELECT id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, model, predicted_label AS label, confidence,
  message_preview AS message, source FROM predictions ORDER BY id DESC LIMIT 200"""))
def joi1(spark, sf_dir):
    return history.recent_predictions(predictions_of(spark, sf_dir), models_of(spark, sf_dir), 200)


@query("top6_newest_ids", sql(MODELS_SQL, """
SELECT id, model FROM predictions ORDER BY id DESC LIMIT 25"""))
def top6(spark, sf_dir):
    newest = history.recent_predictions(predictions_of(spark, sf_dir), models_of(spark, sf_dir))
    return newest.select("id", "model")


@query("joi2_recent_batch_runs", sql(MODELS_SQL + "," + fx.BATCH_RUNS_SQL, """
SELECT batch_run_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, repo_path AS repo, n_commits, model
FROM batch_requests ORDER BY id DESC LIMIT 25"""))
def joi2(spark, sf_dir):
    models = models_of(spark, sf_dir)
    runs = history.batch_run_rows(fx.batch_run_requests(spark, sf_dir), models)
    return history.recent_batch_runs(runs, models)


@query("joi3_prediction_batch_run", sql(MODELS_SQL + "," + fx.BATCH_RUNS_SQL, """
SELECT id, p.batch_run_id, predicted_label, repo_path, n_commits
FROM predictions p LEFT JOIN batch_requests b ON b.batch_run_id = p.batch_run_id"""))
def joi3(spark, sf_dir):
    models = models_of(spark, sf_dir)
    runs = history.batch_run_rows(fx.batch_run_requests(spark, sf_dir), models)
    df = history.with_batch_run(predictions_of(spark, sf_dir), runs)
    return df.select("id", "batch_run_id", "predicted_label", "repo_path", "n_commits")


@query("joi9_get_or_create_model", sql(fx.SCORED_EVENTS_SQL, """,
old AS (SELECT row_number() OVER (ORDER BY min(ts), model) AS model_id, model AS name
  FROM scored_events WHERE source = 'cli' AND model NOT LIKE '%l%' GROUP BY model),
new AS (SELECT (SELECT max(model_id) FROM old) + row_number() OVER (ORDER BY min(ts), model) AS model_id,
  model AS name FROM scored_events WHERE model NOT IN (SELECT name FROM old) GROUP BY model)
SELECT CAST(model_id AS INTEGER) AS model_id, name, '0.1.0' AS version FROM old
UNION ALL SELECT CAST(model_id AS INTEGER), name, '0.1.0' FROM new"""))
def joi9(spark, sf_dir):
    """Some names are stored already and keep their ids; the others follow and are stored too."""
    used = fx.scored_events(spark, sf_dir)
    early = used.filter((F.col("source") == "cli") & ~F.col("model").contains("l"))
    registry = new_path(spark, "registry")
    history.registered(early, registry)
    history.registered(used, registry)
    return history.read_models(spark, registry).select("model_id", "name", "version")


@query("joi10_upsert_metrics", sql(MODELS_SQL, """,
m AS (SELECT model, round(avg(confidence), 6) AS a FROM scored_events
  WHERE source IN ('gui', 'cli') AND model <> 'codebert' GROUP BY model)
SELECT model_id, name, CASE WHEN name = 'cnn_text' THEN '0.2.0' ELSE '0.1.0' END AS version,
  CASE WHEN m.model IS NULL THEN trained_at ELSE TIMESTAMP '2024-02-01 00:00:00' END AS trained_at,
  a AS accuracy_test, CASE WHEN m.model NOT LIKE 'c%' THEN a / 2 END AS macro_f1_test
FROM models LEFT JOIN m ON m.model = name"""))
def joi10(spark, sf_dir):
    """New scores overwrite only where given; models without new scores stay as they were."""
    scored = fx.scored_events(spark, sf_dir)
    new = scored.filter(F.col("source").isin("gui", "cli") & (F.col("model") != "codebert")).groupBy(
        F.col("model").alias("name")).agg(F.round(F.avg("confidence"), 6).alias("accuracy_test"))
    new = new.select(
        "name", "accuracy_test",
        F.when(~F.col("name").startswith("c"), F.col("accuracy_test") / 2).alias("macro_f1_test"),
        F.when(F.col("name") == "cnn_text", "0.2.0").alias("version"))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return history.register_metrics(models_of(spark, sf_dir), new, now).drop("notes")


@query("agg8_logged_labels", sql(MODELS_SQL, """
SELECT predicted_label AS label, count(*) AS n FROM predictions GROUP BY predicted_label"""))
def agg8(spark, sf_dir):
    return history.label_distribution(predictions_of(spark, sf_dir))


# --- streams ----------------------------------------------------------------
@query("stm1_score_stream", sql(OUTSIDE_SQL, f"""
SELECT commit_id AS id, 1 AS model_id, {NAMES}[{ARGMAX}] AS predicted_label,
  round(probs[{ARGMAX}], 6) AS confidence, substring(message, 1, 280) AS message_preview,
  'stream' AS source FROM outside"""))
def stm1(spark, sf_dir):
    """Commits arrive in files and are scored into the log; a replay adds nothing."""
    commits = fx.commits(spark, sf_dir).select("commit_id", "ts", "message", "diff")
    arrivals = new_path(spark, "arrivals")
    log = history.Log(new_path(spark, "registry"), new_path(spark, "stream-log"), "stream")
    commits.repartition(4).write.parquet(arrivals)
    stream = spark.readStream.schema(commits.schema).option("maxFilesPerTrigger", 2).parquet(arrivals)
    for attempt in range(2):
        checkpoint = new_path(spark, f"stream-checkpoint-{attempt}")
        streaming.score_stream(
            stream, "cnn_text", outside_scorers(), log, checkpoint).awaitTermination()
    return history.read_log(spark, log.path).select(
        "id", "model_id", "predicted_label", F.round("confidence", 6).alias("confidence"),
        "message_preview", "source")


@query("stm2_label_counts_stream", sql(MODELS_SQL, """
SELECT predicted_label AS label, count(*) AS n FROM predictions GROUP BY predicted_label"""))
def stm2(spark, sf_dir):
    """Running label counts of the log, in complete mode, as of the last micro-batch."""
    rows = predictions_of(spark, sf_dir).select("id", "predicted_label")
    log, out = new_path(spark, "log"), new_path(spark, "label-counts")
    rows.repartition(4).write.parquet(log)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(log)
    counts = streaming.label_counts_stream(stream)
    counts.writeStream.outputMode("complete").trigger(availableNow=True).option(
        "checkpointLocation", new_path(spark, "counts-checkpoint")).foreachBatch(
        lambda batch, _: batch.write.mode("overwrite").parquet(out)).start().awaitTermination()
    return spark.read.schema("label string, n bigint").parquet(out)
