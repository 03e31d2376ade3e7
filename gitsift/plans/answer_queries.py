"""Prompts, answer parsing, run evaluation, leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions import answers, prompts
from gitsift.operators import evaluation, leaderboards, sampling
from gitsift.plans import fixtures as fx
from gitsift.plans.registry import query
from gitsift.plans.registry import with_tables as sql
from gitsift.plans.voting_queries import report_sql, rounded
from gitsift.session import materialise, new_path
from gitsift.sources import corpus, reports, runs

RUN = ["model", "strategy"]


def cut_sql(text: str, n: int) -> str:
    return (f"(CASE WHEN length({text}) <= {n} THEN {text} ELSE substring({text}, 1, {n}) "
            f"|| chr(10) || '...[truncated]' END)")


def lit_sql(text: str) -> str:
    return fx.sql_text(text)


def fenced_sql(text: str, n: int) -> str:
    return lit_sql("Diff:\n```diff\n") + " || " + cut_sql(text, n) + " || " + lit_sql("\n```")


POOL_SQL = fx.SPLIT_SQL + """,
pool AS MATERIALIZED (SELECT label AS type,
    substring(split_part(message_clean, chr(10), 1), 1, 72) AS subject, diff_text AS diff,
    md5('42|' || commit_id) AS k FROM splits WHERE split = 'train'
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5('42|' || commit_id), commit_id) = 1)"""


def few_shot_examples(spark, sf_dir):
    """One row: an example per class. Diffs one character longer than prompts show are as good
    as whole ones, and bound what is sent to all tasks."""
    train = fx.splits(spark, sf_dir).filter(F.col("split") == "train")
    shown = F.substring("diff", 1, max(fv.GENERATE_EXAMPLE_LIMIT, fv.CLASSIFY_EXAMPLE_LIMIT) + 1)
    return sampling.as_examples(sampling.few_shot_pool(train).withColumn("diff", shown))


def prompt_digests(df, make, strategies):
    """Length and digest of each prompt: the whole text is compared, not printed."""
    out = []
    for s in strategies:
        text = make(s)
        out += [F.md5(text.cast("binary")).alias(f"{s}_md5"), F.length(text).alias(f"{s}_chars")]
    return df.select("commit_id", *out)


def digests_sql(texts: dict[str, str]) -> str:
    return ", ".join(f"md5({t}) AS {s}_md5, length({t}) AS {s}_chars" for s, t in texts.items())


@query("str6_generation_prompts", sql(POOL_SQL + """,
shots AS (SELECT string_agg(""" + fenced_sql("diff", 1500) + """ || chr(10) || 'Commit message: '
  || type || ': ' || subject, """ + lit_sql(fv.EXAMPLE_SEPARATOR) + """ ORDER BY k) AS shown FROM pool)
SELECT commit_id, """ + digests_sql({
    "zero_shot": fenced_sql("diff_text", 3500) + " || " + lit_sql("\n\nCommit message:"),
    "few_shot": "shown || " + lit_sql(fv.EXAMPLE_SEPARATOR) + " || "
                + fenced_sql("diff_text", 3500) + " || " + lit_sql("\nCommit message:"),
    "chain_of_thought": fenced_sql("diff_text", 3500) + " || "
                        + lit_sql("\n\n" + fv.GENERATE_REASONING_TAIL),
    "json_mode": fenced_sql("diff_text", 3500) + " || " + lit_sql("\n\n" + fv.GENERATE_JSON_TAIL),
}) + " FROM splits, shots"))
def str6(spark, sf_dir):
    """Four prompts per commit; the example pool is one row of one example per class."""
    df = fx.splits(spark, sf_dir).join(F.broadcast(few_shot_examples(spark, sf_dir)))
    return prompt_digests(
        df, lambda s: prompts.generation_prompt(s, F.col("diff_text"), F.col("examples")),
        prompts.STRATEGIES)


@query("str7_classification_prompts", sql(POOL_SQL + """,
shots AS (SELECT string_agg('Commit message: ' || subject || chr(10) || """
    + fenced_sql("diff", 1200) + """ || chr(10) || 'Type: ' || type, """
    + lit_sql(fv.EXAMPLE_SEPARATOR) + """ ORDER BY k) AS shown FROM pool)
SELECT commit_id, """ + digests_sql({
    "zero_shot": lit_sql("Commit message:\n") + " || message_clean || " + lit_sql("\n\n") + " || "
                 + fenced_sql("diff_text", 2500) + " || " + lit_sql("\n\nType:"),
    "few_shot": "shown || " + lit_sql(fv.EXAMPLE_SEPARATOR + "Commit message: ")
                + " || message_clean || chr(10) || " + fenced_sql("diff_text", 2500) + " || "
                + lit_sql("\nType:"),
    "json_mode": lit_sql("Commit message:\n") + " || message_clean || " + lit_sql("\n\n") + " || "
                 + fenced_sql("diff_text", 2500) + " || " + lit_sql("\n\n" + fv.CLASSIFY_JSON_TAIL),
}) + " FROM splits, shots"))
def str7(spark, sf_dir):
    df = fx.splits(spark, sf_dir).join(F.broadcast(few_shot_examples(spark, sf_dir)))
    return prompt_digests(
        df, lambda s: prompts.classification_prompt(
            s, F.col("message_clean"), F.col("diff_text"), F.col("examples")),
        ["zero_shot", "few_shot", "json_mode"])


# --- parsing answers --------------------------------------------------------
TYPES = "|".join(fv.COMMIT_TYPES)
LINE = lit_sql(rf"(?i)^({TYPES})(?:\(([^)]*)\))?(!)?{fv.SPACE_CLASS}*:{fv.SPACE_CLASS}*(.+)$")
LINES_SQL = f"""
hits AS (SELECT *, list_filter(list_transform(regexp_split_to_array(raw, {fx.NL}),
    lambda l: trim(l, {fx.WS})), lambda l: regexp_matches(l, {LINE}))[1] AS hit FROM responses),
by_line AS MATERIALIZED (SELECT *, CASE WHEN hit IS NOT NULL
    THEN lower(regexp_extract(hit, {LINE}, 1)) END AS line_type,
  CASE WHEN hit IS NOT NULL THEN trim(regexp_extract(hit, {LINE}, 2), {fx.WS}) ELSE '' END
    AS line_scope,
  CASE WHEN hit IS NOT NULL THEN trim(regexp_extract(hit, {LINE}, 4), {fx.WS})
    ELSE substring(split_part(trim(raw, {fx.WS}), chr(10), 1), 1, 120) END AS line_subject
  FROM hits),
boxed AS (SELECT *, CASE WHEN json_valid(raw) THEN raw
    WHEN json_valid(nullif(regexp_extract(raw, '(?s)\\{{.*\\}}', 0), ''))
    THEN regexp_extract(raw, '(?s)\\{{.*\\}}', 0) END AS j FROM by_line),
by_json AS MATERIALIZED (SELECT *, lower(trim(coalesce(json_extract_string(j, '$.type'), ''), {fx.WS})) AS jt,
  trim(coalesce(json_extract_string(j, '$.scope'), ''), {fx.WS}) AS jscope,
  trim(coalesce(json_extract_string(j, '$.subject'), ''), {fx.WS}) AS jsubject FROM boxed),
parsed_rows AS MATERIALIZED (SELECT *,
  CASE WHEN strategy <> 'json_mode' OR j IS NULL THEN line_type
       WHEN jt IN {fx.TARGETS} THEN jt END AS parsed_type,
  CASE WHEN strategy <> 'json_mode' OR j IS NULL THEN line_scope ELSE jscope END AS scope,
  CASE WHEN strategy <> 'json_mode' OR j IS NULL THEN line_subject ELSE jsubject END AS pred_subject
  FROM by_json)"""
ANSWERS_SQL = fx.RESPONSES_SQL + "," + LINES_SQL
IDS = "commit_id, model, strategy"


@query("str8_commit_line", sql(ANSWERS_SQL, f"""
SELECT {IDS}, line_type AS parsed_type, line_scope AS scope, line_subject AS subject FROM by_line"""))
def str8(spark, sf_dir):
    df = fx.responses(spark, sf_dir)
    return df.select("commit_id", *RUN, answers.parse_commit_line(F.col("raw")).alias("p")).select(
        "commit_id", *RUN, "p.*")


@query("str9_json_message", sql(ANSWERS_SQL, f"""
SELECT {IDS}, CASE WHEN j IS NULL THEN line_type WHEN jt IN {fx.TARGETS} THEN jt END AS parsed_type,
  CASE WHEN j IS NULL THEN line_scope ELSE jscope END AS scope,
  CASE WHEN j IS NULL THEN line_subject ELSE jsubject END AS subject FROM by_json"""))
def str9(spark, sf_dir):
    df = fx.responses(spark, sf_dir)
    return df.select("commit_id", *RUN, answers.parse_json_message(F.col("raw")).alias("p")).select(
        "commit_id", *RUN, "p.*")


WORD = lit_sql(r"(?is)(?:^|[^\p{L}\p{N}_])(feat|fix|docs|refactor|test)(?:$|[^\p{L}\p{N}_])")
CLASSIFIED_SQL = fx.RESPONSES_SQL + f""",
words AS (SELECT *, nullif(lower(regexp_extract(raw, {WORD}, 1)), '') AS word,
  CASE WHEN json_valid(raw) THEN raw END AS whole,
  nullif(regexp_extract(raw, '(?s)\\{{.*?\\}}', 0), '') AS inner_text FROM responses),
kinds AS (SELECT *, lower(trim(coalesce(json_extract_string(whole, '$.type'), ''), {fx.WS})) AS wt,
  lower(trim(coalesce(json_extract_string(CASE WHEN json_valid(inner_text) THEN inner_text END,
    '$.type'), ''), {fx.WS})) AS it FROM words),
classified AS MATERIALIZED (SELECT *, CASE WHEN raw = '' THEN NULL
    WHEN strategy <> 'json_mode' THEN word
    WHEN whole IS NOT NULL THEN CASE WHEN wt IN {fx.TARGETS} THEN wt END
    WHEN it IN {fx.TARGETS} THEN it ELSE word END AS predicted FROM kinds)"""


@query("str10_class_of_answer", sql(CLASSIFIED_SQL, f"SELECT {IDS}, predicted FROM classified"))
def str10(spark, sf_dir):
    return fx.responses(spark, sf_dir).select(
        "commit_id", *RUN, answers.parse_class(F.col("raw"), F.col("strategy")).alias("predicted"))


@query("str11_one_liner", sql(ANSWERS_SQL, f"""
SELECT {IDS}, CASE WHEN parsed_type IS NOT NULL THEN trim(parsed_type
    || CASE WHEN scope <> '' THEN '(' || scope || ')' ELSE '' END || ': ' || pred_subject, {fx.WS})
  WHEN raw = '' THEN '' WHEN pred_subject <> '' THEN pred_subject
  ELSE substring(split_part(raw, chr(10), 1), 1, 120) END AS one_liner FROM parsed_rows"""))
def str11(spark, sf_dir):
    p = evaluation.generation_rows(fx.responses(spark, sf_dir))
    return p.select("commit_id", *RUN, answers.one_liner(
        F.col("parsed_type"), F.col("scope"), F.col("pred_subject"), F.col("raw")).alias("one_liner"))


@query("str12_type_in_target", sql(ANSWERS_SQL, f"""
SELECT {IDS}, coalesce(parsed_type IN {fx.TARGETS}, false) AS in_target FROM parsed_rows"""))
def str12(spark, sf_dir):
    p = fx.responses(spark, sf_dir).withColumn(
        "p", answers.parse_message(F.col("raw"), F.col("strategy")))
    return p.select("commit_id", *RUN, answers.in_target(F.col("p.parsed_type")).alias("in_target"))


@query("str18_tool_calls", sql(fx.TOOL_MESSAGES_SQL, f"""
SELECT conv_id, turn, name, arguments FROM (
  SELECT conv_id, turn, coalesce(nullif(json_extract_string(j, '$.name'), ''),
      nullif(json_extract_string(j, '$.tool'), '')) AS name,
    coalesce(nullif(json_extract(j, '$.arguments')::VARCHAR, '{{}}'),
      nullif(json_extract(j, '$.args')::VARCHAR, '{{}}'),
      nullif(json_extract(j, '$.parameters')::VARCHAR, '{{}}'), '{{}}') AS arguments FROM (
    SELECT *, CASE WHEN json_valid(body) THEN body
      WHEN json_valid(nullif(regexp_extract(body, '(?s)\\{{.*\\}}', 0), ''))
      THEN regexp_extract(body, '(?s)\\{{.*\\}}', 0) END AS j FROM (
      SELECT *, regexp_replace(trim(text, {fx.WS}), '(?m)^```(?:json)?\\s*|\\s*```$', '', 'g')
        AS body FROM tool_messages)))
WHERE name IN ({", ".join(lit_sql(t) for t in fv.TOOL_NAMES)})"""))
def str18(spark, sf_dir):
    df = fx.tool_messages(spark, sf_dir)
    calls = df.withColumn("call", answers.tool_call(F.col("text")))
    squeezed = F.regexp_replace("call.arguments", ":", ":")
    return calls.filter(F.col("call").isNotNull()).select(
        "conv_id", "turn", "call.name", squeezed.alias("arguments"))


# --- evaluation of runs -----------------------------------------------------
@query("agg9_latency_percentiles", sql(fx.RESPONSES_SQL, """
SELECT model, strategy, round(quantile_cont(latency_ms, 0.5), 6) AS latency_ms_p50,
  round(quantile_cont(latency_ms, 0.95), 6) AS latency_ms_p95,
  round(avg(latency_ms), 6) AS latency_ms_mean FROM responses GROUP BY model, strategy"""))
def agg9(spark, sf_dir):
    df = evaluation.latency_summary(fx.responses(spark, sf_dir))
    return rounded(df, ["latency_ms_p50", "latency_ms_p95", "latency_ms_mean"])


@query("agg9_value_percentiles", """
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6)
  AS p95 FROM events GROUP BY event_type""")
def agg9_events(spark, sf_dir):
    df = evaluation.exact_percentiles(
        fx.table(spark, sf_dir, "events"), ["event_type"], "value", [0.5, 0.95])
    return df.select("event_type", F.round(F.col("percentiles")[0], 6).alias("p50"),
                     F.round(F.col("percentiles")[1], 6).alias("p95"))


@query("agg10_run_rates", sql(ANSWERS_SQL, f"""
SELECT model, strategy, count(*) AS n,
  round(avg(CAST(coalesce(parsed_type = gold, false) AS INT)), 6) AS type_exact_match,
  round(avg(CAST(coalesce(parsed_type IN {fx.TARGETS}, false) AS INT)), 6) AS type_in_target,
  round(avg(CAST(parsed_type IS NULL AS INT)), 6) AS parse_failure_rate,
  round(avg(completion_tokens), 6) AS completion_tokens_mean
FROM parsed_rows GROUP BY model, strategy"""))
def agg10(spark, sf_dir):
    rows = evaluation.generation_rows(fx.responses(spark, sf_dir)).drop("rouge_l")
    return rounded(evaluation.run_rates(rows), [
        "type_exact_match", "type_in_target", "parse_failure_rate", "completion_tokens_mean"])


def bleu_tokens_sql(text: str) -> str:
    out = text
    for old, new in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'),
                     ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = f"replace({out}, {lit_sql(old)}, {lit_sql(new)})"
    out = f"' ' || {out} || ' '"
    for pattern, new in ((r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
                         (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")):
        out = f"regexp_replace({out}, {lit_sql(pattern)}, {lit_sql(new)}, 'g')"
    return f"list_filter(regexp_split_to_array({out}, '\\s+'), lambda t: t <> '')"


CANDIDATE_SQL = "CASE WHEN pred_subject <> '' THEN pred_subject ELSE raw END"


@query("agg11_corpus_bleu", sql(ANSWERS_SQL + f""",
tok AS MATERIALIZED (SELECT commit_id, model, strategy, {bleu_tokens_sql(CANDIDATE_SQL)} AS c,
  {bleu_tokens_sql("gold_subject")} AS r FROM parsed_rows),
sides AS (SELECT commit_id, model, strategy, c AS t, 1 AS own FROM tok
  UNION ALL SELECT commit_id, model, strategy, r, 0 FROM tok),
grams AS (SELECT commit_id, model, strategy, n, own, unnest(list_transform(
    range(1, CAST(len(t) - n + 2 AS BIGINT)),
    lambda i: array_to_string(t[i : i + n - 1], ' '))) AS g FROM sides, range(1, 5) AS o(n)
  WHERE len(t) >= n),
counted AS (SELECT model, strategy, n, commit_id, g, sum(own) AS mine, sum(1 - own) AS theirs
  FROM grams GROUP BY ALL),
mt AS (SELECT model, strategy, n, sum(least(mine, theirs)) AS m, sum(mine) AS total FROM counted
  GROUP BY ALL),
sm AS (SELECT *, count(*) FILTER (m = 0) OVER (PARTITION BY model, strategy ORDER BY n) AS z FROM mt),
ln4 AS (SELECT model, strategy, sum(m) AS any_match, sum(ln(CASE WHEN m > 0 THEN 100.0::DOUBLE * m / total
    ELSE 100.0::DOUBLE / (2 ** z * total) END)) AS logs FROM sm GROUP BY model, strategy),
ls AS (SELECT model, strategy, CAST(sum(len(c)) AS BIGINT) AS candidate_length,
  CAST(sum(len(r)) AS BIGINT) AS reference_length FROM tok GROUP BY model, strategy)
SELECT model, strategy, candidate_length, reference_length,
  round(CASE WHEN any_match = 0 THEN 0 ELSE exp(logs / 4) * CASE WHEN candidate_length >= reference_length
    THEN 1 ELSE exp(1 - reference_length / candidate_length) END END, 6) AS bleu
FROM ls JOIN ln4 USING (model, strategy)"""))
def agg11(spark, sf_dir):
    from gitsift.operators.text_metrics import corpus_bleu

    rows = evaluation.generation_rows(fx.responses(spark, sf_dir))
    return rounded(corpus_bleu(rows, RUN, "candidate", "gold_subject"), ["bleu"])


ROUGE_SQL = ANSWERS_SQL + f""",
rt AS (SELECT {IDS}, list_filter(regexp_split_to_array(lower(gold_subject), '[^a-z0-9]+'),
    lambda t: t <> '') AS a, list_filter(regexp_split_to_array(lower({CANDIDATE_SQL}), '[^a-z0-9]+'),
    lambda t: t <> '') AS b FROM parsed_rows),
pairs AS MATERIALIZED (SELECT DISTINCT a, b FROM rt),
dp AS (SELECT a, b, 0 AS i, list_transform(range(CAST(len(b) AS BIGINT) + 1), lambda x: 0) AS row FROM pairs
  UNION ALL SELECT a, b, i + 1, list_transform(range(CAST(len(b) AS BIGINT) + 1), lambda x:
    CASE WHEN x = 0 THEN 0 ELSE greatest(row[x + 1], coalesce(list_max(list_transform(
      list_filter(range(1, x + 1), lambda y: b[y] = a[i + 1]), lambda y: row[y] + 1)), 0)) END)
  FROM dp WHERE i < len(a)),
lcs AS (SELECT a, b, row[-1] AS l FROM dp WHERE i = len(a)),
scored_rows AS (SELECT {IDS}, CASE WHEN len(a) + len(b) > 0 THEN 2.0::DOUBLE * l / (len(a) + len(b))
  ELSE 0.0::DOUBLE END AS rouge_l FROM rt JOIN lcs USING (a, b))"""


@query("agg12_rouge_l", sql(ROUGE_SQL, f"SELECT {IDS}, round(rouge_l, 6) AS rouge_l FROM scored_rows"))
def agg12(spark, sf_dir):
    rows = evaluation.generation_rows(fx.responses(spark, sf_dir))
    return rows.select("commit_id", *RUN, F.round("rouge_l", 6).alias("rouge_l"))


SCORED_SQL = CLASSIFIED_SQL + f""",
cls AS MATERIALIZED (SELECT *, CASE WHEN predicted IN {fx.TARGETS} THEN predicted ELSE 'fix' END AS pred,
  CAST(coalesce(predicted = gold, false) AS INT) AS correct FROM classified)"""


@query("evl3_classification_summary", sql(SCORED_SQL + "," + report_sql("cls", "model, strategy") + """,
extra AS (SELECT model, strategy, avg(correct) AS strict_accuracy,
  avg(CAST(predicted IS NULL AS INT)) AS parse_failure_rate,
  quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
  avg(completion_tokens) AS tokens FROM cls GROUP BY model, strategy)""", """
SELECT model, strategy, n_samples AS n, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
  round(weighted_f1, 6) AS weighted_f1, round(macro_precision, 6) AS macro_precision,
  round(macro_recall, 6) AS macro_recall, round(strict_accuracy, 6) AS strict_accuracy,
  round(parse_failure_rate, 6) AS parse_failure_rate, round(p50, 6) AS latency_ms_p50,
  round(p95, 6) AS latency_ms_p95, round(tokens, 6) AS completion_tokens_mean
FROM rep JOIN extra USING (model, strategy)"""))
def evl3(spark, sf_dir):
    rows = materialise(evaluation.classification_rows(fx.responses(spark, sf_dir)), "rows")
    df = evaluation.classification_summary(rows).drop("latency_ms_mean")
    return rounded(df, [c for c in df.columns if c not in ("model", "strategy", "n")])


@query("win5_running_accuracy", sql(SCORED_SQL, """
SELECT model, strategy, idx, round(acc, 6) AS accuracy FROM (
  SELECT model, strategy, row_number() OVER (PARTITION BY model, strategy ORDER BY commit_id) AS idx,
    avg(correct) OVER (PARTITION BY model, strategy ORDER BY commit_id
      ROWS UNBOUNDED PRECEDING) AS acc FROM cls) WHERE idx % 25 = 0"""))
def win5(spark, sf_dir):
    rows = evaluation.classification_rows(fx.responses(spark, sf_dir))
    return rounded(evaluation.running_accuracy(rows, RUN, 25), ["accuracy"])


@query("win5_running_accuracy_by_text", sql(SCORED_SQL, """
SELECT model, strategy, idx, round(acc, 6) AS accuracy FROM (
  SELECT model, strategy, row_number() OVER (PARTITION BY model, strategy ORDER BY key) AS idx,
    avg(correct) OVER (PARTITION BY model, strategy ORDER BY key ROWS UNBOUNDED PRECEDING) AS acc
  FROM (SELECT *, md5(CAST(commit_id AS VARCHAR)) AS key FROM cls)) WHERE idx % 25 = 0"""))
def win5_text(spark, sf_dir):
    """The same in the order of text ids."""
    rows = evaluation.classification_rows(fx.responses(spark, sf_dir)).withColumn(
        "at", F.md5(F.col("commit_id").cast("string").cast("binary")))
    return rounded(evaluation.running_accuracy(rows, RUN, 25, order="at"), ["accuracy"])


@query("src18_run_documents", sql(SCORED_SQL + "," + report_sql("cls", "model, strategy"), """
SELECT model, strategy, n_samples AS n_rows, round(accuracy, 6) AS accuracy,
  round(macro_recall, 6) AS macro_recall FROM rep"""))
def src18(spark, sf_dir):
    """Documents per run and their rows, written as JSON and read back."""
    from gitsift.operators.metrics import evaluation_report

    rows = materialise(evaluation.classification_rows(fx.responses(spark, sf_dir)), "rows")
    path = new_path(spark, "run-documents")
    summary = evaluation.classification_summary(rows)
    reports.write_run_documents(summary, evaluation_report(rows, RUN), rows.select(
        "commit_id", *RUN, "gold", "pred", "correct", "latency_ms", "raw"), RUN, path)
    documents = reports.read_run_documents(
        spark, path, "model string, strategy string, summary struct<accuracy: double>, "
                     "full_report struct<macro_recall: double>")
    counts = spark.read.schema("commit_id bigint, model string, strategy string").json(
        f"{path}/rows").groupBy(*RUN).agg(F.count("*").alias("n_rows"))
    return documents.join(counts, RUN).select(
        *RUN, "n_rows", F.round("summary.accuracy", 6).alias("accuracy"),
        F.round("full_report.macro_recall", 6).alias("macro_recall"))


# --- run summaries and leaderboards -----------------------------------------
RUN_COLS = ("model, strategy, sample_kind, run_seq, n, type_exact_match, accuracy, bleu, "
            "latency_ms_p50").split(", ")
LAST2 = fx.RUNS_SQL + """,
last2 AS (SELECT * FROM runs QUALIFY row_number() OVER
  (PARTITION BY model, strategy ORDER BY run_seq DESC) = 1)"""
LAST3 = fx.RUNS_SQL + """,
last3 AS (SELECT * FROM runs QUALIFY row_number() OVER
  (PARTITION BY model, strategy, sample_kind ORDER BY run_seq DESC) = 1)"""


def last2(spark, sf_dir):
    return leaderboards.last_runs(fx.run_summaries(spark, sf_dir), RUN)


def last3(spark, sf_dir):
    return leaderboards.last_runs(fx.run_summaries(spark, sf_dir), [*RUN, "sample_kind"])


def tidy(df, columns=("type_exact_match", "accuracy")):
    return rounded(df.select(*RUN_COLS), list(columns))


TIDY = ", ".join(f"round({c}, 6) AS {c}" if c in ("type_exact_match", "accuracy") else c
                 for c in RUN_COLS)


@query("win1_last_run", sql(LAST3, f"SELECT {TIDY} FROM last3"))
def win1(spark, sf_dir):
    return tidy(last3(spark, sf_dir))


@query("set3_keep_last", sql(LAST2, f"SELECT {TIDY} FROM last2"))
def set3(spark, sf_dir):
    return tidy(last2(spark, sf_dir))


@query("win2_best_per_model", sql(LAST2, f"""
SELECT {TIDY} FROM last2 QUALIFY row_number() OVER
  (PARTITION BY model ORDER BY last2.type_exact_match DESC, strategy) = 1"""))
def win2(spark, sf_dir):
    return tidy(leaderboards.best_per_model(last2(spark, sf_dir)))


@query("top2_generation_leaderboard", sql(LAST2, f"""
SELECT {TIDY} FROM last2 ORDER BY last2.type_exact_match DESC, model, strategy"""))
def top2(spark, sf_dir):
    return tidy(leaderboards.leaderboard(last2(spark, sf_dir), "type_exact_match", RUN))


SYSTEMS_SQL = LAST2 + "," + fx.MEMBERS_SQL + f""",
filled AS (SELECT gold, 'ensemble_' || member AS config,
  CASE WHEN pred IN {fx.TARGETS} THEN pred ELSE 'fix' END AS pred FROM mp),
""" + report_sql("filled", "config") + """,
stored AS (SELECT accuracy, macro_f1, weighted_f1 FROM rep WHERE config = 'ensemble_baseline_tfidf'),
board AS (SELECT 'baseline_tfidf report' AS system, accuracy, macro_f1, weighted_f1, true AS is_baseline,
  false AS is_winner FROM stored
UNION ALL SELECT model || ' · ' || strategy, accuracy, macro_f1, weighted_f1, false, false FROM last2
UNION ALL SELECT 'ensemble · ' || replace(config, 'ensemble_', ''), accuracy, macro_f1, weighted_f1,
  false, accuracy >= (SELECT accuracy FROM stored) AND macro_f1 >= (SELECT macro_f1 FROM stored)
    AND weighted_f1 >= (SELECT weighted_f1 FROM stored) FROM rep)"""


def stored_baseline(spark, sf_dir):
    """Scores of the first member, from a report that was written and read back."""
    from gitsift.operators.metrics import evaluation_report
    from gitsift.plans.voting_queries import filled

    path = new_path(spark, "baseline-report")
    evaluation_report(filled(spark, sf_dir).filter("member_idx = 0"), ["member"]).select(
        *leaderboards.SCORES).write.parquet(path)
    return leaderboards.baseline_of(spark.read.parquet(path), "baseline_tfidf report")


def systems(spark, sf_dir):
    from gitsift.operators.metrics import evaluation_report
    from gitsift.plans.voting_queries import filled

    report = evaluation_report(filled(spark, sf_dir), ["member"])
    ensembles = report.withColumn("config", F.concat(F.lit("ensemble_"), "member"))
    return leaderboards.systems_board(last2(spark, sf_dir), ensembles, stored_baseline(spark, sf_dir))


BOARD_SQL = ("SELECT system, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, "
             "round(weighted_f1, 6) AS weighted_f1, is_baseline, is_winner FROM board")


@query("top3_systems_leaderboard", sql(SYSTEMS_SQL, BOARD_SQL + " ORDER BY board.accuracy DESC, system"))
def top3(spark, sf_dir):
    return rounded(systems(spark, sf_dir), ["accuracy", "macro_f1", "weighted_f1"])


@query("fil8_winner_flag", sql(SYSTEMS_SQL, BOARD_SQL + " WHERE is_winner OR is_baseline"))
def fil8(spark, sf_dir):
    board = systems(spark, sf_dir).filter(F.col("is_winner") | F.col("is_baseline"))
    return rounded(board, ["accuracy", "macro_f1", "weighted_f1"])


@query("top4_single_leaders", sql(LAST2, """
SELECT (SELECT model || ' / ' || strategy FROM last2 ORDER BY type_exact_match DESC, model, strategy
    LIMIT 1) AS best,
  (SELECT model || ' / ' || strategy FROM last2 ORDER BY latency_ms_p50, model, strategy LIMIT 1)
    AS fastest,
  (SELECT model || ' / ' || strategy FROM last2 ORDER BY classifier_agreement DESC, model, strategy
    LIMIT 1) AS most_agreed"""))
def top4(spark, sf_dir):
    return leaderboards.leaders(last2(spark, sf_dir))


@query("top5_chart_rows", sql(LAST2, """
SELECT split_part(model, ':', 1) || ' / ' || strategy AS label,
  round(type_exact_match, 6) AS type_exact_match FROM last2
ORDER BY last2.type_exact_match DESC, model, strategy LIMIT 10"""))
def top5(spark, sf_dir):
    top = leaderboards.leaderboard(last2(spark, sf_dir), "type_exact_match", RUN).limit(10)
    return top.select(
        leaderboards.report_label(F.col("model"), F.col("strategy")).alias("label"),
        F.round("type_exact_match", 6).alias("type_exact_match"))


@query("fil6_parse_outliers", sql(LAST3, f"SELECT {TIDY} FROM last3 WHERE parse_failure_rate > 0.5"))
def fil6(spark, sf_dir):
    return tidy(leaderboards.parse_outliers(last3(spark, sf_dir)))


STORED_ONE = fx.MEMBERS_SQL + f""",
filled AS (SELECT gold, member AS config, CASE WHEN pred IN {fx.TARGETS} THEN pred ELSE 'fix' END AS pred
  FROM mp WHERE member_idx = 0),""" + report_sql("filled", "config")
GAP = """CASE WHEN accuracy >= {0} THEN true ELSE false END AS beats,
  round(({0} - accuracy) * 100, 1) AS gap_points"""


@query("fil7_at_or_above_baseline", sql(LAST3 + "," + STORED_ONE, f"""
SELECT 'stored' AS baseline, model, strategy, sample_kind, round(accuracy, 6) AS accuracy,
  {GAP.format("(SELECT accuracy FROM rep)")} FROM last3 WHERE accuracy >= (SELECT accuracy FROM rep)
UNION ALL SELECT * FROM (SELECT 'perfect', model, strategy, sample_kind, round(accuracy, 6),
  {GAP.format("2.0::DOUBLE")} FROM last3 ORDER BY last3.accuracy DESC, model, strategy LIMIT 1)"""))
def fil7(spark, sf_dir):
    """Against a stored report, and against one that nobody reaches, which gives the best run's gap."""
    runs, stored = last3(spark, sf_dir), stored_baseline(spark, sf_dir)
    nobody = stored.withColumns({c: F.lit(2.0) for c in leaderboards.SCORES})
    parts = [leaderboards.against_baseline(runs, b).withColumn("baseline", F.lit(name))
             for name, b in (("stored", stored), ("perfect", nobody))]
    df = parts[0].unionByName(parts[1])
    return df.select("baseline", "model", "strategy", "sample_kind", F.round("accuracy", 6).alias("accuracy"),
                     "beats", "gap_points")


@query("fil9_pretty_generation", sql(LAST2, """
SELECT model, strategy, printf('%.1f', round(type_exact_match * 100, 1)) || '%' AS "type-match",
  printf('%.1f', round(type_in_target * 100, 1)) || '%' AS "in-target",
  printf('%.1f', round(classifier_agreement * 100, 1)) || '%' AS "classif. agree",
  printf('%.1f', round(parse_failure_rate * 100, 1)) || '%' AS "parse fail",
  round(bleu, 2) AS bleu, round(rouge_l_mean, 3) AS "rouge_L",
  CAST(round(latency_ms_p50) AS INT) AS "p50 ms", round(completion_tokens_mean, 1) AS tokens FROM last2"""))
def fil9(spark, sf_dir):
    return leaderboards.pretty_generation(last2(spark, sf_dir))


@query("fil9_pretty_classification", sql(LAST3, """
SELECT model, strategy, sample_kind AS sample, n, printf('%.2f', round(accuracy * 100, 2)) || '%' AS accuracy,
  round(macro_f1, 4) AS "macro_F1", round(weighted_f1, 4) AS "weighted_F1",
  printf('%.1f', round(parse_failure_rate * 100, 1)) || '%' AS "parse fail",
  CAST(round(latency_ms_p50) AS INT) AS "p50 ms" FROM last3"""))
def fil9_classification(spark, sf_dir):
    return leaderboards.pretty_classification(last3(spark, sf_dir))


@query("fil10_report_label", sql(fx.RUNS_SQL, """
SELECT DISTINCT split_part(model, ':', 1) || ' / ' || strategy AS label FROM runs"""))
def fil10(spark, sf_dir):
    df = fx.run_summaries(spark, sf_dir)
    return df.select(leaderboards.report_label(F.col("model"), F.col("strategy")).alias("label")).distinct()


@query("src12_append_summaries", sql(fx.RUNS_SQL, """
SELECT model, strategy, run_seq, n, round(accuracy, 6) AS accuracy FROM runs"""))
def src12(spark, sf_dir):
    """Natural runs appended first, stratified runs after them, all read back."""
    df = fx.run_summaries(spark, sf_dir)
    path = new_path(spark, "summaries")
    for kind in ("natural", "stratified"):
        runs.append_summaries(df.filter(F.col("sample_kind") == kind), path)
    return rounded(runs.read_summaries(spark, path, df.schema).select(
        "model", "strategy", "run_seq", "n", "accuracy"), ["accuracy"])
