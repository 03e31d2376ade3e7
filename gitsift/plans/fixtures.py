"""Commit tables derived from the driver's tables, in Spark and as SQL.

The given tables hold no commits. ``documents`` becomes a commit corpus,
``events`` a prediction log and run summaries, ``orders`` batch runs and
``conversations`` chat answers. Every row of the source table takes part. Each
``*_SQL`` constant is the same derivation as common table expressions, so a
check query can start from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitsift import fixed_values as fv
from gitsift.operators import cleaning, sampling
from gitsift.session import new_path
from gitsift.sources import corpus

STRATEGIES = ["zero_shot", "few_shot", "chain_of_thought", "json_mode"]
ANSWER_MODELS = ["qwen2.5-coder:3b", "phi3.5:3.8b"]
SOURCES = ["gui", "cli", "cli-repo", "cli-batch"]
EVENT_LABELS = {
    "click": "feat", "error": "fix", "view": "docs", "purchase": "refactor", "signup": "test",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, split as the file reader splits it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def pick_sql(values: list[str], index: str) -> str:
    return "(CASE " + " ".join(
        f"WHEN {index} = {i} THEN '{v}'" for i, v in enumerate(values)
    ) + " END)"


# --- commits ----------------------------------------------------------------
def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    text_lines = F.split("text", "\n")
    ty = (
        F.when(i % 11 == 0, "chore")
        .when(F.col("n_chars") < 300, "test")
        .when(F.col("lang") == "en", "fix")
        .when(F.col("lang") == "de", "feat")
        .when(F.col("lang") == "fr", "refactor")
        .otherwise("docs")
    )
    prefix = F.when(i % 13 == 0, "").otherwise(
        F.concat(
            F.when(i % 5 == 0, F.upper(ty)).otherwise(ty),
            F.when(i % 7 == 0, F.concat(F.lit("("), F.col("source"), F.lit(")"))).otherwise(""),
            F.when(i % 17 == 0, "!").otherwise(""),
            F.lit(": "),
        )
    )
    subject = F.substring(F.substring_index("text", "\n", 1), 1, 72)
    body = F.when(i % 4 == 0, F.concat(F.lit("\n\nbody "), F.col("source"))).otherwise("")
    signed = F.transform(
        text_lines,
        lambda line, n: F.concat(
            F.when((n + i) % 3 == 0, "+").when((n + i) % 3 == 1, "-").otherwise(" "), line
        ),
    )
    name = F.concat(F.col("source"), F.lit(".txt"))
    diff = F.when(
        i % 19 != 0,
        F.concat(
            F.lit("diff --git a/"), name, F.lit(" b/"), name,
            F.lit("\n--- a/"), name, F.lit("\n+++ b/"), name,
            F.lit("\n"), F.array_join(signed, "\n"),
        ),
    )
    return d.select(
        i.alias("commit_id"),
        F.md5(i.cast("string").cast("binary")).alias("hash"),
        F.col("source").alias("project"),
        F.concat(F.lit("user"), (i % 23).cast("string")).alias("author"),
        F.when(i % 29 == 0, 2).otherwise(1).alias("n_parents"),
        F.timestamp_seconds(F.lit(1704067200) + i * 2220).alias("ts"),
        ty.alias("ty"),
        subject.alias("subject"),
        F.concat(prefix, subject, body).alias("message"),
        diff.alias("diff"),
    )


COMMITS_SQL = """
docs0 AS (
  SELECT *, string_split(text, chr(10)) AS ls,
    CASE WHEN doc_id % 11 = 0 THEN 'chore' WHEN n_chars < 300 THEN 'test'
         WHEN lang = 'en' THEN 'fix' WHEN lang = 'de' THEN 'feat'
         WHEN lang = 'fr' THEN 'refactor' ELSE 'docs' END AS ty
  FROM documents),
commits AS (
  SELECT doc_id AS commit_id, md5(CAST(doc_id AS VARCHAR)) AS hash, source AS project,
    'user' || (doc_id % 23) AS author, CASE WHEN doc_id % 29 = 0 THEN 2 ELSE 1 END AS n_parents,
    make_timestamp((1704067200 + doc_id * 2220) * 1000000) AS ts, ty,
    substring(ls[1], 1, 72) AS subject,
    CASE WHEN doc_id % 13 = 0 THEN '' ELSE
      (CASE WHEN doc_id % 5 = 0 THEN upper(ty) ELSE ty END)
      || (CASE WHEN doc_id % 7 = 0 THEN '(' || source || ')' ELSE '' END)
      || (CASE WHEN doc_id % 17 = 0 THEN '!' ELSE '' END) || ': ' END
    || substring(ls[1], 1, 72)
    || (CASE WHEN doc_id % 4 = 0 THEN chr(10) || chr(10) || 'body ' || source ELSE '' END)
      AS message,
    CASE WHEN doc_id % 19 <> 0 THEN
      'diff --git a/' || source || '.txt b/' || source || '.txt' || chr(10)
      || '--- a/' || source || '.txt' || chr(10) || '+++ b/' || source || '.txt' || chr(10)
      || array_to_string(list_transform(ls, lambda l, i:
           (CASE (i - 1 + doc_id) % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE ' ' END) || l), chr(10))
    END AS diff
  FROM docs0)"""


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WS = sql_text(fv.WHITE_SPACE)
NL = sql_text(fv.LINE_BREAK)
PREFIX = sql_text(
    rf"(?is)^{fv.SPACE_CLASS}*({'|'.join(fv.COMMIT_TYPES)})(?:\([^)]*\))?(!)?"
    rf"{fv.SPACE_CLASS}*:{fv.SPACE_CLASS}*(.+)"
)
TARGETS = "('feat', 'fix', 'docs', 'refactor', 'test')"
CLASS_INDEX = (
    "CASE {0} WHEN 'feat' THEN 0 WHEN 'fix' THEN 1 WHEN 'docs' THEN 2 "
    "WHEN 'refactor' THEN 3 WHEN 'test' THEN 4 END"
)


def clean_sql(keep: str = f"label IN {TARGETS}", tables: str = COMMITS_SQL, source: str = "commits") -> str:
    return tables + f""",
parsed AS (
  SELECT *, regexp_replace(trim(message, {WS}), {NL}, chr(10), 'g') AS norm,
    split_part(regexp_replace(trim(message, {WS}), {NL}, chr(10), 'g'), chr(10), 1) AS head,
    coalesce(diff, '') AS full_diff FROM {source}),
parsed2 AS (
  SELECT *, nullif(lower(regexp_extract(head, {PREFIX}, 1)), '') AS label,
    trim(CASE WHEN regexp_matches(head, {PREFIX})
        THEN trim(regexp_extract(head, {PREFIX}, 3), {WS}) ELSE head END
      || substring(norm, length(head) + 1), {WS}) AS message_clean,
    CASE WHEN full_diff = '' THEN [] ELSE regexp_split_to_array(full_diff, {NL}) END AS dl
  FROM parsed),
stats AS (
  SELECT *, full_diff AS diff_text,
    CASE WHEN full_diff = '' THEN 0 ELSE greatest(1,
      len(list_filter(dl, lambda l: starts_with(l, 'diff --git')))) END AS files_changed,
    len(list_filter(dl, lambda l: starts_with(l, '+') AND NOT starts_with(l, '+++')))
      AS lines_added,
    len(list_filter(dl, lambda l: starts_with(l, '-') AND NOT starts_with(l, '---')))
      AS lines_removed FROM parsed2),
clean AS MATERIALIZED (
  SELECT commit_id, message_clean, diff_text, files_changed, lines_added, lines_removed, label
  FROM stats WHERE {keep} AND length(message_clean) > 0)"""


CLEAN_SQL = clean_sql()

SPLIT_SQL = CLEAN_SQL + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || commit_id), commit_id) AS r,
    count(*) OVER (PARTITION BY label) AS n FROM clean),
splits AS MATERIALIZED (
  SELECT commit_id, message_clean, diff_text, files_changed, lines_added, lines_removed, label,
    CASE WHEN 20 * r <= 14 * n THEN 'train' WHEN 20 * r <= 17 * n THEN 'val' ELSE 'test' END
      AS split FROM ranked)"""


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_commits(commits(spark, sf_dir), id_column="commit_id")


def new_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_split(clean(spark, sf_dir))


_SPLIT_TABLES: dict[tuple[str, str], str] = {}


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split table, written once per session: later stages read their split of it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SPLIT_TABLES:
        path = new_path(spark, "split-table")
        corpus.write_splits(new_splits(spark, sf_dir), path)
        _SPLIT_TABLES[key] = path
    return spark.read.parquet(_SPLIT_TABLES[key])


# --- commits whose diff is a list of files ----------------------------------
def multi_file_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per text line; every third file has no body, every fourth one path only."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")

    def one(line: Column, n: Column) -> Column:
        path = F.concat(F.col("source"), F.lit("/f"), n.cast("string"))
        return F.struct(
            F.when(n % 4 != 3, path).alias("old_path"),
            F.when(n % 4 != 3, path).alias("new_path"),
            path.alias("filename"),
            F.when((n + i) % 3 == 0, "").otherwise(
                F.concat(F.lit("@@ -1 +1 @@\n+"), line, F.lit("\n-old"))
            ).alias("diff"),
        )

    return d.select(
        i.alias("commit_id"), F.lit("fix: files").alias("message"),
        F.transform(F.split("text", "\n"), one).alias("mods"),
    )


MULTI_FILE_SQL = """
files AS (
  SELECT doc_id AS commit_id, array_to_string(list_transform(string_split(text, chr(10)),
    lambda l, i: 'diff --git a/' || source || '/f' || (i - 1) || ' b/' || source || '/f' || (i - 1)
      || CASE WHEN (i - 1 + doc_id) % 3 = 0 THEN ''
         ELSE chr(10) || '@@ -1 +1 @@' || chr(10) || '+' || l || chr(10) || '-old' END),
    chr(10)) AS full_diff FROM documents)"""


# --- gold labels and member predictions -------------------------------------
def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = commits(spark, sf_dir)
    return c.filter(F.col("ty").isin(fv.TARGET_CLASSES)).select(
        "commit_id", F.col("ty").alias("gold"),
        (F.array_position(F.array(*map(F.lit, fv.TARGET_CLASSES)), F.col("ty")) - 1).alias("g"),
    )


def member_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four members' labels per commit; a member leaves some commits blank."""
    i, k = F.col("commit_id"), F.col("member_idx")
    shifted = (i * (k + 1) + k) % 5
    hit = (i * (2 * k + 3)) % 10 < 6 + k % 2
    return (
        gold(spark, sf_dir)
        .withColumn("member_idx", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .withColumn("member", pick(fv.ENSEMBLE_CANDIDATES, k))
        .withColumn(
            "pred",
            F.when((i + k) % 31 == 0, "")
            .when(hit, F.col("gold"))
            .otherwise(pick(fv.TARGET_CLASSES, shifted)),
        )
        .select("commit_id", "gold", "g", "member_idx", "member", "pred")
    )


MEMBERS_SQL = COMMITS_SQL + f""",
gold AS (
  SELECT commit_id, ty AS gold, {CLASS_INDEX.format("ty")} AS g
  FROM commits WHERE ty IN {TARGETS}),
mp AS MATERIALIZED (
  SELECT commit_id, gold, g, k AS member_idx, {pick_sql(fv.ENSEMBLE_CANDIDATES, "k")} AS member,
    CASE WHEN (commit_id + k) % 31 = 0 THEN ''
         WHEN (commit_id * (2 * k + 3)) % 10 < 6 + k % 2 THEN gold
         ELSE {pick_sql(fv.TARGET_CLASSES, "((commit_id * (k + 1) + k) % 5)")} END AS pred
  FROM gold, range(4) AS members(k))"""


def member_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probabilities of the four members: integer scores over their sum."""
    i, k = F.col("commit_id"), F.col("member_idx")
    scores = F.array(
        *[
            (1 + (i * (k + 3) + 7 * c * (k + 1)) % 10
             + F.when(F.col("pred") == name, 12).otherwise(0))
            for c, name in enumerate(fv.TARGET_CLASSES)
        ]
    )
    total = F.aggregate(F.col("scores"), F.lit(0).cast("long"), lambda a, x: a + x)
    return (
        member_predictions(spark, sf_dir)
        .withColumn("scores", scores.cast("array<bigint>"))
        .withColumn("probs", F.transform("scores", lambda s: s.cast("double") / total))
        .select("commit_id", "gold", "g", "member_idx", "member", "probs")
    )


MEMBER_PROBS_SQL = MEMBERS_SQL + """,
scored AS (
  SELECT *, list_transform(['feat', 'fix', 'docs', 'refactor', 'test'], lambda name, c:
      1 + (commit_id * (member_idx + 3) + 7 * (c - 1) * (member_idx + 1)) % 10
      + CASE WHEN pred = name THEN 12 ELSE 0 END) AS scores FROM mp),
mprob AS MATERIALIZED (
  SELECT commit_id, gold, g, member_idx, member, list_transform(scores,
      lambda s: CAST(s AS DOUBLE) / list_sum(scores)) AS probs FROM scored)"""


# --- answers of language models ---------------------------------------------
def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers per commit, model and strategy, in eight shapes incl. empty and fenced JSON."""
    i = F.col("commit_id")
    base = commits(spark, sf_dir).filter(F.col("ty").isin(fv.TARGET_CLASSES))
    m, s = F.col("m"), F.col("s")
    shape = (i + 3 * m + 5 * s) % 8
    number = i.cast("string")
    raw = (
        F.when(shape == 0, F.concat(
            F.lit('{"type": "'), F.col("ty"), F.lit('", "scope": "", "subject": "s'), number,
            F.lit('"}')))
        .when(shape == 1, F.concat(
            F.lit('```json\n{"type": "chore", "subject": "t'), number, F.lit('"}\n```')))
        .when(shape == 2, F.concat(F.lit("feat(api): add thing "), number))
        .when(shape == 3, F.concat(F.lit("I think this is a "), F.col("ty"), F.lit(" commit.")))
        .when(shape == 4, "")
        .when(shape == 5, "no idea")
        .when(shape == 6, F.concat(F.col("ty"), F.lit(": "), F.lower("subject")))
        .otherwise(F.concat(
            F.lit("Step one.\n"), F.col("ty"), F.lit("(core): "), F.substring("subject", 1, 40)))
    )
    return (
        base.withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(1))))
        .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .select(
            "commit_id", pick(ANSWER_MODELS, m).alias("model"),
            pick(STRATEGIES, s).alias("strategy"), F.col("ty").alias("gold"),
            F.col("subject").alias("gold_subject"), raw.alias("raw"),
            (F.lit(100.0) + ((i * 37 + 11 * m + 5 * s) % 900)).alias("latency_ms"),
            (3 + i % 17).cast("int").alias("completion_tokens"),
            (100 + i % 300).cast("int").alias("prompt_tokens"),
        )
    )


RESPONSES_SQL = COMMITS_SQL + f""",
responses AS MATERIALIZED (
  SELECT commit_id, {pick_sql(ANSWER_MODELS, "m")} AS model, {pick_sql(STRATEGIES, "s")} AS strategy,
    ty AS gold, subject AS gold_subject,
    CASE (commit_id + 3 * m + 5 * s) % 8
      WHEN 0 THEN '{{"type": "' || ty || '", "scope": "", "subject": "s' || commit_id || '"}}'
      WHEN 1 THEN '```json' || chr(10) || '{{"type": "chore", "subject": "t' || commit_id || '"}}'
        || chr(10) || '```'
      WHEN 2 THEN 'feat(api): add thing ' || commit_id
      WHEN 3 THEN 'I think this is a ' || ty || ' commit.'
      WHEN 4 THEN '' WHEN 5 THEN 'no idea'
      WHEN 6 THEN ty || ': ' || lower(subject)
      ELSE 'Step one.' || chr(10) || ty || '(core): ' || substring(subject, 1, 40) END AS raw,
    100.0::DOUBLE + ((commit_id * 37 + 11 * m + 5 * s) % 900) AS latency_ms,
    CAST(3 + commit_id % 17 AS INTEGER) AS completion_tokens,
    CAST(100 + commit_id % 300 AS INTEGER) AS prompt_tokens
  FROM commits, range(2) AS a(m), range(4) AS b(s) WHERE ty IN {TARGETS})"""


# --- prediction history from events and orders ------------------------------
def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored commits: message, diff, label, confidence, probabilities."""
    e = table(spark, sf_dir, "events")
    label = F.element_at(
        F.create_map(*[F.lit(x) for kv in EVENT_LABELS.items() for x in kv]), F.col("event_type")
    )
    confidence = F.round(F.least(F.lit(1.0), F.col("value") / 400), 6)
    words = F.concat(F.col("event_type"), F.lit(" "), F.col("props"), F.lit(" "))
    return e.select(
        "event_id", "ts", pick(fv.AVAILABLE_MODELS, F.col("user_id") % 7).alias("model"),
        F.when(F.col("user_id") % 3 == 0, F.col("event_id")).alias("batch_run_id"),
        F.repeat(words, 20).alias("message"),
        F.repeat(F.concat(F.lit("+"), words), 15).alias("diff"),
        label.alias("label"), confidence.alias("confidence"),
        F.transform(
            F.array(*map(F.lit, fv.TARGET_CLASSES)),
            lambda c: F.when(c == label, confidence).otherwise((1 - confidence) / 4),
        ).alias("probs"),
        pick(SOURCES, F.col("user_id") % 4).alias("source"),
    )


EVENT_LABEL_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_LABELS.items()
) + " END"
SCORED_EVENTS_SQL = f"""
scored_events AS (
  SELECT event_id, ts, {pick_sql(fv.AVAILABLE_MODELS, "user_id % 7")} AS model,
    CASE WHEN user_id % 3 = 0 THEN event_id END AS batch_run_id,
    repeat(event_type || ' ' || props || ' ', 20) AS message,
    repeat('+' || event_type || ' ' || props || ' ', 15) AS diff,
    {EVENT_LABEL_SQL} AS label, round(least(1.0::DOUBLE, value / 400), 6) AS confidence,
    {pick_sql(SOURCES, "user_id % 4")} AS source FROM events)"""


def batch_run_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("batch_run_id"), F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("repo/"), F.col("o_custkey").cast("string")).alias("repo_path"),
        (1 + F.col("o_orderkey") % 200).cast("int").alias("n_commits"),
        pick(fv.AVAILABLE_MODELS, F.col("o_custkey") % 7).alias("model"),
    )


BATCH_RUNS_SQL = f"""
batch_requests AS (
  SELECT o_orderkey AS batch_run_id, o_orderdate AS ts, 'repo/' || o_custkey AS repo_path,
    CAST(1 + o_orderkey % 200 AS INTEGER) AS n_commits,
    {pick_sql(fv.AVAILABLE_MODELS, "o_custkey % 7")} AS model FROM orders)"""


# --- run summaries from events ----------------------------------------------
def run_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several runs per model, strategy and sample kind; ``run_seq`` is append order."""
    e = table(spark, sf_dir, "events")
    u, v = F.col("user_id"), F.col("value")

    def rate(condition: Column) -> Column:
        return F.avg(condition.cast("int"))

    return (
        e.select(
            F.concat(F.lit("m"), (u % 6).cast("string"), F.lit(":"), (u % 3).cast("string"),
                     F.lit("b")).alias("model"),
            pick(STRATEGIES, F.col("event_id") % 4).alias("strategy"),
            F.when(u % 2 == 0, "natural").otherwise("stratified").alias("sample_kind"),
            F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", u, v,
        )
        .groupBy("model", "strategy", "sample_kind", "day")
        .agg(
            F.min("event_id").alias("run_seq"), F.count("*").alias("n"),
            rate(v > 50).alias("type_exact_match"), rate(v > 20).alias("type_in_target"),
            rate(v > 40).alias("classifier_agreement"),
            rate(v < 48).alias("parse_failure_rate"),
            F.round(F.avg(v) / 10, 6).alias("bleu"),
            F.round(F.avg(v) / 500, 6).alias("rouge_l_mean"),
            F.round(F.avg(v) * 20, 6).alias("latency_ms_p50"),
            F.round(F.avg(u), 6).alias("completion_tokens_mean"),
            rate(v > 15).alias("accuracy"), rate(v > 18).alias("macro_f1"),
            rate(v > 16).alias("weighted_f1"),
        )
        .drop("day")
    )


RUNS_SQL = f"""
runs AS MATERIALIZED (
  SELECT 'm' || (user_id % 6) || ':' || (user_id % 3) || 'b' AS model,
    {pick_sql(STRATEGIES, "event_id % 4")} AS strategy,
    CASE WHEN user_id % 2 = 0 THEN 'natural' ELSE 'stratified' END AS sample_kind,
    min(event_id) AS run_seq, count(*) AS n,
    avg(CAST(value > 50 AS INT)) AS type_exact_match, avg(CAST(value > 20 AS INT)) AS type_in_target,
    avg(CAST(value > 40 AS INT)) AS classifier_agreement,
    avg(CAST(value < 48 AS INT)) AS parse_failure_rate,
    round(avg(value) / 10, 6) AS bleu, round(avg(value) / 500, 6) AS rouge_l_mean,
    round(avg(value) * 20, 6) AS latency_ms_p50, round(avg(user_id), 6) AS completion_tokens_mean,
    avg(CAST(value > 15 AS INT)) AS accuracy, avg(CAST(value > 18 AS INT)) AS macro_f1,
    avg(CAST(value > 16 AS INT)) AS weighted_f1
  FROM events GROUP BY 1, 2, 3, CAST(ts AS DATE))"""


# --- chat answers that hold a tool call -------------------------------------
def tool_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns, some rewritten as a tool call in one of several shapes."""
    c = table(spark, sf_dir, "conversations")
    shape = (F.col("conv_id") + F.col("turn")) % 7
    size = F.length("text").cast("string")
    text = (
        F.when(shape == 0, F.concat(
            F.lit('{"name": "scan_repo", "arguments": {"last_n": '), size, F.lit("}}")))
        .when(shape == 1, F.concat(
            F.lit('```json\n{"tool": "classify_repo", "args": {"path": "r'), size,
            F.lit('"}}\n```')))
        .when(shape == 2, F.concat(
            F.lit('Calling {"name": "list_models", "parameters": {"n": '), size,
            F.lit("}} now")))
        .when(shape == 3, '{"name": "unknown_tool", "arguments": {}}')
        .when(shape == 4, '{"name": "list_classes"}')
        .when(shape == 5, '{"name": broken')
        .otherwise(F.col("text"))
    )
    return c.select("conv_id", "turn", "role", text.alias("text"))


TOOL_MESSAGES_SQL = """
tool_messages AS (
  SELECT conv_id, turn, role, CASE (conv_id + turn) % 7
    WHEN 0 THEN '{"name": "scan_repo", "arguments": {"last_n": ' || length(text) || '}}'
    WHEN 1 THEN '```json' || chr(10) || '{"tool": "classify_repo", "args": {"path": "r'
      || length(text) || '"}}' || chr(10) || '```'
    WHEN 2 THEN 'Calling {"name": "list_models", "parameters": {"n": ' || length(text) || '}} now'
    WHEN 3 THEN '{"name": "unknown_tool", "arguments": {}}'
    WHEN 4 THEN '{"name": "list_classes"}'
    WHEN 5 THEN '{"name": broken' ELSE text END AS text FROM conversations)"""


FILE_SCHEMA = T.ArrayType(
    T.StructType([T.StructField(n, T.StringType()) for n in ("old_path", "new_path", "diff")])
)


def exported_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported repository history: one row per commit with its list of files."""
    c = commits(spark, sf_dir)
    name = F.concat(F.col("project"), F.lit(".txt"))
    one = F.struct(
        F.when(F.col("commit_id") % 6 != 0, name).alias("old_path"),
        F.when(F.col("commit_id") % 6 != 1, name).alias("new_path"),
        F.col("diff").alias("diff"),
    )
    other = F.struct(
        F.lit("README").alias("old_path"), F.lit("README").alias("new_path"),
        F.lit(None).cast("string").alias("diff"),
    )
    return c.select(
        "commit_id", "hash", "project", "author", "n_parents", "ts", "message",
        F.when(F.col("commit_id") % 2 == 0, F.array(one, other)).otherwise(F.array(one))
        .cast(FILE_SCHEMA).alias("files"),
    )


EXPORTED_SQL = COMMITS_SQL + """,
exported AS (
  SELECT commit_id, hash, project, author, n_parents, ts, message,
    'diff --git a/' || project || '.txt b/' || project || '.txt' || chr(10) || coalesce(diff, '')
    || CASE WHEN commit_id % 2 = 0 THEN chr(10) || 'diff --git a/README b/README' || chr(10)
       ELSE '' END AS full_diff FROM commits)"""
