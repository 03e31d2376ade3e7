"""Corpus, cleaning, sampling, label summaries and set checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions import text as tx
from gitsift.functions.diffs import diff_stats, diff_view, normalise_diff
from gitsift.operators import cleaning, sampling, summaries
from gitsift.plans import fixtures as fx
from gitsift.plans.registry import query
from gitsift.plans.registry import with_tables as sql
from gitsift.session import new_path
from gitsift.sources import corpus

COUNTS = ["files_changed", "lines_added", "lines_removed"]
CLEAN_OUT = """commit_id, message_clean, diff_text, CAST(files_changed AS INTEGER) AS files_changed,
  CAST(lines_added AS INTEGER) AS lines_added, CAST(lines_removed AS INTEGER) AS lines_removed, label"""


@query("label_distribution", sql(fx.SPLIT_SQL, """
SELECT split, label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 4)
    AS fraction, round(avg(files_changed), 6) AS avg_files, round(avg(lines_added), 6) AS avg_added,
  round(avg(lines_removed), 6) AS avg_removed FROM splits GROUP BY split, label"""))
def label_distribution(spark, sf_dir):
    """Flagship: documents to clean commits to splits to the label distribution of each."""
    df = fx.new_splits(spark, sf_dir)
    stats = df.groupBy("split", "label").agg(
        F.count("*").alias("n"), F.round(F.avg("files_changed"), 6).alias("avg_files"),
        F.round(F.avg("lines_added"), 6).alias("avg_added"),
        F.round(F.avg("lines_removed"), 6).alias("avg_removed"),
    )
    total = F.sum("n").over(fx_window("split"))
    return stats.withColumn("fraction", F.round(F.col("n") / total, 4))


def fx_window(*columns):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


# --- sources and sinks ------------------------------------------------------
@query("src1_load_corpus", "SELECT doc_id, lang, source, n_chars FROM documents")
def src1(spark, sf_dir):
    """The first candidate does not exist, the second has no row, the third is taken."""
    empty = new_path(spark, "empty-corpus")
    fx.table(spark, sf_dir, "documents").filter(F.lit(False)).write.parquet(empty)
    candidates = [
        {"path": f"{sf_dir}/no_such_corpus.parquet"}, {"path": empty},
        {"path": f"{sf_dir}/documents.parquet"},
    ]
    _, df = corpus.load_corpus(spark, candidates)
    return df.select("doc_id", "lang", "source", "n_chars")


@query("src2_first_rows", """
SELECT least(1000, (SELECT count(*) FROM events)) AS n, true AS all_from_corpus""")
def src2(spark, sf_dir):
    """Which rows come first is up to the storage, so the check counts them."""
    events = fx.table(spark, sf_dir, "events").select("event_id")
    taken = corpus.first_rows(events, 1000)
    return taken.agg(
        F.count("*").alias("n"), F.bool_and(F.col("event_id") >= 0).alias("all_from_corpus")
    )


@query("src3_resolve_columns", """
SELECT doc_id AS commit_id, source AS message, text AS full_diff FROM documents""")
def src3(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    renamed = d.select(F.col("doc_id").alias("commit_id"), F.col("source").alias("commit_message"),
                       F.col("text").alias("patch"), F.col("lang").alias("subject"))
    return cleaning.resolve_columns(renamed, keep=["commit_id"])


@query("src4_parquet_round_trip", sql(fx.CLEAN_SQL, f"SELECT {CLEAN_OUT} FROM clean"))
def src4(spark, sf_dir):
    return corpus.write_table(fx.clean(spark, sf_dir), new_path(spark, "clean"))


@query("src5_split_table", sql(fx.SPLIT_SQL, f"""
SELECT {CLEAN_OUT}, split, CAST({fx.CLASS_INDEX.format("label")} AS INTEGER) AS label_id
FROM splits"""))
def src5(spark, sf_dir):
    """Write every split, read each back: only its folder is scanned for it."""
    path = new_path(spark, "splits")
    corpus.write_splits(fx.new_splits(spark, sf_dir), path)
    parts = [corpus.load_split(spark, path, name) for name in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src6_head_sample", sql(fx.COMMITS_SQL, """
SELECT least(500, count(*)) AS n, true AS intact FROM commits"""))
def src6(spark, sf_dir):
    """Which 500 rows are kept is up to the storage; each must equal its commit."""
    df = fx.commits(spark, sf_dir).select("commit_id", "message", "diff")
    path = new_path(spark, "head-sample")
    corpus.write_csv_sample(df, path)
    back = corpus.read_csv(spark, path, "commit_id bigint, message string, diff string")
    key = F.sha2(F.concat("message", F.coalesce("diff", F.lit(""))), 256)
    joined = back.select("commit_id", key.alias("a")).join(
        df.select("commit_id", key.alias("b")), "commit_id")
    return joined.agg(F.count("*").alias("n"), F.bool_and(F.col("a") == F.col("b")).alias("intact"))


@query("src7_corpus_metadata", """
SELECT 'documents' AS source_dataset, 'train' AS split, count(*) AS n_rows,
  'doc_id,text,lang,source,n_chars' AS columns, false AS sample_mode,
  CAST(NULL AS BIGINT) AS row_limit FROM documents""")
def src7(spark, sf_dir):
    meta = corpus.describe_corpus(fx.table(spark, sf_dir, "documents"), "documents", "train")
    return meta.withColumn("columns", F.array_join("columns", ","))


@query("src17_balanced_table", sql(fx.SPLIT_SQL, """,
t AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || commit_id), commit_id)
    AS r2 FROM splits WHERE split = 'train'),
low AS (SELECT min(c) AS m FROM (SELECT count(*) AS c FROM t GROUP BY label))
SELECT 'before' AS stage, label, count(*) AS n FROM t GROUP BY label
UNION ALL SELECT 'after', label, count(*) FROM t, low WHERE r2 <= m GROUP BY label"""))
def src17(spark, sf_dir):
    train = fx.splits(spark, sf_dir).filter(F.col("split") == "train")
    table = corpus.write_table(sampling.balanced_subsample(train), new_path(spark, "balanced"))
    before = summaries.label_counts(train).withColumn("stage", F.lit("before"))
    after = summaries.label_counts(table).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


# --- filters, projections and message functions -----------------------------
@query("str1_commit_type", sql(fx.clean_sql("true"), """
SELECT commit_id, nullif(lower(regexp_extract(head, """ + fx.PREFIX + """, 1)), '') AS label
FROM parsed"""))
def str1(spark, sf_dir):
    return fx.commits(spark, sf_dir).select(
        "commit_id", tx.commit_type(F.col("message")).alias("label"))


@query("str2_strip_prefix", sql(fx.clean_sql("true"), "SELECT commit_id, substring(message_clean, 1, 500) AS message_clean FROM parsed2"))
def str2(spark, sf_dir):
    return fx.commits(spark, sf_dir).select(
        "commit_id", tx.strip_prefix(F.col("message"), fv.MAX_MESSAGE_CHARS).alias("message_clean"))


@query("str3_normalise_diff", sql(fx.MULTI_FILE_SQL, "SELECT commit_id, full_diff FROM files"))
def str3(spark, sf_dir):
    df = fx.multi_file_commits(spark, sf_dir)
    return df.select("commit_id", normalise_diff(df, "mods").alias("full_diff"))


@query("str4_diff_statistics", sql(fx.clean_sql("true"), """
SELECT commit_id, md5(substring(diff_text, 1, 4000)) AS diff_md5,
  length(substring(diff_text, 1, 4000)) AS diff_chars,
  CAST(files_changed AS INTEGER) AS files_changed, CAST(lines_added AS INTEGER) AS lines_added,
  CAST(lines_removed AS INTEGER) AS lines_removed FROM stats"""))
def str4(spark, sf_dir):
    df = cleaning.resolve_columns(fx.commits(spark, sf_dir), keep=["commit_id"])
    return df.select("commit_id", diff_stats(F.col("full_diff"), fv.MAX_DIFF_CHARS).alias("s")).select(
        "commit_id", F.md5(F.col("s.diff_text").cast("binary")).alias("diff_md5"),
        F.length("s.diff_text").alias("diff_chars"), *[f"s.{c}" for c in COUNTS])


@query("str5_truncate", sql(fx.COMMITS_SQL, """
SELECT commit_id, """ + ", ".join(
    f"md5(CASE WHEN length(coalesce(diff, '')) <= {n} THEN coalesce(diff, '') ELSE "
    f"substring(diff, 1, {n}) || chr(10) || '...[truncated]' END) AS cut_{n}"
    for n in (3500, 2500, 1500, 1200)) + " FROM commits"))
def str5(spark, sf_dir):
    limits = (fv.GENERATE_DIFF_LIMIT, fv.CLASSIFY_DIFF_LIMIT, fv.GENERATE_EXAMPLE_LIMIT,
              fv.CLASSIFY_EXAMPLE_LIMIT)
    return fx.commits(spark, sf_dir).select(
        "commit_id",
        *[F.md5(tx.truncate(F.col("diff"), n).cast("binary")).alias(f"cut_{n}") for n in limits])


@query("str13_subject", sql(fx.COMMITS_SQL, """
SELECT commit_id, substring(split_part(message, chr(10), 1), 1, 120) AS retrieval_subject,
  substring(split_part(message, chr(10), 1), 1, 72) AS few_shot_subject FROM commits"""))
def str13(spark, sf_dir):
    message = F.col("message")
    return fx.commits(spark, sf_dir).select(
        "commit_id", tx.subject(message, fv.RETRIEVED_SUBJECT_CHARS).alias("retrieval_subject"),
        tx.subject(message, fv.FEW_SHOT_SUBJECT_CHARS).alias("few_shot_subject"))


@query("str17_diff_line_kinds", sql(fx.clean_sql("true"), """,
shown AS (SELECT commit_id, unnest(dl[1:24]) AS line, generate_subscripts(dl[1:24], 1) - 1 AS line_no
  FROM parsed2 WHERE trim(full_diff, """ + fx.WS + """) <> '')
SELECT commit_id, CAST(line_no AS INTEGER) AS line_no, line,
  CASE WHEN starts_with(line, '+++') OR starts_with(line, '---') OR starts_with(line, 'diff ')
    THEN 'context' WHEN starts_with(line, '+') THEN 'added' WHEN starts_with(line, '-')
    THEN 'removed' ELSE 'context' END AS kind FROM shown"""))
def str17(spark, sf_dir):
    return diff_view(fx.commits(spark, sf_dir).select("commit_id", "diff"), "diff")


@query("str20_previews", sql(fx.COMMITS_SQL, """
SELECT commit_id, """ + ", ".join(
    f"substring(coalesce(diff, ''), 1, {n}) AS p{n}" for n in (280, 500, 160, 120, 80)) + """,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y-%m-%d') AS day FROM commits"""))
def str20(spark, sf_dir):
    return fx.commits(spark, sf_dir).select(
        "commit_id", *[tx.preview(F.col("diff"), n).alias(f"p{n}") for n in (280, 500, 160, 120, 80)],
        tx.iso_seconds(F.col("ts")).alias("iso"), tx.day(F.col("ts")).alias("day"))


@query("fil1_keep_targets", sql(fx.clean_sql("true"), f"""
SELECT commit_id, label FROM parsed2 WHERE label IN {fx.TARGETS}"""))
def fil1(spark, sf_dir):
    df = fx.commits(spark, sf_dir).select("commit_id", tx.commit_type(F.col("message")).alias("label"))
    return cleaning.keep_targets(df)


@query("fil2_drop_empty_messages", """
SELECT conv_id, turn FROM conversations WHERE length(trim(CASE WHEN role = 'system' THEN '' ELSE text END)) > 0""")
def fil2(spark, sf_dir):
    """System turns stand for messages that are empty once stripped."""
    c = fx.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        tx.strip_prefix(F.when(F.col("role") == "system", " \n ").otherwise(F.col("text")))
        .alias("message_clean"))
    return cleaning.drop_empty_messages(c).select("conv_id", "turn")


@query("fil3_clean_projection", sql(fx.CLEAN_SQL, f"SELECT {CLEAN_OUT} FROM clean"))
def fil3(spark, sf_dir):
    return fx.clean(spark, sf_dir)


@query("fil4_label_ids", sql(fx.clean_sql("true"), f"""
SELECT commit_id, label, CAST({fx.CLASS_INDEX.format("label")} AS INTEGER) AS label_id,
  CASE WHEN label IN {fx.TARGETS} THEN label END AS label_again FROM parsed2"""))
def fil4(spark, sf_dir):
    df = fx.commits(spark, sf_dir).select("commit_id", tx.commit_type(F.col("message")).alias("label"))
    df = df.withColumn("label_id", cleaning.class_index(F.col("label")))
    return df.withColumn("label_again", cleaning.class_name(F.col("label_id")))


@query("fil5_fallback_class", sql(fx.clean_sql("true"), f"""
SELECT commit_id, CASE WHEN label IN {fx.TARGETS} THEN label ELSE 'fix' END AS label FROM parsed2"""))
def fil5(spark, sf_dir):
    return fx.commits(spark, sf_dir).select(
        "commit_id", cleaning.or_fallback(tx.commit_type(F.col("message"))).alias("label"))


# --- sampling ---------------------------------------------------------------
@query("smp1_stratified_split", sql(fx.SPLIT_SQL, "SELECT commit_id, label, split FROM splits"))
def smp1(spark, sf_dir):
    return fx.new_splits(spark, sf_dir).select("commit_id", "label", "split")


GROUP_SPLIT_SQL = fx.CLEAN_SQL + """,
keyed AS (SELECT *, md5('42|' || message_clean || chr(1) || diff_text) AS key FROM clean),
grouped AS (
  SELECT key, arg_min(label, (-n, label)) AS grp, CAST(sum(n) AS BIGINT) AS size
  FROM (SELECT key, label, count(*) AS n FROM keyed GROUP BY ALL) GROUP BY key),
lined AS (
  SELECT key, 2 * sum(size) OVER (PARTITION BY grp ORDER BY key) - size AS middle,
    sum(size) OVER (PARTITION BY grp) AS n FROM grouped),
splits AS MATERIALIZED (
  SELECT keyed.*, CASE WHEN middle <= 2 * floor(n * 14 / 20) THEN 'train'
    WHEN middle <= 2 * floor(n * 17 / 20) THEN 'val' ELSE 'test' END AS split
  FROM keyed JOIN lined USING (key))"""


@query("smp1_group_split", sql(GROUP_SPLIT_SQL, "SELECT commit_id, label, split FROM splits"))
def smp1_group(spark, sf_dir):
    """The same shares, but commits of equal message and diff are never in two splits."""
    return sampling.group_split(fx.clean(spark, sf_dir)).select("commit_id", "label", "split")


def ranked_sql(where: str, size: str) -> str:
    return f""",
k AS (SELECT commit_id, label, n_all, r, n, min(n) OVER () AS smallest FROM (
  SELECT commit_id, label, count(*) OVER () AS n_all,
    row_number() OVER (PARTITION BY label ORDER BY md5('42|' || commit_id), commit_id) AS r,
    count(*) OVER (PARTITION BY label) AS n FROM clean))
SELECT commit_id, label FROM k WHERE r <= {size} AND {where}"""


@query("smp2_balanced_subsample", sql(fx.clean_sql("label IS NOT NULL"),
                                      ranked_sql(f"label IN {fx.TARGETS}", "smallest")))
def smp2(spark, sf_dir):
    """The smallest class counts among all labels present, targets or not."""
    c = cleaning.resolve_columns(fx.commits(spark, sf_dir), ["commit_id"])
    labelled = c.select("commit_id", tx.commit_type(F.col("message")).alias("label"),
                        tx.strip_prefix(F.col("message")).alias("message_clean"))
    labelled = cleaning.drop_empty_messages(labelled.filter(F.col("label").isNotNull()))
    return sampling.balanced_subsample(labelled.select("commit_id", "label"))


@query("smp3_budgeted_subsample", sql(fx.CLEAN_SQL, ranked_sql("true", "greatest(64, 400 // 5)")))
def smp3(spark, sf_dir):
    return sampling.budgeted_subsample(fx.clean(spark, sf_dir), 400).select("commit_id", "label")


@query("smp4_proportional_sample", sql(fx.CLEAN_SQL, """,
sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS n_all FROM clean GROUP BY label),
shares AS (SELECT label, n, n_all, n * 500 // n_all AS whole, row_number() OVER (
    ORDER BY n * 500 % n_all DESC, label) AS place, 500 - sum(n * 500 // n_all) OVER () AS spare
  FROM sizes),
quota AS (SELECT label, CASE WHEN n_all <= 500 THEN n ELSE whole + CAST(place <= spare AS INT) END
    AS most FROM shares),
k AS (SELECT commit_id, label,
    row_number() OVER (PARTITION BY label ORDER BY md5('42|' || commit_id), commit_id) AS r FROM clean)
SELECT commit_id, label FROM k JOIN quota USING (label) WHERE r <= most"""))
def smp4(spark, sf_dir):
    df = fx.clean(spark, sf_dir).select("commit_id", "label")
    return sampling.proportional_sample(df, 500)


@query("smp5_evaluation_sample", sql(fx.CLEAN_SQL, ranked_sql("true", "greatest(1, 50 // 5)")))
def smp5(spark, sf_dir):
    return sampling.evaluation_sample(fx.clean(spark, sf_dir).select("commit_id", "label"), 50)


@query("smp6_natural_sample", sql(fx.CLEAN_SQL, """
SELECT commit_id, label FROM clean ORDER BY md5('42|' || commit_id), commit_id LIMIT 200"""))
def smp6(spark, sf_dir):
    return sampling.natural_sample(fx.clean(spark, sf_dir).select("commit_id", "label"), 200)


@query("smp7_few_shot_pool", sql(fx.SPLIT_SQL, """,
p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || commit_id), commit_id)
    AS r2 FROM splits WHERE split = 'train')
SELECT to_json(list({'type': label, 'subject': substring(split_part(message_clean, chr(10), 1), 1, 72),
    'diff': diff_text} ORDER BY md5('42|' || commit_id))) AS examples
FROM p WHERE r2 <= 2"""))
def smp7(spark, sf_dir):
    train = fx.splits(spark, sf_dir).filter(F.col("split") == "train")
    pool = sampling.as_examples(sampling.few_shot_pool(train, per_class=2))
    return pool.select(F.to_json("examples").alias("examples"))


@query("smp8_shuffle", sql(fx.CLEAN_SQL, """
SELECT commit_id, md5('42|' || commit_id) AS shuffle_key FROM clean ORDER BY 2"""))
def smp8(spark, sf_dir):
    return sampling.shuffled(fx.clean(spark, sf_dir).select("commit_id"))


# --- label summaries, set checks --------------------------------------------
@query("agg1_label_counts", sql(fx.CLEAN_SQL, "SELECT label, count(*) AS n FROM clean GROUP BY label"))
def agg1(spark, sf_dir):
    return summaries.label_counts(fx.clean(spark, sf_dir))


@query("agg2_label_fractions", sql(fx.SPLIT_SQL, """
SELECT split, label, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 4) AS fraction
FROM splits GROUP BY split, label"""))
def agg2(spark, sf_dir):
    return summaries.label_fractions(fx.new_splits(spark, sf_dir))


@query("agg3_class_weights", sql(fx.CLEAN_SQL, """
SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM clean GROUP BY label"""))
def agg3(spark, sf_dir):
    return summaries.class_weights(fx.clean(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query("joi11_attach_class_weight", sql(fx.CLEAN_SQL, """,
w AS (SELECT label, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
  FROM clean GROUP BY label)
SELECT commit_id, label, round(weight, 6) AS weight FROM clean JOIN w USING (label)"""))
def joi11(spark, sf_dir):
    df = summaries.attach_class_weights(fx.clean(spark, sf_dir).select("commit_id", "label"))
    return df.withColumn("weight", F.round("weight", 6))


@query("agg7_label_histogram", sql(fx.SPLIT_SQL, """,
dim AS (SELECT unnest(['feat', 'fix', 'docs', 'refactor', 'test', 'none']) AS label,
  unnest([0, 1, 2, 3, 4, 5]) AS class_idx),
h AS (SELECT CAST(class_idx AS INTEGER) AS class_idx, dim.label, count(c.label) AS n FROM dim
  LEFT JOIN clean c ON c.label = dim.label
  WHERE class_idx < 5 GROUP BY 1, 2)
SELECT class_idx, label, n, round(n * 100 / sum(n) OVER (), 1) AS pct,
  first_value(label) OVER (ORDER BY n DESC, class_idx) AS dominant,
  count(*) FILTER (n > 0) OVER () AS classes_seen, CAST(sum(n) OVER () AS BIGINT) AS n_commits FROM h"""))
def agg7(spark, sf_dir):
    """All clean commits by class; a class without commits would show as zero."""
    histogram = summaries.label_histogram(fx.clean(spark, sf_dir))
    return histogram.join(F.broadcast(summaries.histogram_summary(histogram)), F.lit(True))


@query("joi8_split_overlap", sql(fx.SPLIT_SQL, """,
te AS (SELECT DISTINCT message_clean, diff_text FROM splits WHERE split = 'test'),
tr AS (SELECT DISTINCT message_clean, diff_text FROM splits WHERE split = 'train')
SELECT count(*) AS n_keys, count(tr.diff_text) AS n_shared,
  round(count(tr.diff_text) / greatest(count(*), 1), 6) AS ratio
FROM te LEFT JOIN tr ON te.message_clean = tr.message_clean AND te.diff_text = tr.diff_text"""))
def joi8(spark, sf_dir):
    return summaries.split_overlap(fx.splits(spark, sf_dir))


@query("joi8_group_split_overlap", sql(GROUP_SPLIT_SQL, """
SELECT count(DISTINCT key) AS n_keys, 0 AS n_shared, CAST(0 AS DOUBLE) AS ratio FROM splits WHERE split = 'test'"""))
def joi8_group(spark, sf_dir):
    """After the group split nothing of the test texts occurs in training."""
    return summaries.split_overlap(sampling.group_split(fx.clean(spark, sf_dir)))


@query("set1_union", sql(fx.SPLIT_SQL, "SELECT commit_id, split, label FROM splits"))
def set1(spark, sf_dir):
    df = fx.splits(spark, sf_dir).select("commit_id", "split", "label")
    parts = [df.filter(F.col("split") == s) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("set2_shared_keys", sql(fx.SPLIT_SQL, """
SELECT message_clean FROM splits WHERE split = 'train'
INTERSECT SELECT message_clean FROM splits WHERE split = 'test'"""))
def set2(spark, sf_dir):
    df = fx.splits(spark, sf_dir)
    train, test = (df.filter(F.col("split") == s) for s in ("train", "test"))
    return summaries.shared_keys(train, test, ["message_clean"])


@query("set4_row_conservation", sql(fx.SPLIT_SQL, """
SELECT (SELECT count(*) FROM clean) AS n_whole, (SELECT count(*) FROM splits) AS n_parts,
  (SELECT count(*) FROM (SELECT commit_id, label, diff_text FROM clean EXCEPT ALL
     SELECT commit_id, label, diff_text FROM splits)) AS n_missing,
  (SELECT count(*) FROM (SELECT commit_id, label, diff_text FROM splits EXCEPT ALL
     SELECT commit_id, label, diff_text FROM clean)) AS n_extra"""))
def set4(spark, sf_dir):
    return summaries.conservation(
        fx.clean(spark, sf_dir), fx.splits(spark, sf_dir), ["commit_id", "label", "diff_text"])


@query("win3_lowest_ranks_per_class", sql(fx.CLEAN_SQL, ranked_sql("true", "ceil(n / 3)")))
def win3(spark, sf_dir):
    """The lowest third of the hash ranks of every class."""
    df = fx.clean(spark, sf_dir).select("commit_id", "label")
    return sampling.take_per_class(df, lambda n, _: F.ceil(n / 3))


@query("win6_fraction_of_total", sql(fx.COMMITS_SQL, """
SELECT project, ty AS label, round(count(*) / sum(count(*)) OVER (PARTITION BY project), 4) AS fraction
FROM commits GROUP BY project, ty"""))
def win6(spark, sf_dir):
    """Share of each commit type inside its project."""
    df = fx.commits(spark, sf_dir).select("project", F.col("ty").alias("label"))
    return summaries.label_fractions(df, "project")
