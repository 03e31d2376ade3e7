"""Steps that must not hang on one task, or write a row a term, against plain versions."""

import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift import session
from gitsift.functions import ngrams, term_counts
from gitsift.operators import classifier, scoring, tfidf
from gitsift.sources import history, repository

TEXTS = ["aa bb aa", "", None, "  Größe ÄB\n𝒳𝒴z aa ", "x", "bb bb\taabb", "aa bb aa"]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i % 6 if i < 6 else 0, t) for i, t in enumerate(TEXTS)] + [(None, "aa")]
    return spark.createDataFrame(rows, "commit_id long, diff_text string").coalesce(1)


def terms_of(documents):
    listed = documents.select("commit_id", ngrams.char_terms(F.coalesce("diff_text", F.lit(""))).alias("t"))
    return [(r.commit_id, r.t) for r in listed.collect()]


def test_term_counts_are_those_of_the_listed_terms_and_one_file_is_not_one_task(documents):
    n, df = Counter(), Counter()
    for _, terms in terms_of(documents):
        n.update(terms)
        df.update(set(terms))
    found = tfidf.term_statistics(documents, tfidf.DIFF)
    assert {r.term: (r.n, r.df) for r in found.collect()} == {t: (n[t], df[t]) for t in n}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan and "Generate" not in plan


def test_vectors_take_rows_of_one_id_together(documents):
    terms = tfidf.vocabulary(documents, tfidf.DIFF, 40, min_df=1)
    known = {r.term: (r.idx, r.idf) for r in terms.collect()}
    want = {}
    for i, listed in terms_of(documents):
        want.setdefault(i, Counter()).update(t for t in listed if t in known)
    found = {r.commit_id: dict(zip(r.idx, r.weight)) for r in tfidf.vectors(documents, tfidf.DIFF, terms).collect()}
    assert set(found) == {i for i, tf in want.items() if tf}
    for i, mine in found.items():
        raw = {known[t][0]: (1 + np.log(n)) * known[t][1] for t, n in want[i].items()}
        length = np.sqrt(sum(w * w for w in raw.values()))
        assert mine == pytest.approx({k: w / length for k, w in raw.items()}) and list(mine) == sorted(mine)
    kept = {r.commit_id: len(r.idx) for r in tfidf.vectors(documents, tfidf.DIFF, terms, keep_empty=True).collect()}
    assert set(kept) == set(want) and kept[None] == 0


def test_features_take_their_weights_where_these_are_made(spark):
    rows = [(1, "aa", "x y", 1, 2, 3, "a"), (1, "aa", "y", 4, 5, 6, "b"), (2, "bb aa", None, 7, 8, 9, "a"),
            (None, "aa", "x y", 1, 1, 1, "c"), (None, "bb", "x", 2, 2, 2, "c")]
    df = spark.createDataFrame(rows, "commit_id long, message_clean string, diff_text string, "
                                     "files_changed int, lines_added int, lines_removed int, label string")
    terms = classifier.numbered(tfidf.fit_vocabulary(df, classifier.BLOCKS, 40, min_df=1)).cache()
    n = terms.count()
    found = classifier.feature_columns(df, terms, n, [0.0] * 3, [1.0] * 3, 40, ["label"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    held = sorted((r.commit_id or 0, r.label, r.features.values[-3:], len(r.features.indices) - 3) for r in found.collect())
    weights = {r.commit_id: len(r.i0) + len(r.i1) for r in tfidf.weighted(df, classifier.BLOCKS, terms).collect()}
    assert held == [(0, "c", [1, 1, 1], 0), (0, "c", [2, 2, 2], 0), (1, "a", [1, 2, 3], weights[1]),
                    (1, "b", [4, 5, 6], weights[1]), (2, "a", [7, 8, 9], weights[2])]


def test_terms_outside_the_vocabulary_are_left_out_before_documents_are_spelled_out():
    texts = pa.array(["aa\nbb\naa", "", None, "größe\n𝒳𝒴z\naa"])
    for analyzer in ("char", "word"):
        every = term_counts.counted(texts, analyzer)
        place = {t: i for i, t in enumerate(sorted(set(every.terms) - {""})[::2])}
        some = term_counts.counted(texts, analyzer, place)

        def counts(c, name):
            return [Counter({k: n for k, n in sum((Counter({name(x): t}) for x, t in zip(
                c.number[a:b].tolist(), c.times[a:b].tolist())), Counter()).items() if k is not None})
                for a, b in zip(c.cuts[:-1], c.cuts[1:])]

        assert counts(some, int) == counts(every, lambda x: place.get(every.terms[x]))
        assert len(some.number) < len(every.number)


def test_a_scan_of_all_commits_stays_in_its_tasks(spark, monkeypatch):
    monkeypatch.setattr(repository, "TOP_ROWS", 10)
    files = F.array(F.struct(F.lit("a").alias("old_path"), F.lit("a").alias("new_path"), F.lit("+x").alias("diff")))
    history = spark.range(0, 60, 1, 6).select(
        F.col("id").alias("commit_id"), F.md5(F.col("id").cast("string").cast("binary")).alias("hash"),
        F.lit("u").alias("author"), F.when(F.col("id") % 10 == 0, 2).otherwise(1).alias("n_parents"),
        F.timestamp_seconds("id").alias("ts"), F.lit("fix: x").alias("message"), files.alias("files"))
    every = repository.scan(history, 60)
    assert {r.commit_id for r in every.collect()} == {i for i in range(60) if i % 10}
    assert every.select(F.spark_partition_id()).distinct().count() == 6
    newest = repository.scan(history, 20).collect()
    assert {r.commit_id for r in newest} == set(sorted(i for i in range(60) if i % 10)[-20:])


def test_the_log_stores_no_whole_texts_on_its_way(spark, tmp_path, monkeypatch):
    seen = []

    def stored(df, name):
        seen.append(df.agg(F.max(F.length("message")), F.max(F.length("diff"))).first())
        return df

    monkeypatch.setattr(history, "materialise", stored)
    rows = spark.range(1).select(
        "id", F.current_timestamp().alias("ts"), F.lit("cnn_text").alias("model"),
        F.lit(None).cast("bigint").alias("batch_run_id"), F.repeat(F.lit("m"), 5000).alias("message"),
        F.repeat(F.lit("d"), 5000).alias("diff"), F.lit("fix").alias("label"), F.lit(0.5).alias("confidence"),
        F.create_map(F.lit("fix"), F.lit(0.5)).alias("probabilities"), F.lit("x").alias("source"))
    log = history.Log(str(tmp_path / "registry"), str(tmp_path / "log"), "w")
    log.write(rows)
    assert [tuple(x) for x in seen] == [(280, 280)]
    assert history.read_log(spark, log.path).first().message_preview == "m" * 280


def test_written_tables_leave_no_shuffle_files(spark):
    """What is written replaces its shuffles: their files go at once, and the setting is as before."""
    jvm = spark.sparkContext._jvm
    folders = list(jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {str(p) for folder in folders for p in Path(folder).rglob("shuffle_*.data")}

    df = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    before = files()
    table = session.materialise(df, "counted")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(session.CLEAN_UP, None) is None
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect()))


def test_writers_at_the_same_time_put_the_setting_back(spark):
    """The second begins while the first writes, and ends after it."""
    first, second = session.shuffles_removed(spark), session.shuffles_removed(spark)
    before = spark.conf.get(session.CLEAN_UP, None)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(session.CLEAN_UP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(session.CLEAN_UP, None) == before


def test_the_training_table_goes_and_has_few_parts(spark, monkeypatch):
    """Its files are split for the cores there are, however many they are, and removed with the fit."""
    rows = [(k, fv.TARGET_CLASSES[k % 5], f"{fv.TARGET_CLASSES[k % 5]} word{k % 9} more", f"+line {k % 11}", 1, k % 4, k % 3) for k in range(100)]
    train = spark.createDataFrame(rows, "commit_id long, label string, message_clean string, diff_text string, "
                                        "files_changed int, lines_added int, lines_removed int")
    seen, write = [], classifier.write_features

    def kept(features, path=None):
        stored = write(features.repartition(40), path)
        held = sorted(map(str, stored.collect())) == sorted(map(str, spark.read.schema(stored.schema).parquet(path).collect()))
        seen.append((path, stored.rdd.getNumPartitions(), held, bool(session.file_sizes(spark, path))))
        return stored

    monkeypatch.setattr(classifier, "write_features", kept)
    monkeypatch.setattr(classifier, "LEAST_PARTS", 3)
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for c in before:
        spark.conf.set(c, "1000")
    try:
        model = classifier.TextClassifier.fit(train, max_terms=50, max_iterations=3)
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
    (path, parts, held, there), = seen
    assert parts == 2 * spark.sparkContext.defaultParallelism and held and there
    assert not session.file_sizes(spark, path) and model.terms.count()


def test_outside_models_see_a_few_rows_at_a_time(spark):
    """Each call has a frame of its own; a whole Arrow batch never becomes Python objects."""
    def predictor(rows):
        assert rows.index.max() < 100  # a slice of a larger frame would count on
        return np.repeat([[float(len(rows)), 0, 0, 0, 0]], len(rows), axis=0)

    df = spark.range(250).select(
        F.when(F.col("id") > 0, F.col("id")).alias("commit_id"), F.lit("x").alias("message_clean")).coalesce(1)
    rows = scoring.external_scorer(predictor, 100)(df).collect()
    assert Counter(r.probs[0] for r in rows) == {100.0: 200, 50.0: 50}
    assert sorted(r.commit_id or 0 for r in rows) == list(range(250))
