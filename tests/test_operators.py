"""Sampling, metrics, votes, percentiles and retrieval against brute force; golden metrics."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions import ngrams
from gitsift.functions import probabilities as pr
from gitsift.operators import (
    classifier,
    evaluation,
    hybrid,
    leaderboards,
    metrics,
    retrieval,
    sampling,
    scoring,
    summaries,
    tfidf,
    voting,
)
from gitsift.plans import fixtures as fx
from gitsift.sources import corpus, history

CLASSES = fv.TARGET_CLASSES


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(i, rng.choices(CLASSES + ["chore"], [60, 12, 4, 11, 10, 3])[0]) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "commit_id long, label string").repartition(4)


def by_hash(rows, label):
    return sorted((i for i, lab in rows if lab == label),
                  key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())


def test_split_matches_ranks_and_invariants(spark, labelled):
    rows, df = labelled
    split = {r.commit_id: r.split for r in sampling.stratified_split(df).collect()}
    assert len(split) == len(rows)
    for label in {lab for _, lab in rows}:
        ids = by_hash(rows, label)
        n = len(ids)
        for r, i in enumerate(ids, 1):
            want = "train" if 20 * r <= 14 * n else "val" if 20 * r <= 17 * n else "test"
            assert split[i] == want
    sizes = Counter(split.values())
    assert abs(sizes["train"] / len(rows) - 0.70) < 0.005
    shares = {s: Counter(lab for i, lab in rows if split[i] == s) for s in sizes}
    for c in CLASSES:
        fractions = [shares[s][c] / sizes[s] for s in sizes]
        assert min(fractions) > 0 and max(fractions) - min(fractions) < 0.02


def test_samples(spark, labelled):
    rows, df = labelled
    sizes = Counter(lab for _, lab in rows)
    low = min(sizes.values())
    got = {r.commit_id for r in sampling.balanced_subsample(df).collect()}
    assert got == {i for c in CLASSES for i in by_hash(rows, c)[:low]}
    some = sampling.balanced_subsample(df, 150).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in some} == {c: min(150, sizes[c]) for c in CLASSES}
    share = sampling.proportional_sample(df, 600).groupBy("label").count().collect()
    whole = {c: n * 600 // 3000 for c, n in sizes.items()}
    by_rest = sorted(sizes, key=lambda c: (-(sizes[c] * 600 % 3000), c))
    spare = by_rest[:600 - sum(whole.values())]
    assert {r.label: r["count"] for r in share} == {c: whole[c] + (c in spare) for c in sizes}
    assert sampling.proportional_sample(df, 10).count() == 10
    assert sampling.proportional_sample(df, 5000).count() == 3000
    assert sampling.evaluation_sample(df, 3).count() == 5
    assert sorted(r.commit_id for r in sampling.natural_sample(df, 5).collect()) == sorted(sorted(
        (i for i, _ in rows), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())[:5])


def test_threshold_ties_and_tiny_groups(spark):
    df = spark.createDataFrame([(1, "fix"), (2, "fix"), (3, "docs")], "commit_id long, label string")
    assert sampling.take_per_class(df, lambda *_: F.lit(0)).count() == 0
    assert sampling.take_per_class(df, lambda *_: F.lit(1)).count() == 2
    assert sampling.stratified_split(df).count() == 3


# A published confusion matrix and the metrics published with it.
MATRIX = [
    [410, 186, 9, 55, 16], [398, 2607, 89, 371, 195], [8, 17, 199, 20, 1],
    [56, 171, 10, 383, 29], [12, 38, 3, 15, 547],
]
METRICS = {
    "accuracy": 0.7093242087254064, "macro_f1": 0.6632465085620523,
    "weighted_f1": 0.7186919976365603, "macro_precision": 0.6234442530221839,
    "macro_recall": 0.7221236849718846,
}


def test_metrics_follow_from_their_matrix(spark):
    counts = spark.createDataFrame(
        [(g, p, n) for g, line in zip(CLASSES, MATRIX) for p, n in zip(CLASSES, line)],
        "gold string, pred string, n long")
    got = metrics.metrics_from_counts(counts).first()
    for name, value in METRICS.items():
        assert got[name] == pytest.approx(value, abs=1e-12)
    assert got.confusion_matrix == MATRIX and got.n_samples == 5845


def test_empty_classes_score_zero(spark):
    df = spark.createDataFrame([("fix", "fix"), ("fix", "feat")], "gold string, pred string")
    got = metrics.evaluation_report(df).first()
    assert got.per_class["docs"].f1 == 0.0 and got.per_class["fix"].recall == 0.5
    assert got.macro_f1 == pytest.approx((2 / 3) / 5) and got.macro_f1_present == pytest.approx(1 / 3)
    assert metrics.confusion_matrix(df).count() == 25


@pytest.mark.parametrize("seed", range(4))
def test_percentiles_are_exact(spark, seed):
    """A coarse sketch, so that values fall below, inside and above the bracket."""
    rng = np.random.default_rng(seed)
    a = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25)])
    b = rng.integers(0, 5, 37).astype(float)
    df = spark.createDataFrame([("a", float(x)) for x in a] + [("b", float(x)) for x in b], "k string, v double")
    points = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {r.k: r.percentiles for r in evaluation.exact_percentiles(df, ["k"], "v", points, sketch=50).collect()}
    assert got["a"] == pytest.approx(list(np.percentile(a, [p * 100 for p in points])))
    assert got["b"] == pytest.approx(list(np.percentile(b, [p * 100 for p in points])))


@pytest.mark.parametrize("sketch", [2, 3, 9])
def test_percentiles_are_exact_with_sketches_far_too_small(spark, sketch):
    """Brackets miss, and are narrowed until every rank is found; also without keys."""
    rng = np.random.default_rng(sketch)
    values = np.concatenate([rng.normal(size=700), np.full(200, 0.5), [-40.0, 40.0, 7.0]])
    df = spark.createDataFrame([(float(x), "a") for x in values] + [(1.0, "b")], "v double, k string")
    points = [0.0, 0.01, 0.31, 0.5, 0.77, 0.999, 1.0]
    want = pytest.approx(list(np.percentile(values, [p * 100 for p in points])))
    got = {r.k: r.percentiles for r in evaluation.exact_percentiles(df, ["k"], "v", points, sketch=sketch).collect()}
    assert got == {"a": want, "b": pytest.approx([1.0] * len(points))}
    alone = evaluation.exact_percentiles(df.filter("k = 'a'"), [], "v", points, sketch=sketch).collect()
    assert [r.percentiles for r in alone] == [want]


@pytest.mark.parametrize("parts", [1, 7])
def test_running_accuracy(spark, parts):
    """Text ids, several runs of different lengths, one of them without a name."""
    rng = random.Random(3)
    flags = {run: [rng.randint(0, 1) for _ in range(n)] for run, n in (("a", 230), ("b", 41), (None, 60), ("d", 5))}
    rows = [(f"{i:04d}x", f, run) for run, some in flags.items() for i, f in enumerate(some)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "commit_id string, correct int, run string")
    got = {(r.run, r.idx): r.accuracy for r in evaluation.running_accuracy(df, ["run"], 20, parts=parts).collect()}
    assert got == {(run, n): pytest.approx(sum(some[:n]) / n) for run, some in flags.items()
                   for n in range(20, len(some) + 1, 20)}


def plain_vote(preds, weights):
    score = {}
    for p, w in zip(preds, weights):
        score[p] = score.get(p, 0.0) + w
    return max(score.items(), key=lambda kv: kv[1])[0]


def test_votes_match_a_loop(spark):
    rng = random.Random(5)
    table = [[rng.choice([*CLASSES, ""]) for _ in range(4)] for _ in range(300)]
    names, weights = ["a", "b", "c", "d"], [0.4, 0.3, 0.2, 0.5]
    df = spark.createDataFrame(
        [(i, "fix", k, names[k], p) for i, row in enumerate(table) for k, p in enumerate(row)],
        "commit_id long, gold string, member_idx int, member string, pred string").repartition(4)
    hard = {r.commit_id: r.vote for r in voting.hard_vote(df).collect()}
    w = voting.weights_table(df, dict(zip(names, weights)))
    soft = {r.commit_id: r.vote for r in voting.weighted_vote(df, w).collect()}
    for i, row in enumerate(table):
        assert hard[i] == plain_vote(row, [1.0] * 4)
        assert soft[i] == plain_vote(row, weights)
    zero = voting.vote_probabilities(df, voting.weights_table(df, dict.fromkeys(names, 0.0))).first()
    assert zero.probs == [0.0] * 5


def test_argmax_ties_and_order(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4, 0.0, 0.0],), ([0.1 + 0.2, 0.3, 0.0, 0.0, 0.4 - 0.1],)], "p array<double>")
    rows = df.select(pr.best(F.col("p")).alias("b"), pr.ordered(F.col("p")).alias("o")).collect()
    assert [r.b.label for r in rows] == ["fix", "feat"]
    assert [x.label for x in rows[0].o] == ["fix", "docs", "feat", "refactor", "test"]


def test_candidate_weights(spark):
    points = [tuple(r.units) for r in voting.grid_weights(spark, 4, 10).collect()]
    assert len(points) == 286 and len(set(points)) == 286
    assert all(sum(p) == 10 and min(p) >= 0 for p in points)
    one = spark.createDataFrame([([1, 2, 0, 2],)], "units array<int>")
    near = {tuple(r.units) for r in voting.nearby_weights(one, 4).collect()}
    assert near == {p for p in points if all(abs(x - 2 * u) <= 1 for x, u in zip(p, (1, 2, 0, 2)))}
    middle = spark.createDataFrame([([3] * 6,)], "units array<int>")
    assert voting.nearby_weights(middle, 6).count() == voting.nearby_count(6)


def test_refined_search_over_eight_members(spark):
    """Two members are right where the others are not; the search finds a mix that is always right."""
    rng = random.Random(8)
    names, rows = [f"m{k}" for k in range(8)], []
    for i in range(80):
        gold = CLASSES[i % 5]
        for k, name in enumerate(names):
            sure = (k == 2 and i < 40) or (k == 5 and i >= 40)
            p = [0.05 + rng.random() * 0.3 for _ in CLASSES]
            p[CLASSES.index(gold)] += 1.5 if sure else 0.0
            rows.append((i, gold, name, [x / sum(p) for x in p]))
    df = spark.createDataFrame(rows, "commit_id int, gold string, member string, probs array<double>")
    found = voting.refined_weights(df, names, coarse=2, rounds=2)
    weights = {r.member: r.weight for r in voting.best_weights(found, names).collect()}
    assert found.agg(F.max("macro_f1")).first()[0] == pytest.approx(1.0)
    assert abs(sum(weights.values()) - 1) < 1e-9 and weights["m2"] > 0.2 and weights["m5"] > 0.2
    with pytest.raises(ValueError):
        voting.search_weights(df, names, 10)


def plain_char_grams(text):
    out = Counter()
    for w in text.lower().split():
        w = f" {w} "
        for n in (3, 4, 5):
            out.update(w[i: i + n] for i in range(len(w) - n + 1))
    return out


def test_char_grams_count_code_points(spark):
    texts = ["", "a", "Ab cde\n\tf", "\U0001f600\U0001f601x y\U0001f602", "  sp  aces ", "naïve—ok", "a b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, r in zip(texts, df.select(ngrams.char_terms(F.col("t"))).collect()):
        assert Counter(r[0]) == plain_char_grams(t)


def test_word_terms(spark):
    df = spark.createDataFrame([("Fix a bug_1, ÜBER x9!",), ("one",), ("",)], "t string")
    got = [r[0] for r in df.select(ngrams.word_terms(F.col("t"))).collect()]
    assert got == [["fix", "bug_1", "über", "x9", "fix bug_1", "bug_1 über", "über x9"], ["one"], []]


def test_vocabulary_cap_and_idf(spark):
    docs = ["aa bb", "aa bb cc", "aa dd", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "commit_id long, message_clean string")
    rows = tfidf.vocabulary(df, tfidf.MESSAGE, max_terms=2).orderBy("idx").collect()
    assert [(r.term, r.n, r.df) for r in rows] == [("aa", 3, 3), ("aa bb", 2, 2)]
    assert rows[0].idf == pytest.approx(np.log(5 / 4) + 1)


def test_fold_vocabularies_are_those_of_the_rows_outside(spark):
    rows = [(i, f"w{i % 4} w{i % 3} common", i % 3) for i in range(12)]
    df = spark.createDataFrame(rows, "commit_id long, message_clean string, fold int")
    found = tfidf.fold_vocabularies(df, [tfidf.MESSAGE], 4, max_terms=5)
    for fold, vocabulary in enumerate(found):
        want = tfidf.fit_vocabulary(df.filter(F.col("fold") != fold), [tfidf.MESSAGE], 5)
        assert sorted(vocabulary.select(want.columns).collect()) == sorted(want.collect())


def test_out_of_fold_covers_every_commit_once_and_shows_no_text_twice(spark):
    rows = [(i, f"w{i % 30} w{i % 7}", f"+{i % 5}", 1, 2, 3, CLASSES[i % 5]) for i in range(210)]
    df = spark.createDataFrame(rows, "commit_id long, message_clean string, diff_text string, files_changed int, "
                                     "lines_added int, lines_removed int, label string")
    seen = {}

    def fit(train, vocabulary, fold):
        seen[fold] = {(r.message_clean, r.diff_text) for r in train.collect()}
        coef = F.array(*[F.lit(0.0)] * 5)
        terms = classifier.numbered(vocabulary).select("block", "term", "idx", "idf", coef.alias("coef"))
        return classifier.TextClassifier(terms, classifier.Parameters(
            100, 0, [0.0] * 5, [0.0] * 3, [1.0] * 3, [[0.0] * 3] * 5, 0))

    found = {r.commit_id: r.fold for r in hybrid.out_of_fold(df, fit, 3, max_terms=100).collect()}
    assert sorted(found) == list(range(210)) and len(seen) == 3
    for i, message, diff, *_ in rows:
        assert (message, diff) not in seen[found[i]]


@pytest.mark.parametrize("seed", [1, 42])
def test_group_split_keeps_equal_texts_together_and_shares_right(spark, seed):
    """A third of one class is one text, some texts have two classes, some classes few rows."""
    rows = [(i, "same" if i % 3 == 0 else f"m{i % 150}", f"d{i % 2}", "fix") for i in range(400)]
    rows += [(1000 + i, f"m{i}", "d1", "feat") for i in range(100)] + [(2000, "x", None, "docs"), (2001, None, "", "test")]
    df = spark.createDataFrame(rows, "commit_id long, message_clean string, diff_text string, label string")
    split = {r.commit_id: r.split for r in sampling.group_split(df, seed).collect()}
    assert sorted(split) == sorted(r[0] for r in rows)
    groups = {}
    for i, message, diff, label in rows:
        groups.setdefault((message or "", diff or ""), []).append((label, split[i]))
    assert all(len({s for _, s in g}) == 1 for g in groups.values())
    owner = {k: min({c for c, _ in g}, key=lambda c: (-sum(x == c for x, _ in g), c)) for k, g in groups.items()}
    for label in {r[3] for r in rows}:
        own = [g for k, g in groups.items() if owner[k] == label]
        n, largest = sum(map(len, own)), max(map(len, own), default=0)
        for name, share in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
            assert abs(sum(len(g) for g in own if g[0][1] == name) - share * n) <= largest + 1


def test_token_sequences(spark):
    df = spark.createDataFrame([(1, "b, a a"), (2, "a! c"), (3, "")], "commit_id long, t string")
    got = {r.commit_id: r.tokens for r in tfidf.token_sequences(df, "t", 4, 3).collect()}
    assert got == {1: [3, 2, 2], 2: [2, 1, 0], 3: [0, 0, 0]}


@pytest.mark.parametrize("entries", [10**6, 40])
def test_nearest_matches_brute_force(spark, entries):
    """Once with the corpus in few buckets, once in many; copies tie and go by lower id."""
    rng = np.random.default_rng(0)

    def unit(i):
        idx = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        w = rng.random(len(idx)) + 0.1
        return int(i), [int(x) for x in idx], [float(x) for x in w / np.linalg.norm(w)]

    corpus_rows = [unit(i) for i in range(60)]
    corpus_rows += [(i + 100, r[1], r[2]) for i, r in enumerate(corpus_rows[:20])]
    queries = [unit(i) for i in range(25)]
    schema = "commit_id long, idx array<int>, weight array<double>"
    got = retrieval.nearest(
        spark.createDataFrame(queries, schema), spark.createDataFrame(corpus_rows, schema).repartition(5),
        40, 3, bucket_entries=entries).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.id, round(r.score, 6)))
    for q, idx, w in queries:
        mine = dict(zip(idx, w))
        scores = [(-round(sum(mine.get(i, 0) * x for i, x in zip(ci, cw)), 9), c) for c, ci, cw in corpus_rows]
        want = [(c, round(-s, 6)) for s, c in sorted(scores)[:3] if s < 0]
        assert found.get(q, []) == want


def test_reconcile(spark):
    cases = [
        ("feat", "fix", 0.9, ("fix", True, True)), ("feat", "fix", 0.59, ("feat", False, False)),
        (None, "docs", 0.1, ("docs", True, True)), ("perf", "test", 0.2, ("test", False, True)),
        ("fix", "fix", 0.99, ("fix", False, False)),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "t string, v string, c double")
    got = [tuple(r[0]) for r in df.select(hybrid.final_type(F.col("t"), F.col("v"), F.col("c"))).collect()]
    assert got == [c[3] for c in cases]


def test_class_weights_and_histogram(spark, labelled):
    rows, df = labelled
    sizes = Counter(lab for _, lab in rows)
    got = {r.label: r.weight for r in summaries.class_weights(df).collect()}
    assert got == {c: pytest.approx(3000 / (len(sizes) * n)) for c, n in sizes.items()}
    empty = summaries.label_histogram(df.filter("label = 'none'"))
    assert [(r.n, r.pct) for r in empty.collect()] == [(0, 0.0)] * 5


def test_against_baseline_gap(spark):
    runs = spark.createDataFrame([("a", "x", 0.5), ("b", "y", 0.6)], "model string, strategy string, accuracy double")
    stored = spark.createDataFrame([(0.7093, 0.6, 0.6)], "accuracy double, macro_f1 double, weighted_f1 double")
    row = leaderboards.against_baseline(runs, leaderboards.baseline_of(stored, "s")).collect()
    assert [(r.model, r.beats, r.gap_points) for r in row] == [("b", False, 10.9)]


def test_score_by_name(spark):
    df = spark.createDataFrame([(1, "fix: a", None), (2, "", "")], "commit_id long, message string, diff string")
    even = scoring.external_scorer(lambda rows: np.full((len(rows), 5), 0.2))
    rows = scoring.score(df, "codebert", {"codebert": even}).collect()
    assert len(rows) == 2 and all(r.label == "feat" and abs(sum(r.probs) - 1) < 1e-9 for r in rows)
    assert scoring.score(df.limit(0), "codebert", {"codebert": even}).count() == 0
    with pytest.raises(ValueError):
        scoring.score(df, "not_a_real_model", {})
    with pytest.raises(FileNotFoundError):
        scoring.score(df, "ensemble", {})


def test_load_corpus_needs_a_candidate(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        corpus.load_corpus(spark, [{"path": str(tmp_path / "none.parquet")}])


def test_log_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.range(10).select("id", F.timestamp_seconds(F.col("id")).alias("ts"), F.lit("x").alias("v"))
    assert history.read_log(spark, path, rows.schema).count() == 0
    history.write_batch(rows.filter("id < 6"), path, "a", 0)
    history.write_batch(rows.filter("id < 6"), path, "a", 0)
    history.write_batch(rows, path, "b", 1)
    history.write_batch(rows.limit(0), path, "a", 1)
    assert sorted(r.id for r in history.read_log(spark, path, rows.schema).collect()) == list(range(10))


def test_classifier_on_held_out_rows(spark, sf_dir, tmp_path):
    """A quality floor on rows the model has not seen, and the same answers after reloading."""
    splits = fx.splits(spark, sf_dir)
    train, rest = splits.filter("split = 'train'"), splits.filter("split <> 'train'")
    model = classifier.TextClassifier.fit(train, max_terms=2000, max_iterations=60)
    predicted = model.predict(rest).join(rest.select("commit_id", F.col("label").alias("gold")), "commit_id")
    report = metrics.evaluation_report(predicted).first()
    assert report.n_samples == rest.count()
    assert report.accuracy > 0.75
    for r in predicted.collect():
        assert r.pred in CLASSES and 0 <= r.confidence <= 1 and abs(sum(r.probs) - 1) < 1e-4
    model.save(str(tmp_path / "m"))
    again = classifier.TextClassifier.load(spark, str(tmp_path / "m"))
    a = {r.commit_id: r.pred for r in predicted.collect()}
    assert {r.commit_id: r.pred for r in again.predict(rest).collect()} == a
    # relational scoring equals MLlib's own transform of the stored vectors
    p = model.parameters
    rows = classifier.write_features(classifier.feature_columns(
        rest, model.terms, p.n_terms, p.means, p.stds, p.max_terms))
    theirs = {r.commit_id: r.probability.toArray() for r in model.mllib_model.transform(rows).collect()}
    for r in predicted.collect():
        assert np.allclose(r.probs[: len(theirs[r.commit_id])], theirs[r.commit_id], atol=1e-8)
