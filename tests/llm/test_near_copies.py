"""Near copies by shingle similarity against a comparison of all pairs."""

import random

import numpy as np
import pytest

from gitsift.llm import near_copies, simhash


def sets_of(rows):
    out = []
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        width = min(5, len(words))
        out.append((doc, {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()))
    return out


def brute_kept(rows):
    """doc_ids that stay; groups by all pairs of similarity 0.8 or more, in whole numbers."""
    sets = sets_of([r for r in rows if r[0] is not None])
    root = {doc: doc for doc, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if 5 * len(x & y) >= 4 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(doc for doc in root if find(doc) == doc)


def edited(rng, words, share):
    """A copy with some of its words replaced."""
    return [f"new{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in words]


def near_rows(seed, passage=()):
    rng = random.Random(seed)
    rows, doc = [], 0
    for _ in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(3, 300))] + list(passage)
        for share in (0, 0, 0.004, 0.01, 0.02, 0.03, 0.04, 0.06):
            rows.append((doc := doc + 1, " ".join(edited(rng, words, share))))
    rng.shuffle(rows)
    return rows + [(9001, ""), (9002, None), (9003, "a b"), (9004, "a B"), (9005, "a b c"), rows[0],
                   (None, rows[0][1])]


@pytest.mark.parametrize("passage", [(), tuple(f"common{k}" for k in range(60))])
def test_near_copies_equal_all_pairs(spark, monkeypatch, passage):
    monkeypatch.setattr(near_copies, "SAMPLE", 1)
    rows = near_rows(7, passage)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS key", "'x' AS id", "1 AS n")
    out = near_copies.keep_one(df)
    assert out.columns == df.columns
    kept = [r.doc_id for r in out.collect()]
    assert kept.count(None) == 1
    assert sorted(k for k in kept if k is not None) == brute_kept(rows)


def test_pipeline_stage_drops_near_copies_of_other_fingerprints(spark, sf_dir):
    """Copies of similarity 0.8 to 0.95, most of whose fingerprints differ by more than five bits."""
    import corpus_pipeline

    rng = random.Random(3)
    rows = []
    for k in range(30):
        words = [f"t{k}w{i}" for i in range(200)]
        rows.append((2 * k, " ".join(words)))
        for at in rng.sample(range(10, 190, 10), 1 + k % 3):
            words[at] = "other"
        rows.append((2 * k + 1, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, sf_dir).collect())
    assert kept == brute_kept(rows) == list(range(0, 60, 2))


@pytest.mark.parametrize("keep_one", [near_copies.keep_one, simhash.keep_one])
def test_texts_of_one_id_all_stay(spark, keep_one):
    """Document 9 goes for one text of document 1: neither of that one's texts may go then."""
    first, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    rows = [(1, first, "x", {"k": 1}), (1, other, "y", None), (1, other, "z", {}), (1, first, "x", {"k": 1}),
            (9, other, "w", None), (9, other, None, None), (None, first, "n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, m map<string, int>")
    found = [keep_one(part).collect() for part in (df, df.repartition(5, "`a.b`"), df.orderBy("`a.b`"))]
    for out in found:
        assert sorted((r.doc_id or 0, r.text) for r in out) == [(0, first), (1, first), (1, other)]
        assert {r["a.b"] for r in out} == {r["a.b"] for r in found[0]}
    assert keep_one(df).columns == df.columns
    assert keep_one(df.select("text", "doc_id")).columns == ["text", "doc_id"]


def test_near_copies_of_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").limit(0)
    assert near_copies.keep_one(df).count() == 0


def test_first_shingles_keep_the_bound():
    found = np.arange(10, dtype=np.int64)
    common, counts = np.array([0, 1]), np.array([9, 5])
    assert near_copies.first_shingles(found, common, counts).tolist() == [2, 3, 4]
    assert near_copies.first_shingles(found[:2], common, counts).tolist() == [1]


def test_sketches_rule_out_unlike_sets_only():
    rng = np.random.default_rng(5)
    ruled_out = 0
    for _ in range(300):
        n = int(rng.integers(1, 400))
        base = rng.integers(-2 ** 63, 2 ** 63, 2 * n)
        at = int(rng.integers(0, n))
        a, b = np.unique(base[:n]), np.unique(base[at:at + int(rng.integers(1, n + 1))])
        may = near_copies.may_be_similar(near_copies.sketch(a), len(a), near_copies.sketch(b), len(b))
        assert may or not near_copies.similar(a, b)
        ruled_out += not may
    assert ruled_out > 100


def test_pipeline_stage_links_by_fingerprints_too(spark, sf_dir):
    """A long refrain decides the fingerprint, which counts repeats; the sets are unlike."""
    from corpus_pipeline import near_dedup

    def song(tail):
        return " ".join(["we sing the same old song again"] * 60 + [f"{tail}{i}" for i in range(20)])

    rows = [(1, song("a")), (2, song("b")), (3, " ".join(f"c{i}" for i in range(60)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert brute_kept(rows) == [1, 2, 3]
    assert sorted(r.doc_id for r in near_dedup(spark, docs, sf_dir).collect()) == [1, 3]


def test_sizes_rule_pairs_out_that_a_short_sketch_cannot():
    """Folded to a short sketch, a long one differs in few bits, so sizes must decide."""
    rng = np.random.default_rng(3)
    a, b = (np.unique(rng.integers(-2 ** 63, 2 ** 63, n)) for n in (2000, 100))
    assert not near_copies.similar(a, b)
    assert not near_copies.may_be_similar(near_copies.sketch(a), len(a), near_copies.sketch(b), len(b))
    whole, part = np.arange(100), np.arange(80)  # exactly four fifths stay possible
    assert near_copies.may_be_similar(near_copies.sketch(whole), 100, near_copies.sketch(part), 80)


def test_known_links_are_not_met_again(spark):
    """Documents that fingerprints have linked are no pairs of the exact check; others still are."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"tail{i}"])) for i in (1, 2, 3)]
    texts = spark.createDataFrame(rows, "id long, text string")
    roots = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")

    def pairs(met):
        return {tuple(sorted((r.id, x))) for r in met.collect() for x in (r.before, r.first) if x is not None and x != r.id}

    assert (1, 2) in pairs(near_copies.meetings(texts))
    left = pairs(near_copies.meetings(texts, roots=roots))
    assert (1, 2) not in left and any(3 in p for p in left)
