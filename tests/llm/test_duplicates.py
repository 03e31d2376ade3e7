"""Duplicate operators against brute force on small fixtures."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from gitsift.llm import automaton_dedup, components, lines, simhash, suffix_dedup, windows


def documents(spark, rows, extra=True):
    """Rows with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "7 AS key", "'x' AS row", "1.5 AS spans") if extra else df


def sha(data):
    return hashlib.sha256(data).hexdigest()


# --- lines ------------------------------------------------------------------
def brute_lines(rows):
    def key(line):
        stripped = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)

    holders = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        gone = [doc is not None and len(key(x)) >= 10 and len(holders[key(x)]) > 1 and min(holders[key(x)]) != doc
                for x in all_lines]
        out.append((doc, len(all_lines), sum(gone), "\n".join(x for x, g in zip(all_lines, gone) if not g)))
    return sorted(out, key=str)


def test_lines_equal_brute_force(spark):
    rng = random.Random(4)
    pool = ["A long line here", "a LONG line here \t", "É long line here", "é long line here", "short", "", " ",
            "another shared line", "\x0banother shared line", "x" * 9, "y" * 10]
    rows = [(k, "\n".join(rng.choice(pool + [f"only in {k} of them"]) for _ in range(rng.randint(0, 8))))
            for k in range(60)]
    rows += [(7, rows[7][1]), (8, "another shared line"), (None, "a long line here"), (None, None), (61, None),
             (62, "\n".join(["another shared line"] * 3000 + ["last"]))]
    found = lines.drop_lines(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_lines(rows)


def test_lines_of_an_empty_table_and_other_thresholds(spark):
    df = documents(spark, [(1, "shared by three"), (2, "shared by three"), (3, "shared by three\nshared by two"),
                           (4, "shared by two")])
    kept = {r.doc_id: r.kept for r in lines.drop_lines(df, min_documents=3).collect()}
    assert kept == {1: "shared by three", 2: "", 3: "shared by two", 4: "shared by two"}
    assert lines.drop_lines(df.limit(0)).count() == 0
    replaced = lines.replace_texts(df.withColumn("n_chars", df["doc_id"]))
    assert replaced.columns == [*df.columns, "n_chars"]
    assert {r.doc_id: (r.text, r.n_chars) for r in replaced.collect()}[2] == ("", 0)


# --- windows ----------------------------------------------------------------
def brute_windows(rows, length, keep, split, join):
    where = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            symbols = split(text)
            for i in range(len(symbols) - length + 1):
                where[tuple(symbols[i:i + length])].add((doc, i, text or ""))
    out = []
    for doc, text in rows:
        symbols = split(text)
        gone = np.zeros(len(symbols), dtype=bool)
        for i in range(len(symbols) - length + 1) if doc is not None else ():
            places = where[tuple(symbols[i:i + length])]
            if len(places) > 1 and (keep == "none" or min(places)[:2] != (doc, i)):
                gone[i:i + length] = True
        out.append((doc, len(symbols), int(gone.sum()), sha(join([s for s, g in zip(symbols, gone) if not g]))))
    return sorted(out, key=str)


def copied(seed, alphabet, sep, count=50):
    rng = random.Random(seed)
    base = [[rng.choice(alphabet) for _ in range(60)] for _ in range(5)]
    rows = []
    for k in range(count):
        text = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                start = rng.randint(0, 40)
                text += rng.choice(base)[start:start + rng.randint(3, 50)]
            elif kind < 0.5:
                text += [alphabet[0]] * rng.randint(5, 60)
            else:
                text += [rng.choice(alphabet) for _ in range(rng.randint(1, 30))]
        rows.append((k, sep.join(text)))
    return rows + [(3, rows[3][1]), (None, rows[3][1]), (None, None), (count, None), (count + 1, "")]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("most", [4096, 2])
def test_bytes_equal_brute_force(spark, monkeypatch, keep, most):
    monkeypatch.setattr(windows, "MAX_REGIONS", most)
    rows = copied(5, list("abcdé"), "")
    found = suffix_dedup.remove_repeats(documents(spark, rows), 24, keep, 8).collect()
    want = brute_windows(rows, 24, keep, lambda t: list((t or "").encode()), bytes)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in found), key=str) == want
    assert sum(w[2] for w in want)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("most", [4096, 2])
def test_words_equal_brute_force(spark, monkeypatch, keep, most):
    monkeypatch.setattr(windows, "MAX_REGIONS", most)
    rows = copied(6, "a b c d é f".split(), " ")
    found = automaton_dedup.remove_substrings(documents(spark, rows), 9, keep, 4).collect()
    want = brute_windows(rows, 9, keep, lambda t: (t or "").encode().split(), b" ".join)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str) == want


def test_windows_of_an_empty_table(spark):
    df = documents(spark, [(1, "a")]).limit(0)
    assert suffix_dedup.remove_repeats(df).count() == automaton_dedup.remove_substrings(df).count() == 0


def test_registered_byte_query_equals_brute_force(spark, sf_dir):
    from gitsift.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    seen, twice = set(), set()
    for _, text in rows:
        data = text.encode()
        for i in range(len(data) - 199):
            window = data[i:i + 200]
            (twice if window in seen else seen).add(window)
    want = {}
    for doc, text in rows:
        data = text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - 199):
            if data[i:i + 200] in twice:
                gone[i:i + 200] = True
        want[doc] = (len(data), int(gone.sum()), len(windows.spans_of(gone)[0]),
                     sha(np.frombuffer(data, np.uint8)[~gone].tobytes()))
    found = QUERIES["op5_suffix_array_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want


def test_longest_previous_factors_equal_brute_force():
    rng = random.Random(1)
    for _ in range(100):
        n = rng.randint(1, 30)
        x = np.array([rng.randint(0, 1) for _ in range(n)])
        cuts = sorted(set(rng.choices(range(1, n + 1), k=2)) | {n})
        end = np.array([next(c for c in cuts if c > i) for i in range(n)])

        def common(i, j):
            k = 0
            while i + k < end[i] and j + k < end[j] and x[i + k] == x[j + k]:
                k += 1
            return k

        found = suffix_dedup.longest_previous(*suffix_dedup.suffix_order(x, end, 64))
        assert found.tolist() == [max((common(i, j) for j in range(i)), default=0) for i in range(n)]


# --- fingerprints -----------------------------------------------------------
def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints, distance):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(k) for k in range(len(prints))]


def test_anchors_cover_the_distance():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for bit in rng.choice(64, 4, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(bit)
    sent, homes = defaultdict(set), defaultdict(set)
    for row, key, home in zip(*simhash.anchors(x)):
        if home:
            homes[row].add(key)
    for row, key, _ in zip(*simhash.anchors(y)):
        sent[row].add(key)
    assert all(homes[k] & sent[k] for k in range(len(x)))


@pytest.mark.parametrize("block", [4096, 5])
def test_links_equal_brute_force(spark, block):
    rng = random.Random(2)
    prints = []
    for _ in range(60):
        value = rng.getrandbits(64)
        prints.append(value)
        for _ in range(rng.randint(0, 4)):  # chains of near copies
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                value ^= 1 << bit
            prints.append(value)
    prints = list(dict.fromkeys(prints))
    nodes = spark.createDataFrame([(k, int(np.uint64(p).view(np.int64))) for k, p in enumerate(prints)],
                                  "id long, fingerprint long")
    roots = components.smallest_reachable(simhash.links(nodes, block=block))
    found = {r.node: r.component for r in roots.collect()}
    assert [found.get(k, k) for k in range(len(prints))] == classes_of(prints, 4)


def test_near_duplicates_of_documents(spark, sf_dir):
    rng = random.Random(3)
    words = [f"word{k}" for k in range(400)]
    base = " ".join(words)
    rows = [(k, " ".join(words[:k] + ["other"] + words[k + 1:])) for k in range(5, 25)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, base), (104, base.upper()), (104, base.upper()),
             (None, base), (105, " ".join(rng.choice(words) for _ in range(80)))]
    found = simhash.components(documents(spark, rows)).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    assert sorted((r.doc_id or -1, r.fingerprint) for r in found) == sorted(
        (d or -1, f"{p:016x}") for (d, _), p in zip(rows, prints))
    named = [(d, p) for (d, _), p in zip(rows, prints) if d is not None]
    named.sort()
    roots = classes_of([p for _, p in named], 4)
    want = {d: named[r][0] for (d, _), r in zip(named, roots)}
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want
    kept = [r.doc_id for r in simhash.keep_one(documents(spark, rows)).collect()]
    assert sorted(k for k in kept if k is not None) == sorted(set(want.values())) and kept.count(None) == 1
    assert simhash.components(documents(spark, rows).limit(0)).count() == 0


def test_components_of_paths_and_hubs(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(129, 200), (5, 4)]
    found = components.smallest_reachable(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {
        **{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 130)}, 200: 100}


def test_factors_are_sought_only_where_the_length_is_reached(monkeypatch):
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 256, 60, dtype=np.uint8)
    contents = [np.concatenate((rng.integers(0, 256, 400, dtype=np.uint8), passage)) for _ in range(3)]
    kind = suffix_dedup.byte_windows(48, 16)
    sought, whole = [], suffix_dedup.longest_previous

    def seen(order, *rest):
        sought.append(len(order))
        return whole(order, *rest)

    monkeypatch.setattr(suffix_dedup, "longest_previous", seen)
    sizes, copies = np.array([len(c) - 47 for c in contents]), np.ones(3, np.int64)
    again, later = suffix_dedup.compare(contents, sizes, copies, kind)
    assert [np.flatnonzero(f).tolist() for f in again] == [list(range(400, 413))] * 3
    assert [np.flatnonzero(f).tolist() for f in later] == [[], *[list(range(400, 413))] * 2]
    alone = suffix_dedup.compare(contents[:1], sizes[:1], copies[:1], kind)
    assert not alone[0][0].any() and not alone[1][0].any()
    assert sought == [3 * 13, 0]
