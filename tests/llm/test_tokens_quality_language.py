"""Row-wise operators: BPE against tiktoken, quality rules against brute force, languages held out."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from gitsift.llm import bpe, language, quality  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
AWKWARD = ["", " ", "\n\n", "don't  we'll", "été x", "😀😀 a", "a\x1cb\x85c", "日本語テキスト", "x" * 5000, "1²½ Ⅷ"]


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as handle:
        return bpe.Codec(handle.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as handle:
        ranks = bpe.read_ranks(handle.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_reference_encoder(codec, reference):
    rng = random.Random(1)
    texts = AWKWARD + ["".join(rng.choice("ab \t\n1'sté·　😀=- \x1c") for _ in range(rng.randint(0, 60)))
                       for _ in range(3000)]
    assert [codec.encode(t) for t in texts] == [reference.encode_ordinary(t) for t in texts]


def test_any_split_of_a_token_may_merge(codec, reference):
    """Strings in which one token can be put together in two overlapping ways."""
    ranks = reference._mergeable_ranks
    for token in ranks:
        for p in range(1, len(token)):
            x, y, z = token[:p], token[p:], token[len(token) - p:]
            if token[p:] == token[:-p] and x != z and {x, y, z} <= ranks.keys():
                try:
                    text = (x + y + z).decode()
                except UnicodeDecodeError:
                    continue
                assert codec.encode(text) == reference.encode_ordinary(text)


def test_other_patterns_run_over_whole_texts():
    with open(PATH, "rb") as handle:
        data = handle.read()
    ours = bpe.Codec(data, r"\S+|\s+")
    theirs = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=bpe.read_ranks(data), special_tokens={})
    assert ours.encode("ab, cd  été") == theirs.encode_ordinary("ab, cd  été")


def test_decoding_and_offsets(codec):
    text = "é😀x a"
    packed = codec.pack(text)
    assert codec.decode(packed) == text.encode()
    starts, ends = codec.offsets(packed)
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] <= ends[:-1]).all()
    split = codec.decode(packed[:4 * 2])  # ends inside the emoji
    assert split.decode(errors="replace").startswith("é")


def test_round_trip_rows(spark, codec):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, None, 6), (2, "", 7), (3, "é" * 3000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, bpe.round_trip(df, PATH, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for doc, text, _ in rows:
        ids = np.array(codec.encode(text or ""), dtype="<u4").tobytes()
        want.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    encoded = bpe.encode(df, PATH, public_tokenizers.PATTERN, with_offsets=True)
    assert {r.text for r in bpe.decode(encoded, PATH, public_tokenizers.PATTERN).collect()} == {"a b", "", "é" * 3000}
    assert bpe.round_trip(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def brute_quality(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    n = len(words)
    threes = Counter(tuple(words[j:j + 3]) for j in range(n - 2))
    repeated = {k for j in range(n - 2) if threes[tuple(words[j:j + 3])] > 1 for k in (j, j + 1, j + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    deepest = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            deepest[i] = max(deepest[i], k)
    spans = {k for i, size in enumerate(deepest) if size >= quality.MIN_REPEAT for k in range(i, i + size)}
    return [n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(repeated), max(deepest, default=0), len(spans)]


def test_statistics_equal_brute_force():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a ", "b ", "é ", "c\n", "d# ", "\t", "e e e e e ", "\x85 "])
                     for _ in range(rng.randint(0, 35))) for _ in range(150)]
    assert quality.document_statistics([t.encode() for t in texts]).tolist() == [brute_quality(t) for t in texts]


def test_quality_verdicts_and_pass_through(spark):
    clean = " ".join(f"w{k}" for k in range(100))
    block = " ".join(f"v{k}" for k in range(70))
    rows = [(1, clean, True), (2, None, True), (3, "", False), (4, "a b " * 200, True),
            (5, clean + " " + block + " x " + block, True), (None, clean, None), (1, clean, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    found = {(r.doc_id, r.kept) for r in quality.score(df).collect()}
    # Document 5 repeats 70 of 241 words: too much in one piece.
    assert found == {(1, True), (2, False), (3, False), (4, False), (5, False), (None, True)}
    kept = quality.keep(df)
    assert kept.schema == df.schema and sorted(kept.collect(), key=str) == sorted(
        [df.collect()[k] for k in (0, 5, 6)], key=str)
    assert quality.keep(df.limit(0)).count() == 0


def test_language_on_held_out_documents(spark, sf_dir):
    from gitsift.llm.queries import QUERIES

    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_without_letters_or_labels(spark):
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (3, None, "en"), (4, "123 !", None), (None, "x", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df, language.train(df)).collect()}
    assert found[3] == found[4] == ("und", 0.0) and found[1][0] == "en" and found[2][0] == "fr"
    digits = language.train(df.filter("doc_id = 1").withColumn("text", df["doc_id"].cast("string")))
    assert digits.languages == ["en"] and digits.predict("a")[0] == "en" and digits.predict("1")[0] == "und"
    nothing = language.train(df.filter("lang = 'xx'"))
    assert {r.lang_pred for r in language.predict(df, nothing).collect()} == {"und"}
    assert language.predict(df.limit(0), nothing).count() == 0


def test_temperature_makes_scores_honest():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 2000)
    logits = rng.normal(size=(2000, 3)) + 2 * np.eye(3)[truth]
    assert abs(language.fit_temperature(5 * logits, truth) / language.fit_temperature(logits, truth) - 5) < 0.05
