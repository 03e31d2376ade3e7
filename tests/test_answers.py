"""Answers of language models and prompts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gitsift.functions import answers, prompts
from gitsift.operators.text_metrics import clipped_matches, corpus_bleu, lcs_length, rouge_l

CLASSES = [
    ('{"type": "FIX"}', "json_mode", "fix"), ('{"type": "chore"}', "json_mode", None),
    ('say {"type": "docs"} or feat', "json_mode", "docs"), ('say {"type": "x"} or feat', "json_mode", "feat"),
    ("[1, 2] fix", "json_mode", "fix"), ("[1]", "json_mode", None), ('{"type": "fix"} test', "json_mode", "fix"),
    ("", "json_mode", None), (None, "few_shot", None), ("Refactor!", "few_shot", "refactor"),
    ("prefix fixes", "few_shot", None), ("it is a test.", "zero_shot", "test"), ("fix_it", "rag", None),
    ('{"type": null}', "json_mode", None),
]
LINES = [
    ("feat(api)!: add x", ("feat", "api", "add x")), ("Step one\n  FIX:  y  \nfeat: z", ("fix", "", "y")),
    ("nothing here\nmore", (None, "", "nothing here")), ("", (None, "", "")), (None, (None, "", None)),
    ("\n\n late", (None, "", "late")), ("perf: fast", ("perf", "", "fast")), ("feat: ", (None, "", "feat:")),
]
JSON = [
    ('{"type": "Fix", "scope": " a ", "subject": "s"}', ("fix", "a", "s")),
    ('```json\n{"type": "perf", "subject": "s"}\n```', (None, "", "s")),
    ("docs: by line", ("docs", "", "by line")), ("{broken\ntest: t", ("test", "", "t")),
    ("[1]", (None, "", "")), ('{"type": "feat", "scope": null}', ("feat", "", "")),
    ('{"type": "fix"} {"type": "feat"}', (None, "", '{"type": "fix"} {"type": "feat"}')),
]
CALLS = [
    ('{"name": "scan_repo", "arguments": {"n": 1}}', ("scan_repo", '{"n":1}')),
    ('```json\n{"tool": "list_models"}\n```', ("list_models", "{}")),
    ('ok {"name": "", "tool": "list_classes", "args": {}, "parameters": {"a": 2}} end', ("list_classes", '{"a":2}')),
    ('{"name": "rm"}', None), ("text", None), ("[1]", None), ('{"name": ["scan_repo"]}', None), ("", None),
]


def test_class_of_answer(spark):
    df = spark.createDataFrame([(r, s) for r, s, _ in CLASSES], "r string, s string")
    got = [x[0] for x in df.select(answers.parse_class(F.col("r"), F.col("s"))).collect()]
    assert got == [w for _, _, w in CLASSES]


def test_commit_line(spark):
    df = spark.createDataFrame([(r,) for r, _ in LINES], "r string")
    got = [tuple(x[0]) for x in df.select(answers.parse_commit_line(F.col("r"))).collect()]
    assert [(a, b, c or "") for a, b, c in got] == [(a, b, c or "") for _, (a, b, c) in LINES]


def test_json_message(spark):
    df = spark.createDataFrame([(r,) for r, _ in JSON], "r string")
    got = [tuple(x[0]) for x in df.select(answers.parse_json_message(F.col("r"))).collect()]
    assert got == [w for _, w in JSON]


def test_tool_call(spark):
    df = spark.createDataFrame([(r,) for r, _ in CALLS], "r string")
    got = [x[0] and tuple(x[0]) for x in df.select(answers.tool_call(F.col("r"))).collect()]
    assert got == [w for _, w in CALLS]


def test_one_liner(spark):
    rows = [("fix", "a", "s", "r"), ("fix", "", "", "r"), (None, "", "sub", "r"), (None, "", "", "x\ny"),
            (None, "", "", "")]
    df = spark.createDataFrame(rows, "t string, c string, s string, r string")
    got = [x[0] for x in df.select(answers.one_liner(*map(F.col, "tcsr"))).collect()]
    assert got == ["fix(a): s", "fix:", "sub", "x", ""]


def test_prompts(spark):
    examples = F.array(F.struct(F.lit("fix").alias("type"), F.lit("s").alias("subject"), F.lit("d").alias("diff")))
    none = F.array().cast("array<struct<type:string,subject:string,diff:string>>")
    few = prompts.classification_prompt("few_shot", F.lit("m"), F.lit("D"), examples)
    bare = prompts.classification_prompt("rag", F.lit("m"), F.lit("D"), none)
    gen = prompts.generation_prompt("few_shot", F.lit("D"), examples)
    row = spark.range(1).select(few, bare, gen).first()
    assert row[0] == ("Commit message: s\nDiff:\n```diff\nd\n```\nType: fix\n\n---\n\n"
                      "Commit message: m\nDiff:\n```diff\nD\n```\nType:")
    assert row[1] == "Commit message:\nm\n\nDiff:\n```diff\nD\n```\n\nType:"
    assert row[2] == ("Diff:\n```diff\nd\n```\nCommit message: fix: s\n\n---\n\n"
                      "Diff:\n```diff\nD\n```\nCommit message:")
    with pytest.raises(ValueError):
        prompts.generation_prompt("other", F.lit(""))
    with pytest.raises(ValueError):
        prompts.classification_prompt("few_shot", F.lit(""), F.lit(""))


def test_rouge(spark):
    pairs = [("the cat sat", "the cat", 0.8), ("a b c d", "b d", 2 / 3), ("", "x", 0.0), ("", "", 0.0),
             ("Fix-it now!", "fix it", 0.8)]
    df = spark.createDataFrame(pairs, "a string, b string, w double")
    for r in df.select(rouge_l(F.col("a"), F.col("b")).alias("g"), "w").collect():
        assert r.g == pytest.approx(r.w)


def test_bleu(spark):
    rows = [("r", 1, "a b c d e", "a b c d e"), ("q", 1, "x", "y"), ("s", 1, "a b c d", "a b c e")]
    df = spark.createDataFrame(rows, "run string, commit_id int, c string, r string")
    got = {x.run: x.bleu for x in corpus_bleu(df, ["run"], "c", "r").collect()}
    assert got["r"] == pytest.approx(100.0) and got["q"] == 0.0
    # matches 3/4, 2/3, 1/2 and, smoothed, 1/(2*1)
    assert got["s"] == pytest.approx(100 * (3 / 4 * 2 / 3 * 1 / 2 * 1 / 2) ** 0.25)


def lcs_by_hand(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_longest_common_subsequence_over_many_words(spark):
    """Lengths around a word's 62 places, carries between words, few and many different tokens."""
    rng = random.Random(4)
    rows = []
    for n in (0, 1, 2, 30, 61, 62, 63, 100, 123, 124, 125, 190, 260):
        for kinds in (1, 2, 5, 60):
            a, b = ([f"t{rng.randrange(kinds)}" for _ in range(k)] for k in (n, max(0, n + rng.randrange(-40, 41))))
            rows += [(a, b), (b, a), (a, a)]
    rows += [(["x"], ["y"]), ([], ["y"])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = [r[0] for r in df.select(lcs_length(F.col("a"), F.col("b"))).collect()]
    assert got == [lcs_by_hand(a, b) for a, b in rows]


def test_clipped_matches(spark):
    rng = random.Random(5)
    rows = [tuple([f"g{rng.randrange(k)}" for _ in range(rng.randrange(30))] for _ in range(2))
            for k in (1, 2, 4, 10, 100) for _ in range(20)] + [([], []), (["", "a", ""], ["", "b", "", ""])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = [r[0] for r in df.select(clipped_matches(F.col("a"), F.col("b"))).collect()]
    assert got == [sum((Counter(a) & Counter(b)).values()) for a, b in rows]
