"""Commit messages, prefixes and diffs: tables of cases and a plain rewrite of the rules."""

import re

import pytest
from pyspark.sql import functions as F

from gitsift import fixed_values as fv
from gitsift.functions import text as tx
from gitsift.functions.diffs import diff_stats, diff_view, normalise_diff
from gitsift.operators import cleaning

TYPES = [
    ("feat: add login", "feat"), ("fix(auth): bug", "fix"), ("FIX: race condition", "fix"),
    ("docs(README): update", "docs"), ("refactor!: rewrite api", "refactor"),
    ("perf: faster sort", "perf"), ("style: formatting", "style"),
    ("not a conventional commit", None), ("", None), (None, None), ("note: just an FYI", None),
    ("feat:", None), ("feat:  \nbody", "feat"), ("\n\n  fix: late start", "fix"),
    ("fix(a b)!  :  spaced", "fix"), ("chore: x\r\nfix: y", "chore"), ("   ", None),
    ("feat : wide spaces", "feat"), ("build: a feat: b", "build"),
]
PREFIXES = [
    ("feat: add login", "add login"), ("fix(auth): handle null", "handle null"),
    ("docs: README\n\nbody text", "README\n\nbody text"), ("just a sentence", "just a sentence"),
    ("feat: " + "x" * 1000, "x" * 1000), (None, ""), ("", ""), ("  \n ", ""),
    ("fix: a\r\nb\u000bc\u0085d", "a\nb\nc\nd"), ("feat: \U0001f600" * 200, None),
    ("docs: trailing  \n\n", "trailing"), ("no prefix\nfix: second", "no prefix\nfix: second"),
]


def plain_strip_prefix(message):
    if not message or not message.strip():
        return ""
    first, *rest = message.strip().splitlines()
    words = "|".join(fv.COMMIT_TYPES)
    m = re.match(rf"(?is)\s*(?:{words})(?:\([^)]*\))?!?\s*:\s*(.+)", first)
    return "\n".join([m.group(1).strip() if m else first, *rest]).strip()


def test_commit_type(spark):
    df = spark.createDataFrame([(m,) for m, _ in TYPES], "m string")
    got = [r[0] for r in df.select(tx.commit_type(F.col("m"))).collect()]
    assert got == [want for _, want in TYPES]


def test_type_with_blank_rest_keeps_label_and_body(spark):
    df = spark.createDataFrame([("x: y\n",), ("feat: ​",)], "m string")
    assert [r[0] for r in df.select(tx.commit_type(F.col("m"))).collect()] == [None, "feat"]


def test_strip_prefix(spark):
    df = spark.createDataFrame([(m,) for m, _ in PREFIXES], "m string")
    got = [r[0] for r in df.select(tx.strip_prefix(F.col("m"))).collect()]
    for (message, want), out in zip(PREFIXES, got):
        assert out == (plain_strip_prefix(message) if want is None else want)
        assert out == plain_strip_prefix(message)


def test_a_limit_is_an_argument(spark):
    df = spark.createDataFrame([("feat: " + "x" * 1000,)], "m string")
    assert df.select(tx.strip_prefix(F.col("m"), 500)).first()[0] == "x" * 500


def test_lines_match_python(spark):
    texts = ["", "a", "a\n", "a\n\nb", "\n", "a\r\nb\rc", "x\u001cy\u001ez", "p q\u0085"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(tx.lines(F.col("t"))).collect()] == [t.splitlines() for t in texts]


DIFF = ("diff --git a/foo.py b/foo.py\n--- a/foo.py\n+++ b/foo.py\n@@ -1 +1,2 @@\n"
        "-old line\n+new line a\n+new line b\n")


def test_diff_statistics(spark):
    long = DIFF + "+x\n" * 3000
    df = spark.createDataFrame([(DIFF,), ("",), (long,), ("plain",), ("+++x\n++y\n",)], "d string")
    rows = df.select(diff_stats(F.col("d")).alias("s")).select("s.*").collect()
    counts = [(r.files_changed, r.lines_added, r.lines_removed) for r in rows]
    assert counts == [(1, 2, 1), (0, 0, 0), (1, 3002, 1), (1, 0, 0), (1, 1, 0)]
    assert rows[2].diff_text == long and rows[0].diff_text == DIFF
    cut = df.select(diff_stats(F.col("d"), 4000)["diff_text"]).collect()
    assert len(cut[2][0]) == 4000 and cut[0][0] == DIFF


def test_list_of_files(spark):
    schema = "message string, mods array<struct<old_path:string,new_path:string,filename:string,diff:string,patch:string>>"
    mods = [("a.py", "a.py", None, "@@ -1 +1 @@\n+new\n-old", None), (None, "", "f", None, "+p"),
            (None, None, None, None, None)]
    df = spark.createDataFrame([("fix: a", mods), ("fix: b", None)], schema)
    got = [r[0] for r in df.select(normalise_diff(df, "mods")).collect()]
    assert got == [
        "diff --git a/a.py b/a.py\n@@ -1 +1 @@\n+new\n-old\ndiff --git a/f b/f\n+p\ndiff --git a/ b/", ""]


def test_columns_by_priority(spark):
    df = spark.createDataFrame([(1, "s", "m", "p")], "commit_id int, subject string, msg string, patch string")
    assert cleaning.message_column(df) == "msg" and cleaning.diff_column(df) == "patch"
    with pytest.raises(KeyError):
        cleaning.message_column(df.select("patch"))
    bare = df.select("commit_id", F.lit("fix: x").alias("message"))
    row = cleaning.clean_commits(bare).first()
    assert (row.diff_text, row.files_changed, row.lines_added, row.lines_removed) == ("", 0, 0, 0)


def test_clean_keeps_only_targets_with_text(spark):
    rows = [(1, "perf: x", ""), (2, "fix: y", DIFF), (3, "hello", ""), (4, "test: z", None)]
    df = spark.createDataFrame(rows, "commit_id int, message string, diff string")
    out = {r.commit_id: r for r in cleaning.clean_commits(df).collect()}
    assert set(out) == {2, 4} and out[2].lines_added == 2 and out[4].diff_text == ""
    assert cleaning.clean_commits(df).columns == ["commit_id", *fv.CLEAN_COLUMNS]


def test_diff_view(spark):
    df = spark.createDataFrame([(1, DIFF), (2, "  \n")], "commit_id int, d string")
    rows = diff_view(df, "d").orderBy("line_no").collect()
    assert [r.kind for r in rows] == ["context"] * 4 + ["removed", "added", "added"]


def test_truncate(spark):
    df = spark.createDataFrame([("abcd",), ("abc",), (None,)], "t string")
    got = [r[0] for r in df.select(tx.truncate(F.col("t"), 3)).collect()]
    assert got == ["abc\n...[truncated]", "abc", ""]
