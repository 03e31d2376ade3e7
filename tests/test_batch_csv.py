"""CSV files with line breaks in quoted fields, read in several byte ranges."""

import csv
import io
import random

import pytest

from gitsift.sources import batch_csv


def written(rows, line_end, quoting):
    out = io.StringIO()
    csv.writer(out, lineterminator=line_end, quoting=quoting).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("quoting", [csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
def test_records_are_the_same_in_any_number_of_ranges(spark, tmp_path, line_end, quoting):
    rng = random.Random(1)
    pieces = ["a", 'say "x"', '""', "\n", "\r\n", "\n\n", ",", " ", "é", "+line", '"', "fix: b"]
    rows = [["message", "extra", "diff"]]
    rows += [["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) + "." for _ in range(3)]
             for _ in range(150)] + [["end", "", "x" * 5000 + "\n" * 50]]
    for k in range(2):
        (tmp_path / f"part-{k}.csv").write_bytes(written(rows, line_end, quoting).encode())
    want = sorted((r[0], r[2]) for r in rows[1:] * 2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = batch_csv.read_commits(spark, str(tmp_path)).collect()
            assert sorted((r.message, r.diff) for r in got) == want
        lines = spark.read.text(str(tmp_path)).select("_metadata.file_block_start")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        assert lines.distinct().count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_lines_a_missing_column_and_an_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('message\n\nfix: a\n"two\n\nlines"\n\n')
    got = sorted((r.message, r.diff) for r in batch_csv.read_commits(spark, str(tmp_path)).collect())
    assert got == [("fix: a", ""), ("two\n\nlines", "")]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "b.csv").write_text("")
    assert batch_csv.read_commits(spark, str(tmp_path / "empty")).collect() == []
