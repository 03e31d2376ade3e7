"""What a Python worker holds is bounded by bytes, not by the rows that Spark sends at once."""

import public_tokenizers
import pyarrow as pa
import pytest

from gitsift.llm import bpe, common, quality


def test_slices_are_bounded_and_whole():
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text": ["x" * (100 * i) for i in range(9)]})
    parts = list(common.slices(rows, 500))
    assert all(p.num_rows == 1 or p.nbytes <= 500 for p in parts)
    assert pa.Table.from_batches(parts).combine_chunks() == pa.Table.from_batches([rows])
    assert [p.num_rows for p in common.slices(rows.slice(0, 0), 500)] == [0]  # no rows are a part too


def test_functions_see_few_bytes_at_a_time(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('abcdefgh', 1 << 16) AS text").coalesce(1)
    seen = common.map_batches(docs, lambda b: pa.RecordBatch.from_pydict({"n": [b.nbytes], "rows": [b.num_rows]}),
                              "n long, rows long").collect()
    assert sum(r.rows for r in seen) == 40
    assert max(r.n for r in seen) <= common.SLICE_BYTES


@pytest.mark.parametrize("method", ["score", "keep"])
def test_quality_takes_few_bytes_at_a_time(spark, monkeypatch, method):
    found = []
    real = quality.texts_of
    monkeypatch.setattr(quality, "texts_of", lambda b: found.append(b.nbytes) or real(b))
    text = " ".join(f"w{i}" for i in range(100_000))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(30)), "text": [text] * 30})

    class Rows:  # runs the function on one batch, without a worker
        schema = None

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return list(run(iter([batch])))

    out = getattr(quality, method)(Rows())
    assert sum(b.num_rows for b in out) == 30 and max(found) <= common.SLICE_BYTES


def test_tables_of_the_codec_stay_small():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as handle:
        codec = bpe.Codec(handle.read(), public_tokenizers.PATTERN)
    words = [f" w{i}" for i in range(120_000)]
    packed = codec.pack("".join(words))
    assert codec.decode(packed) == "".join(words).encode()
    held = sum(len(t) + len(t._old) for t in (codec._chunks, codec._pieces))
    assert held <= 200_000
