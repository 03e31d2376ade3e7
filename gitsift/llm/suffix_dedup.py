"""Suffix-array dedup of byte strings, by longest-previous-factor arrays.

``windows`` finds the regions that may share a long string and brings those of one key
together. Here their suffix order and common prefixes are built, cut off at the length
asked for. In suffix order, the previous and the next smaller place of a suffix lead
to its longest earlier match: the longest-previous-factor array. A place whose factor
reaches the length is a later copy. A place that only reaches it towards a neighbour
has its copies later on, so it is the first.

* ``keep="first"`` removes later copies, ``keep="none"`` all of them.
* null text: no bytes, nothing removed. Texts shorter than the length lose nothing.
* rows without doc_id lose nothing and are no copy of anything; repeated rows of one
  document are one document, each of them comes back.
* matches never cross documents. Very long texts are taken whole. Further columns,
  whatever their names, are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import covered, map_batches, sha256_hex, spans_of, text_key
from gitsift.llm.windows import Windows, repeated

LENGTH = 200
GRAM = 32
#: Bytes in a first sort key, nine bits each.
PACKED = 4


def suffix_order(symbols: np.ndarray, end: np.ndarray, depth: int,
                 packed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` symbols, and what each shares with the one before.

    Each suffix stops at its ``end``. Shared symbols are exact below ``depth``. A symbol
    may stand for the next ``packed`` symbols, a power of two; then shared symbols are
    multiples of it. It must tell what ends within it from what goes on.
    """
    n = len(symbols)
    rank = np.empty(n, np.int64)
    order = np.argsort(symbols)
    moving, keys, places = order, symbols[order], np.arange(n)
    levels, width = [], packed
    while True:
        new = np.ones(len(moving), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        rank[moving] = places[np.maximum.accumulate(np.where(new, np.arange(len(moving)), 0))]
        levels.append(rank.copy())
        alike = ~new
        alike[:-1] |= ~new[1:]
        if width >= depth or not alike.any():
            break
        places = places[alike]
        moving = order[places]
        ahead = moving + width
        second = np.where(ahead < end[moving], rank[np.minimum(ahead, n - 1)] + 1, 0)
        keys = rank[moving] * (n + 1) + second
        by = np.argsort(keys)
        moving, keys = moving[by], keys[by]
        order[places] = moving
        width *= 2
    shared = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    left_end, right_end = end[left], end[right]
    for level in range(len(levels) - 1, -1, -1):
        step = packed << level
        at = np.flatnonzero((left + step <= left_end) & (right + step <= right_end))
        at = at[levels[level][left[at]] == levels[level][right[at]]]
        shared[at + 1] += step
        left[at] += step
        right[at] += step
    return order, shared


def _towards_smaller(places: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Per entry of a suffix order, what it shares with the nearest entry before of smaller place.

    All entries look one step back and then, as long as they see a larger place, on to
    where that one looks; what is shared is the least on the way.
    """
    n = len(places)
    seen = np.arange(n) - 1
    least = shared.copy()
    active = np.arange(1, n)
    while len(active):
        active = active[seen[active] >= 0]
        active = active[places[seen[active]] > places[active]]
        through = seen[active]
        step, share = seen[through], np.minimum(least[active], least[through])
        seen[active], least[active] = step, share
    least[seen < 0] = 0
    return least


def longest_previous(order: np.ndarray, shared: np.ndarray, size: int | None = None) -> np.ndarray:
    """For each place, the longest string from there that also starts at a smaller place.

    ``order`` may leave out some of ``size`` places, which then have none.
    """
    before = _towards_smaller(order, shared)
    following = np.append(shared, 0)[1:]
    after = _towards_smaller(order[::-1], following[::-1])[::-1]
    out = np.zeros(len(order) if size is None else size, np.int64)
    out[order] = np.maximum(before, after)
    return out


def compare(contents: list[np.ndarray], windows: np.ndarray, copies: np.ndarray,
            kind: Windows) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Which windows of each region occur again, and which in an earlier region."""
    sizes = np.array([len(c) for c in contents])
    ends = np.cumsum(sizes)
    end = np.repeat(ends, sizes)
    # Some bytes are one number, if the length is whole in them: rounds less. What lies
    # behind a region's end is less than any byte.
    packed = PACKED if kind.length % PACKED == 0 else 1
    one = np.concatenate([*contents, np.zeros(packed, np.uint8)]).astype(np.int64) + 1
    place, symbols = np.arange(len(end)), np.zeros(len(end), np.int64)
    for k in range(packed):
        symbols = symbols << 9 | np.where(place + k < end, one[k:k + len(end)], 0)
    order, shared = suffix_order(symbols, end, kind.length, packed)
    nearest = np.maximum(shared, np.concatenate((shared[1:], [0])))
    neighbour = np.empty(len(order), np.int64)
    neighbour[order] = nearest
    # Places that share less than the length with both neighbours have no factor of that length.
    reach = np.flatnonzero(nearest >= kind.length)
    least = np.where(shared[reach] >= kind.length, shared[reach], 0)
    previous = longest_previous(order[reach], least, len(order))
    again, later = [], []
    for start, n, many in zip((ends - sizes).tolist(), windows.tolist(), copies.tolist()):
        again.append((neighbour[start:start + n] >= kind.length) | (many > 1))
        later.append(previous[start:start + n] >= kind.length)
    return again, later


def byte_windows(length: int = LENGTH, gram: int = GRAM) -> Windows:
    return Windows(length, gram, lambda text: np.frombuffer(text, dtype=np.uint8), "u1")


def remove_repeats(df: DataFrame, length: int = LENGTH, keep: str = "first",
                   gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs of bytes), kept (binary), kept_sha256."""
    kind = byte_windows(length, gram)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select("doc_id", text_key(F.col("text")).alias("row"), "text")
    # Used twice, to fetch regions and to cut texts: Spark shuffles the texts once.
    placed = docs.repartition(tasks, "doc_id", "row")
    found = repeated(df, placed, kind, compare, keep)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, spans, kept, digests = [], [], [], [], []
        for text, places in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                                batch.column("spans").to_pylist()):
            text, places = text or b"", places or []
            a = np.array([p["a"] for p in places], dtype=np.int64)
            b = np.array([p["b"] for p in places], dtype=np.int64)
            flags = covered(len(text), a, b + length - 1)
            starts, ends = (x.tolist() for x in spans_of(flags))
            rest = np.frombuffer(text, dtype=np.uint8)[~flags].tobytes()
            sizes.append(len(text))
            removed.append(len(text) - len(rest))
            spans.append([{"a": x, "b": y} for x, y in zip(starts, ends)])
            kept.append(rest)
            digests.append(sha256_hex(rest))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
            "kept": pa.array(kept, pa.binary()), "kept_sha256": pa.array(digests, pa.string())})

    joined = placed.join(found, ["doc_id", "row"], "left").select("doc_id", "text", "spans")
    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, "
                                    "spans array<struct<a:long,b:long>>, kept binary, kept_sha256 string")
