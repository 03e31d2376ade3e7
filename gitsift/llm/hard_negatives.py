"""Hard negatives of anchors by a secondary sort of packed pair scores.

Every anchor is scored against all rows, in blocks: rows are dealt to groups of a bounded
size, every group is visited by all anchors, and an anchor passes a group's rows as one
product of integer matrices. Two passes over those blocks keep what can still be wanted:

1. the best rows of the anchor's own label in each group. Their union holds the anchor's
   positives, and so tells the score window of each;
2. per window, the best rows of other labels in each group. Their union holds the
   negatives of the window.

Both are packed into one binary key a pair: anchor, descending score, kind, id. The keys
are dealt by anchor and sorted by key within each partition (``repartitionAndSort-
WithinPartitions`` in its DataFrame form, which sorts and spills in the JVM), and an
iterator reads them once: the first positives of an anchor open their windows, negatives
are given to every window that their score lies in, and a window closes when it is full
or the scores have fallen below it. No anchor is ever held as a list.

* A row takes no part if its id, label or vector is null, or any component is null or not
  finite. Scores are exact; one that does not fit 64 bits is an error.
* Vectors of different lengths have no inner product, so such pairs do not exist.
* Repeated rows (same id, label and vector) are one row. Rows of one id that differ are
  rows of their own, but no row is a positive of an anchor of the same id, and rows of
  one id, kind and score count once for an anchor.
* Ties in score go by smaller id. A positive precedes a negative of the same score, which
  matters at score zero only, where the window is that one score.
* An anchor whose positives score below zero has empty windows. An empty table, or one
  without anchors, gives no rows. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gitsift.session import materialise

#: Rows that one group may hold at most, on average; a group is what a task keeps in memory.
GROUP_ROWS = 65_536
#: Rows that a group should have at least before more groups are made.
LEAST_ROWS = 1_024
#: Pairs that are scored at once.
SLAB = 1 << 21

_LOWEST = np.iinfo(np.int64).min
_POSITIVE, _NEGATIVE = 0, 1
#: A packed pair: sorts as bytes by anchor, then score from high to low, kind, id.
_KEY = np.dtype([("anchor", ">u8"), ("digest", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_ANCHOR_BYTES = 16


def _ordered(values: np.ndarray) -> np.ndarray:
    """Signed longs as unsigned ones in the same order."""
    return (values.astype(np.int64) ^ _LOWEST).view(np.uint64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64) ^ _LOWEST


def pack(anchor: np.ndarray, digest: np.ndarray, score: np.ndarray, kind: int, row: np.ndarray) -> pa.Array:
    keys = np.empty(len(anchor), _KEY)
    keys["anchor"], keys["digest"], keys["id"] = _ordered(anchor), _ordered(digest), _ordered(row)
    keys["score"], keys["kind"] = ~_ordered(score), kind
    offsets = np.arange(0, (len(keys) + 1) * _KEY.itemsize, _KEY.itemsize, dtype=np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(keys.tobytes())])


def unpack(keys: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(keys.to_pylist()), _KEY)


def _matrices(vectors: pa.ListArray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and scaled, floored components of the vectors of each length."""
    offsets = vectors.offsets.to_numpy()
    values = np.floor(scale * vectors.values.to_numpy(zero_copy_only=False).astype(np.float64))
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[offsets[rows][:, None] + np.arange(length)]


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of integers held as doubles, exact, as longs."""
    bound = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < 2 ** 53:
        return (left @ right.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(left) @ whole(right).T
    if any(abs(x) >= 2 ** 63 for x in exact.ravel()):
        raise ValueError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def _best(scores: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k best wanted scores of each row; lower columns on ties."""
    masked = np.where(wanted, scores, _LOWEST)
    n = masked.shape[1]
    if n > k:
        wanted = wanted & (masked >= np.partition(masked, n - k, axis=1)[:, n - k, None])
    row, column = np.nonzero(wanted)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


def _window(score: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """Least and greatest integer between the two fractions of a score."""
    return -(-low[0] * score // low[1]), high[0] * score // high[1]


class _Group:
    """The rows of one group by vector length, in the order of their ids."""

    def __init__(self) -> None:
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: pa.ListArray, scale: int) -> None:
        for rows, matrix in _matrices(vectors, scale):
            self.parts.setdefault(matrix.shape[1], []).append((ids[rows], labels[rows], matrix))

    def of_length(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        some = self.parts.get(length)
        if some is None:
            return None
        if len(some) > 1 or not np.all(some[0][0][1:] >= some[0][0][:-1]):
            ids, labels, matrix = (np.concatenate(x) for x in zip(*some))
            order = np.argsort(ids, kind="stable")
            self.parts[length] = some = [(ids[order], labels[order], matrix[order])]
        return some[0]


def _visits(rows: DataFrame, anchors: DataFrame, groups: int) -> DataFrame:
    """All anchors after the rows of each group, sorted so that a task can stream them."""
    kind, nothing = F.lit(0).alias("kind"), F.lit(None).cast("array<bigint>")
    at_home = rows.select(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(groups)).cast("int").alias("g"),
                          kind, "id", "label", "vector", F.lit(0).cast("long").alias("digest"),
                          nothing.alias("limits"))
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
                          F.lit(1).alias("kind"), "id", "label", "vector", "digest", "limits")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (at_home.unionByName(sent).repartition(max(parts, min(groups, 4 * parts)), "g")
            .sortWithinPartitions("g", "kind", "id"))


def _scored(visits: DataFrame, kind: int, k: int, scale: int, low: tuple[int, int],
            high: tuple[int, int]) -> DataFrame:
    """Packed keys of what each anchor keeps of each group: positives, or negatives by window."""

    def kept(a_ids, a_labels, limits, scores, ids, labels):
        same = a_labels[:, None] == labels[None, :]
        if kind == _POSITIVE:
            return _best(scores, same & (a_ids[:, None] != ids[None, :]), k)
        found = np.zeros(scores.shape, bool)
        for number in range(max(map(len, limits), default=0)):
            bounds = np.array([_window(w[number], low, high) if number < len(w) else (1, 0)
                               for w in limits], dtype=np.int64)
            inside = ~same & (scores >= bounds[:, :1]) & (scores <= bounds[:, 1:])
            found[_best(scores, inside, k)] = True
        return np.nonzero(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, _Group()
        for batch in batches:
            numbers = batch.column("g").to_numpy() * 2 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(cuts, cuts[1:]):
                part = batch.slice(start, end - start)
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                if numbers[start] // 2 != group:
                    group, held = numbers[start] // 2, _Group()
                if numbers[start] % 2 == 0:
                    held.add(ids, labels, part.column("vector"), scale)
                    continue
                digests, limits = part.column("digest").to_numpy(), part.column("limits").to_pylist()
                for rows, matrix in _matrices(part.column("vector"), scale):
                    others = held.of_length(matrix.shape[1])
                    if others is None:
                        continue
                    step = max(1, SLAB // len(others[0]))
                    for at in range(0, len(rows), step):
                        some = rows[at:at + step]
                        scores = inner_products(matrix[at:at + step], others[2])
                        a, r = kept(ids[some], labels[some], [limits[i] or [] for i in some],
                                    scores, others[0], others[1])
                        if len(a):
                            yield pa.RecordBatch.from_arrays(
                                [pack(ids[some][a], digests[some][a], scores[a, r], kind, others[0][r])],
                                ["key"])

    return visits.mapInArrow(run, "key binary")


def _scores_of(keys: DataFrame, k: int) -> DataFrame:
    """id, digest, limits: the k best scores of each anchor from packed positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = unpack(batch.column("key"))
            yield pa.RecordBatch.from_pydict({
                "id": _signed(keys["anchor"]), "digest": _signed(keys["digest"]),
                "score": _signed(~keys["score"]), "other": _signed(keys["id"])})

    best = Window.partitionBy("id", "digest").orderBy(F.desc("score"), "other")
    return (keys.distinct().mapInArrow(run, "id long, digest long, score long, other long")
            .withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k)
            .groupBy("id", "digest").agg(F.collect_list("score").alias("limits")))


def windows(keys: Iterator[bytes | np.void], positives: int, negatives: int, low: tuple[int, int],
            high: tuple[int, int]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """anchor, positive, rank, negative and both scores from sorted (anchor, score, kind, id).

    ``keys`` gives ((anchor, digest), score, kind, id) in key order.
    """
    current, opened, open_windows, last = None, 0, [], None
    for key in keys:
        anchor, score, kind, row = key
        if anchor != current:
            current, opened, open_windows = anchor, 0, []
        elif key == last:
            continue
        last = key
        if kind == _POSITIVE:
            if opened < positives:
                opened += 1
                least, most = _window(score, low, high)
                open_windows.append([row, score, least, most, 0])
            continue
        full = False
        for window in open_windows:
            if window[2] <= score <= window[3]:
                window[4] += 1
                yield anchor[0], window[0], window[4], row, window[1], score
            full |= window[4] == negatives or score < window[2]
        if full:
            open_windows = [w for w in open_windows if w[4] < negatives and score >= w[2]]


def _emitted(keys: DataFrame, positives: int, negatives: int, low: tuple[int, int],
             high: tuple[int, int]) -> DataFrame:
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for batch in batches:
                keys = unpack(batch.column("key"))
                yield from zip(
                    zip(_signed(keys["anchor"]).tolist(), _signed(keys["digest"]).tolist()),
                    _signed(~keys["score"]).tolist(), keys["kind"].tolist(), _signed(keys["id"]).tolist())

        held = []
        for found in windows(pairs(), positives, negatives, low, high):
            held.append(found)
            if len(held) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (keys.repartition(parts, F.substring("key", 1, _ANCHOR_BYTES)).sortWithinPartitions("key")
            .mapInArrow(run, "anchor_id long, positive_id long, rank int, negative_id long, "
                             "positive_score long, negative_score long"))


def mine(df: DataFrame, row_id: Column, label: Column, vector: Column, is_anchor: Column, *,
         positives: int = 5, negatives: int = 10, scale: int = 256,
         low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100),
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    The columns say what the rows' id, integer label and vector are and which rows are
    anchors. Components are multiplied by ``scale`` and floored. For each anchor and each
    of its first ``positives`` rows of the same label, the first ``negatives`` rows of
    other labels whose score lies between the fractions ``low`` and ``high`` of the
    positive's.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (df.select(row_id.cast("long").alias("id"), label.cast("long").alias("label"),
                      vector.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
            .filter(finite).distinct())
    rows = materialise(rows, "vectors")
    n, parts = rows.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(-(-n // group_rows), min(3 * parts, n // LEAST_ROWS), 1)
    anchors = rows.filter("anchor").select("id", "label", "vector", F.xxhash64("label", "vector").alias("digest"))
    none = anchors.withColumn("limits", F.lit(None).cast("array<bigint>"))
    found = materialise(_scored(_visits(rows, none, groups), _POSITIVE, positives, scale, low, high), "positives")
    limits = _scores_of(found, positives)
    known = materialise(anchors.join(limits, ["id", "digest"]), "anchors")
    others = _scored(_visits(rows, known, groups), _NEGATIVE, negatives, scale, low, high)
    return _emitted(found.unionByName(others), positives, negatives, low, high)
