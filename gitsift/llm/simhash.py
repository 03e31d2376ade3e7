"""Near-duplicate documents by SimHash, found with anchor points of a covering code.

A fingerprint's 64 bits are cut into sections with thresholds so that two
fingerprints within the overall threshold are within the section's threshold in at
least one section. In a section the anchors are the words of the binary Golay code on
23 bits, whose balls of radius 3 cover every word exactly once, with any further bits
as they are. Each fingerprint has one home, the anchor within 3 bits of it, and is
sent to every anchor within 3 bits plus the section's threshold. Whatever is within
the threshold of a fingerprint is therefore at its home. At each anchor, those at home
are compared with all that were sent there, by exact Hamming distance.

* Equal fingerprints are one row before anything is sent, so exact copies cost nothing.
* An anchor with more rows than ``BLOCK`` is compared in blocks, each a task's share.
* A block gives a spanning forest of its links, not all its pairs.

Rows: null text has no words, so fingerprint zero, which links like any other. Rows
without doc_id get their fingerprint, link nothing, and have no component. Repeated
rows are one document. Ties are settled by the smallest doc_id. Further columns,
whatever their names, are not looked at. Very long texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import map_batches, one_of_equals, texts_of
from gitsift.llm.components import smallest_reachable
from gitsift.session import materialise, measured

SHINGLE_WORDS = 4
SEED = 42
MAX_DISTANCE = 4
#: Bits and threshold of each section; the thresholds plus one add up to MAX_DISTANCE + 1.
SECTIONS = ((24, 1), (24, 1), (16, 0))
#: Fingerprints of an anchor that are compared in one block.
BLOCK = 4096
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16

# Length, radius and generator polynomial of the binary Golay code.
GOLAY_BITS, GOLAY_RADIUS, GOLAY_POLYNOMIAL = 23, 3, 0b110001110101


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text: bytes lower and split at exactly the ASCII the contract names."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    width = min(shingle_words, len(words))
    count = len(words) - width + 1
    starts, ends = starts[:count].tolist(), (ends[width - 1:] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, CHUNK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in
                           zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (its 64 bits as a long) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t, shingle_words) for t in texts_of(batch)]
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "fingerprint": pa.array(np.array(prints, dtype=np.uint64).view(np.int64))})

    return map_batches(df.select("doc_id", "text"), run, "doc_id long, fingerprint long")


@lru_cache(maxsize=1)
def _bit_remainders() -> list[int]:
    """What each bit of a word leaves when divided by the polynomial."""
    remainders = []
    for bit in range(GOLAY_BITS):
        value = 1 << bit
        for high in range(bit, 10, -1):
            if value >> high & 1:
                value ^= GOLAY_POLYNOMIAL << (high - 11)
        remainders.append(value)
    return remainders


def _remainder(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), np.int64)
    for bit, value in enumerate(_bit_remainders()):
        out ^= (words >> bit & 1) * value
    return out


@lru_cache(maxsize=8)
def _patterns(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Error patterns of weight up to ``radius`` by remainder, and where each remainder starts."""
    bits = [sum(1 << b for b in some) for weight in range(radius + 1)
            for some in combinations(range(GOLAY_BITS), weight)]
    patterns = np.array(bits, dtype=np.int64)
    remainders = _remainder(patterns)
    order = np.argsort(remainders, kind="stable")
    return patterns[order], np.searchsorted(remainders[order], np.arange(2049))


def golay_home(words: np.ndarray) -> np.ndarray:
    """The one code word within three bits of each word."""
    patterns, starts = _patterns(GOLAY_RADIUS)
    return words ^ patterns[starts[_remainder(words)]]


def golay_within(words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and code words: all within ``radius`` of each word."""
    patterns, starts = _patterns(radius)
    remainder = _remainder(words)
    first, last = starts[remainder], starts[remainder + 1]
    rows = np.repeat(np.arange(len(words)), last - first)
    inner = np.arange(len(rows)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
    return rows, words[rows] ^ patterns[first[rows] + inner]


def anchors(prints: np.ndarray, sections=SECTIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, anchor keys and whether the anchor is the row's home.

    A key holds the section in its top bits, so anchors of sections never meet.
    """
    rows, keys, homes, shift = [], [], [], 0
    for number, (bits, threshold) in enumerate(sections):
        part = (prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
        part, shift = part.astype(np.int64), shift + bits
        coded = GOLAY_BITS if bits >= GOLAY_BITS else 0
        low, high = part & ((1 << coded) - 1), part >> coded
        home = golay_home(low) if coded else low
        for flips in range(threshold + 1):
            for some in combinations(range(bits - coded), flips):
                mask = sum(1 << b for b in some)
                left = threshold - flips
                if coded and left:
                    at, words = golay_within(low, GOLAY_RADIUS + left)
                else:
                    at, words = np.arange(len(part)), home
                rows.append(at)
                keys.append(np.int64(number) << 58 | (high[at] ^ mask) << coded | words)
                homes.append((words == home[at]) & (flips == 0))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def local_links(home: np.ndarray, home_ids: np.ndarray, other: np.ndarray, other_ids: np.ndarray,
                max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between fingerprints at home and the others."""
    ids, at = np.unique(np.concatenate((home_ids, other_ids)), return_inverse=True)
    left, right = [], []
    step = max(1, (1 << 22) // max(1, len(other)))
    for start in range(0, len(home), step):
        near = np.bitwise_count(home[start:start + step, None] ^ other[None, :]) <= max_distance
        a, b = np.nonzero(near)
        a, b = at[:len(home)][a + start], at[len(home):][b]
        differ = a != b
        left.append(a[differ])
        right.append(b[differ])
    a, b = np.concatenate(left or [[]]).astype(np.int64), np.concatenate(right or [[]]).astype(np.int64)
    label = np.arange(len(ids))
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]


def _links_of_groups(df: DataFrame, max_distance: int) -> DataFrame:
    """Edges a, b from rows (key, i, j, home, fingerprint, id), sorted by group within partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(block: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            new = np.any(block[1:, :3] != block[:-1, :3], axis=1)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(block)]
            found = []
            for start, end in zip(cuts, cuts[1:]):
                group = block[start:end]
                home = group[:, 3] == 1
                if home.any() and end - start > 1:
                    prints = group[:, 4].view(np.uint64)
                    found.append(local_links(prints[home], group[home, 5], prints[~home],
                                             group[~home, 5], max_distance))
            return found

        def batch_of(found):
            a = np.concatenate([x[0] for x in found])
            b = np.concatenate([x[1] for x in found])
            return pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

        for batch in batches:
            block = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)
                              for k in range(6)], axis=1)
            if held:
                block = np.concatenate([*held, block])
            # The last group may go on in the next batch.
            cut = int(np.flatnonzero(np.all(block[:, :3] == block[-1, :3], axis=1))[0])
            held = [np.ascontiguousarray(block[cut:])]
            if cut and (found := links(np.ascontiguousarray(block[:cut]))):
                yield batch_of(found)
        if held and (found := links(held[0])):
            yield batch_of(found)

    return df.select("key", "i", "j", F.col("home").cast("long"), "fingerprint", "id").mapInArrow(
        run, "a long, b long")


def links(nodes: DataFrame, max_distance: int = MAX_DISTANCE, sections=SECTIONS,
          block: int = BLOCK) -> DataFrame:
    """Edges a, b between rows (id, fingerprint) that join whatever is within the distance."""
    if sum(bits for bits, _ in sections) != 64 or sum(t + 1 for _, t in sections) <= max_distance:
        raise ValueError("the sections must have 64 bits and cover the distance")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).astype(np.int64)
        rows, keys, homes = anchors(prints.view(np.uint64), sections)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_pydict({
            "key": pa.array(keys), "fingerprint": pa.array(prints[rows]),
            "id": pa.array(ids[rows]), "at_home": pa.array(homes)})

    sent = map_batches(nodes.select("id", "fingerprint"), run,
                       "key long, fingerprint long, id long, at_home boolean")
    counts = sent.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    hot = measured(counts.select("key", F.ceil(F.col("n") / block).cast("int").alias("parts")), "anchors")
    parts = F.coalesce(F.col("parts"), F.lit(1))
    split = (sent.join(hot, "key", "left")
             .withColumn("parts", parts)
             .withColumn("part", F.pmod(F.xxhash64("fingerprint"), "parts").cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    others = split.select("key", every.alias("i"), F.col("part").alias("j"),
                          F.lit(False).alias("home"), "fingerprint", "id")
    at_home = split.filter("at_home").select("key", F.col("part").alias("i"), every.alias("j"),
                                             F.lit(True).alias("home"), "fingerprint", "id")
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = (others.unionByName(at_home).repartition(tasks, "key", "i", "j")
               .sortWithinPartitions("key", "i", "j"))
    return _links_of_groups(grouped, max_distance).distinct()


def components(df: DataFrame, max_distance: int = MAX_DISTANCE, sections=SECTIONS,
               shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    prints = materialise(fingerprints(df, shingle_words), "fingerprints")
    nodes = materialise(prints.filter("doc_id IS NOT NULL").groupBy("fingerprint")
                        .agg(F.min("doc_id").alias("id")), "nodes")
    roots = smallest_reachable(links(nodes, max_distance, sections))
    classes = (nodes.join(roots, nodes["id"] == roots["node"], "left")
               .select("fingerprint", F.coalesce("component", "id").alias("component_id")))
    # A fingerprint that a third of all rows share is a hot key of this join only.
    return (prints.join(materialise(classes, "classes"), "fingerprint", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_one(df: DataFrame, **options) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all columns of ``df``.

    Rows without doc_id stay. Of rows equal in doc_id and text one stays, always the same
    one. Different texts under the kept doc_id all stay, since other documents may have been
    dropped for any of them.
    """
    found = components(df, **options).select(F.col("doc_id").alias("_gs_id"), "component_id")
    kept = found.filter("_gs_id = component_id").select("_gs_id").distinct()
    named = df.filter("doc_id IS NOT NULL")
    named = named.join(kept, F.col("doc_id") == F.col("_gs_id"), "left_semi")
    return one_of_equals(named).unionByName(df.filter("doc_id IS NULL"))
