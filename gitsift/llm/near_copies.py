"""Documents that share four fifths or more of their word shingles, found exactly.

Two sets whose Jaccard similarity is a/b or more share an element among the first
n - ceil(a n / b) + 1 of each (n its size), in any one order of all shingles. Documents
meet by those first shingles, and every pair that meets is verified on its whole sets
before it becomes a link, so the links are those of a comparison of all pairs.

* The order puts shingles that many documents of a sample hold last, so that common
  passages bring few documents together. It decides the work only, never the links.
* Equal sets are one row before anything is sent, so exact copies cost nothing.
* First each document is verified with the first and the previous one at each shingle,
  which is linear, unless fingerprints have linked them already. Then all pairs that meet and are not yet of one component, if sizes
  and places allow the similarity.
* Before texts move, sizes and sketches of a bit a shingle drop the pairs that they prove unlike.

Rows: null text has no words, so an empty set, which equals other empty sets only. Texts
of fewer words than a shingle are one shingle. Rows without doc_id link nothing.
Repeated rows are one document. Ties are settled by the smallest doc_id. Very long texts
are hashed whole. Shingles are told apart by 64 bits, sets by 128.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gitsift.llm import simhash
from gitsift.llm.common import map_batches, one_of_equals, texts_of
from gitsift.llm.components import smallest_reachable
from gitsift.session import materialise, spread

SHINGLE_WORDS = 5
#: The least similarity, as a fraction of whole numbers.
SIMILARITY = (4, 5)
SEED = 42
#: One document in so many is looked at for common shingles; how many of those make one common.
SAMPLE, COMMON = 8, 4
#: Common shingles that the order knows at most, the most frequent ones.
MAX_COMMON = 200_000


def shingles(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the different shingles of a text, ascending; words as in ``simhash``."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    width = min(shingle_words, len(words))
    count = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(
        starts[:count].tolist(), (ends[width - 1:] - 1).tolist())), np.uint64, count)
    return np.unique(hashes.view(np.int64))


def similar(a: np.ndarray, b: np.ndarray, similarity=SIMILARITY) -> bool:
    """Whether two sets without repeats have the similarity."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return similarity[1] * both >= similarity[0] * (len(a) + len(b) - both)


def first_shingles(found: np.ndarray, common: np.ndarray, counts: np.ndarray,
                   similarity=SIMILARITY) -> np.ndarray:
    """The shingles of a set by which it must meet any similar one, in their order."""
    n = len(found)
    if not n:
        return found
    rank = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        rank = np.where(common[at] == found, counts[at], 0)
    least = -(-similarity[0] * n // similarity[1])
    return found[np.lexsort((found, rank))[:n - least + 1]]


def sketch(found: np.ndarray) -> bytes:
    """Parities of how many shingles fall on each bit, about a bit for each shingle.

    Two sketches differ in no more bits than their sets differ in shingles.
    """
    bits = max(64, 1 << (len(found) - 1).bit_length())
    odd = np.bincount(found & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_be_similar(a: bytes, n_a: int, b: bytes, n_b: int, similarity=SIMILARITY) -> bool:
    """False only if the sizes or the sketches show that the sets lack the similarity."""
    if similarity[1] * min(n_a, n_b) < similarity[0] * max(n_a, n_b):
        return False  # a short sketch could not tell: folded, the longer one may differ in few bits
    width = min(len(a), len(b))
    # The longer one is folded: its bits of equal low places are one bit of a shorter sketch.
    x, y = (np.bitwise_xor.reduce(np.frombuffer(s, np.uint8).reshape(-1, width), axis=0) for s in (a, b))
    differ = int(np.bitwise_count(x ^ y).sum())
    return (similarity[0] + similarity[1]) * differ <= (similarity[1] - similarity[0]) * (n_a + n_b)


def set_keys(df: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, set_key (digest of its set of shingles) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [xxhash.xxh3_128_digest(shingles(t, shingle_words).tobytes()) for t in texts_of(batch)]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                           "set_key": pa.array(keys, pa.binary())})

    return map_batches(df.select("doc_id", "text"), run, "doc_id long, set_key binary")


def common_shingles(texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of the sample hold, ascending, and how many hold each."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, shingle_words) for t in texts_of(batch)]
        return pa.RecordBatch.from_pydict({"key": pa.array(np.concatenate(found))})

    sample = texts.filter(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    rows = (map_batches(sample.select("text"), run, "key long").groupBy("key")
            .agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
            .orderBy(F.desc("n"), "key").limit(MAX_COMMON).toPandas())
    keys, counts = rows["key"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def meetings(texts: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity=SIMILARITY,
             roots: DataFrame | None = None) -> DataFrame:
    """key, id, n, at: first shingles that several documents have, the set's size, the place.

    ``before`` and ``first`` are other documents there, null if ``roots`` (node, component) has
    them in one component already.
    """
    common, counts = common_shingles(texts, shingle_words)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, shingle_words) for t in texts_of(batch)]
        firsts = [first_shingles(x, common, counts, similarity) for x in found]
        lengths = [len(x) for x in firsts]
        ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.RecordBatch.from_pydict({
            "key": pa.array(np.concatenate(firsts)), "id": pa.array(np.repeat(ids, lengths)),
            "n": pa.array(np.repeat(np.array([len(x) for x in found], np.int32), lengths)),
            "at": pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths]))})

    sent = map_batches(texts.select("id", "text"), run, "key long, id long, n int, at int")
    root = F.col("id")
    if roots is not None:
        sent, root = sent.join(roots, F.col("id") == F.col("node"), "left"), F.coalesce("component", "id")
    named = sent.select("key", "id", "n", "at", F.struct("id", root.alias("root")).alias("own"))
    # Places at a key in order of size: neighbours are the likeliest to be similar.
    group = Window.partitionBy("key").orderBy("n", "id")
    met = (named.withColumn("before", F.lag("own").over(group)).withColumn("after", F.lead("id").over(group))
           .withColumn("first", F.first("own").over(group)).filter("before IS NOT NULL OR after IS NOT NULL"))
    other = [F.when(F.col(c)["root"] != F.col("own")["root"], F.col(c)["id"]).alias(c) for c in ("before", "first")]
    return met.select("key", "id", "n", "at", *other)


def sketches(texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """id, n, bits: the size and the sketch of every set that is not empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, shingle_words) for t in texts_of(batch)]
        full = [len(x) > 0 for x in found]
        return pa.RecordBatch.from_pydict({
            "id": batch.column("id"), "n": pa.array([len(x) for x in found], pa.int32()),
            "bits": pa.array([sketch(x) if len(x) else b"" for x in found], pa.binary()),
        }).filter(pa.array(full, pa.bool_()))

    return map_batches(texts.select("id", "text"), run, "id long, n int, bits binary")


def possible(pairs: DataFrame, known: DataFrame, similarity=SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches (``known``) do not rule the similarity out."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = (batch.column(c).to_pylist() for c in ("bits_a", "n_a", "bits_b", "n_b"))
        may = [may_be_similar(*row, similarity) for row in zip(*columns)]
        return batch.select(["a", "b"]).filter(pa.array(may, pa.bool_()))

    joined = pairs
    for side in ("a", "b"):
        joined = joined.join(known.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"),
                                          F.col("bits").alias(f"bits_{side}")), side)
    return map_batches(joined.select("a", "b", "n_a", "bits_a", "n_b", "bits_b"), run,
                       "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, shingle_words: int = SHINGLE_WORDS,
             similarity=SIMILARITY) -> DataFrame:
    """Those of the pairs (a, b) whose sets have the similarity."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held: dict[int, np.ndarray] = {}

        def known(name: str) -> list[np.ndarray]:
            out = []
            for text in texts_of(batch, name):
                key = xxhash.xxh3_128_intdigest(text)
                if key not in held:
                    held[key] = shingles(text, shingle_words)
                out.append(held[key])
            return out

        near = [similar(x, y, similarity) for x, y in zip(known("text_a"), known("text_b"))]
        return batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    joined = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))
    return map_batches(joined.select("a", "b", "text_a", "text_b"), run, "a long, b long").distinct()


def links(texts: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity=SIMILARITY,
          known_links: DataFrame | None = None) -> DataFrame:
    """Edges a, b of rows (id, text): all similar pairs, but for those of one component already.

    ``known_links`` (a, b) are among the edges returned, and make components from the start.
    """
    part, whole = similarity
    linked_before = None if known_links is None else materialise(smallest_reachable(known_links), "roots")
    met = materialise(meetings(texts, shingle_words, similarity, linked_before), "meetings")

    def ordered(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    near = met.select(*ordered("id", "before")).unionByName(met.select(*ordered("id", "first")))
    tried = materialise(near.filter("a <> b").distinct(), "pairs")
    known = materialise(sketches(texts, shingle_words), "sketches")

    def linked(pairs):
        likely = materialise(possible(pairs, known, similarity), "likely")
        return verified(spread(likely, "a"), texts, shingle_words, similarity)

    found = materialise(linked(tried), "links")
    if known_links is not None:
        found = found.unionByName(known_links)
    roots = materialise(smallest_reachable(found), "roots")
    named = (met.select("key", "id", "n", "at").join(roots, F.col("id") == F.col("node"), "left")
             .select("key", "id", "n", "at", F.coalesce("component", "id").alias("root")))
    x, y = named.alias("x"), named.alias("y")
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    # Shared are at most those up to the key's places and those after them.
    shared = F.least("x.at", "y.at") + 1 + F.least(F.expr("x.n - x.at - 1"), F.expr("y.n - y.at - 1"))
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id"))
                  & (F.col("x.root") != F.col("y.root")) & (whole * small >= part * large)
                  & ((part + whole) * shared >= part * (F.col("x.n") + F.col("y.n"))))
    rest = rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    rest = materialise(rest.join(tried, ["a", "b"], "left_anti"), "pairs")
    return found.unionByName(linked(rest))


def fingerprint_links(texts: DataFrame, shingle_words: int, bits: int) -> DataFrame:
    """Edges a, b that join all rows (id, text) whose SimHash fingerprints are that near."""
    prints = materialise(simhash.fingerprints(
        texts.select(F.col("id").alias("doc_id"), "text"), shingle_words), "fingerprints")
    nodes = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "nodes")
    same = prints.join(nodes, "fingerprint").filter("doc_id <> id").select(
        F.col("doc_id").alias("a"), F.col("id").alias("b"))
    return simhash.links(nodes, bits).unionByName(same)


def components(df: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity=SIMILARITY,
               fingerprint_bits: int | None = None) -> DataFrame:
    """doc_id, component_id of every row that has a doc_id.

    With ``fingerprint_bits``, SimHash fingerprints that differ in no more bits link first,
    and the exact comparison of sets follows for the similar pairs that they miss.
    """
    named = df.filter("doc_id IS NOT NULL").select("doc_id", "text")
    keys = materialise(set_keys(named, shingle_words), "set_keys")
    nodes = materialise(keys.groupBy("set_key").agg(F.min("doc_id").alias("id")), "nodes")
    # A doc_id with several texts may bring one along that another node stands for: no harm.
    texts = named.join(nodes.select("id").distinct(), F.col("doc_id") == F.col("id"), "left_semi")
    texts = materialise(texts.select(F.col("doc_id").alias("id"), "text").distinct(), "texts")
    if fingerprint_bits is None:
        edges = links(texts, shingle_words, similarity)
    else:
        near = materialise(fingerprint_links(texts, shingle_words, fingerprint_bits), "fingerprint_links")
        edges = links(texts, shingle_words, similarity, near)
    roots = smallest_reachable(edges)
    classes = (nodes.join(roots, F.col("id") == F.col("node"), "left")
               .select("set_key", F.coalesce("component", "id").alias("component_id")))
    return (keys.join(materialise(classes, "classes"), "set_key")
            .select("doc_id", "component_id"))


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
