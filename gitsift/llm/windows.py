"""Windows that occur more than once in a whole corpus, for the two substring operators.

A window is a fixed number of neighbouring symbols (bytes or words) of one document.
Comparing all windows by digest would move many times the corpus, so they are found in
three steps, none of which loses a window:

1. Every window names the gram in it whose hash is smallest, the leftmost of equal ones.
   Equal windows name equal hashes. Neighbouring windows mostly name the same gram; such
   a run of windows is one row (key, digest of the region it spans, where it is). There
   are about two rows for each window length of text, and no run holds a window twice.
2. Keys of one row only hold no repeated window. Keys whose rows all span equal regions
   hold nothing else. Both are settled by counts with map-side combine.
3. The other keys' different regions, each once however often it occurs, are fetched from
   the texts and compared by the operator's own method, key by key. A key with more than
   ``MAX_REGIONS`` different regions (the edges of a passage that very many documents
   share) has its windows' 128-bit digests counted instead, which no single task must hold.

A document is its doc_id and text: repeated rows are one document, which does not repeat
itself. Rows without doc_id hold no windows and lose nothing. Very long texts are taken
whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import drop_table, map_batches, spans_of, text_key
from gitsift.session import materialise, new_path

#: Different regions of one key that a task compares by itself.
MAX_REGIONS = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Enough for a place in the longest string that Spark holds.
_PLACE_BITS = 31


@dataclass(frozen=True)
class Windows:
    """What a window is: its length, the grams in it, and how a text becomes symbols."""

    length: int
    gram: int  # a power of two
    symbols: Callable[[bytes], np.ndarray]  # one number per symbol, equal for equal ones
    dtype: str  # of the symbols in a region's bytes
    group_bytes: int = 1 << 20  # of regions that are compared together

    @property
    def grams(self) -> int:
        return self.length - self.gram + 1


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values so that their order says nothing of what they stand for."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` symbols from each place, by doubling."""
    out, width, factor = mixed(symbols.astype(np.uint64) + _MIX), 1, _MIX
    while width < gram:
        out = out[:-width] * factor + out[width:]
        factor, width = factor * factor, 2 * width
    return mixed(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the ``width`` values from each place."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def runs(symbols: np.ndarray, kind: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and key of each run of windows with one key."""
    if len(symbols) < kind.length:
        none = np.empty(0, np.int64)
        return none, none, none
    with np.errstate(over="ignore"):
        hashes = gram_hashes(symbols, kind.gram)
    # The place below the hash makes the leftmost of equal grams the smallest.
    low = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_min(packed, kind.grams) & low
    starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    sizes = np.diff(np.concatenate((starts, [len(least)])))
    return starts, sizes, hashes[least[starts].astype(np.int64)].view(np.int64)


def run_rows(df: DataFrame, kind: Windows) -> DataFrame:
    """doc_id, row, start, n, key, region of every run of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, starts, sizes, keys, regions = [], [], [], [], []
        for k, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            symbols = kind.symbols(text or b"")
            first, n, key = runs(symbols, kind)
            data, width = symbols.tobytes(), symbols.itemsize
            regions += [xxhash.xxh3_64_intdigest(data[a * width:b * width]) for a, b in
                        zip(first.tolist(), (first + n + kind.length - 1).tolist())]
            at.append(np.full(len(first), k))
            starts.append(first)
            sizes.append(n)
            keys.append(key)
        at = pa.array(np.concatenate(at)) if at else pa.array([], pa.int64())
        ints = lambda parts, dtype: pa.array(np.concatenate(parts).astype(dtype))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id").take(at), "row": batch.column("row").take(at),
            "start": ints(starts, np.int32), "n": ints(sizes, np.int32),
            "key": ints(keys, np.int64),
            "region": pa.array(np.array(regions, dtype=np.uint64).view(np.int64))})

    docs = df.filter("doc_id IS NOT NULL").select("doc_id", text_key(F.col("text")).alias("row"), "text")
    return map_batches(docs, run, "doc_id long, row long, start int, n int, key long, region long")


def _regions(docs: DataFrame, wanted: DataFrame, kind: Windows) -> DataFrame:
    """key, region, copies, doc_id, start, n, hot, content of the wanted places."""
    lists = wanted.groupBy("doc_id", "row").agg(F.collect_list(
        F.struct("key", "region", "copies", "start", "n", "hot")).alias("places"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in (
            "key", "region", "copies", "doc_id", "start", "n", "hot", "content")}
        for doc, text, places in zip(batch.column("doc_id").to_pylist(),
                                     batch.column("text").cast(pa.binary()).to_pylist(),
                                     batch.column("places").to_pylist()):
            symbols = kind.symbols(text or b"")
            data, width = symbols.tobytes(), symbols.itemsize
            for place in places:
                for name, value in place.items():
                    out[name].append(value)
                out["doc_id"].append(doc)
                end = place["start"] + place["n"] + kind.length - 1
                out["content"].append(data[place["start"] * width:end * width])
        types = {"copies": pa.int64(), "start": pa.int32(), "n": pa.int32(), "hot": pa.bool_(),
                 "content": pa.binary()}
        return pa.RecordBatch.from_pydict({
            name: pa.array(values, types.get(name, pa.int64())) for name, values in out.items()})

    return map_batches(
        docs.join(lists, ["doc_id", "row"]).select("doc_id", "text", "places"), run,
        "key long, region long, copies long, doc_id long, start int, n int, hot boolean, content binary")


#: From contents in the order of their documents, the number of windows of each and how many
#: copies each has: which windows occur elsewhere too, and which occur in an earlier region.
Compare = Callable[[list[np.ndarray], np.ndarray, np.ndarray, Windows],
                   tuple[list[np.ndarray], list[np.ndarray]]]
_FOUND = "key long, region long, again array<struct<a:int,b:int>>, later array<struct<a:int,b:int>>"


def _ranges(flags: np.ndarray) -> list[dict[str, int]]:
    return [{"a": a, "b": b} for a, b in zip(*(x.tolist() for x in spans_of(flags)))]


def _found_batch(keys, regions, again, later) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    return pa.RecordBatch.from_pydict({
        "key": pa.array(keys, pa.int64()), "region": pa.array(regions, pa.int64()),
        "again": pa.array([_ranges(f) for f in again], span),
        "later": pa.array([_ranges(f) for f in later], span)})


def _compared(regions: DataFrame, kind: Windows, compare: Compare) -> DataFrame:
    """What of each region occurs again, from all regions of its key in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def result(rows: list[dict]) -> pa.RecordBatch:
            contents = [np.frombuffer(r["content"], dtype=kind.dtype) for r in rows]
            again, later = compare(contents, np.array([r["n"] for r in rows]),
                                   np.array([r["copies"] for r in rows]), kind)
            return _found_batch([r["key"] for r in rows], [r["region"] for r in rows], again, later)

        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size > kind.group_bytes and row["key"] != held[-1]["key"]:
                    yield result(held)
                    held, size = [], 0
                # A region comes twice from repeated rows of its document.
                if not held or (row["key"], row["region"]) != (held[-1]["key"], held[-1]["region"]):
                    held.append(row)
                    size += len(row["content"])
        if held:
            yield result(held)

    tasks = int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (regions.select("key", "region", "copies", "doc_id", "start", "n", "content")
            .repartition(tasks, "key").sortWithinPartitions("key", "doc_id", "start")
            .select("key", "region", "copies", "n", "content").mapInArrow(run, _FOUND))


def _counted(regions: DataFrame, kind: Windows) -> DataFrame:
    """The same for keys with very many regions: a digest of each window, counted."""

    def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {"at": [], "offset": [], "digest": []}
        for k, (n, content) in enumerate(zip(batch.column("n").to_pylist(),
                                             batch.column("content").to_pylist())):
            width = np.dtype(kind.dtype).itemsize
            out["at"] += [k] * n
            out["offset"] += range(n)
            out["digest"] += [xxhash.xxh3_128_digest(content[a * width:(a + kind.length) * width])
                              for a in range(n)]
        at = pa.array(out["at"], pa.int64())
        return pa.RecordBatch.from_pydict({
            **{name: batch.column(name).take(at) for name in ("key", "region", "copies", "doc_id", "start")},
            "offset": pa.array(out["offset"], pa.int32()), "digest": pa.array(out["digest"], pa.binary())})

    windows = map_batches(regions, digests, "key long, region long, copies long, doc_id long, "
                                            "start int, offset int, digest binary")
    place = F.struct("doc_id", (F.col("start") + F.col("offset")).alias("place"))
    own = F.xxhash64("region", "offset")  # the same for repeated rows of one document
    total = windows.groupBy("digest").agg(
        F.max("copies").alias("copies"), F.min(own).alias("low"), F.max(own).alias("high"), F.min(place).alias("first"))
    again = (windows.withColumn("own", place).drop("copies")
             .join(total.filter("copies > 1 OR low < high").select("digest", "first"), "digest")
             .groupBy("key", "region").agg(
                 F.collect_list("offset").alias("again"),
                 F.collect_list(F.when(F.col("own") != F.col("first"), F.col("offset"))).alias("later")))

    def ranges(batch: pa.RecordBatch) -> pa.RecordBatch:
        flags = []
        for name in ("again", "later"):
            flags.append([np.bincount(x, minlength=1) > 0 if x else np.zeros(1, bool)
                          for x in batch.column(name).to_pylist()])
        return _found_batch(batch.column("key").to_pylist(), batch.column("region").to_pylist(), *flags)

    return map_batches(again, ranges, _FOUND)


def repeated(df: DataFrame, docs: DataFrame, kind: Windows, compare: Compare, keep: str) -> DataFrame:
    """doc_id, row, spans: where ``kind`` windows begin that occur elsewhere too.

    A span holds the places a to b of its first and last-plus-one window. ``keep`` is
    "none" for all copies, or "first" for all but the first by doc_id and place.
    ``docs`` has doc_id, row, text, partitioned by doc_id and row.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep is none or first, not {keep}")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    spark = df.sparkSession
    path = new_path(spark, "runs")
    run_rows(df, kind).write.parquet(path)
    rows = spark.read.parquet(path)
    # Counting moves the keys alone; most occur once and are gone then.
    twice = rows.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key")
    found = materialise(rows.join(twice, "key"), "repeated")
    drop_table(spark, path)  # nothing reads the runs again, and they are most of the disk

    # Each different region once. Places are told apart by a digest, so repeated rows of a
    # document count once; whether there are two places or more is all that matters.
    place = F.struct("doc_id", "start", "row", "n")
    digest = F.xxhash64("doc_id", "row", "start")
    if keep == "first":
        one = [F.min(place).alias("first")]
    else:  # any place will do
        one = [F.struct(*[F.first(c).alias(c) for c in ("doc_id", "start", "row", "n")]).alias("first")]
    classes = found.groupBy("key", "region").agg(
        *one, F.when(F.min(digest) < F.max(digest), 2).otherwise(1).cast("long").alias("copies"))
    classes = materialise(classes, "classes")
    regions = classes.groupBy("key").agg(F.count("*").alias("regions")).filter("regions > 1")
    alone = classes.join(regions, "key", "left_anti").filter("copies > 1")
    differ = classes.join(regions, "key")
    wanted = differ.select("key", "region", "copies", "first.*",
                           (F.col("regions") > MAX_REGIONS).alias("hot"))
    fetched = _regions(docs, wanted, kind)
    results = _compared(fetched.filter("NOT hot"), kind, compare).unionByName(
        _counted(fetched.filter("hot"), kind))
    none = F.array().cast("array<struct<a:int,b:int>>")
    settled = results.join(differ.select("key", "region", "copies", "first"), ["key", "region"]).unionByName(
        alone.select("key", "region", none.alias("again"), none.alias("later"), "copies", "first"))
    if keep == "none":
        settled = settled.select("key", "region", "copies", "again")
        spans = F.when(F.col("copies") > 1, whole).otherwise(F.col("again"))
    else:
        spans = F.when(place != F.col("first"), whole).otherwise(F.col("later"))
    return (found.join(settled, ["key", "region"])
            .select("doc_id", "row", "start", F.explode(spans).alias("span"))
            .groupBy("doc_id", "row").agg(F.collect_set(F.struct(
                (F.col("start") + F.col("span.a")).alias("a"),
                (F.col("start") + F.col("span.b")).alias("b"))).alias("spans")))
