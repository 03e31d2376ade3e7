"""Benchmark decontamination by the q-gram lemma in overlapping diagonal bands.

Both sides are lowered and their white space made single spaces. Items are cut into
overlapping passages of ``PASSAGE`` characters, half a passage apart, the last one at the
item's end; shorter items are one passage. A passage counts as found in a document if some
region of it is within k edits, and an item if one of its passages is, so a leaked half of
a long item is found.

The lemma is counted on q-grams that do not overlap: of the ``m // q`` ones of a passage an
edit spoils at most one, so a region within k edits shares at least ``m // q - k`` of them,
all on k + 1 neighbouring diagonals (place in the document minus place in the passage).
Hits are counted per passage and band of diagonals; bands overlap by half, so that one of
them holds all. Of the places the grams may start at, the ones that fewest passages share
are taken. Bands that reach the bound are verified by a banded alignment in bit vectors,
64 diagonals in a word and many bands at a time, so phrases that many items share cost
microseconds an item.

A passage of m characters may have ``min(int(EDIT_RATE * m), m // Q - 1)`` edits: none below
12 characters, 1 from 12 to 17, 2 from 18, 3 from 25, and so on to 7 at 64.

The passages go to all tasks in shards of at most ``SHARD_CHARS`` expected characters of
items, a pass over the documents for each; a benchmark that fits into one shard costs one
pass. Texts are not shuffled.

* null or empty texts and items: found nowhere, hold nothing. Items shorter than a q-gram
  are looked for letter by letter. An empty table on either side: nothing is found.
* repeated rows and null doc_ids: every row is searched for itself; equal rows give equal
  results. Repeated items are found each under its item_id.
* ties: of several regions the one with fewest edits is given, then the first.
* very long texts are searched whole, very long items by all their passages. Further
  columns, whatever their names, pass through ``keep_clean`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import map_batches, texts_of
from gitsift.llm.windows import mixed

Q = 6
#: Edits allowed, as a part of a passage's characters.
EDIT_RATE = 0.12
#: Characters of a passage.
PASSAGE = 64
#: Characters of items that are held by every task at a time.
SHARD_CHARS = 4 << 20
#: Characters of documents that are searched together.
GROUP_CHARS = 1 << 20
#: Shared q-grams that are counted at a time, and bands that are aligned at a time.
HITS_AT_ONCE, BANDS_AT_ONCE = 1 << 22, 1 << 12

#: Diagonals that an alignment walks: the bits of a word.
DIAGONALS = 64
#: Between two texts, so wide that no alignment sees both, of a symbol that no text has.
WALL = np.full(2 * (DIAGONALS + PASSAGE), 1 << 21, dtype=np.uint32)
_FILTER_BITS = 22
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: bytes) -> str:
    return " ".join(text.decode().lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def gram_keys(symbols: np.ndarray, q: int, at_once: int = 1 << 15) -> np.ndarray:
    """A 64-bit digest of the ``q`` symbols from each place, in parts that caches hold."""
    n = max(0, len(symbols) - q + 1)
    out = np.empty(n, np.uint64)
    with np.errstate(over="ignore"):
        for begin in range(0, n, at_once):
            part = out[begin:begin + at_once]
            scrambled = mixed(symbols[begin:begin + len(part) + q - 1].astype(np.uint64) + _FACTOR)
            part[:] = scrambled[:len(part)]
            for k in range(1, q):
                part *= _FACTOR
                part += scrambled[k:len(part) + k]
            part[:] = mixed(part)
    return out


def sorted_set(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values in order, and how often each is there."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else values
    return values[first], np.diff(np.concatenate((first, [len(values)])))


def banded_edits(items: np.ndarray, regions: np.ndarray, begin: int | None = None):
    """Edits of each row of ``items`` against regions that end on each of 64 diagonals.

    ``regions`` has 63 symbols more than ``items``: item symbol i meets region symbols i to
    i + 63. A match may begin on any diagonal, or on ``begin`` alone, where the others cost
    their distance from it. The result has a column per diagonal. A word holds the
    differences between neighbouring diagonals of all cells of a row, so a step takes a few
    operations on words.
    """
    rows, size = items.shape
    plus, minus, one = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64), np.uint64(1)
    first = np.zeros(rows, np.int64)
    if begin is not None:
        first += begin
        minus += np.uint64((1 << begin) - 1)
        plus = ~minus
    with np.errstate(over="ignore"):
        for i in range(size):
            equal = regions[:, i:i + DIAGONALS] == items[:, i:i + 1]
            same = np.packbits(equal, axis=1, bitorder="little").view("<u8")[:, 0]
            kept = (((same & plus) + plus) ^ plus) | same | minus  # no dearer than the cell before
            first += 1 - (kept & one).astype(np.int64)
            more, less, upper = minus | ~(kept | plus), kept & plus, kept >> one
            plus, minus = less | ~(upper | more), upper & more
    steps = [np.unpackbits(np.ascontiguousarray(w).view(np.uint8).reshape(rows, 8), axis=1, bitorder="little")
             for w in (plus, minus)]
    rest = np.cumsum(steps[0].astype(np.int64) - steps[1], axis=1)[:, :DIAGONALS - 1]
    return np.concatenate((first[:, None], first[:, None] + rest), axis=1)


def passages(text: str) -> list[tuple[int, int]]:
    """Starts and ends of the passages of an item."""
    if len(text) <= PASSAGE:
        return [(0, len(text))]
    starts = list(range(0, len(text) - PASSAGE, PASSAGE // 2)) + [len(text) - PASSAGE]
    return [(a, a + PASSAGE) for a in starts]


def edit_budget(size: int, q: int = Q, edit_rate: float = EDIT_RATE) -> int:
    """Edits that a passage of ``size`` characters may have."""
    return max(0, min(int(edit_rate * size), size // q - 1))


@dataclass
class Items:
    """Passages of benchmark items as the tasks need them."""

    ids: list[int | None]
    texts: list[str]
    q: int = Q
    edit_rate: float = EDIT_RATE
    item: np.ndarray = field(init=False)
    sizes: np.ndarray = field(init=False)
    edits: np.ndarray = field(init=False)

    def __post_init__(self):
        cut = [(k, a, b) for k, t in enumerate(self.texts) for a, b in passages(t)]
        self.item = np.array([k for k, _, _ in cut], dtype=np.int64)
        self.sizes = np.array([b - a for _, a, b in cut], dtype=np.int64)
        self.edits = np.array([edit_budget(b - a, self.q, self.edit_rate) for _, a, b in cut], dtype=np.int64)
        self.least = np.maximum(1, self.sizes // self.q - self.edits)
        self.band = int(self.edits.max(initial=0)) + 1
        if 4 * self.band > DIAGONALS:
            raise ValueError(f"edit_rate allows {self.band - 1} edits in a passage; an alignment holds 15")
        self.codes = np.zeros((len(cut), PASSAGE), dtype=np.uint32)
        for row, (k, a, b) in enumerate(cut):
            self.codes[row, :b - a] = code_points(self.texts[k][a:b])

    def __getstate__(self):
        return {"ids": self.ids, "texts": self.texts, "q": self.q, "edit_rate": self.edit_rate}

    def __setstate__(self, state):
        self.__init__(**state)

    @cached_property
    def index(self):
        """Different q-grams in order, where the passages and places of each begin, and a table
        that most other q-grams fail."""
        q = self.q
        grams = [gram_keys(c[:n], q) for c, n in zip(self.codes, self.sizes)]
        every = np.concatenate([np.empty(0, np.uint64), *grams])
        _, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
        shared = np.split(count[inverse], np.cumsum([len(g) for g in grams])[:-1]) if grams else []
        places = []
        for g, common, size in zip(grams, shared, self.sizes):
            choices = [np.arange(r, size - q + 1, q) for r in range(size % q + 1)] if len(g) else [np.arange(0)]
            places.append(min(choices, key=lambda at: common[at].sum()))
        key = np.concatenate([np.empty(0, np.uint64), *(g[at] for g, at in zip(grams, places))])
        passage = np.repeat(np.arange(len(places)), [len(at) for at in places])
        place = np.concatenate([np.empty(0, np.int64), *places])
        order = np.argsort(key, kind="stable")
        table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        table[key >> np.uint64(64 - _FILTER_BITS)] = True
        different, many = sorted_set(key)
        return different, np.cumsum(many) - many, many, passage[order], place[order], table

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """(text number, item number, start, end, edits, passages found) of each pair found.

        Start, end and edits are those of the best passage.
        """
        joined = np.concatenate([WALL, *(part for t in texts for part in (code_points(t), WALL))])
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        begins = len(WALL) + np.cumsum(np.concatenate(([0], sizes + len(WALL))))[:-1]
        found: dict[tuple[int, int], tuple[set[int], tuple[int, int, int]]] = {}

        def note(text: int, passage: int, region: tuple[int, int, int]) -> None:
            seen, best = found.get((text, int(self.item[passage])), (set(), region))
            seen.add(passage)
            found[text, int(self.item[passage])] = seen, min(best, region)

        for passage in np.flatnonzero((self.sizes > 0) & (self.sizes < self.q)).tolist():
            short = self.texts[self.item[passage]]
            for k, text in enumerate(texts):
                if (at := text.find(short)) >= 0:
                    note(k, passage, (0, at, at + len(short)))
        passage, low = self._bands(joined)
        for size in np.unique(self.sizes[passage]).tolist():
            chosen = np.flatnonzero(self.sizes[passage] == size)
            for k in range(0, len(chosen), BANDS_AT_ONCE):
                part = chosen[k:k + BANDS_AT_ONCE]
                rows, edits, start, end = self._align(joined, passage[part], low[part], size)
                text = np.searchsorted(begins, end - 1, side="right") - 1
                start = np.maximum(start - begins[text], 0)
                end = np.minimum(end - begins[text], sizes[text])
                for row in zip(text.tolist(), rows.tolist(), edits.tolist(), start.tolist(), end.tolist()):
                    note(row[0], row[1], row[2:])
        return [(text, item, start, end, edits, len(seen))
                for (text, item), (seen, (edits, start, end)) in sorted(found.items())]

    def _bands(self, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages and first diagonals of the bands that hold enough shared q-grams."""
        key, begins, counts, of_passage, places, table = self.index
        if not len(key):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        grams = gram_keys(joined, self.q)
        at = np.flatnonzero(table[grams >> np.uint64(64 - _FILTER_BITS)])
        grams = grams[at]
        rank = np.minimum(np.searchsorted(key, grams), len(key) - 1)
        hits = key[rank] == grams
        at, first, many = at[hits], begins[rank[hits]], counts[rank[hits]]
        total, reach, stride = np.cumsum(many), PASSAGE + 2 * self.band, len(joined) // self.band + 2
        out, low = [np.empty(0, np.int64)], 0
        while low < len(at):
            # As many places as give a bounded number of hits. What a band counts lies within
            # ``reach`` places, so parts that overlap by that lose no band.
            high = max(int(np.searchsorted(total, total[low] - many[low] + HITS_AT_ONCE, side="right")),
                       int(np.searchsorted(at, at[low] + 4 * reach)))
            n = many[low:high]
            rows = np.repeat(np.arange(low, min(high, len(at))), n)
            hit = first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            band = of_passage[hit] * stride + (at[rows] - places[hit]) // self.band
            band, count = sorted_set(np.concatenate((band, band - 1)))
            out.append(band[count >= self.least[band // stride]])
            if high >= len(at):
                break
            low = int(np.searchsorted(at, at[high] - reach))
        # Neighbouring bands that one alignment covers are aligned once.
        side = (DIAGONALS - 4 * self.band + 2) // self.band + 1
        band = np.concatenate(out)
        wide, _ = sorted_set(band // stride * stride + band % stride // side)
        return wide // stride, wide % stride * side * self.band

    def _align(self, joined: np.ndarray, passage: np.ndarray, low: np.ndarray, size: int):
        """Passages found in their bands, with edits, start and end in ``joined``."""
        items, span = self.codes[passage, :size], np.arange(size + DIAGONALS - 1)
        most = int(self.edits[passage].max())
        low = low - most
        edits = banded_edits(items, joined[low[:, None] + span])
        best = edits.argmin(axis=1)
        edits = edits[np.arange(len(best)), best]
        good = edits <= most
        passage, items, edits, end = passage[good], items[good], edits[good], (low + size + best)[good]
        # The start: the same alignment from behind, which begins at the end just found.
        back = banded_edits(items[:, ::-1], joined[end[:, None] - 1 + most - span], most)
        length = size - most + (back == edits[:, None]).argmax(axis=1)
        return passage, edits, end - length, end


def shards(benchmark: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE,
           shard_chars: int = SHARD_CHARS) -> list[Items]:
    """The items in parts of bounded size, by a hash of id and text."""
    kept = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    total = kept.agg(F.sum(F.char_length("text"))).first()[0] or 0
    number = -(-total // shard_chars)
    out = []
    for k in range(number):
        rows = kept.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k).collect()
        pairs = sorted(((r.item_id, normalised(r.text.encode())) for r in rows),
                       key=lambda p: (p[0] is None, p[0] or 0, p[1]))
        pairs = [p for p in pairs if p[1]]
        out.append(Items([p[0] for p in pairs], [p[1] for p in pairs], q, edit_rate))
    return out


def _groups(texts: list[bytes]):
    """(number of the first, normalised texts) of some texts at a time."""
    group: list[str] = []
    first = size = 0
    for k, text in enumerate(texts):
        if group and size + len(text) > GROUP_CHARS:
            yield first, group
            first, group, size = k, [], 0
        group.append(normalised(text))
        size += len(text)
    if group:
        yield first, group


def find(df: DataFrame, benchmark: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE) -> DataFrame:
    """doc_id, item_id, start, end, edits, n_found: a row for each item found in a document.

    Start and end of the best passage are characters of the normalised text; n_found are the
    item's passages that the document holds.
    """
    schema = "doc_id long, item_id long, start long, end long, edits long, n_found long"
    out = df.sparkSession.createDataFrame([], schema)
    for items in shards(benchmark, q, edit_rate):
        sent = df.sparkSession.sparkContext.broadcast(items)

        def run(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            held, ids = sent.value, batch.column("doc_id")
            rows = [(first + text, *rest) for first, group in _groups(texts_of(batch))
                    for text, *rest in held.search(group)]
            columns = list(zip(*rows)) or [()] * 6
            return pa.RecordBatch.from_pydict({
                "doc_id": ids.take(pa.array(columns[0], pa.int64())),
                "item_id": pa.array([held.ids[k] for k in columns[1]], pa.int64()),
                "start": pa.array(columns[2], pa.int64()), "end": pa.array(columns[3], pa.int64()),
                "edits": pa.array(columns[4], pa.int64()),
                "n_found": pa.array(columns[5], pa.int64())})

        out = out.unionByName(map_batches(df.select("doc_id", "text"), run, schema))
    return out


def keep_clean(df: DataFrame, benchmark: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE) -> DataFrame:
    """The rows in which no item is found, with all their columns; nothing is shuffled."""
    for items in shards(benchmark, q, edit_rate):
        sent = df.sparkSession.sparkContext.broadcast(items)

        def run(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            clean = np.ones(batch.num_rows, dtype=bool)
            for first, group in _groups(texts_of(batch)):
                clean[[first + text for text, *_ in sent.value.search(group)]] = False
            return batch.filter(pa.array(clean))

        df = map_batches(df, run, df.schema)
    return df
