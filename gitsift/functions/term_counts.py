"""Terms of texts counted in Arrow batches: what a document holds, without a row a term.

A text comes as its pieces, joined by line breaks (``ngrams.joined_pieces``). Equal pieces of
a batch are taken apart once; a document is then a list of numbers of terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gitsift import fixed_values as fv

CHUNK_BYTES = 4_000_000  # text that is taken apart at once


def chunks(*columns: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``CHUNK_BYTES`` of text each."""
    ends = np.cumsum(sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                         for c in columns))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield start, stop
        start = stop


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(int(lengths.sum()))


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each value, by first appearance, and where each number is first; hashed, not sorted."""
    number = pa.array(values).dictionary_encode().indices.to_numpy()
    known = np.maximum.accumulate(number)
    return number, np.flatnonzero(np.diff(known, prepend=np.int32(-1)))


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Owner and number of every 3- to 5-gram of the padded words, and the grams."""
    text = "".join([f" {w} " for w in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    letter, alphabet = _numbered(points)
    letter = letter.astype(np.int64)
    place, number = np.arange(len(points)), letter
    owners, numbers, terms = [], [], []
    for n in range(2, fv.CHAR_NGRAMS[1] + 1):
        inside = place + n <= end[place]
        place, number = place[inside], number[inside]
        # A gram is its first part's number and one more letter, so no number is ever large.
        number, first = _numbered(number * np.int64(len(alphabet)) + letter[place + n - 1])
        if n >= fv.CHAR_NGRAMS[0]:
            owners.append(owner[place])
            numbers.append(number + len(terms))
            terms += [text[p:p + n] for p in place[first].tolist()]
    return np.concatenate(owners), np.concatenate(numbers), terms


@dataclass
class Counted:
    """Documents as term numbers: ``terms[number]``, ``times`` each, from ``cuts[i]`` to ``cuts[i + 1]``.

    A number may come several times in a document, once for every different piece that has it.
    """

    terms: list[str]
    number: np.ndarray
    times: np.ndarray
    cuts: np.ndarray


def counted(texts: pa.Array, analyzer: str, place: dict[str, int] | None = None) -> Counted:
    """Term counts of each text; ``word`` pieces are terms, ``char`` pieces have theirs inside.

    With ``place`` numbers are places, and other terms are left out before documents are spelled out.
    """
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    encoded = lists.flatten().dictionary_encode()
    words = encoded.dictionary.to_pylist()
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    pair, times = np.unique(row * max(1, len(words)) + encoded.indices.to_numpy(zero_copy_only=False),
                            return_counts=True)
    row, word = np.divmod(pair, max(1, len(words)))
    if analyzer == "word":
        terms, inner, owner = words, np.arange(len(words)), np.arange(len(words))
        kept = np.fromiter(map(len, words), np.int64, len(words)) > 0
    else:
        owner, inner, terms = _grams(words)
        kept = np.ones(len(owner), bool)
    if place is not None:
        inner = np.fromiter((place.get(t, -1) for t in terms), np.int64, len(terms))[inner]
        kept &= inner >= 0
    owner, inner = owner[kept], inner[kept]
    order = np.argsort(owner, kind="stable")
    inner, sizes = inner[order].astype(np.int32), np.bincount(owner, minlength=len(words))
    first = np.cumsum(sizes) - sizes
    ends = np.concatenate(([0], np.cumsum(sizes[word])))
    return Counted(terms, inner[runs(first[word], sizes[word])], np.repeat(times.astype(np.float64), sizes[word]),
                   ends[np.searchsorted(row, np.arange(len(texts) + 1))])


def statistics(texts: pa.Array, analyzer: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Terms of these texts with their corpus count and document frequency."""
    c = counted(texts, analyzer)
    total = np.bincount(c.number, c.times, len(c.terms)).astype(np.int64)
    frequency, stamp = np.zeros(len(c.terms), np.int64), np.zeros(len(c.terms), np.int64)
    for a, b in zip(c.cuts[:-1].tolist(), c.cuts[1:].tolist()):
        number, order = c.number[a:b], np.arange(b - a)
        stamp[number] = order  # the last copy of a number keeps its place
        frequency[number[stamp[number] == order]] += 1
    held = np.flatnonzero(frequency)
    return [c.terms[i] for i in held.tolist()], total[held], frequency[held]


@dataclass
class Vocabulary:
    """Terms of one block with index and idf, sent to tasks; bounded by the vocabulary's cap."""

    analyzer: str
    place: dict[str, int]
    idx: np.ndarray
    idf: np.ndarray

    def counts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text the places of its known terms, ascending, and how often it has each."""
        c = counted(texts, self.analyzer, self.place)
        for a, b in zip(c.cuts[:-1].tolist(), c.cuts[1:].tolist()):
            tf = np.bincount(c.number[a:b], c.times[a:b], len(self.idx))
            mine = np.flatnonzero(tf > 0)  # terms lie in the order of their indices
            yield mine, tf[mine]

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text its known terms' indices, ascending, and weights of unit length."""
        out = []
        for mine, tf in self.counts(texts):
            w = (1 + np.log(tf)) * self.idf[mine]
            out.append((self.idx[mine], w / np.sqrt(np.dot(w, w))))
        return out

    def coded(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The same in two or three bytes a term: steps from place to place, and counts."""
        steps, counts = [], []
        for mine, tf in self.counts(texts):
            steps.append(np.diff(mine, prepend=0).astype(_step_type(len(self.idx))).tobytes())
            counts.append(tf.astype(np.uint8 if tf.max(initial=0) < 256 else np.uint32).tobytes())
        return pa.array(steps, pa.binary()), pa.array(counts, pa.binary())


def _step_type(places: int) -> type:
    return np.uint16 if places <= 1 << 16 else np.uint32


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each value begins and the last one ends."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    return (np.frombuffer(held, np.uint8) if held else np.empty(0, np.uint8))[ends[0]:ends[-1]], ends - ends[0]


def decoded(steps: pa.Array, counts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many terms each text of ``Vocabulary.coded`` has, their places, and weights of unit length."""
    kind = np.dtype(_step_type(len(idf)))
    held, ends = _bytes(steps)
    lengths = np.diff(ends).astype(np.int64) // kind.itemsize
    place = np.cumsum(held.view(kind) if len(held) else np.empty(0, kind), dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    place -= np.repeat(np.concatenate(([0], place))[first], lengths)
    held, ends = _bytes(counts)
    if len(held) != len(place):  # counts of some texts take four bytes
        each = [held[a:b] if b - a == n else np.frombuffer(held[a:b].tobytes(), np.uint32)
                for a, b, n in zip(ends[:-1].tolist(), ends[1:].tolist(), lengths.tolist())]
        held = np.concatenate(each)
    weight = (1 + np.log(held.astype(np.float64))) * idf[place]
    each = np.split(weight, first[1:]) if len(first) else []
    size = np.fromiter((np.dot(w, w) for w in each), np.float64, len(each))
    return lengths, place.astype(np.int32), weight / np.repeat(np.sqrt(size), lengths)
