"""Substring dedup by suffix automata of reference shards.

The reference is the corpus itself, so sending every shard's automaton to every document
would compare all with all. ``windows`` routes instead: a reference shard is the set of
different regions under some keys, each once, and what is streamed through its automaton
are the regions of documents with the same keys. No other document can hold a window of
the shard. The automaton counts the occurrences of each state and knows the first one;
streaming gives, word by word, the state of the window that ends there (its matching
statistic, cut at the window's length), and so whether the window occurs elsewhere.

* ``keep="first"`` removes later copies, ``keep="none"`` all of them.
* words are compared by 64-bit digests; 35 would have to collide in a row to matter.
* null text: no words, nothing removed. Texts shorter than a window lose nothing.
* rows without doc_id lose nothing and are no copy of anything; repeated rows of one
  document are one document, each of them comes back.
* matches never cross documents. Very long texts are taken whole. Further columns,
  whatever their names, are not looked at.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import covered, map_batches, sha256_hex, spans_of, text_key
from gitsift.llm.windows import Windows, repeated

LENGTH = 35
GRAM = 8
#: Words of a shard: its automaton has at most twice as many states.
SHARD_WORDS = 1 << 15


class SuffixAutomaton:
    """All substrings of some word sequences, with how often and where first each occurs."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count, self.first = [-1], [0], [0], [1 << 62]

    def _state(self, moves: dict[int, int], length: int, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        self.first.append(1 << 62)
        return len(self.link) - 1

    def _split(self, state: int, word: int, old: int) -> int:
        """A state of its own for the strings of ``old`` that are no longer than needed."""
        new = self._state(dict(self.next[old]), self.length[state] + 1, self.link[old])
        self.link[old] = new
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]
        return new

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state({}, self.length[last] + 1, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            known = self.next[state][word]
            if self.length[known] != self.length[state] + 1:
                known = self._split(state, word, known)
            self.link[new] = known
        return new

    def add(self, words: list[int], copies: int, place: int) -> None:
        """Adds a sequence that occurs ``copies`` times, the first time from ``place`` on."""
        last = 0
        for at, word in enumerate(words, place):
            last = self._extend(last, word)
            self.count[last] += copies
            if at < self.first[last]:
                self.first[last] = at

    def finish(self) -> None:
        """Hands counts and first places on to the suffixes."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            link = self.link[state]
            self.count[link] += self.count[state]
            if self.first[state] < self.first[link]:
                self.first[link] = self.first[state]

    def windows(self, words: list[int], length: int, place: int) -> tuple[list[bool], list[bool]]:
        """For each window of a sequence: occurs more than once, and occurs before this place."""
        again, earlier, state, have = [], [], 0, 0
        moves, link, longest = self.next, self.link, self.length
        for at, word in enumerate(words, place):
            state = moves[state][word]
            have += 1
            if have >= length:
                have = length
                while longest[link[state]] >= length:
                    state = link[state]
                again.append(self.count[state] > 1)
                earlier.append(self.first[state] < at)
        return again, earlier


def compare(contents: list[np.ndarray], windows: np.ndarray, copies: np.ndarray,
            kind: Windows) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Which windows of each region occur again, and which in an earlier region."""
    sizes = [len(c) for c in contents]
    _, ids = np.unique(np.concatenate(contents), return_inverse=True)
    ends = np.cumsum(sizes)
    sequences = [ids[end - size:end].tolist() for end, size in zip(ends, sizes)]
    automaton = SuffixAutomaton()
    places = (ends - sizes).tolist()
    for words, many, place in zip(sequences, copies.tolist(), places):
        automaton.add(words, many, place)
    automaton.finish()
    again, later = [], []
    for words, place in zip(sequences, places):
        found, before = automaton.windows(words, kind.length, place)
        again.append(np.array(found, dtype=bool))
        later.append(np.array(before, dtype=bool))
    return again, later


def _digests(text: bytes) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(word) for word in text.split()], dtype=np.uint64)


def word_windows(length: int = LENGTH, gram: int = GRAM) -> Windows:
    return Windows(length, gram, _digests, "u8", SHARD_WORDS * 8)


def remove_substrings(df: DataFrame, length: int = LENGTH, keep: str = "first",
                      gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed runs of words), kept (words joined by a space), kept_sha256."""
    kind = word_windows(length, gram)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select("doc_id", text_key(F.col("text")).alias("row"), "text")
    # Used twice, to fetch regions and to cut texts: Spark shuffles the texts once.
    placed = docs.repartition(tasks, "doc_id", "row")
    found = repeated(df, placed, kind, compare, keep)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, spans, kept, digests = [], [], [], [], []
        for text, places in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                                batch.column("spans").to_pylist()):
            words, places = (text or b"").split(), places or []
            a = np.array([p["a"] for p in places], dtype=np.int64)
            b = np.array([p["b"] for p in places], dtype=np.int64)
            flags = covered(len(words), a, b + length - 1)
            starts, ends = (x.tolist() for x in spans_of(flags))
            rest = b" ".join(compress(words, (~flags).tolist()))
            sizes.append(len(words))
            removed.append(int(flags.sum()))
            spans.append([{"a": x, "b": y} for x, y in zip(starts, ends)])
            kept.append(rest.decode())
            digests.append(sha256_hex(rest))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
            "kept": pa.array(kept, pa.string()), "kept_sha256": pa.array(digests, pa.string())})

    joined = placed.join(found, ["doc_id", "row"], "left").select("doc_id", "text", "spans")
    return map_batches(joined, run, "doc_id long, n_words long, n_removed long, "
                                    "spans array<struct<a:long,b:long>>, kept string, kept_sha256 string")
