"""Quality rules by suffix-array repetition.

The words of some documents form one integer sequence. Its suffix order and longest
common prefixes come from prefix doubling in NumPy; a document's number leads every
sort key, so documents never share anything. Intervals of the common-prefix array are
the maximal repeated substrings: the union of their places is what a document repeats
of itself, and the deepest interval is its longest repeat. Both are limited.

* null text: no words, ``base_failed``. Very long texts are never cut.
* repeated rows, null or equal doc_ids: every row is judged for itself.
* further columns of the input, whatever their names, pass through ``keep`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gitsift.llm.common import covered, slices, texts_of

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"

#: Shortest repeated substring that counts, in words.
MIN_REPEAT = 5
#: Largest part of the words that repeated substrings may cover.
MAX_COVERED = 0.3
#: The longest repeat may be this part of the words, or ``FREE_REPEAT`` words if more.
MAX_LONGEST = 0.2
FREE_REPEAT = 60
#: Bytes of text whose suffixes are sorted together; one longer text goes alone.
GROUP_BYTES = 2 << 20

SPACES = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))

STATISTICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, longest_repeat long, covered_words long")


def suffix_array(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and the symbols each suffix shares with the one before it.

    ``owner`` numbers the documents in place order; suffixes end with their document
    and only neighbours of one document share anything. Prefix doubling: a suffix's
    rank is the first place of all that begin with the same 1, 2, 4, ... symbols, so
    only what still shares its rank is sorted again. The ranks of all widths are
    kept, and common prefixes are read off them from the widest down.
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    end = np.searchsorted(owner, owner, side="right")
    rank = np.empty(n, np.int64)
    keys = owner * (int(symbols.max()) + 1) + symbols
    places = np.arange(n)
    order = np.argsort(keys, kind="stable")
    moving, moved_keys = order, keys[order]
    levels, width = [], 1
    while True:
        new = np.ones(len(moving), dtype=bool)
        new[1:] = moved_keys[1:] != moved_keys[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(moving)), 0))
        rank[moving] = places[first]
        levels.append(rank.copy())
        shared = ~new
        shared[:-1] |= ~new[1:]
        if not shared.any():
            break
        places = places[shared]
        moving = order[places]
        ahead = moving + width
        second = np.where(ahead < end[moving], rank[np.minimum(ahead, n - 1)] + 1, 0)
        moved_keys = rank[moving] * (n + 1) + second
        by = np.argsort(moved_keys, kind="stable")
        moving, moved_keys = moving[by], moved_keys[by]
        order[places] = moving
        width *= 2
    shares = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    left_end, right_end = end[left], end[right]
    same = owner[left] == owner[right]
    for level in range(len(levels) - 1, -1, -1):
        width = 1 << level
        at = np.flatnonzero(same & (left + width <= left_end) & (right + width <= right_end))
        at = at[levels[level][left[at]] == levels[level][right[at]]]
        shares[at + 1] += width
        left[at] += width
        right[at] += width
    return order, shares


def repeat_lengths(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each place, the longest substring from there that its document has elsewhere too.

    It is the depth of the deepest common-prefix interval that holds the suffix.
    """
    order, shares = suffix_array(symbols, owner)
    deepest = shares.copy()
    deepest[:-1] = np.maximum(shares[:-1], shares[1:])
    out = np.empty(len(order), np.int64)
    out[order] = deepest
    return out


def _group_statistics(texts: list[bytes]) -> np.ndarray:
    """One row of statistics per text."""
    out = np.zeros((len(texts), 7), dtype=np.int64)
    ids: dict[bytes, int] = {}
    symbols: list[int] = []
    for k, text in enumerate(texts):
        words = text.split()  # bytes split at exactly the white space of the contract
        symbols += [ids.setdefault(word, len(ids)) for word in words]
        letters = text.translate(None, SPACES)
        lines = [line for line in text.split(b"\n") if line.strip()]
        out[k, :4] = (len(words), len(letters.translate(None, _CONTINUATION)),
                      len(letters) - len(letters.translate(None, SYMBOLS)),
                      len(lines) - len(set(lines)))
    if not symbols:
        return out
    owner = np.repeat(np.arange(len(texts)), out[:, 0])
    lengths = repeat_lengths(np.array(symbols, dtype=np.int64), owner)
    starts = np.flatnonzero(lengths >= WINDOW)
    windows = covered(len(owner), starts, starts + WINDOW)
    starts = np.flatnonzero(lengths >= MIN_REPEAT)
    repeats = covered(len(owner), starts, starts + lengths[starts])
    out[:, 4] = np.bincount(owner[windows], minlength=len(texts))
    np.maximum.at(out[:, 5], owner, lengths)
    out[:, 6] = np.bincount(owner[repeats], minlength=len(texts))
    return out


def document_statistics(texts: list[bytes]) -> np.ndarray:
    """The columns of ``STATISTICS`` for each text."""
    parts, group, size = [np.zeros((0, 7), np.int64)], [], 0
    for text in texts:
        if group and size + len(text) > GROUP_BYTES:
            parts.append(_group_statistics(group))
            group, size = [], 0
        group.append(text)
        size += len(text)
    return np.concatenate([*parts, _group_statistics(group)])


def verdicts(found: np.ndarray, max_covered: float, max_longest: float) -> tuple[np.ndarray, np.ndarray]:
    """``base_failed`` and ``kept`` for rows of statistics."""
    words, repeat_words, longest, spans = found[:, 0], found[:, 4], found[:, 5], found[:, 6]
    failed = (words < MIN_WORDS) | (100 * repeat_words > MAX_REPEATED_PERCENT * words)
    repeats = (spans > max_covered * words) | (
        longest > np.maximum(FREE_REPEAT, max_longest * words))
    return failed, ~failed & ~repeats


def score(df: DataFrame, max_covered: float = MAX_COVERED,
          max_longest: float = MAX_LONGEST) -> DataFrame:
    """doc_id, the statistics, base_failed and kept of every row."""
    names = [part.split()[0] for part in STATISTICS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            found = document_statistics(texts_of(batch))
            failed, kept = verdicts(found, max_covered, max_longest)
            columns = {"doc_id": batch.column("doc_id")}
            columns |= {name: pa.array(found[:, k]) for k, name in enumerate(names)}
            yield pa.RecordBatch.from_pydict(
                columns | {"base_failed": pa.array(failed), "kept": pa.array(kept)})

    return df.select("doc_id", "text").mapInArrow(
        run, f"doc_id long, {STATISTICS}, base_failed boolean, kept boolean")


def keep(df: DataFrame, max_covered: float = MAX_COVERED,
         max_longest: float = MAX_LONGEST) -> DataFrame:
    """The rows that pass, with all their columns; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            _, kept = verdicts(document_statistics(texts_of(batch)), max_covered, max_longest)
            yield batch.filter(pa.array(kept, pa.bool_()))

    return df.mapInArrow(run, df.schema)
