"""Best-fit packing of token pieces into sequences, by bin completion.

Documents become tokens in the tasks; what is longer than a sequence is cut, and every
piece is written once with its length. How pieces combine depends on lengths alone, so the
packing is found for the histogram of lengths, whose size is bounded by the capacity (2,048
counts) and not by the data, and the tasks then look up where each piece belongs.

The search over the histogram is bin completion: take the largest piece that is left,
enumerate the undominated fillings around it, the least wasteful first, and branch. A
filling is dominated if some of its pieces together could give way to one larger piece
that is still there. A filling is applied as often as the counts allow, or, as another
branch, once; so the tree does not get deeper with more documents, and is still complete.
A branch is cut when its waste so far, plus a bound on the waste of what is left, allows no
packing with fewer sequences than the incumbent. The first incumbent is best fit in
descending order; the search stops at the lower bound, where the packing is optimal, or
after ``NODES`` branches or ``LOOKS`` times as many fillings, where the best incumbent stands.

* null text is empty. An empty document is its end token alone. Very long texts are cut
  into full pieces and a rest; a full piece is a sequence of its own.
* repeated rows are documents like others. Rows are told apart by where they were written,
  so a null or repeated doc_id changes nothing.
* ties: among equally wasteful fillings, the one with larger pieces first; pieces of one
  length are interchangeable and go in the order in which they were written.
* an empty table gives no rows. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gitsift.llm.bpe import Remembered, byte_characters
from gitsift.llm.common import texts_of
from gitsift.session import materialise, measured

CAPACITY = 2048
#: Branches of the search, and fillings looked at for each; the incumbent stands when either is used up.
NODES = 3_000
LOOKS = 10
#: A tokenizer file up to this size is sent to the tasks.
MAX_TOKENIZER_BYTES = 64 << 20
#: Distinct words, and letters of words, whose ids a worker remembers, young and old.
CACHE_WORDS = 1 << 17
CACHE_PARTS = 1 << 18
#: Letters of ASCII or Latin-1, then marks other than the apostrophe that begins a contraction.
_LETTERS_MARKS = re.compile(
    rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")
# The normaliser and the splitter of a tokenizer whose texts may be taken word by word.
_STEPS = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {
            "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
)

#: Pieces of a sequence as (length, how many), largest first, and how many sequences are so.
Filling = tuple[tuple[int, int], ...]
Packing = list[tuple[Filling, int]]


# --- the search over lengths ------------------------------------------------------------


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Packing:
    """Best fit of pieces in descending order, all equal sequences at once."""
    by_room: dict[int, list[tuple[Filling, int]]] = {}
    rooms = 0  # bit r is set if sequences with room r exist
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                filling, times = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, filling, times = capacity, (), left
            each = min(room // length, left)
            used = min(times, left // each)
            for amount, n, to in ((each, used, room - each * length), (0, times - used, room)):
                if n and (amount or filling):
                    with_more = (*filling, (length, amount)) if amount else filling
                    by_room.setdefault(to, []).append((with_more, n))
                    rooms |= 1 << to
            left -= each * used
    return [x for some in by_room.values() for x in some]


def fewest(packing: Packing) -> int:
    return sum(times for _, times in packing)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: pieces that exclude each other, and total length.

    For every k: pieces over capacity - k share with none of k or more; those over half of
    the capacity share with none of their kind, only with pieces of at least k.
    """
    lengths = np.arange(capacity + 1)
    n_from = np.concatenate((np.cumsum(counts[::-1])[::-1], [0]))  # pieces of length >= i
    sum_from = np.concatenate((np.cumsum((counts * lengths)[::-1])[::-1], [0]))
    half = capacity // 2
    k = np.arange(0, half + 1)
    alone = n_from[capacity - k + 1]
    large = n_from[half + 1] - alone
    room = large * capacity - (sum_from[half + 1] - sum_from[capacity - k + 1])
    small = sum_from[k] - sum_from[half + 1]
    return int((alone + large + np.maximum(0, -(-(small - room) // capacity))).max())


def _reach(counts: np.ndarray, room: int) -> tuple[list[int], list[int]]:
    """Lengths that are left, ascending, and the sums (as bits) that those up to each can make."""
    lengths, sums, bits, most = [], [], 1, (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[:room + 1]).tolist():
        left, step = min(int(counts[length]), room // length), 1
        while left:
            step = min(step, left)
            bits |= (bits << (step * length)) & most
            left, step = left - step, 2 * step
        lengths.append(length)
        sums.append(bits)
    return lengths, sums


def _is_dominated(chosen: Filling, counts: np.ndarray, others: int, waste: int) -> bool:
    """Whether some of the pieces could give way to one larger piece that is left.

    ``others`` has a bit for every length that is left.
    """
    sums, several = 1, 0
    for length, n in chosen:
        if counts[length] == n:
            others &= ~(1 << length)
        for _ in range(n):
            several |= (sums & ~1) << length
            sums |= sums << length
    if others & several:  # two or more together make exactly one that is left
        return True
    shifted, width = sums << 1, 1
    while width < waste:  # shifts by 1 to waste
        step = min(width, waste - width)
        shifted |= shifted << step
        width += step
    return bool(waste and others & shifted)


def fillings(counts: np.ndarray, largest: int, capacity: int, max_waste: int,
             ) -> Iterator[tuple[Filling | None, int]]:
    """Undominated fillings around one piece of the largest length, and their waste, least first.

    ``counts`` no longer holds that piece. A dominated filling is given as None, so that the
    caller can count what has been looked at.
    """
    room = capacity - largest
    lengths, sums = _reach(counts, room)
    reachable = sums[-1] if sums else 1
    left = sum(1 << length for length in lengths)

    def exactly(total: int, upto: int) -> Iterator[Filling]:
        if not total:
            yield ()
            return
        for i in range(upto, -1, -1):
            if not sums[i] >> total & 1:
                return  # not with smaller ones either
            length = lengths[i]
            smaller = sums[i - 1] if i else 1
            for n in range(min(int(counts[length]), total // length), 0, -1):
                if smaller >> (total - n * length) & 1:
                    for rest in exactly(total - n * length, i - 1):
                        yield ((length, n), *rest)

    for waste in range(0, min(room, max_waste) + 1):
        if reachable >> (room - waste) & 1:
            for chosen in exactly(room - waste, len(lengths) - 1):
                yield (None if _is_dominated(chosen, counts, left, waste) else chosen), waste


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES) -> tuple[Packing, int]:
    """The best packing found, and a number of sequences that none can be below."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    total = int((left * np.arange(capacity + 1)).sum())
    bound = lower_bound(left, capacity)
    best = best_fit_decreasing(counts, capacity)
    fewest_so_far = fewest(best)
    spent = looks = 0

    def moves(waste: int) -> Iterator[tuple[Filling, int, int]]:
        """Fillings around the largest piece that is left: in bulk, then alone."""
        nonlocal looks
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        budget = (fewest_so_far - 1) * capacity - total - waste
        found = fillings(left.copy(), largest, capacity, budget) if budget >= 0 else iter(())
        left[largest] += 1
        for chosen, wasted in found:
            looks += 1
            if looks > LOOKS * nodes:
                return
            if chosen is None:
                continue
            each = dict(chosen)
            each[largest] = each.get(largest, 0) + 1
            filling = tuple(sorted(each.items(), reverse=True))
            often = min(int(left[x]) // n for x, n in filling)
            for times in dict.fromkeys((often, 1)):
                yield filling, times, wasted

    def apply(filling: Filling, times: int) -> None:
        for length, n in filling:
            left[length] += n * times

    # Each entry of the path is the iterator of a node's moves and the move that is applied.
    path: list[list] = [[moves(0), None, 0]] if total else []
    while path and fewest_so_far > bound and spent < nodes:
        node = path[-1]
        if node[1] is not None:
            apply(*node[1])
            node[1] = None
        move = next(node[0], None)
        if move is None:
            path.pop()
            continue
        spent += 1
        filling, times, wasted = move
        waste = node[2] + wasted * times
        apply(filling, -times)
        node[1] = filling, times
        used = sum(n[1][1] for n in path)
        if used + lower_bound(left, capacity) >= fewest_so_far:
            continue
        if not left.any():
            best, fewest_so_far = [n[1] for n in path], used
            continue
        path.append([moves(waste), None, waste])
    return best, bound


# --- pieces and their places ------------------------------------------------------------


class _Words:
    """Packed ids of texts by the library, word by word where its pipeline allows that.

    A pipeline of ``_STEPS`` normalises nothing across white space, and none of its pieces
    holds any, so the ids of a text are those of its words. Plain letters and the marks
    after them are pieces of their own, and what it does to plain letters before the merges
    is to lower them and to name their bytes; so the library's merges are called directly.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer)
        self._merges = self._tokenizer.model
        self._letters = dict(enumerate(byte_characters()))
        stated = json.loads(tokenizer)
        self._by_words = (stated["normalizer"], stated["pre_tokenizer"]) == _STEPS
        self._known = Remembered(self._word, CACHE_WORDS)
        self._parts = Remembered(self._part, CACHE_PARTS)

    def _encode(self, text: bytes) -> bytes:
        return array("I", self._tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def _part(self, letters: bytes) -> bytes:
        named = letters.decode().lower().encode().decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self._merges.tokenize(named)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        split = _LETTERS_MARKS.fullmatch(word)
        if split is None:
            return self._encode(word)
        letters, marks = split.groups()
        return self._parts[letters] + self._known[marks] if marks else self._parts[letters]

    def pack(self, text: bytes) -> bytes:
        if not self._by_words:
            return self._encode(text)
        return b"".join(map(self._known.__getitem__, text.split()))


@lru_cache(maxsize=2)
def _words(tokenizer: str) -> _Words:
    return _Words(tokenizer)


def cut(df: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """part, place, doc_id, piece, start, length, ids (packed 32-bit) of every piece, written.

    ``part`` is the partition that wrote a piece, ``place`` counts the part's pieces of the
    same length from 0. Together they order the pieces of a length without a sort.
    """
    with open(tokenizer_path, encoding="utf-8") as handle:  # part of the installed package, on the driver
        tokenizer = handle.read()
    if len(tokenizer) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{tokenizer_path} is larger than {MAX_TOKENIZER_BYTES} bytes")
    shipped = df.sparkSession.sparkContext.broadcast(tokenizer)
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part, seen = _words(shipped.value), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows, place, piece, length, ids = [], [], [], [], []
            for row, text in enumerate(texts_of(batch)):
                packed = words.pack(text) + end
                for number, at in enumerate(range(0, len(packed), 4 * capacity)):
                    some = packed[at:at + 4 * capacity]
                    size = len(some) // 4
                    rows.append(row)
                    piece.append(number)
                    length.append(size)
                    ids.append(some)
                    place.append(seen[size])
                    seen[size] += 1
            numbers = np.array(piece, np.int64)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(len(rows), part, np.int64)), "place": pa.array(place, pa.int64()),
                "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
                "piece": pa.array(numbers.astype(np.int32)), "start": pa.array(numbers * capacity),
                "length": pa.array(length, pa.int64()), "ids": pa.array(ids, pa.binary())})

    schema = "part long, place long, doc_id long, piece int, start long, length long, ids binary"
    return materialise(df.select("doc_id", "text").mapInArrow(run, schema), "pieces")


class _Places:
    """Where the n-th piece of a length goes; one entry a filling and length."""

    def __init__(self, packing: Packing, capacity: int):
        first, used, entries = 0, [0] * (capacity + 1), []
        for filling, times in packing:
            offset = 0
            for length, n in filling:
                entries.append((length, used[length], n, first, offset))
                used[length] += n * times
                offset += n * length
            first += times
        table = np.array(sorted(entries), np.int64).reshape(-1, 5).T
        self.starts, self.each, self.first, self.offset = table[1:]
        #: First entry of each length.
        self.of_length = np.searchsorted(table[0], np.arange(capacity + 2))
        self.keys = self._key(table[0], table[1])

    @staticmethod
    def _key(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return length << 47 | rank  # 12 bits of length at most, ranks below 2 ** 47

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these ranks among their length."""
        entry = np.searchsorted(self.keys, self._key(length, rank), side="right") - 1
        inside = rank - self.starts[entry]
        each = self.each[entry]
        return self.first[entry] + inside // each, self.offset[entry] + inside % each * length


def solve(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> tuple[Packing, int]:
    """The packing of a table with ``length``, and the number that none can be below."""
    counted = pieces.groupBy("length").count().collect()  # at most one row a length
    return bin_completion({row["length"]: row["count"] for row in counted}, capacity, nodes)


def place(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``pieces`` (with part, place, length) and their sequence_id and offset.

    Offsets are gapless from 0 in each sequence.
    """
    packing, _ = solve(pieces, capacity, nodes)
    if not packing:
        return pieces.select("*", F.lit(None).cast("long").alias("sequence_id"),
                             F.lit(None).cast("long").alias("offset"))
    places = _Places(packing, capacity)  # its size is bounded by the lengths, not by the pieces
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    ahead = measured(counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")),
                     "ahead")
    ranked = pieces.join(ahead, ["length", "part"]).select(
        *pieces.columns, (F.col("ahead") + F.col("place")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = places.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, found)], [*names, "sequence_id", "offset"])

    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids, lengths: the packed sequences themselves, with ``ids`` kept."""
    row = F.struct("offset", "ids", "doc_id", "length")
    held = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(row)).alias("held"))
    return held.select("sequence_id", F.expr("aggregate(held.ids, X'', (a, b) -> a || b)").alias("ids"),
                       F.col("held.doc_id").alias("doc_ids"), F.col("held.length").alias("lengths"))
