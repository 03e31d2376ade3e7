"""Byte-level BPE: texts to token ids and back, exactly as the rank file says.

The merges run in the ``tokenizers`` library over Arrow batches. Texts are cut into
chunks at white space first. No match of the splitting pattern crosses a chunk, so
ids of a chunk never depend on its neighbours, and each worker keeps the ids of
chunks it has met in a bounded table: real text repeats its words.

Ids travel as packed little-endian unsigned 32-bit integers: one binary value per
document, far cheaper than an array column.

* null text: as an empty one, no ids. Very long texts are never cut.
* repeated rows and null or equal doc_ids: every row is handled for itself.
* further columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gitsift.llm.common import sha256_hex, slices, texts_of

#: Chunks and pieces in a worker's young table; the old ones have as many. In all about 35 MB:
#: a worker holds them through the stages that follow, beside what those need.
CACHE_CHUNKS, CACHE_PIECES = 50_000, 40_000
#: The largest rank file that is sent to the workers.
MAX_VOCABULARY_BYTES = 32 << 20

# The code points with the Unicode property White_Space.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"

_CHUNKS = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
# Fixed value: the pattern that _CHUNKS and _PLAIN are made for; others run over whole texts.
_CHUNKED_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                    r"|\s+(?!\S)|\s+")
# Words of Latin letters with marks of ASCII behind them: two pieces by any pattern that
# keeps letters together; an apostrophe may begin a suffix of its own and is left out.
_PLAIN = re.compile("( ?[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)"
                    "([!-&(-/:-@\\[-`{-~]*)")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 0x100
    for byte in range(256):
        if byte in printable:
            out.append(chr(byte))
        else:
            out.append(chr(free))
            free += 1
    return out


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64, a space, the rank, line by line."""
    return {base64.b64decode(token): int(rank)
            for token, rank in (line.split() for line in data.splitlines() if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every way to put a token together from two others, in the order of the token's rank.

    A rank file allows any pair whose concatenation is a token, so one pair per
    token would not do.
    """
    merges: list[tuple[bytes, bytes]] = []
    for token in sorted(ranks, key=ranks.__getitem__):
        pairs = [(token[:i], token[i:]) for i in range(1, len(token))
                 if token[:i] in ranks and token[i:] in ranks]
        merges += sorted(pairs, key=lambda p: (ranks[p[0]], ranks[p[1]]))
    return merges


class Remembered(dict):
    """Values of a function, the young ones here and as many older ones aside."""

    def __init__(self, function: Callable[[str], bytes], most: int):
        super().__init__()
        self._function, self._most, self._old = function, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self._old.get(key)
        if value is None:
            value = self._function(key)
        if len(self) >= self._most:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """Encoder and decoder for one rank file and splitting pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        from tokenizers import Tokenizer, models

        ranks = read_ranks(rank_file)
        letters = byte_characters()
        name = {token: "".join(letters[b] for b in token) for token in ranks}
        self._tokenizer = Tokenizer(models.BPE(
            vocab={name[token]: rank for token, rank in ranks.items()},
            merges=[(name[a], name[b]) for a, b in merges_of(ranks)], ignore_merges=True))
        self._pattern = regex.compile(pattern)
        self._letters = dict(enumerate(letters))
        self._bytes = {letter: byte for byte, letter in enumerate(letters)}
        self._model = self._tokenizer.model
        self._by_chunks = pattern == _CHUNKED_PATTERN
        self._pieces = Remembered(self._piece, CACHE_PIECES)
        self._chunks = Remembered(self._chunk, CACHE_CHUNKS)
        size = max(ranks.values(), default=-1) + 1
        self._tokens = [b""] * size
        for token, rank in ranks.items():
            self._tokens[rank] = self._back(name[token])
        self._lengths = np.array([len(t) for t in self._tokens] or [0], dtype=np.int64)

    def _back(self, letters: str) -> bytes:
        """The bytes that the characters of a token stand for."""
        return bytes(self._bytes[letter] for letter in letters)

    def _piece(self, piece: str) -> bytes:
        """Packed ids of one match of the pattern."""
        letters = piece.encode().decode("latin-1").translate(self._letters)
        return array("I", [token.id for token in self._model.tokenize(letters)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            word, marks = plain.groups()
            return self._pieces[word] + self._pieces[marks] if marks else self._pieces[word]
        return b"".join([self._pieces[piece] for piece in self._pattern.findall(chunk)])

    def pack(self, text: str) -> bytes:
        """Packed ids of a text."""
        if not self._by_chunks:
            return b"".join([self._pieces[piece] for piece in self._pattern.findall(text)])
        return b"".join(map(self._chunks.__getitem__, _CHUNKS.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.pack(text), dtype="<u4").tolist()

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids; ids may end inside a character."""
        return b"".join(map(self._tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))

    def offsets(self, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one character of every token, in code points.

        A character split over tokens belongs to all of them.
        """
        ids = np.frombuffer(packed, dtype="<u4")
        ends = np.cumsum(self._lengths[ids])
        data = np.frombuffer(self.decode(packed), dtype=np.uint8)
        char_of = np.cumsum((data & 0xC0) != 0x80) - 1
        starts = ends - self._lengths[ids]
        return char_of[starts], char_of[ends - 1] + 1


@lru_cache(maxsize=2)
def _codec(rank_file: bytes, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def _rank_file(df: DataFrame, path: str):
    """The rank file, read once on the driver; its size is bounded by the vocabulary."""
    with open(path, "rb") as handle:  # part of the installed package, on the driver
        data = handle.read()
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes; {MAX_VOCABULARY_BYTES} are allowed")
    return df.sparkSession.sparkContext.broadcast(data)


def encode(df: DataFrame, path: str, pattern: str, with_offsets: bool = False) -> DataFrame:
    """doc_id, ids (packed binary), n_tokens; with offsets also char_starts, char_ends."""
    ranks = _rank_file(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in chain.from_iterable(map(slices, batches)):
            packed = [codec.pack(t.decode()) for t in texts_of(batch)]
            columns = {"doc_id": batch.column("doc_id"), "ids": pa.array(packed, pa.binary()),
                       "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64())}
            if with_offsets:
                spans = [codec.offsets(p) for p in packed]
                for k, name in enumerate(("char_starts", "char_ends")):
                    columns[name] = pa.array([s[k].tolist() for s in spans], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, ids binary, n_tokens long"
    if with_offsets:
        schema += ", char_starts array<long>, char_ends array<long>"
    return df.select("doc_id", "text").mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (binary), text of rows with ``ids``.

    Bytes of a character that the ids cut off become U+FFFD in ``text``, never in ``data``.
    """
    ranks = _rank_file(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in chain.from_iterable(map(slices, batches)):
            data = [codec.decode(p or b"") for p in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "data": pa.array(data, pa.binary()),
                "text": pa.array([d.decode(errors="replace") for d in data], pa.string())})

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary, text string")


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass.

    Neither ids nor texts leave the task; a short batch is in memory at a time.
    """
    ranks = _rank_file(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in chain.from_iterable(map(slices, batches)):
            counts, ids, decoded = [], [], []
            for text in texts_of(batch):
                packed = codec.pack(text.decode())
                counts.append(len(packed) // 4)
                ids.append(sha256_hex(packed))
                decoded.append(sha256_hex(codec.decode(packed)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string())})

    return df.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
