"""Language of texts by sparse multinomial logistic regression on character n-grams.

Letters are lowered, everything else becomes a space, and the n-grams of one to three
characters fall into ``BUCKETS`` hash buckets. A bucket weighs log(1 + count) times its
inverse document frequency over all rows that may be learned from; a row has length one.

The regression is fitted by the follow-the-regularised-leader rule with elastic-net
penalties: the L1 part keeps unneeded buckets at exactly zero. It sees a bounded sample,
``MAX_TRAINING_ROWS`` rows in expectation, equally many of each language, chosen by a
hash. A fifth of the sample is not fitted but sets the temperature that makes scores
probabilities. Everything else covers all rows, and whole texts.

* null text or no letter: "und", score 0. So is every row if there is nothing to learn from.
* null lang: predicted but never learned from. Rows without doc_id: the same.
* repeated rows and ties: the language that sorts first wins a tie; rows are independent.
* further columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gitsift.llm.common import map_batches

BUCKETS = 1 << 15
NGRAMS = (1, 2, 3)
#: Labelled rows that a fit sees, in expectation.
MAX_TRAINING_ROWS = 4000
#: Languages that one model tells apart; its weights are bounded by this.
MAX_LANGUAGES = 500
UNKNOWN = "und"

# Follow the regularised leader: learning rate, its offset, L1 and L2 strength, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.001, 3


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, runs of anything else as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    letters = _letters()[codes]
    codes = np.where(letters, codes, 32)
    keep = letters.copy()
    keep[:1] = True
    keep[1:] |= letters[:-1]
    return np.concatenate(([32], codes[keep], [32])).astype(np.uint64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and counts of a text's n-grams; ``None`` if it has no letter."""
    codes = _codes(text or "")
    if not (codes != 32).any():
        return None
    total = np.zeros(BUCKETS, np.int64)
    with np.errstate(over="ignore"):
        for n in NGRAMS:
            size = len(codes) - n + 1
            if size <= 0:
                continue
            keys = np.full(size, n, np.uint64)
            for k in range(n):
                keys = (keys ^ codes[k:k + size]) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(29)
            total += np.bincount((keys % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, total[used]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray  # per bucket
    weights: np.ndarray  # bucket and one bias row, by language
    temperature: float

    def values(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = np.log1p(counts) * self.idf[used]
        return values / max(np.linalg.norm(values), 1e-12)

    def logits(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.values(used, counts) @ self.weights[used] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0
        chance = softmax(self.logits(*found) / self.temperature)
        best = int(np.argmax(chance))
        return self.languages[best], float(chance[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int) -> np.ndarray:
    """Follow the regularised leader over (buckets, values, language), in the order given."""
    z = np.zeros((BUCKETS + 1, n_languages))
    n = np.zeros((BUCKETS + 1, n_languages))

    def leader(at):
        weights = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, weights)

    for _ in range(PASSES):
        for used, values, language in rows:
            at, x = np.append(used, BUCKETS), np.append(values, 1.0)
            weights = leader(at)
            error = softmax(x @ weights)
            error[language] -= 1
            gradient = np.outer(x, error)
            square = gradient * gradient
            sigma = (np.sqrt(n[at] + square) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * weights
            n[at] += square
    return leader(slice(None))


def fit_temperature(logits: np.ndarray, languages: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm.

    Targets fall short of one as Platt's do, (n + 1) / (n + 2), or rows without any
    error would call for a temperature of zero and scores of one.
    """
    if not len(logits):
        return 1.0
    rows, others = np.arange(len(languages)), logits.shape[1] - 1
    target = np.full(logits.shape, 1 / (len(rows) + 2) / max(1, others))
    target[rows, languages] = (len(rows) + 1) / (len(rows) + 2)

    def loss(log_t: float) -> float:
        return -(target * np.log(np.maximum(softmax(logits / np.exp(log_t)), 1e-300))).sum(axis=1).mean()

    low, high, ratio = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """In how many rows each bucket occurs; a fixed number of sums reaches the driver."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = np.zeros(BUCKETS, np.int64)
        for text in batch.column("text").to_pylist():
            found = features(text)
            if found is not None:
                total[found[0]] += 1
        used = np.flatnonzero(total)
        return pa.RecordBatch.from_pydict({"bucket": pa.array(used), "n": pa.array(total[used])})

    counts = (map_batches(rows.select("text"), run, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(BUCKETS, np.int64)
    for row in counts:
        out[row.bucket] = row.n
    return out


def train(rows: DataFrame, max_training_rows: int = MAX_TRAINING_ROWS) -> LanguageModel:
    """A model from rows (doc_id, text, lang), all of which may be learned from."""
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)), 1.0)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; {MAX_LANGUAGES} are allowed")
    frequencies = document_frequencies(rows)
    idf = np.log((1 + sum(counts.values())) / (1 + frequencies)) + 1
    model = LanguageModel(languages, idf, np.zeros((BUCKETS + 1, len(languages))), 1.0)
    share = max(1, max_training_rows // len(languages))
    order = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("order")), 12)
    # Rows of a language whose hash is small enough: about ``share`` of them.
    limit = F.lit(0).cast("long")
    for language in languages:
        most = min(1 << 52, int((1 << 52) * share / counts[language]))
        limit = F.when(F.col("lang") == language, F.lit(most)).otherwise(limit)
    sample = rows.select("lang", "text", order.alias("order")).filter(F.col("order") < limit)

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        kept = [(o, languages.index(lang), *found) for o, lang, found in zip(
            batch.column("order").to_pylist(), batch.column("lang").to_pylist(),
            map(features, batch.column("text").to_pylist())) if found is not None]
        if not kept:
            return None
        return pa.RecordBatch.from_pydict({
            "order": pa.array([r[0] for r in kept], pa.int64()),
            "language": pa.array([r[1] for r in kept], pa.int64()),
            "used": pa.array([r[2].astype("<i4").tobytes() for r in kept], pa.binary()),
            "counts": pa.array([r[3].astype("<i4").tobytes() for r in kept], pa.binary())})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for row in batch.to_pylist():
                used = np.frombuffer(row["used"], dtype="<i4")
                held.append((used, model.values(used, np.frombuffer(row["counts"], dtype="<i4")),
                             row["language"]))
        aside = held[::5] if len(held) >= 5 * len(languages) else []
        fitted = [row for k, row in enumerate(held) if k % 5 or not aside]
        weights = fit_weights(fitted, len(languages))
        logits = np.array([x @ weights[used] + weights[-1] for used, x, _ in aside])
        temperature = fit_temperature(logits, np.array([language for *_, language in aside], dtype=np.int64))
        yield pa.RecordBatch.from_pydict({
            "weights": pa.array([weights.astype("<f8").tobytes()], pa.binary()),
            "temperature": pa.array([temperature], pa.float64())})

    # The sample is bounded, so one task may hold it.
    one = (map_batches(sample, sparse, "order long, language long, used binary, counts binary")
           .repartition(1).sortWithinPartitions("order", "language", "used", "counts"))
    found = one.mapInArrow(fit, "weights binary, temperature double").first()
    if found is None:  # no text of the sample has a letter
        return model
    model.weights = np.frombuffer(found.weights, dtype="<f8").reshape(BUCKETS + 1, len(languages))
    model.temperature = found.temperature
    return model


def predict(df: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of every row. The model's size is bounded by its parameters."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sent.value.predict(text) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "lang_pred": pa.array([f[0] for f in found], pa.string()),
            "score": pa.array([f[1] for f in found], pa.float64())})

    return map_batches(df.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """A third of the rows, by a checksum of the id; rows without id are not among them."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))
