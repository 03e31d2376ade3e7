"""Tf-idf as relational work: term counts, vocabulary, weights, sparse vectors.

A text block is a column with an analyzer (``word`` or ``char``). Texts are dealt evenly to
tasks, which count terms in Arrow batches (``term_counts``): fitting then moves only counts
per term, and a document's weights leave its task as one row. A row a term and document would
be a hundred times the text.

The vocabulary is capped (30,000 terms a block). It is sent to the tasks, which is bounded by
that cap and not by the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitsift import fixed_values as fv
from gitsift.functions import ngrams, term_counts
from gitsift.session import materialise, measured, spread


@dataclass(frozen=True)
class Block:
    name: str
    column: str
    analyzer: str


MESSAGE = Block("message", "message_clean", "word")
DIFF = Block("diff", "diff_text", "char")


def pieces(block: Block) -> Column:
    return ngrams.joined_pieces(F.coalesce(block.column, F.lit("")), block.analyzer)


def term_statistics(df: DataFrame, block: Block, by: str | None = None) -> DataFrame:
    """``(term, n, df)``: corpus count and document frequency; with ``by`` for each of its values.

    Rows are dealt evenly first, as a small file is one task's however long its texts take.
    Tasks return counts of a batch; neither texts nor (document, term) pairs are moved again.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.lit(0).alias("_by") if by is None else F.col(by).alias("_by")
    texts = df.select(group, F.col(block.column)).repartition(parts).select("_by", pieces(block).alias("t"))
    analyzer = block.analyzer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column("_by").dictionary_encode("encode")
            for g, name in enumerate(groups.dictionary):
                mine = batch.column("t").filter(pa.array(groups.indices.to_numpy(zero_copy_only=False) == g))
                for a, b in term_counts.chunks(mine):
                    terms, n, df = term_counts.statistics(mine.slice(a, b - a), analyzer)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name.as_py()] * len(terms), name.type), pa.array(terms, pa.string()),
                         pa.array(n), pa.array(df)], ["_by", "term", "n", "df"])

    kind = texts.schema["_by"].dataType.simpleString()
    found = texts.mapInArrow(run, f"_by {kind}, term string, n long, df long")
    keys = ["term"] if by is None else ["term", F.col("_by").alias(by)]
    return found.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def vocabulary(
    df: DataFrame, block: Block, max_terms: int = fv.MAX_TERMS, min_df: int = fv.MIN_DOC_FREQ
) -> DataFrame:
    """Terms of a block by corpus count (term order on a tie) with index and smoothed idf.

    The cap is a distributed top-n; only its result is numbered in one task.
    """
    stats = term_statistics(df, block).filter(F.col("df") >= min_df)
    top = stats.orderBy(F.desc("n"), "term").limit(max_terms)
    size = df.agg(F.count("*").alias("n_docs"))
    index = F.row_number().over(Window.partitionBy("block").orderBy("term")) - 1
    return top.withColumn("block", F.lit(block.name)).join(F.broadcast(size)).select(
        "block", "term", index.alias("idx"), "n", "df",
        (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf"))


def fit_vocabulary(
    df: DataFrame, blocks: Sequence[Block], max_terms: int = fv.MAX_TERMS, **options
) -> DataFrame:
    out = None
    for b in blocks:
        one = vocabulary(df, b, max_terms, **options)
        out = one if out is None else out.unionByName(one)
    return out


def fold_vocabularies(
    df: DataFrame, blocks: Sequence[Block], folds: int, max_terms: int = fv.MAX_TERMS,
    min_df: int = fv.MIN_DOC_FREQ, fold: str = "fold",
) -> list[DataFrame]:
    """For each fold the vocabulary of all rows outside it, as ``fit_vocabulary`` would find it.

    Terms are counted once, by fold; what lies outside a fold is the total less its own.
    """
    size = measured(df.groupBy(fold).agg(F.count("*").alias("rows")), "fold-sizes")
    counted = None
    for b in blocks:
        one = term_statistics(df, b, fold)
        one = one.groupBy("term").agg(
            F.map_from_entries(F.collect_list(F.struct(fold, F.struct("n", "df")))).alias("own"),
            F.sum("n").alias("n"), F.sum("df").alias("df")).withColumn("block", F.lit(b.name))
        counted = one if counted is None else counted.unionByName(one)
    counted = materialise(counted, "fold-terms", ["block"])
    out = []
    for f in range(folds):
        own = F.try_element_at("own", F.lit(f).cast(df.schema[fold].dataType))
        outside = counted.select(
            "block", "term", (F.col("n") - F.coalesce(own["n"], F.lit(0))).alias("n"),
            (F.col("df") - F.coalesce(own["df"], F.lit(0))).alias("df")).filter(F.col("df") >= min_df)
        n_docs = F.broadcast(size.filter(F.col(fold) != f).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("n_docs")))
        tops = [outside.filter(F.col("block") == b.name).orderBy(F.desc("n"), "term").limit(max_terms)
                for b in blocks]
        index = F.row_number().over(Window.partitionBy("block").orderBy("term")) - 1
        out.append(reduce(DataFrame.unionByName, tops).join(n_docs).select(
            "block", "term", index.alias("idx"), "n", "df",
            (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1).alias("idf")))
    return out


def sent(terms: DataFrame, blocks: Sequence[Block]) -> list[term_counts.Vocabulary]:
    """The vocabulary of each block as tasks need it."""
    rows = terms.filter(F.col("block").isin([b.name for b in blocks])).select(
        "block", "term", F.col("idx").cast("int").alias("idx"), "idf").orderBy("idx").toArrow()  # capped
    held = rows.column("block").to_numpy(zero_copy_only=False)
    out = []
    for b in blocks:
        mine = rows.filter(pa.array(held == b.name))
        out.append(term_counts.Vocabulary(
            b.analyzer, {t: i for i, t in enumerate(mine.column("term").to_pylist())},
            mine.column("idx").to_numpy().astype(np.int32), mine.column("idf").to_numpy().astype(np.float64)))
    return out


def by_document(df: DataFrame, blocks: Sequence[Block], id_column: str = "commit_id",
                carry: Sequence[str] = ()) -> DataFrame:
    """``(id, t0, t1, ...)``: the pieces of each block, those of rows of one id together.

    With ``carry`` there is ``rows`` too, an array with these columns of each row of the id.
    """
    columns = list(dict.fromkeys(b.column for b in blocks))
    by_id = spread(df.select(id_column, *columns, *[F.col(c).alias(f"_own_{c}") for c in carry]), id_column)
    rows = [F.collect_list(F.struct(*[F.col(f"_own_{c}").alias(c) for c in carry])).alias("rows")] if carry else []
    held = by_id.groupBy(id_column).agg(*[
        F.collect_list(F.coalesce(c, F.lit(""))).alias(f"_{c}") for c in columns], *rows)

    def whole(b: Block) -> Column:
        return F.array_join(F.transform(f"_{b.column}", lambda t: ngrams.joined_pieces(t, b.analyzer)), "\n")

    return held.select(id_column, *[whole(b).alias(f"t{i}") for i, b in enumerate(blocks)], *(["rows"] if carry else []))


def map_documents(
    documents: DataFrame, vocabularies: Sequence[term_counts.Vocabulary],
    body: Callable[[pa.RecordBatch, list], pa.RecordBatch], schema: str | T.StructType,
) -> DataFrame:
    """``body(rows, vectors of each block)`` over batches of ``by_document`` with further columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in term_counts.chunks(*[batch.column(f"t{i}") for i in range(len(vocabularies))]):
                part = batch.slice(a, b - a)
                yield body(part, [v.vectors(part.column(f"t{i}")) for i, v in enumerate(vocabularies)])

    return documents.mapInArrow(run, schema)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays or [[]]), kind))


def weighted(
    df: DataFrame, blocks: Sequence[Block], terms: DataFrame, id_column: str = "commit_id",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(id, i0, w0, i1, w1, ...)``: per block indices and weights, w = (1 + ln tf) * idf, of unit length.

    Weights are per document; a document's arrays are bounded by the vocabulary, and empty if
    it has no known term. With ``carry`` the ``rows`` of ``by_document`` come along, so that
    weights need not be moved to meet them.
    """
    def body(rows, found):
        lists = [x for vectors in found for x in (
            _lists([v[0] for v in vectors], pa.int32()), _lists([v[1] for v in vectors], pa.float64()))]
        names = [f"{c}{i}" for i in range(len(found)) for c in "iw"]
        held = [rows.column(c) for c in kept]
        return pa.RecordBatch.from_arrays([*held, *lists], [*kept, *names])

    documents = by_document(df, blocks, id_column, carry)
    kept = [id_column, *(["rows"] if carry else [])]
    schema = T.StructType([T.StructField(c, documents.schema[c].dataType) for c in kept])
    for i in range(len(blocks)):
        schema = schema.add(f"i{i}", T.ArrayType(T.IntegerType())).add(f"w{i}", T.ArrayType(T.DoubleType()))
    return map_documents(documents, sent(terms, blocks), body, schema)


def tfidf(
    df: DataFrame, blocks: Sequence[Block], terms: DataFrame, max_terms: int = fv.MAX_TERMS,
    id_column: str = "commit_id",
) -> DataFrame:
    """Long table ``(id, block_no, idx, weight)``, unit length per document and block."""
    found = weighted(df, blocks, terms, id_column)
    each = F.array(*[F.struct(
        F.lit(i).alias("block_no"), F.arrays_zip(F.col(f"i{i}").alias("idx"), F.col(f"w{i}").alias("weight"))
        .alias("e")) for i in range(len(blocks))])
    return found.select(id_column, F.inline(each)).select(id_column, "block_no", F.inline("e"))


def vectors(
    df: DataFrame, block: Block, terms: DataFrame, max_terms: int = fv.MAX_TERMS,
    id_column: str = "commit_id", keep_empty: bool = False,
) -> DataFrame:
    """``(id, idx array<int>, weight array<double>)`` in index order, unit length.

    A document's array is bounded by the vocabulary. Documents without a known term
    are left out, or come with empty arrays if ``keep_empty`` says so, as do rows without id.
    """
    found = weighted(df, [block], terms, id_column)
    if not keep_empty:
        return found.filter(F.size("i0") > 0).select(id_column, F.col("i0").alias("idx"), F.col("w0").alias("weight"))
    named = F.col(id_column).isNotNull()
    return found.select(
        id_column, F.when(named, F.col("i0")).otherwise(F.array().cast("array<int>")).alias("idx"),
        F.when(named, F.col("w0")).otherwise(F.array().cast("array<double>")).alias("weight"))


def numeric_scale(df: DataFrame, columns: Sequence[str] = tuple(fv.NUMERIC_COLUMNS)) -> DataFrame:
    """One row per column: mean and population standard deviation, 1 where it is zero."""
    stats = df.agg(*[
        F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"))
        .alias(c) for c in columns])
    rows = stats.select(F.explode(F.array(*columns)).alias("s")).select("s.*")
    return rows.withColumn("std", F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0)))


def token_sequences(
    df: DataFrame, column: str, vocabulary_size: int, length: int, train: DataFrame | None = None,
    id_column: str = "commit_id",
) -> DataFrame:
    """Token ids of a text, cut or zero-padded to ``length``; 1 stands for unknown words.

    Words get ids from 2 by corpus count in ``train`` (word order on a tie).
    """
    source = df if train is None else train
    counts = source.select(F.explode(ngrams.plain_tokens(F.col(column))).alias("token")).groupBy(
        "token").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(vocabulary_size - 2)
    ids = top.select("token", (F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "token")) + 1).alias("token_id"))
    shown = F.slice(ngrams.plain_tokens(F.col(column)), 1, length)
    pieces = spread(df.select(id_column, column), id_column).select(
        id_column, F.posexplode_outer(shown).alias("pos", "token"))
    known = pieces.join(ids, "token", "left")
    value = F.when(F.col("token").isNotNull(), F.coalesce("token_id", F.lit(1)))
    packed = known.groupBy(id_column).agg(F.sort_array(F.collect_list(
        F.when(value.isNotNull(), F.struct(F.col("pos"), value.alias("v"))))).alias("e"))
    filled = F.concat(F.transform("e", lambda e: e["v"]),
                      F.array_repeat(F.lit(0), F.lit(length) - F.size("e")))
    return packed.select(id_column, filled.alias("tokens"))
