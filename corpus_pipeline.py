"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and returns
a DataFrame. ``run`` applies them to ``documents``; every stage is written as Parquet in
the shared work folder and read back, so a lost executor costs a stage at most.

Every stage works on all rows it is given. Rows with a null text or no words end at the
quality rules. Rows without doc_id pass the line and near-duplicate stages unchanged, as
nothing says which document they are. An empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitsift.llm import bpe, decontam, lines, near_copies, quality, simhash
from gitsift.session import materialise

#: The stage language, SQL, has no suffix orders, hashes with seeds or merges by rank.
ORACLE_SQL = None

#: Near copies have SimHash fingerprints of five-word shingles that are within the operator's
#: bits, or share four fifths of those shingles or more. No number of differing bits finds all
#: of the latter, so an exact check follows the fingerprints.
SHINGLE_WORDS = 5
SIMILARITY = (4, 5)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and repeat little of themselves."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; n_chars follows the text."""
    return lines.replace_texts(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id."""
    return near_copies.keep_one(docs, shingle_words=SHINGLE_WORDS, similarity=SIMILARITY,
                                fingerprint_bits=simhash.MAX_DISTANCE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("byte_level_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
