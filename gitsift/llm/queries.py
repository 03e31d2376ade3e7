"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gitsift.llm import (
    automaton_dedup,
    bpe,
    decontam,
    hard_negatives,
    language,
    lines,
    lloyd,
    packing,
    page_text,
    quality,
    sharding,
    simhash,
    suffix_dedup,
)
from gitsift.plans.registry import Query
from gitsift.session import new_path

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 35-word windows that occur elsewhere too."""
    found = automaton_dedup.remove_substrings(table(spark, sf_dir, "documents"), 35, keep="none")
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


CHECK_SQL["op8_substring_dedup"] = """
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS words FROM documents),
windows AS (
  SELECT doc_id, i, hash(array_to_string(words[i:i + 34], ' ')) AS a,
    hash(array_to_string(words[i:i + 34], '|')) AS b
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM docs)),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY a, b) AS n FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS position FROM counted WHERE n > 1),
words AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS position FROM docs),
kept AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.position) AS n_removed,
    string_agg(w.word, ' ' ORDER BY w.position) FILTER (WHERE g.position IS NULL) AS text
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.position = g.position
  GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol, line and repetition statistics of every document, and the verdict."""
    return quality.score(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "longest_repeat", "covered_words")


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id it is linked to."""
    return simhash.components(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a model that two thirds of the labelled ones taught."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.filter(~language.held_out(F.col("doc_id"))))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, exactly or within a few edits."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 200 bytes that occur elsewhere too."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), 200, keep="none")
    return found.select("doc_id", "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier document has."""
    return lines.drop_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


# RE2 takes the same class of white space; ASCII letters alone are lowered by translate.
CHECK_SQL["op7_line_dedup"] = """
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS position FROM docs),
keyed AS (
  SELECT doc_id, line, position, translate(
    regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM numbered),
shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, k.line, k.position, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), ''))
    AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op10_min_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of eight shards by source, moved so that eight shards hold equal bytes."""
    by_source = F.pmod(F.xxhash64("source"), F.lit(8))
    moved = sharding.move(table(spark, sf_dir, "documents"), by_source, 8, 8, new_path(spark, "new-shards"))
    return moved.select("doc_id", sharding.size_of(F.col("text")).alias("size"),
                        sharding.crc32_of(F.col("text")).alias("text_crc32"), F.lit(sharding.LAW).alias("law"),
                        "shard", F.col("slot").cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query
def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score a little below each of an anchor's positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id"), label,
                               F.col("embedding"), F.col("vec_id") % 100 == 0)


CHECK_SQL["op11_hard_negative_mining"] = """
WITH vectors AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
    CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM vectors a JOIN vectors r ON len(a.q) = len(r.q) AND a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
    ORDER BY s.score DESC, s.row_id) AS INTEGER) AS rank,
  s.row_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces and their places in sequences of 2,048 tokens."""
    pieces = packing.cut(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(digests).drop("part", "place")


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds, with inertias and the centroid's digest."""
    found, centroids = lloyd.cluster(table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("embedding"))
    return lloyd.with_digests(found, centroids).withColumnRenamed("id", "vec_id")


def _lloyd_sql(rounds: int) -> str:
    nearest = """
near{r} AS (
  SELECT id, c AS cluster, d AS distance FROM (
    SELECT x.id, m.c, CAST(sum((x.v - m.v) * (x.v - m.v)) AS BIGINT) AS d
    FROM components x JOIN means{r} m ON x.k = m.k GROUP BY x.id, m.c)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, c) = 1)"""
    means = """
means{n} AS (
  SELECT m.c, m.k, coalesce(u.v, m.v) AS v FROM means{r} m LEFT JOIN (
    SELECT n.cluster AS c, x.k, CAST(floor(sum(x.v) / count(*)) AS BIGINT) AS v
    FROM near{r} n JOIN components x ON n.id = x.id GROUP BY n.cluster, x.k) u
  ON m.c = u.c AND m.k = u.k)"""
    steps = [nearest.format(r=r) + "," + means.format(r=r, n=r + 1) for r in range(rounds)]
    return """
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
components AS (
  SELECT id, unnest(range(64)) AS k,
    unnest(list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM kept),
firsts AS (
  SELECT id, row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) - 1 AS c FROM kept
  QUALIFY c < 16),
means0 AS (SELECT f.c, x.k, x.v FROM firsts f JOIN components x ON f.id = x.id),""" + ",".join(steps) + f"""
,{nearest.format(r=rounds)},
digests AS (
  SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY k)) AS centroid_sha256
  FROM means{rounds} GROUP BY c)
SELECT k.vec_id, CAST(n.cluster AS INTEGER) AS cluster, n.distance,
  CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(n.distance) OVER () AS BIGINT) AS inertia, d.centroid_sha256
FROM near{rounds} n JOIN kept k ON n.id = k.id JOIN digests d ON n.cluster = d.c
"""


CHECK_SQL["op13_centroid_clustering"] = _lloyd_sql(3)
