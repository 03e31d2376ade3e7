"""Balanced multinomial logistic regression on tf-idf and numeric features.

Training writes the sparse features once, as a table, and lets MLlib iterate
over it; the table goes when the model is fitted. Scoring stores no vectors: tasks hold the coefficients, which the vocabulary's
cap bounds, and return a commit's sums.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitsift import fixed_values as fv
from gitsift.functions import term_counts
from gitsift.functions.probabilities import argmax, class_array
from gitsift.operators import tfidf
from gitsift.operators.cleaning import class_index
from gitsift.operators.summaries import attach_class_weights
from gitsift.session import materialise, new_path, shuffles_removed, temporary_path

K = len(fv.TARGET_CLASSES)
BLOCKS = (tfidf.MESSAGE, tfidf.DIFF)
LEAST_PARTS = 64  # partitions of the training table that are left as its files are split


@dataclass
class Parameters:
    max_terms: int
    n_terms: int
    intercepts: list[float]
    means: list[float]
    stds: list[float]
    numeric_weights: list[list[float]]  # class by numeric column
    iterations: int


def numbered(terms: DataFrame) -> DataFrame:
    """One index over both blocks: message terms first, then diff terms."""
    order = F.when(F.col("block") == tfidf.MESSAGE.name, 0).otherwise(1)
    index = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order, "term")) - 1
    return terms.withColumn("idx", index)


def feature_columns(
    df: DataFrame, terms: DataFrame, n_terms: int, means: Sequence[float], stds: Sequence[float],
    max_terms: int, carry: Sequence[str] = (),
) -> DataFrame:
    """``(id, carry, features)`` with features laid out like a sparse ML vector.

    Order: message terms, diff terms, the three scaled numerics. Rows without id have no terms.
    """
    named = df.withColumns({
        b.column: F.when(F.col("commit_id").isNotNull(), F.col(b.column)).otherwise("") for b in BLOCKS})
    packed = tfidf.weighted(named, BLOCKS, terms, carry=[*carry, *fv.NUMERIC_COLUMNS])
    base = packed.select("commit_id", F.inline("rows"), *[f"{c}{b}" for b in range(len(BLOCKS)) for c in "iw"])
    places = F.array(*[F.lit(n_terms + i) for i in range(len(fv.NUMERIC_COLUMNS))])
    numerics = F.array(*[(F.col(c) - means[i]) / stds[i] for i, c in enumerate(fv.NUMERIC_COLUMNS)])

    def whole(of: str, rest: Column) -> Column:
        """Message terms come before diff terms in ``numbered``, so indices ascend."""
        return F.concat(*[f"{of}{b}" for b in range(len(BLOCKS))], rest)

    return base.select(
        "commit_id", *carry,
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(n_terms + len(fv.NUMERIC_COLUMNS)).alias("size"),
            whole("i", places).alias("indices"),
            whole("w", numerics).alias("values"),
        ).alias("features"))


def write_features(features: DataFrame, path: str | None = None) -> DataFrame:
    """Stores features as an evenly cut table and reads the column back as an ML vector.

    Training passes over this table many times, so no part of it should be larger. Documents
    lie as ``by_document`` has dealt them by id, evenly; vectors, ten times the texts, are not
    dealt once more.
    """
    spark = features.sparkSession
    path = path or new_path(spark, "features")
    with shuffles_removed(spark):
        features.write.parquet(path)
    fields = [f if f.name != "features" else T.StructField("features", VectorUDT())
              for f in features.schema.fields]
    return _few_parts(spark.read.schema(T.StructType(fields)).parquet(path))


def _few_parts(stored: DataFrame) -> DataFrame:
    """No more partitions than keep all cores busy: each sends a gradient as large as the model, every iteration."""
    most = max(LEAST_PARTS, 2 * stored.sparkSession.sparkContext.defaultParallelism)
    return stored.coalesce(most) if stored._jdf.queryExecution().toRdd().getNumPartitions() > most else stored


class TextClassifier:
    """Fitted terms with their coefficients, and a few scalars."""

    def __init__(self, terms: DataFrame, parameters: Parameters, mllib_model=None):
        self.terms = terms  # block, term, idx, idf, coef array<double>
        self.parameters = parameters
        self.mllib_model = mllib_model

    @classmethod
    def fit(
        cls, train: DataFrame, max_terms: int = fv.MAX_TERMS,
        max_iterations: int = fv.MAX_ITERATIONS, tolerance: float = 1e-3,
        inverse_regularisation: float = fv.INVERSE_REGULARISATION,
        vocabulary: DataFrame | None = None,
    ) -> TextClassifier:
        """Vocabulary, scaling and coefficients from training rows only.

        ``vocabulary`` is that of the training rows, if it is known already.
        """
        spark = train.sparkSession
        if vocabulary is None:
            vocabulary = tfidf.fit_vocabulary(train, BLOCKS, max_terms)
        terms = materialise(numbered(vocabulary).select("block", "term", "idx", "idf"), "terms")
        n_terms = terms.count()
        scale = {r["column"]: r for r in tfidf.numeric_scale(train).collect()}  # three rows
        means = [float(scale[c]["mean"]) for c in fv.NUMERIC_COLUMNS]
        stds = [float(scale[c]["std"]) for c in fv.NUMERIC_COLUMNS]
        labelled = attach_class_weights(train).withColumn(
            "label_id", class_index(F.col("label")).cast("double"))
        with temporary_path(spark, "features") as path:
            features = write_features(feature_columns(
                labelled, terms, n_terms, means, stds, max_terms, ["label_id", "weight"]), path)
            n_rows = features.count()
            model = LogisticRegression(
                featuresCol="features", labelCol="label_id", weightCol="weight",
                family="multinomial", maxIter=max_iterations, tol=tolerance, standardization=False,
                regParam=1.0 / (inverse_regularisation * n_rows),
            ).fit(features)
        matrix = np.zeros((K, n_terms + len(fv.NUMERIC_COLUMNS)))
        fitted = model.coefficientMatrix.toArray()
        matrix[: fitted.shape[0]] = fitted
        intercepts = np.full(K, -np.inf)  # a class without training rows stays impossible
        intercepts[: fitted.shape[0]] = model.interceptVector.toArray()
        rows = list(enumerate(matrix[:, :n_terms].T.tolist()))  # bounded by the vocabulary
        coefficients = spark.createDataFrame(rows, "idx int, coef array<double>")
        parameters = Parameters(
            max_terms, n_terms, [float(max(x, -1e300)) for x in intercepts], means, stds,
            matrix[:, n_terms:].tolist(), int(model.summary.totalIterations))
        return cls(materialise(terms.join(coefficients, "idx"), "fitted-terms"), parameters, model)

    def _coefficients(self) -> tuple[np.ndarray, np.ndarray]:
        """The row of each index, and the coefficients by row; bounded by the vocabulary's cap."""
        rows = self.terms.select("idx", "coef").toArrow()
        idx = rows.column("idx").to_numpy()
        place = np.zeros(int(idx.max(initial=-1)) + 1, np.int64)
        place[idx] = np.arange(len(idx))
        return place, np.array(rows.column("coef").to_pylist(), np.float64).reshape(-1, K)

    def probabilities(self, df: DataFrame) -> DataFrame:
        """``(commit_id, probs)`` for rows with clean texts and numerics."""
        p = self.parameters
        place, coef = self._coefficients()

        def body(rows, found):
            sums = np.zeros((rows.num_rows, K))
            for block in found:
                for i, (idx, weight) in enumerate(block):
                    sums[i] += weight @ coef[place[idx]]
            return pa.RecordBatch.from_arrays(
                [rows.column(0), *map(pa.array, sums.T)], ["commit_id", *[f"s{k}" for k in range(K)]])

        kind = df.schema["commit_id"].dataType.simpleString()
        per_commit = tfidf.map_documents(
            tfidf.by_document(df, BLOCKS), tfidf.sent(self.terms, BLOCKS), body,
            f"commit_id {kind}, " + ", ".join(f"s{k} double" for k in range(K)))
        base = df.select("commit_id", *fv.NUMERIC_COLUMNS).join(per_commit, "commit_id", "left")
        logits = []
        for k in range(K):
            total = F.coalesce(F.col(f"s{k}"), F.lit(0.0)) + p.intercepts[k]
            for i, c in enumerate(fv.NUMERIC_COLUMNS):
                total = total + (F.col(c) - p.means[i]) / p.stds[i] * p.numeric_weights[k][i]
            logits.append(total.alias(f"l{k}"))
        shifted = base.select("commit_id", *logits)
        top = F.greatest(*[F.col(f"l{k}") for k in range(K)])
        raised = shifted.select(
            "commit_id", *[F.exp(F.col(f"l{k}") - top).alias(f"e{k}") for k in range(K)])
        total = sum((F.col(f"e{k}") for k in range(1, K)), F.col("e0"))
        return raised.select(
            "commit_id", F.array(*[F.col(f"e{k}") / total for k in range(K)]).alias("probs"))

    def predict(self, df: DataFrame) -> DataFrame:
        """``(commit_id, probs, pred, confidence)``."""
        best = argmax(F.col("probs"))
        return self.probabilities(df).withColumns({
            "pred": F.get(class_array(), best), "confidence": F.get(F.col("probs"), best)})

    def gradient(
        self, train: DataFrame, inverse_regularisation: float = fv.INVERSE_REGULARISATION,
    ) -> DataFrame:
        """``(part, idx, gradient array<double>)`` of the penalised loss at these coefficients.

        The loss is the class-weighted mean over ``train``; the penalty is half the squared
        coefficients, without intercepts, over the inverse strength and the number of rows.
        At the optimum every component is zero. Terms are summed by feature in Spark, so what
        is shuffled is bounded by the vocabulary and not by the rows.
        """
        p = self.parameters
        n = train.count()
        labelled = attach_class_weights(train)
        total = F.broadcast(labelled.agg(F.sum("weight").alias("total")))  # one row
        known = labelled.join(total).select(
            "commit_id", (F.col("weight") / F.col("total")).alias("share"), class_index(F.col("label")).alias("c"),
            *[((F.col(x) - p.means[i]) / p.stds[i]).alias(f"x{i}") for i, x in enumerate(fv.NUMERIC_COLUMNS)])
        left = F.transform("probs", lambda q, k: (q - (k == F.col("c")).cast("double")) * F.col("share"))
        residuals = materialise(self.probabilities(train).join(known, "commit_id").select(
            "commit_id", left.alias("r"), *[f"x{i}" for i in range(len(p.means))]), "residuals")

        def sums(by: Column) -> Column:
            return F.array(*[F.sum(by * F.col("r")[k]) for k in range(K)])

        size = int(self.terms.agg(F.max("idx")).first()[0] or 0) + 1
        vocabularies = tfidf.sent(self.terms, BLOCKS)

        def summed(batches):
            total = np.zeros((size, K))  # of a task: bounded by the vocabulary
            for batch in batches:
                for a, b in term_counts.chunks(batch.column("t0"), batch.column("t1")):
                    rows = batch.slice(a, b - a)
                    r = np.array(rows.column("r").to_pylist(), np.float64).reshape(-1, K)
                    for i, v in enumerate(vocabularies):
                        for mine, (idx, weight) in zip(r, v.vectors(rows.column(f"t{i}"))):
                            total[idx] += np.outer(weight, mine)
            held = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.astype(np.int32)), pa.array(total[held].tolist(), pa.list_(pa.float64()))], ["idx", "r"])

        own = residuals.groupBy("commit_id").agg(sums(F.lit(1.0)).alias("r"))  # rows of one id are one document
        by_term = tfidf.by_document(train, BLOCKS).join(own, "commit_id").mapInArrow(
            summed, "idx int, r array<double>").groupBy("idx").agg(sums(F.lit(1.0)).alias("g"))
        strength = 1.0 / (inverse_regularisation * max(n, 1))

        def penalised(loss: Column, coef: Column) -> Column:
            return F.zip_with(loss, coef, lambda g, w: g + w * strength).alias("gradient")

        nothing = F.array(*[F.lit(0.0)] * K)
        of_terms = self.terms.join(by_term, "idx", "left").select(
            F.col("block").alias("part"), "idx", penalised(F.coalesce("g", nothing), F.col("coef")))
        others = [F.struct(
            F.lit("numeric").alias("part"), F.lit(i).alias("idx"), sums(F.col(f"x{i}")).alias("g"),
            F.array(*[F.lit(w[i]) for w in p.numeric_weights]).alias("coef")) for i in range(len(p.means))]
        others.append(F.struct(F.lit("intercept").alias("part"), F.lit(0).alias("idx"),
                               sums(F.lit(1.0)).alias("g"), nothing.alias("coef")))
        rest = residuals.agg(F.array(*others).alias("o")).select(F.inline("o")).select(
            "part", "idx", penalised(F.coalesce("g", nothing), F.col("coef")))
        return of_terms.unionByName(rest)

    def verify(self, texts: DataFrame, text: str) -> DataFrame:
        """Class of a text alone: no diff, and raw zeros for the numerics."""
        zeros = [F.lit(0).alias(c) for c in fv.NUMERIC_COLUMNS]
        rows = texts.select("commit_id", F.coalesce(text, F.lit("")).alias("message_clean"),
                            F.lit("").alias("diff_text"), *zeros)
        return self.predict(rows).select(
            "commit_id", F.col("pred").alias("verifier_type"),
            F.col("confidence").alias("verifier_confidence"))

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        spark.createDataFrame([(json.dumps(asdict(self.parameters)),)], "parameters string") \
            .write.mode("overwrite").parquet(f"{path}/parameters")
        if self.mllib_model is not None:
            self.mllib_model.write().overwrite().save(f"{path}/mllib")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        """The model as saved. Its terms are copied, so it can be saved over the same folder."""
        stored = spark.read.parquet(f"{path}/parameters").first()["parameters"]
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/mllib")
        files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        mllib_model = LogisticRegressionModel.load(f"{path}/mllib") if files.exists(target) else None
        terms = materialise(spark.read.parquet(f"{path}/terms"), "fitted-terms")
        return cls(terms, Parameters(**json.loads(stored)), mllib_model)
