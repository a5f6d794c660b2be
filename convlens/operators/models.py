"""Training and scoring with MLlib: linear text model and feed-forward model."""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convlens import constants as K
from convlens import session
from convlens.functions import text as TX
from convlens.operators import metrics, row_fit, tfidf


class SublinearCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Replace each count c of a sparse vector by 1 + ln(c)."""

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        if inputCol:
            self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        damp = F.udf(lambda v: SparseVector(v.size, v.indices, 1 + np.log(v.values)), VectorUDT())
        return dataset.withColumn(self.getOutputCol(), damp(self.getInputCol()))


class SmoothIDF(Estimator, HasInputCol, HasOutputCol):
    """Fit ln((1 + N) / (1 + df)) + 1 weights; the model is a plain element-wise product."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        fitted = IDF(inputCol=self.getInputCol(), outputCol=self.getOutputCol()).fit(dataset)
        return ElementwiseProduct(
            scalingVec=Vectors.dense(fitted.idf.toArray() + 1),
            inputCol=self.getInputCol(),
            outputCol=self.getOutputCol(),
        )


def text_terms(text: str, max_n: int = 2, stop: Sequence[str] = ()) -> list[SQLTransformer]:
    """Stages that list the 1- to max_n-grams of a text in `_terms`."""
    pattern = K.TERM_TOKEN.replace("\\", "\\\\")
    found = f"regexp_extract_all(lower(`{text}`), '{pattern}', 0)"
    if stop:
        words = ", ".join("'" + w.replace("'", "\\'") + "'" for w in stop)
        found = f"filter({found}, w -> w NOT IN ({words}))"
    grams = ["_tokens"]
    for n in range(2, max_n + 1):
        joined = ", ".join(f"get(_tokens, i + {k})" for k in range(1, n))
        grams.append(
            f"slice(transform(_tokens, (t, i) -> concat_ws(' ', t, {joined})), 1, greatest(size(_tokens) - {n - 1}, 0))"
        )
    return [
        SQLTransformer(statement=f"SELECT *, {found} AS _tokens FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, concat({', '.join(grams)}) AS _terms FROM __THIS__"),
    ]


def term_features(min_df: int = 5, max_df: float = 1.0, vocabulary: int = (1 << 31) - 1) -> Pipeline:
    """TF-IDF of `_terms`: sublinear counts, smooth idf, unit length.

    The vocabulary lives on the driver, like every MLlib linear model; `min_df`
    bounds it. No term is dropped unless `vocabulary` is set lower.
    """
    limit = {} if max_df >= 1 else {"maxDF": float(max_df)}
    return Pipeline(
        stages=[
            CountVectorizer(inputCol="_terms", outputCol="_counts", minDF=float(min_df), vocabSize=vocabulary, **limit),
            SublinearCounts("_counts", "_damped"),
            SmoothIDF("_damped", "_weighted"),
            Normalizer(p=2.0, inputCol="_weighted", outputCol="features"),
        ]
    )


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Add the balanced class weight of each row."""
    weights = tfidf.class_weights(df, label).select(label, F.col("weight").alias("_weight"))
    return df.join(F.broadcast(weights), label)


def logistic(label: str, strength: float, rows: int, max_iter: int = 1000) -> LogisticRegression:
    """Balanced L2 logistic regression. Balanced weights sum to the row count, so C becomes 1 / (C * rows)."""
    return LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="_weight", regParam=1.0 / (strength * rows),
        elasticNetParam=0.0, standardization=False, maxIter=max_iter
    )


def held(df: DataFrame) -> DataFrame:
    """Keep a training table in memory or on disk: training reads it once per iteration. Release it with `unpersist`."""
    return df.persist()


def listed(df: DataFrame, stages: Sequence[Transformer], label: str) -> DataFrame:
    """Labels and terms of a table, tokenised once."""
    for stage in stages:
        df = stage.transform(df)
    return held(df.select(label, "_terms"))


def fit_text_model(train: DataFrame, text: str, label: str, strength: float = 8.0, max_n: int = 2,
                   stop: Sequence[str] = (), **features) -> PipelineModel:
    """Fit features and classifier on the training rows only; reuse the result on any table."""
    terms = text_terms(text, max_n, stop)
    rows = listed(train, terms, label)
    pipe = term_features(**features).fit(rows)
    ready = held(with_class_weights(pipe.transform(rows).select(label, "features"), label))
    classifier = logistic(label, strength, ready.count()).fit(ready)
    if classifier.summary.totalIterations >= classifier.getMaxIter():
        raise RuntimeError(f"not converged after {classifier.getMaxIter()} iterations")
    ready.unpersist()
    rows.unpersist()
    return PipelineModel(stages=[*terms, *pipe.stages, classifier])


def score(model, df: DataFrame, threshold: float = K.THRESHOLD) -> DataFrame:
    """Add `prob` and `pred`; the model's working columns are dropped. Works on streams too."""
    out = model.transform(df).withColumn("prob", vector_to_array("probability")[1])
    return out.select(*df.columns, "prob", (F.col("prob") >= threshold).cast("int").alias("pred"))


@dataclass
class TextFit:
    """Text models that share their rows: the rows with numbers, the fit, and its vocabulary sizes by `min_df`."""

    rows: DataFrame
    fit: row_fit.Fit
    features: dict[int, int]

    def scored(self, which: int = 0, threshold: float = K.THRESHOLD) -> DataFrame:
        """The rows with `prob` and `pred` of one of the models."""
        found = self.fit.rows(which).select("row", "prob")
        out = self.rows.join(found, "row").withColumn("pred", (F.col("prob") >= threshold).cast("int"))
        return out.drop("row", "_fit")

    def weights(self, which: int = 0) -> DataFrame:
        """(term, weight) of one of the models: a sum over the fitted rows of each term."""
        return self.fit.weights(which)


def fit_texts(rows: DataFrame, train: Column, text: str, label: str, settings: Sequence[tuple[int, float]], max_n: int = 2,
              stop: Sequence[str] = (), max_df: float = 1.0) -> TextFit:
    """Balanced L2 logistic regressions of TF-IDF features, one per (min_df, C), fitted on the training rows and applied to all.

    The models of `fit_text_model`, solved in the space of rows: the vocabulary
    stays in the tables, however large it is.
    """
    rows = row_fit.numbered(rows).withColumn("_fit", F.coalesce(train, F.lit(False)))
    known = F.col("_fit") & F.col(label).isNotNull()  # a row without a label counts for the features, not for the fit
    found = rows.agg(F.count("*").alias("n"), F.count_if("_fit").alias("fit"), F.count_if(known).alias("known")).first()
    tokens = rows.select("row", F.col("_fit").alias("fit"), TX.term_tokens(F.col(text), stop).alias("tokens"))
    terms = row_fit.text_lists(tokens, "tokens", max_n)
    least = sorted({m for m, _ in settings})
    blocks = session.stage(row_fit.term_blocks(terms, found["fit"], found["n"], least[0], max_df))
    share = tfidf.class_weights(rows.filter(known), label).select(F.col(label).alias("_l"), (F.col("weight") / found["known"]).alias("share"))
    labels = rows.join(F.broadcast(share), F.col(label) == F.col("_l"), "left").select(
        "row", F.col(label).alias("y"), F.when(known, F.col("share")).otherwise(0.0).alias("share")
    )
    fit = row_fit.Fit(blocks, labels, found["n"], [row_fit.Model(m, 1.0 / (c * max(found["known"], 1))) for m, c in settings])
    return TextFit(rows, fit, row_fit.n_terms(blocks, least))


def text_grid(rows: DataFrame, train: Column, text: str, label: str, min_dfs: Iterable[int] = (1, 2, 5), strengths: Iterable[float] = (1, 8, 32),
              max_n: int = 2, stop: Sequence[str] = (), max_df: float = 1.0) -> DataFrame:
    """One row of metrics of the rows outside `train` per (min_df, C), areas from probabilities.

    Texts are tokenised once, and the models share their features and passes;
    no vocabulary reaches the driver.
    """
    settings = list(itertools.product(min_dfs, strengths))
    fitted = fit_texts(rows, train, text, label, settings, max_n, stop, max_df)

    def one(which: int) -> dict:
        min_df, c = settings[which]
        unseen = fitted.scored(which).filter(~F.coalesce(train, F.lit(False)))
        return {"min_df": min_df, "C": float(c), "features": fitted.features[min_df], **evaluate(unseen, label)}

    return rows.sparkSession.createDataFrame(side_by_side(rows, one, range(len(settings))))


def grid_search(train: DataFrame, val: DataFrame, text: str, label: str, min_dfs: Iterable[int] = (1, 2, 5),
                strengths: Iterable[float] = (1, 8, 32), max_n: int = 2, stop: Sequence[str] = (), max_df: float = 1.0) -> DataFrame:
    """`text_grid` of two tables: the first is trained on, the second gives the metrics."""
    both = [df.select(text, label, F.lit(k).alias("_train")) for df, k in ((train, True), (val, False))]
    return text_grid(both[0].unionByName(both[1]), F.col("_train"), text, label, min_dfs, strengths, max_n, stop, max_df)


def evaluate(scored: DataFrame, label: str) -> dict:
    """Metrics of one scored table. Several passes read the scores, which are computed once."""
    scored = held(scored.select(label, "prob", "pred"))
    table = metrics.binary_metrics(scored, label, "pred").first().asDict()
    areas = metrics.curve_areas(scored, label, "prob").first().asDict()
    scored.unpersist()
    keep = ("roc_auc", "average_precision", "recall_at_precision")
    return {**{k: float(v) for k, v in table.items() if k != "n"}, **{k: areas[k] for k in keep}}


def choose(results: DataFrame, metric: str = "average_precision", margin: float = 0.001) -> DataFrame:
    """The simplest run within a margin of the best: fewest features, then lowest C."""
    best = results.agg(F.max(metric)).scalar()
    return results.filter(F.col(metric) >= best - margin).orderBy("features", "C").limit(1)


def term_weights(model: PipelineModel) -> DataFrame:
    """(term, weight) of a fitted text model."""
    vocabulary = next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))
    weights = model.stages[-1].coefficients.toArray()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(vocabulary, weights.tolist(), strict=True)), "term string, weight double")


def top_weights(weights: DataFrame, k: int = 20) -> DataFrame:
    """The k strongest terms of either sign with their side."""
    up = weights.orderBy(F.desc("weight"), "term").limit(k).withColumn("side", F.lit("harmful"))
    down = weights.orderBy("weight", "term").limit(k).withColumn("side", F.lit("unharmful"))
    return up.unionByName(down)


#: Rows that make a task of a training pass worth its start, and vector components that one task holds at most.
PASS_ROWS, PASS_NUMBERS = 2048, 1 << 23
#: Networks trained at a time. Each keeps its own copy of the training vectors, in memory or on disk.
FITS = 4


def pass_parts(rows: int, dimension: int, cores: int) -> int:
    """Parts of a training table: as many as there are cores, fewer for few rows, more where a part would grow too large."""
    return max(1, min(cores, math.ceil(rows / PASS_ROWS)), math.ceil(rows * dimension / PASS_NUMBERS))


def for_passes(rows: DataFrame, dimension: int) -> DataFrame:
    """A held table of training vectors in parts for training: where it has more than three a core, they are put together.

    A network is trained in some hundred passes, and each sends all weights to
    every part and back. The parts that files, joins and samples leave behind
    follow the input and the shuffle settings, and most of them hold few rows.
    Fewer parts stay as they are: their order decides how sums are rounded.
    """
    n, found, cores = rows.count(), rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(pass_parts(n, dimension, cores)) if found > 3 * cores else rows


def side_by_side(train: DataFrame, fit: Callable, settings: Iterable) -> list:
    """What `fit` gives for each setting, in their order; some fits run at a time and fill each other's waits between passes."""
    one = inheritable_thread_target(train.sparkSession)(fit)
    with ThreadPool(FITS) as pool:
        return pool.map(one, list(settings), chunksize=1)


def with_vectors(df: DataFrame, embedding: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(embedding).cast("array<double>")))


def feed_forward(label: str, dimension: int, hidden: Sequence[int] = (128, 64), max_iter: int = 100,
                 step: float | None = None, seed: int = K.SEED) -> MultilayerPerceptronClassifier:
    """Two-class network with the given hidden layers; with a step, trained by gradient descent instead of L-BFGS."""
    return MultilayerPerceptronClassifier(
        layers=[dimension, *hidden, 2], featuresCol="features", labelCol=label, maxIter=max_iter, seed=seed,
        **({"solver": "l-bfgs"} if step is None else {"solver": "gd", "stepSize": step}),
    )


def forward(df: DataFrame, vector: str, layers: Sequence[tuple[Sequence[Sequence[float]], Sequence[float]]], threshold: float = K.THRESHOLD) -> DataFrame:
    """Add `prob` and `pred` of a two-class network of given weights, on the JVM.

    Each layer is (rows of weights, biases); hidden layers end in a sigmoid, the
    last one in shares. The weights are constants of the plan: a network of
    some thousand numbers, not a large model.
    """
    values = F.col(vector).cast("array<double>")
    out = df
    for k, (weights, biases) in enumerate(layers):
        flat = [[float(x) for x in row] + [float(b)] for row, b in zip(weights, biases, strict=True)]
        rows = F.from_json(F.lit(json.dumps(flat)), "array<array<double>>")
        inputs = F.concat(values, F.array(F.lit(1.0)))  # the bias is the weight of a constant input
        act = F.col("_inputs")
        sums = F.transform(rows, lambda row: F.aggregate(F.zip_with(row, act, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))
        if k + 1 < len(layers):
            sums = F.transform(sums, lambda x: 1 / (1 + F.exp(-x)))
        out = out.withColumn("_inputs", inputs).withColumn("_layer", sums)
        values = F.col("_layer")
    prob = 1 / (1 + F.exp(F.get("_layer", F.lit(0)) - F.get("_layer", F.lit(1))))
    out = out.select(*df.columns, prob.alias("prob"))
    return out.withColumn("pred", (F.col("prob") >= threshold).cast("int"))


def sweep(train: DataFrame, val: DataFrame, label: str, dimension: int, configs: dict[int, dict]) -> DataFrame:
    """One row per configuration: train and validation PR score, their gap, number of weights."""
    train, val = held(train), held(val)
    parts = for_passes(train, dimension)

    def one(run: int) -> tuple:
        model = feed_forward(label, dimension, **configs[run]).fit(parts)
        on_train = evaluate(score(model, train), label)["average_precision"]
        on_val = evaluate(score(model, val), label)["average_precision"]
        return run, str(configs[run]), int(model.weights.size), float(on_train), float(on_val), abs(float(on_val) - float(on_train))

    rows = side_by_side(train, one, configs)
    train.unpersist()
    val.unpersist()
    return train.sparkSession.createDataFrame(rows, "run int, config string, weights int, train_pr double, val_pr double, gap double")


def ranked_runs(runs: DataFrame) -> DataFrame:
    """Runs of a sweep with their places by validation score and by the gap to training, ties to the lower run."""
    whole = Window.partitionBy(F.lit(0))
    return runs.withColumns({
        "rank_val": F.row_number().over(whole.orderBy(F.desc("val_pr"), "run")),
        "rank_gap": F.row_number().over(whole.orderBy("gap", "run")),
    })


def seeds_and_arms(arms: dict[str, DataFrame], test: DataFrame, label: str, dimension: int, seeds: Sequence[int], **config) -> DataFrame:
    """Train every arm with every seed; one row of test metrics each."""
    rows = []
    test = held(test)
    for arm, train in arms.items():
        train = held(train)
        parts = for_passes(train, dimension)

        def one(seed: int, arm: str = arm, parts: DataFrame = parts) -> dict:
            model = feed_forward(label, dimension, seed=seed, **config).fit(parts)
            return {"arm": arm, "seed": seed, **evaluate(score(model, test), label)}

        rows += side_by_side(train, one, seeds)
        train.unpersist()
    test.unpersist()
    return test.sparkSession.createDataFrame(rows)
