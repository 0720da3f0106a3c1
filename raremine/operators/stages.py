"""Own operators as Spark ML stages: they go into a ``Pipeline``, through
``CrossValidator``, and are saved and loaded with the pipeline.

Scaling, correlation pruning and Gaussian naive Bayes keep their fitted numbers
as params (O(columns) of them), so Spark ML's default writer saves them.  The
nearest-neighbour model keeps its training rows as Parquet beside its params.
All stages read and write a ``features`` vector column.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.operators.models import VAR_SMOOTHING


def _numbers(name: str, doc: str):
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toListFloat)


def _moments(df: DataFrame, column: str, by: str | None = None):
    """Per (group and) position: n, mean, population variance, min, max.  One
    aggregate, positions x groups rows."""
    group = [F.col(by).alias("g")] if by else []
    long = df.select(*group, F.posexplode(vector_to_array(column)).alias("j", "x"))
    return (long.groupBy(*["g"] * len(group), "j")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var"), F.min("x").alias("min"), F.max("x").alias("max"))
            .toPandas().sort_values([*["g"] * len(group), "j"]))


# ------------------------------------------------------------------ scaling --

class Scaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``kind`` 'minmax' (onto [0.0001, 1], constant columns to the lower end)
    or 'standard' (population deviation, constant columns to 0)."""

    kind = Param(Params._dummy(), "kind", "minmax or standard", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "raw", outputCol: str = "features", kind: str = "minmax"):
        super().__init__()
        self._setDefault(inputCol="raw", outputCol="features", kind="minmax")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ScalerModel":
        m = _moments(df, self.getInputCol())
        if self.getOrDefault(self.kind) == "minmax":
            span = np.where(m["max"] > m["min"], m["max"] - m["min"], 1.0)
            factor, shift = 0.9999 / span, 0.0001 - m["min"] * 0.9999 / span
        else:
            std = np.where(m["var"] > 0, np.sqrt(m["var"]), 1.0)
            factor, shift = 1.0 / std, -m["mean"] / std
        model = ScalerModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol())
        return model._set(factor=[float(v) for v in factor], shift=[float(v) for v in shift])._resetUid(self.uid)


class ScalerModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    factor = _numbers("factor", "factor of every position")
    shift = _numbers("shift", "added to every position")

    @keyword_only
    def __init__(self, *, inputCol: str = "raw", outputCol: str = "features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in
                          zip(self.getOrDefault(self.factor), self.getOrDefault(self.shift))])
        scaled = F.zip_with(vector_to_array(self.getInputCol()), pairs, lambda x, p: x * p["a"] + p["b"])
        return df.withColumn(self.getOutputCol(), array_to_vector(scaled))


# ------------------------------------------------------ correlation pruning --

class CorrelationPruner(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the positions that the greedy walk of ``drop_correlated`` keeps:
    in order, each drops all later or earlier ones correlated above ``threshold``."""

    threshold = Param(Params._dummy(), "threshold", "largest absolute rank correlation kept", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol: str = "features", outputCol: str = "kept", threshold: float = 0.93):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="kept", threshold=0.93)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "CorrelationPrunerModel":
        from raremine.operators.stats import drop_correlated, spearman_matrix
        from raremine.session import written

        p = len(df.select(vector_to_array(self.getInputCol())).first()[0])
        names = [f"x{j}" for j in range(p)]
        wide = df.select(vector_to_array(self.getInputCol()).alias("_x")).select(*[F.col("_x")[j].alias(n) for j, n in enumerate(names)])
        wide = wide.withColumn("id", F.monotonically_increasing_id())
        dropped = set(drop_correlated(spearman_matrix(written(wide, "prune"), names), names, None, self.getOrDefault(self.threshold)))
        model = CorrelationPrunerModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol())
        return model._set(positions=[j for j, n in enumerate(names) if n not in dropped])._resetUid(self.uid)


class CorrelationPrunerModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    positions = Param(Params._dummy(), "positions", "positions that stay", typeConverter=TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCol: str = "features", outputCol: str = "kept"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(self.getInputCol())
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*[x[j] for j in self.getOrDefault(self.positions)])))


# --------------------------------------------------------------- classifiers --

class GaussianNB(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Gaussian naive Bayes with the smoothing of ``models.gnb_fit``."""

    smoothing = Param(Params._dummy(), "smoothing", "share of the largest variance added to all", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", smoothing: float = VAR_SMOOTHING):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", smoothing=VAR_SMOOTHING)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "GaussianNBStageModel":
        m = _moments(df, self.getFeaturesCol(), self.getLabelCol())
        classes = sorted(m["g"].unique())
        n = np.array([m[m["g"] == c]["n"].iloc[0] for c in classes], float)
        mean = np.stack([m[m["g"] == c]["mean"].to_numpy() for c in classes])
        var = np.stack([m[m["g"] == c]["var"].to_numpy() for c in classes])
        share = (n / n.sum())[:, None]
        every = (share * (var + mean ** 2)).sum(axis=0) - (share * mean).sum(axis=0) ** 2
        var = var + self.getOrDefault(self.smoothing) * every.max()
        model = GaussianNBStageModel(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol())
        return model._set(classes=[float(c) for c in classes], constants=[float(v) for v in np.log(share[:, 0]) - 0.5 * np.log(2 * math.pi * var).sum(axis=1)],
                          means=mean.ravel().tolist(), halves=(0.5 / var).ravel().tolist())._resetUid(self.uid)


class GaussianNBStageModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    classes = _numbers("classes", "labels, ascending")
    constants = _numbers("constants", "log prior and normalisation per class")
    means = _numbers("means", "class by class")
    halves = _numbers("halves", "1 / (2 variance), class by class")

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        classes = self.getOrDefault(self.classes)
        p = len(self.getOrDefault(self.means)) // len(classes)
        x = vector_to_array(self.getFeaturesCol())
        scores = []
        for i, (c, const) in enumerate(zip(classes, self.getOrDefault(self.constants))):
            part = slice(i * p, (i + 1) * p)
            fitted = F.array(*[F.struct(F.lit(a).alias("m"), F.lit(b).alias("h")) for a, b in
                               zip(self.getOrDefault(self.means)[part], self.getOrDefault(self.halves)[part])])
            terms = F.zip_with(x, fitted, lambda v, f: (v - f["m"]) * (v - f["m"]) * f["h"])
            score = F.aggregate(terms, F.lit(const), lambda a, b: a - b)
            scores.append(F.struct(score.alias("s"), F.lit(-c).alias("c")))     # ties: the smaller label
        best = F.array_max(F.array(*scores)) if len(scores) > 1 else scores[0]
        return df.withColumn(self.getPredictionCol(), -best["c"])


class KNearest(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Majority label of the ``k`` nearest training rows; ties: the smaller label."""

    k = Param(Params._dummy(), "k", "neighbours", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", k: int = 5):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", k=5)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "KNearestModel":
        from raremine.session import written

        rows = df.select(F.monotonically_increasing_id().alias("id"), F.col(self.getLabelCol()).cast("double").alias("label"),
                         vector_to_array(self.getFeaturesCol()).alias("v"))
        model = KNearestModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), k=self.getOrDefault(self.k))
        model.rows = written(rows, "knn-rows")
        return model._resetUid(self.uid)


class KNearestModel(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    k = Param(Params._dummy(), "k", "neighbours", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", predictionCol: str = "prediction", k: int = 5):
        super().__init__()
        self._set(**self._input_kwargs)
        self.rows: DataFrame | None = None

    def _transform(self, df: DataFrame) -> DataFrame:
        from raremine.operators.neighbors import knn_vote
        from raremine.session import written

        # ids of the rows must not change between the search and the join
        asked = written(df.withColumn("_row", F.monotonically_increasing_id()), "knn-queries")
        test = asked.select(F.col("_row").alias("id"), F.lit(0.0).alias("label"), vector_to_array(self.getFeaturesCol()).alias("v"))
        votes = knn_vote(test, self.rows, self.getOrDefault(self.k), "id", "label", "v")
        return asked.join(votes.select(F.col("id").alias("_row"), F.col("prediction").alias(self.getPredictionCol())), "_row").drop("_row")

    def copy(self, extra=None):
        that = super().copy(extra)
        that.rows = self.rows
        return that

    def write(self):
        return _KNearestWriter(self)

    @classmethod
    def read(cls):
        return _KNearestReader(cls)


class _KNearestWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.rows.write.parquet(f"{path}/rows")


class _KNearestReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.rows = self.sparkSession.read.parquet(f"{path}/rows")
        return model
