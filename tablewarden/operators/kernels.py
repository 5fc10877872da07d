"""Random Fourier features (Rahimi and Recht 2007) for a scalable RBF-kernel SVM."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """sqrt(2/D) cos(x W + b): inner products approximate exp(-gamma |x - y|^2)."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "number of features D", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=1.0, width=256, seed=42):
        super().__init__()
        self._setDefault(gamma=1.0, width=256, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, width = self.getOrDefault(self.gamma), self.getOrDefault(self.width)
        seed = self.getOrDefault(self.seed)

        @F.arrow_udf("array<double>")
        def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            weights = offset = None
            for vec in batches:
                # Whole buffers in and out: no object per row.
                x = vec.flatten().to_numpy().reshape(len(vec), -1) if len(vec) else np.zeros((0, 1))
                if weights is None and len(x):
                    rng = np.random.default_rng(seed)
                    weights = rng.normal(0.0, np.sqrt(2.0 * gamma), (x.shape[1], width))
                    offset = rng.uniform(0.0, 2.0 * np.pi, width)
                lifted = np.sqrt(2.0 / width) * np.cos(x @ weights + offset) if len(x) else np.zeros((0, width))
                ends = np.arange(len(x) + 1, dtype=np.int32) * width
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(lifted.ravel()))

        vec = project(vector_to_array(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(vec))


def scale_gamma(df: DataFrame, features: str) -> float:
    """1 / (number of features * variance of all feature values)."""
    s = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(features)).alias("s")).select(
        "s.mean", "s.variance", "s.count").first()
    mean, n = s["mean"].toArray(), s["count"]
    square = s["variance"].toArray() * (n - 1) / n + mean**2
    spread = square.mean() - mean.mean() ** 2
    return 1.0 / (len(mean) * spread) if spread > 0 else 1.0 / len(mean)
