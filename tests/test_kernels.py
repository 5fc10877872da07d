"""Random Fourier features against their formula."""

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array

from tablewarden.operators import kernels


def test_rows_are_lifted_by_whole_buffers(spark, monkeypatch):
    """No pandas objects per row (F8): batches go in and out as Arrow buffers, empty ones too."""
    monkeypatch.setattr(kernels.F, "pandas_udf", None)
    x = np.random.default_rng(3).normal(size=(50, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").repartition(7).select(
        "id", array_to_vector("x").alias("features"))
    lift = kernels.RandomFourierFeatures(inputCol="features", outputCol="lifted", gamma=0.3, width=16, seed=9)
    got = {r["id"]: r["v"] for r in lift.transform(df).select("id", vector_to_array("lifted").alias("v")).collect()}
    rng = np.random.default_rng(9)
    weights, offset = rng.normal(0.0, np.sqrt(0.6), (5, 16)), rng.uniform(0.0, 2.0 * np.pi, 16)
    want = np.sqrt(2.0 / 16) * np.cos(x @ weights + offset)
    assert len(got) == 50 and np.allclose([got[i] for i in range(50)], want, rtol=0, atol=1e-12)
    assert lift.transform(df.where("id < 0")).count() == 0
