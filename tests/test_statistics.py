import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewarden.functions.pvalues import chi2_sf, kolmogorov_sf, touching_share
from tablewarden.operators import drift
from tablewarden.operators.evaluate import binary_metrics, compare_gate, gate_decision, roc_auc, select_best


def exact_ks_cdf(n: int, d: float) -> float:
    """Marsaglia, Tsang and Wang (2003): exact distribution of the one-sample distance."""
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    H = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
    for i in range(m):
        H[i, 0] -= h ** (i + 1)
        H[m - 1, i] -= h ** (m - i)
    H[m - 1, 0] += (2 * h - 1) ** m if 2 * h - 1 > 0 else 0
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                H[i, j] /= math.factorial(i - j + 1)
    # Powers by squaring, with the factor n!/n^n taken along.
    scale, Q = 0, np.linalg.matrix_power(H / 1.0, 1)
    R = np.eye(m)
    e = n
    while e:
        if e & 1:
            R = R @ Q
            if R.max() > 1e140:
                R, scale = R * 1e-140, scale + 140
        Q = Q @ Q
        if Q.max() > 1e140:
            # keep exponents small by undoing the scale at the end
            Q = Q * 1e-140
            scale += 140 * ((e >> 1))
        e >>= 1
    logp = math.log(R[k - 1, k - 1]) + scale * math.log(10) + math.lgamma(n + 1) - n * math.log(n)
    return math.exp(logp)


def test_kolmogorov_against_exact(spark):
    n = 1000
    grid = [0.02, 0.03, 0.04, 0.05]
    # Sizes whose effective size is n.
    rows = spark.createDataFrame([(d, 2 * n, 2 * n) for d in grid], "d double, n long, m long")
    got = [r[0] for r in rows.select(kolmogorov_sf(F.col("d"), F.col("n"), F.col("m"), 0)).collect()]
    for p, d in zip(got, grid, strict=True):
        assert p == pytest.approx(1 - exact_ks_cdf(n, d), abs=3e-5)


def paths_touching(n, m, gap):
    """Count of all lattice paths that reach the gap, one path after the other."""
    return sum(
        any(abs(x * m - y * n) >= gap for x, y in zip(xs, ys, strict=True))
        for right in itertools.combinations(range(n + m), n)
        for xs in [np.cumsum([0] + [k in right for k in range(n + m)])] for ys in [np.arange(n + m + 1) - xs])


@pytest.mark.parametrize(("n", "m"), [(1, 1), (4, 4), (3, 7), (6, 5), (8, 2)])
def test_exact_kolmogorov_counts_paths(n, m):
    for gap in range(1, n * m + 1):
        assert touching_share(n, m, gap) == pytest.approx(paths_touching(n, m, gap) / math.comb(n + m, n), rel=1e-12)


def test_exact_kolmogorov_and_its_limit(spark):
    # Equal sizes have a closed form: 2 sum (-1)^(i+1) C(2n, n - i k) / C(2n, n).
    n, k = 500, 60
    closed = 2 * sum((-1) ** (i + 1) * math.comb(2 * n, n - i * k) / math.comb(2 * n, n) for i in range(1, n // k + 1))
    rows = spark.createDataFrame([(k / n, n, n), (1.0, 4000, 4000), (0.02, 10_001, 9_000), (None, 5, 5)], "d double, n long, m long")
    got = [r[0] for r in rows.select(kolmogorov_sf(F.col("d"), F.col("n"), F.col("m"))).collect()]
    series = [r[0] for r in rows.select(kolmogorov_sf(F.col("d"), F.col("n"), F.col("m"), 0)).collect()]
    assert got[0] == pytest.approx(closed, rel=1e-10) and got[0] == pytest.approx(series[0], rel=0.1)
    assert got[2] == series[2] and got[3] is None  # beyond the switch; no distance
    assert 0 <= got[1] < 1e-300


def test_chi2_critical_values(spark):
    known = [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251179, 3), (9.487729036781154, 4), (18.307038053275146, 10), (124.34211340400407, 100)]
    rows = spark.createDataFrame(known, "x double, dof int")
    for r in rows.select(chi2_sf(F.col("x"), F.col("dof")).alias("p")).collect():
        assert r["p"] == pytest.approx(0.05, abs=1e-9)
    tail = spark.createDataFrame([(100.0, 1), (0.0, 3), (5.0, 0), (80.0, 2)], "x double, dof int")
    got = [r["p"] for r in tail.select(chi2_sf(F.col("x"), F.col("dof")).alias("p")).collect()]
    assert got[0] == pytest.approx(math.erfc(math.sqrt(50)), rel=1e-9)
    assert got[1:] == [1.0, 1.0, pytest.approx(math.exp(-40), rel=1e-9)]


def test_yates_and_degenerate(spark):
    rows = [(True, "a")] * 10 + [(True, "b")] * 20 + [(False, "a")] * 20 + [(False, "b")] * 15
    df = spark.createDataFrame(rows, "ref boolean, c string").withColumn("one", F.lit("x"))
    got = {r["feature"]: r for r in drift.chi2_drift(df, ["c", "one"], "ref").collect()}
    table = np.array([[10, 20], [20, 15]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    want = ((np.abs(table - expected) - 0.5) ** 2 / expected).sum()
    assert got["c"]["statistic"] == pytest.approx(want) and got["c"]["dof"] == 1
    assert (got["one"]["statistic"], got["one"]["p_value"], got["one"]["drift_detected"]) == (0.0, 1.0, False)


def test_ks_same_sample_and_skipped_feature(spark):
    df = spark.range(100).select(
        (F.col("id") % 2 == 0).alias("ref"), F.floor(F.col("id") / 2).cast("double").alias("same"),
        F.when(F.col("id") % 2 == 0, 1.0).alias("one_sided"))
    got = drift.ks_drift(df, ["same", "one_sided"], "ref").collect()
    assert [(r["feature"], r["statistic"], r["p_value"]) for r in got] == [("same", 0.0, 1.0)]


def test_auc_reversal_and_single_class(spark):
    df = spark.range(500).select((F.rand(3) > 0.6).cast("int").alias("y"), F.round(F.rand(4), 1).alias("s"))
    a = roc_auc(df, "y", "s").first()["auc"]
    b = roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first()["auc"]
    assert a + b == pytest.approx(1.0)
    assert roc_auc(df.where("y = 1"), "y", "s").first()["auc"] is None


def test_zero_division(spark):
    row = binary_metrics(spark.createDataFrame([(0, 0), (1, 0)], "y int, p int"), "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_gate_is_strict(spark):
    base = spark.createDataFrame([("accuracy", 0.75), ("auc", 0.5)], "metric string, value double")
    edge = spark.createDataFrame([("accuracy", 0.73), ("auc", 0.5), ("f1", 0.4)], "metric string, value double")
    threshold = 0.75 - 0.73
    found = compare_gate(base, edge, threshold)
    assert gate_decision(found).first()["approved"] is True
    worse = gate_decision(compare_gate(base, edge.where("metric = 'f1'"), threshold)).first()
    assert worse["approved"] is False and worse["reasons"] == ["accuracy degraded by 0.7500", "auc degraded by 0.5000"]


def test_best_takes_first_name_on_tie(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model string, auc double")
    assert select_best(df).first()["model"] == "a"
    with pytest.raises(ValueError):
        select_best(df, "loss")


def test_performance_threshold_is_strict(spark):
    base = spark.createDataFrame([("auc", 0.5), ("f1", 0.0)], "metric string, value double")
    now = spark.createDataFrame([("auc", 0.48), ("f1", 0.1), ("accuracy", 0.3)], "metric string, value double")
    got = {r["metric"]: r for r in drift.performance_drift(base, now).collect()}
    assert got["auc"]["exceeded"] == (0.5 - 0.48 > 0.02)
    assert got["f1"]["degradation_pct"] == 0.0 and got["accuracy"]["baseline"] == 0.3


def test_no_features_is_no_drift(spark):
    none = spark.createDataFrame([], "feature string, type string, statistic double, p_value double, drift_detected boolean")
    perf = spark.createDataFrame([("auc", False)], "metric string, exceeded boolean")
    row = drift.drift_decision(none, perf).first()
    assert (row["drift_pct"], row["drift_detected"], row["reasons"]) == (0.0, False, [])
