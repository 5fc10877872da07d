from tablewarden.operators import scoring
from tablewarden.operators.features import engineer_features, right_closed_bins
from tablewarden.spec import AGE_BINS, PATIENT, SIZE_BINS, SUBJECT
from pyspark.sql import functions as F


def test_bin_edges(spark):
    rows = spark.createDataFrame([(v,) for v in (0.0, 0.1, 40.0, 40.5, 150.0, 150.5, None)], "v double")
    got = [r[0] for r in rows.select(right_closed_bins(F.col("v"), AGE_BINS)).collect()]
    assert got == [None, "30-40", "30-40", "40-50", "70+", None, None]
    sizes = spark.createDataFrame([(v,) for v in (20.0, 60.0, 100.0, 100.1)], "v double")
    assert [r[0] for r in sizes.select(right_closed_bins(F.col("v"), SIZE_BINS)).collect()] == [
        "Small", "Large", "Very_Large", None]


def test_scores_with_missing_columns_and_nulls(spark):
    rows = spark.createDataFrame(
        [("Normal", "Low", "Yes", 1), ("Obese", None, None, 0), ("Other", "High", "No", 1)],
        "bmi string, diet string, smoking string, diabetes int")
    got = engineer_features(rows, SUBJECT).collect()
    assert [r["lifestyle_score"] for r in got] == [2.0, None, None]
    assert [r["risk_score"] for r in got] == [2, 0, 1]
    assert "age_group" not in got[0] and "cost_per_mm" not in got[0]


def test_patient_names(spark):
    rows = spark.createDataFrame([(50, 40.0, 82.0, "Regional")], "Age int, Tumor_Size_mm double, Healthcare_Costs double, Cancer_Stage string")
    got = engineer_features(rows, PATIENT).first()
    assert (got["age_group"], got["tumor_severity"], got["age_tumor_interaction"], got["cost_per_mm"], got["stage_severity_score"]) == (
        "40-50", "Medium", 1.0, 2.0, 2)


def test_fitted_maxima_make_a_map(spark):
    rows = spark.createDataFrame([(50, 40.0)], "age int, size_mm double")
    got = engineer_features(rows, SUBJECT, {"age": 100, "size": 80.0}, only=["age_tumor_interaction"])
    assert got.first()["age_tumor_interaction"] == 0.25
    assert "Exchange" not in got._jdf.queryExecution().toString()


def test_zero_maximum_is_null(spark):
    rows = spark.createDataFrame([(0, 0.0)], "age int, size_mm double")
    assert engineer_features(rows, SUBJECT).first()["age_tumor_interaction"] is None


def test_tier_edges(spark):
    p = spark.createDataFrame([(v,) for v in (0.8, 0.81, 0.2, 0.19, 0.6, 0.61, 0.4, 0.39, 0.5, None)], "p double")
    assert [r[0] for r in p.select(scoring.confidence_tier(F.col("p"))).collect()] == [
        "Medium", "High", "Medium", "High", "Low", "Medium", "Low", "Medium", "Low", None]


def test_risk_factors_in_order(spark):
    rows = spark.createDataFrame(
        [("Metastatic", "Yes", "No", 50.0, "No"), (None, None, None, 51.0, None)],
        "stage string, family_history string, smoking string, size_mm double, early_detection string")
    got = [r[0] for r in rows.select(scoring.risk_factors(rows, SUBJECT)).collect()]
    assert got == [["Advanced cancer stage", "Family history present", "Late detection"], ["Large tumor size"]]
