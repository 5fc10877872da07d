import pytest
from pyspark.sql import functions as F

from tablewarden.operators import clean, encode, scale, validate
from tablewarden.spec import TableSpec

SPEC = TableSpec(numerical=("a", "b"), categorical=("c", "f"), target="y", drop=("id",), binary=("f", "y"), roles={"outcome": "y"})


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, 1.0, 5.0, "x", "Yes", "Yes"), (2, 2.0, 5.0, "y", "No", "No"), (3, 4.0, 5.0, None, None, "No"), (4, None, 5.0, "z", "Yes", "Yes"),
         (5, 10.0, None, "y", "No", "No"), (6, 3.0, 5.0, "x", "No", "No")],
        "id int, a double, b double, c string, f string, y string")


def test_mean_median_mode_ties(rows):
    assert clean.fit_fill_values(rows, SPEC)["a"] == 4.0
    assert clean.fit_fill_values(rows, SPEC, "median")["a"] == 3.0
    fill = clean.fit_fill_values(rows, SPEC, "mode")
    assert fill["a"] == 4.0 and fill["c"] == "x"  # x and y tie; the smaller one wins
    assert clean.handle_missing(rows, SPEC, "drop").count() == 3


def test_even_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "a double")
    assert clean.numeric_medians(df, ["a"]) == {"a": 3.0}


def test_scalers(rows):
    center, spread = scale.fit_scaler(rows, ["a", "b"])["a"]
    assert center == 4.0 and spread == pytest.approx((50 / 5) ** 0.5)
    assert scale.fit_scaler(rows, ["b"])["b"] == (5.0, 1.0)
    flat = scale.apply_scaler(rows, scale.fit_scaler(rows, ["b"], "minmax")).select("b").distinct().collect()
    assert {r["b"] for r in flat} == {0.0, None}
    q = scale.fit_scaler(rows.sparkSession.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "a double"), ["a"], "robust")
    assert q["a"] == (3.0, 3.75)
    back = scale.undo_scaler(scale.apply_scaler(rows, {"a": (4.0, 3.0)}), {"a": (4.0, 3.0)})
    assert [r["a"] for r in back.orderBy("id").collect()] == pytest.approx([1.0, 2.0, 4.0, None, 10.0, 3.0][:3] + [None, 10.0, 3.0])


def test_binary_null_is_zero(rows):
    assert [r["f"] for r in encode.encode_binary(rows, SPEC).orderBy("id").collect()] == [1, 0, 0, 1, 0, 0]


def test_onehot_unseen_and_odd_names(spark):
    train = spark.createDataFrame([("it's",), ("a.b",), (None,)], "c string")
    levels = encode.fit_levels(train, ["c"])
    got = encode.encode_onehot(spark.createDataFrame([("it's",), ("new",), (None,)], "c string"), levels)
    assert got.columns == ["c_a.b", "c_it's"]
    assert [tuple(r) for r in got.collect()] == [(False, True), (False, False), (False, False)]


@pytest.mark.parametrize("limit", [2000, 1])
def test_label_codes_literal_and_joined(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(encode, "MAX_LITERAL_CODES", limit)
    codes = encode.fit_label_codes(rows, ["c", "f"])
    got = encode.apply_codes(rows, codes, ["c", "f"]).orderBy("id").collect()
    assert [r["c"] for r in got] == [0, 1, None, 2, 1, 0]
    with pytest.raises(Exception, match="unseen value in c"):
        encode.apply_codes(spark.createDataFrame([("q",)], "c string"), codes, ["c"]).collect()


def test_target_means(spark, rows):
    codes = encode.fit_target_means(rows, ["c"], (F.col("y") == "Yes").cast("int"))
    got = encode.apply_codes(rows, codes, ["c"], unseen="null").orderBy("id").collect()
    assert [r["c"] for r in got] == [0.5, 0.0, None, 1.0, 0.0, 0.5]


def test_many_levels(spark):
    df = spark.range(6000).select(F.col("id").cast("string").alias("c"))
    levels = encode.fit_levels(df, ["c"])
    assert len(levels["c"]) == 6000
    got = encode.encode_onehot(df.where("c = '5999'"), levels)
    assert len(got.columns) == 6000
    assert [c for c, v in got.first().asDict().items() if v] == ["c_5999"]


@pytest.mark.parametrize("limit", [2000, 1])
def test_codes_keep_their_type(spark, monkeypatch, limit):
    monkeypatch.setattr(encode, "MAX_LITERAL_CODES", limit)
    df = spark.createDataFrame([("x", None), ("y", None)], "c string, nothing string")
    got = encode.apply_codes(df, encode.fit_label_codes(df, ["c", "nothing"]), ["c", "nothing"])
    assert got.dtypes == [("c", "bigint"), ("nothing", "bigint")]
    assert sorted(r["c"] for r in got.collect()) == [0, 1]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(30.0,), (float("nan"),), (50.0,), (None,)], "a double")
    assert clean.numeric_means(df, ["a"]) == {"a": 40.0}
    assert clean.numeric_medians(df, ["a"]) == {"a": 40.0}
    assert sorted(r["a"] for r in clean.fill_missing(df, {"a": 40.0}).collect()) == [30.0, 40.0, 40.0, 50.0]
    assert validate.validate_missing(df).first()["n"] == 2


def test_duplicates_and_report(spark, rows):
    twice = rows.unionAll(rows)
    assert validate.duplicate_count(twice).first()["n"] == 6
    assert clean.remove_duplicates(twice).count() == 6
    report = {r["check"]: r["ok"] for r in validate.validation_report(rows, SPEC).collect()}
    assert report == {"schema": True, "missing": False, "duplicates": True, "dtypes": True, "ranges": True, "domain": True, "overall": False}


def test_clean_table_passes(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "x", "Yes", "Yes")], "id int, a double, b double, c string, f string, y string")
    assert all(r["ok"] for r in validate.validation_report(df, SPEC).collect())


def test_level_index_of_many_levels(spark):
    """A hundred thousand levels, a hot one and a null: positions equal the ranks, and no level reaches the plan."""
    df = spark.range(200_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None)
        .otherwise(F.concat(F.lit("v"), (F.col("id") % 100_000).cast("string"))).alias("a"), (F.col("id") % 7).cast("string").alias("b"))
    index = encode.fit_level_index(df, ["a", "b"])
    rows = df.select("a", "b").toPandas()
    a, b = (sorted(rows[c].dropna().unique()) for c in "ab")
    want = {("a", v): i for i, v in enumerate(a)} | {("b", v): len(a) + i for i, v in enumerate(b)}
    assert {(r["column"], r["value"]): r["index"] for r in index.collect()} == want and len(want) > 60_000
    got = encode.encode_onehot_indices(df, "id", ["a", "b"], index)
    assert "v99" not in got._jdf.queryExecution().optimizedPlan().toString()
    picked = {r["id"]: list(r["indices"]) for r in got.where("id % 997 = 4 or id = 1001").collect()}
    for i, found in picked.items():
        own = [want["a", rows.a[i]]] if rows.a[i] is not None else []
        assert found == [*own, want["b", rows.b[i]]]
    assert got.count() == 200_000 and [len(picked[1001])] == [1]
    unseen = spark.createDataFrame([(1, "new", None)], "id long, a string, b string")
    assert encode.encode_onehot_indices(unseen, "id", ["a", "b"], index).first()["indices"] == []


def test_too_many_levels_for_columns(spark, monkeypatch):
    monkeypatch.setattr(encode, "MAX_WIDE_LEVELS", 5)
    df = spark.range(6).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="encode_onehot_indices"):
        encode.fit_levels(df, ["c"])
