import pytest
from pyspark.sql import functions as F

from tablewarden.config import Settings
from tablewarden.session import scratch_path, shared_dir
from tablewarden.sources import runlog, tables
from tablewarden.spec import PATIENT


def test_missing_words_in_typed_columns(spark, tmp_path):
    (tmp_path / "d.csv").write_text('id,n,f,s\n1,NA,1.5,"a, ""b"""\n2,7,null,None\n3,,nan,N/A\n')
    got = tables.read_csv(spark, str(tmp_path / "d.csv"))
    assert dict(got.dtypes) == {"id": "bigint", "n": "bigint", "f": "double", "s": "string"}
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, None, 1.5, 'a, "b"'), (2, 7, None, None), (3, None, None, None)]


def test_inference_casts_no_words(spark, tmp_path):
    """Texts that can't be numbers are told by their first letters; a failing cast throws an exception for every cell."""
    cells = ["Yes", "Infinity", "-inf", "NaN ", "12.0", "1e3", " 7 ", "\t1.5", "+4", "0x1p3", "1.5d", "Info", "nano", "é1", ":1", "~"]
    rows = "".join(f'{i},"{c}"\n' for i, c in enumerate(cells))
    (tmp_path / "d.csv").write_text("id,s\n" + rows)
    raw = tables._raw_csv(spark, str(tmp_path / "d.csv"), None, False)
    got = raw.select("s", tables._may_be_number(F.col("s")).alias("may"), F.col("s").try_cast("double").isNotNull().alias("is")).collect()
    assert len(got) == len(cells) and all(r["may"] for r in got if r["is"])
    assert [r["s"] for r in got if r["may"] and not r["is"]] == ["Info", "nano"]
    for i, c in enumerate(cells):  # each text alone in its column gets the type that its casts give
        (tmp_path / f"{i}.csv").write_text(f'id,s\n1,"{c}"\n')
    one = {c: dict(tables.read_csv(spark, str(tmp_path / f"{i}.csv")).dtypes)["s"] for i, c in enumerate(cells)}
    assert {c for c, t in one.items() if t == "string"} == {"Yes", "Info", "nano", "é1", ":1", "~"}
    assert {c for c, t in one.items() if t == "bigint"} == {" 7 ", "+4"}


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, "/tmp/there-is-no-such-file.csv")


def test_split_read_prunes_folders(spark):
    path = scratch_path(spark, "t")
    tables.write_splits(spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test")), path)
    test = tables.read_split(spark, path, "test")
    assert test.count() == 3
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()
    assert tables.feature_names(spark, path, ["split"]) == ["id"]


def test_baseline_is_started_once_and_overwritten(spark):
    path = scratch_path(spark, "baseline")
    first = spark.createDataFrame([("auc", 0.9)], "metric string, value double")
    second = spark.createDataFrame([("auc", 0.5)], "metric string, value double")
    assert tables.load_or_start_baseline(first, path).first()["value"] == 0.9
    assert tables.load_or_start_baseline(second, path).first()["value"] == 0.9
    tables.overwrite_baseline(second, path, "knn", ["Feature drift: 20.0%"])
    row = spark.read.parquet(path).first()
    assert (row["value"], row["model_name"], row["retrained_due_to"]) == (0.5, "knn", ["Feature drift: 20.0%"])


def test_run_log_appends(spark):
    path = scratch_path(spark, "runs")
    for i, name in enumerate(("a", "b")):
        with runlog.RunLog(spark, path, name) as log:
            log.params({"k": 1})
            log.metrics({"auc": i / 2})
    got = runlog.pivot_metrics(runlog.read_runs(spark, path), ["auc", "f1"]).orderBy("run_name").collect()
    assert [tuple(r) for r in got] == [("a", 0.0, None), ("b", 0.5, None)]


def test_rows_without_a_commit_are_not_read(spark):
    path = scratch_path(spark, "runs")
    found = spark.createDataFrame([("a", 5, 0.5, None), ("b", 7, 0.25, 1.0)], "model string, n long, auc double, f1 double")
    runlog.append_runs(found, path, "model", ["n"], ["auc", "f1"])
    runlog.read_runs(spark, path).write.parquet(f"{path}/rows/batch=died")  # written, never committed
    log = runlog.read_runs(spark, path)
    assert log.count() == 6 and log.select("run_id").distinct().count() == 2
    got = runlog.pivot_metrics(log, ["auc", "f1"]).orderBy("run_name").collect()
    assert [tuple(r) for r in got] == [("a", 0.5, None), ("b", 0.25, 1.0)]
    assert {r["value_str"] for r in log.where("kind = 'param'").collect()} == {"5", "7"}


def test_rescued_cells(spark, tmp_path):
    (tmp_path / "d.csv").write_text('id,n,f,s\n1,NA,1.5,x\n2,7.5,null,None\n3,"a, b",nan,y\n4,8\n5,9,1,z,extra\n,x,2,w\n')
    schema = spark.createDataFrame([], "id long, n int, f double, s string").schema
    typed, rescued = tables.read_csv_rescued(spark, str(tmp_path / "d.csv"), schema, "id")
    assert typed.schema == schema and typed.count() == 6
    got = sorted((str(r["row"]), str(r["column"]), r["raw"]) for r in rescued.collect())
    assert got == [("2", "n", "7.5"), ("3", "n", "a, b"), ("4", "None", "4,8"), ("5", "None", "5,9,1,z,extra"), ("None", "n", "x")]
    assert {r["column"]: r["cells"] for r in tables.rescued_counts(rescued).collect()} == {"n": 3, None: 2}


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("features:\n  target: y\n  numerical: [a]\nmonitoring:\n  drift_threshold: 0.01\n")
    found = Settings.from_yaml(str(path))
    assert found.get("features.target") == "y" and found.get("a.b", 3) == 3
    assert found.table_spec().numerical == ("a",) and found.table_spec().categorical == PATIENT.categorical
    assert found.thresholds().drift_p_value == 0.01
    with pytest.raises(FileNotFoundError):
        Settings.from_yaml(str(tmp_path / "none.yaml"))


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
