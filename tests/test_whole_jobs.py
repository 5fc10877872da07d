"""Registered queries do every step that they name (F11, F12)."""

import inspect

import numpy as np
import pytest

from tablewarden.catalog import load
from tablewarden.catalog.registry import QUERIES
from tablewarden.catalog.views import subject
from tablewarden.operators import scoring
from tablewarden.operators.models import FULL_SUITE, QUICK_SUITE
from tablewarden.plans import monitoring, training
from tablewarden.spec import SUBJECT

load()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Tables with 1,200 orders of 60 customers, one order without lines and nulls among the values."""
    path, rng = tmp_path_factory.mktemp("tables"), np.random.default_rng(6)

    def store(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")

    store("nation", [(i, f"n{i}", i % 5) for i in range(6)], "n_nationkey int, n_name string, n_regionkey int")
    store("customer", [(i, i % 6, "BUILDING" if i % 4 else "MACHINERY") for i in range(60)], "c_custkey long, c_nationkey int, c_mktsegment string")
    store("orders", [
        (i, int(rng.integers(60)), "FOP"[i % 3], float(rng.integers(1000, 9000)), ("1-URGENT", "2-HIGH", "5-LOW", None)[i % 4])
        for i in range(1200)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    store("lineitem", [
        (i, float(rng.integers(1, 51)), None if i % 9 == 0 else i % 10 / 100, i % 8 / 100)
        for i in range(1199)], "l_orderkey long, l_quantity double, l_discount double, l_tax double")
    store("events", [
        (i, f"2024-01-{1 + i % 28:02d} {i % 24:02d}:00:00", i % 20, ("click", "view", "error")[i % 3], float(rng.normal(40, 9)))
        for i in range(600)], "event_id long, ts string, user_id long, event_type string, value double")
    return str(path)


def test_streamed_answers_carry_risk_factors(spark, tables):
    got = {r["subject_id"]: r["risk_factors"] for r in QUERIES["stream_score"](spark, tables).collect()}
    rows = subject(spark, tables)
    want = {r[0]: "; ".join(r[1]) for r in rows.select("subject_id", scoring.risk_factors(rows, SUBJECT)).collect()}
    assert len(got) > 900 and len(set(got.values())) > 5
    assert got == {i: want[i] for i in got}
    batch = {r["subject_id"]: r["risk_factors"] for r in QUERIES["score_batch"](spark, tables).collect()}
    assert got == {i: batch[i] for i in got}


def test_continuous_training_trains_all_models_with_folds(spark, tables, monkeypatch):
    asked = {}

    class Asked(Exception):
        pass

    def record(*args, **kwargs):
        found = inspect.signature(training.train_suite).bind(*args, **kwargs)
        found.apply_defaults()
        asked.update(found.arguments)
        raise Asked

    monkeypatch.setattr(monitoring, "train_suite", record)
    with pytest.raises(Asked):
        QUERIES["continuous_training"](spark, tables)
    assert (asked["suite"] or (QUICK_SUITE if asked["quick"] else FULL_SUITE)) == FULL_SUITE
    assert asked["cv"] == 5 and asked["train"].count() > 500
