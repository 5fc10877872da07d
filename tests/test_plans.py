"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tablewarden.catalog.views import labelled, request, subject
from tablewarden.operators.evaluate import roc_auc
from tablewarden.operators.features import engineer_features
from tablewarden.plans import prepare
from tablewarden.plans.training import score_rows, vectors
from tablewarden.operators.models import fit_logistic
from tablewarden.spec import SUBJECT
from tablewarden.session import materialize


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def done(spark, sf_dir):
    return prepare.run(materialize(subject(spark, sf_dir), "subject"), SUBJECT, validate=False)


def test_parts_read_their_own_folder(done):
    text = plan(done.test)
    assert "PartitionFilters: [isnotnull(split" in text
    assert text.count("Exchange") == 1  # the duplicate removal


def test_fit_never_reads_other_parts(done, spark):
    train = done.features.where("split = 'train'").drop("split")
    broken = done.features.withColumn("cost", F.when(F.col("split") == "train", F.col("cost")).otherwise(1e12))
    again = prepare.fit(broken.where("split = 'train'").drop("split"), SUBJECT, maxima=done.state.maxima)
    want = prepare.fit(train, SUBJECT, maxima=done.state.maxima)
    for c, pair in want.scaler.items():
        assert again.scaler[c] == pytest.approx(pair)


def test_scoring_is_a_map(done, spark, sf_dir):
    train = vectors(done.raw_parts("train"), SUBJECT, done.state, dedup=True)
    rows = materialize(subject(spark, sf_dir).drop("outcome"), "requests")
    scored = score_rows(rows, SUBJECT, done.state, fit_logistic(train, max_iter=3))
    assert "Exchange" not in plan(scored) and "Join" not in plan(scored)
    assert scored.count() == rows.count()


def test_no_single_partition_sort_in_ranks(spark, sf_dir):
    text = plan(roc_auc(labelled(request(spark, sf_dir)), "label", "probability"))
    # One window over the small range totals; every other window is partitioned by range.
    assert text.count("Window") >= 2 and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_feature_scan_is_pruned(spark, sf_dir):
    rows = materialize(subject(spark, sf_dir), "subject")
    text = plan(engineer_features(rows, SUBJECT, only=["cost_per_mm"]).select("cost_per_mm"))
    assert "ReadSchema: struct<size_mm:double,cost:double>" in text


@pytest.mark.parametrize("options", [
    {"scaling": "robust", "strategy": "median"}, {"scaling": "minmax", "encoding": "label"},
    {"encoding": "target", "strategy": "drop"}, {"parity": True},
], ids=str)
def test_options(spark, sf_dir, options):
    strategy = options.get("strategy")
    rows = materialize(subject(spark, sf_dir), "subject")
    found = prepare.run(rows, SUBJECT, **options)
    n = {name: df.count() for name, df in found.frames().items()}
    assert n["train"] > n["test"] > n["val"] > 0
    assert found.report.count() == 7
    path_state = found.state
    if strategy == "drop":
        assert path_state.fill == {}


@pytest.mark.parametrize("encoding", ["onehot", "label", "target"])
def test_state_round_trip(spark, sf_dir, tmp_path, encoding):
    done = prepare.run(materialize(subject(spark, sf_dir), "subject"), SUBJECT, validate=False, encoding=encoding)
    done.state.save(spark, str(tmp_path))
    back = prepare.PrepState.load(spark, str(tmp_path))
    raw = done.raw_parts("test")
    assert prepare.transform(raw, SUBJECT, back).exceptAll(prepare.transform(raw, SUBJECT, done.state)).isEmpty()
    assert back.feature_names == done.state.feature_names
    assert [c for c in done.train.columns if c != "outcome"] == back.feature_names
