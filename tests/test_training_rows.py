"""Training rows are made distinct once, in tasks of bounded size (F13, F14)."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewarden.catalog.views import subject
from tablewarden.operators.split import HashOrder
from tablewarden.plans import prepare
from tablewarden.plans.training import stored_vectors, vectors
from tablewarden.session import materialize, parts_for
from tablewarden.spec import SUBJECT


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    """Subjects, a third of them three times under further ids, with nulls and zeros of both signs."""
    base = subject(spark, sf_dir).withColumn("rate_a", F.when(F.col("subject_id") % 7 == 0, None).otherwise(F.col("rate_a")))
    copies = base.where("subject_id % 3 = 0")
    out = base.withColumn("rate_b", F.when(F.col("rate_b") == 0, -0.0).otherwise(F.col("rate_b")))
    for i in (1, 2):
        out = out.unionAll(copies.withColumn("subject_id", F.col("subject_id") + 1_000_000 * i))
    return materialize(out, "subject")


def listed(df):
    cells = df.select("id", "label", vector_to_array("features").alias("v")).collect()
    return {r["id"]: (r["label"], tuple(round(x, 9) for x in r["v"])) for r in cells}


@pytest.mark.parametrize("part", ["train", "test"])
def test_stored_rows_give_the_same_vectors(rows, part):
    plain, stored = (prepare.run(rows, SUBJECT, validate=False, store_rows=s) for s in (False, True))
    assert plain.state.distinct is None
    want = vectors(plain.raw_parts(part), SUBJECT, plain.state, dedup=True)
    got = stored_vectors(stored, part, SUBJECT)
    assert want.count() == got.count() < plain.raw_parts(part).count()
    assert listed(got) == listed(want)
    assert stored.state.feature_names == plain.state.feature_names


def test_duplicates_are_removed_once(rows):
    done = prepare.run(rows, SUBJECT, validate=False, store_rows=True)
    text = plan(vectors(done.state.distinct, SUBJECT, done.state))
    assert "Exchange" not in text and "Aggregate" not in text


def test_equal_rows_meet_without_a_first_pass_over_files(rows, spark):
    done = prepare.run(rows, SUBJECT, validate=False)
    text = plan(vectors(done.raw_parts("test"), SUBJECT, done.state, dedup=True, rows=10_000_000))
    assert text.count("Exchange") == 1
    assert f"{parts_for(spark, 10_000_000)}), REPARTITION_BY_NUM" in text
    below = text[text.index("Exchange"):]
    assert "Aggregate" not in below


def test_cuts_are_sent_to_the_rows(rows, monkeypatch):
    from tablewarden.operators import split

    seen = []
    monkeypatch.setattr(split, "materialize", lambda df, name, *args: seen.append((name, df)) or materialize(df, name, *args))
    HashOrder(rows, "outcome", "subject_id", 42).cuts({"Yes": (5, 9), "No": (3, 0)})
    text = plan(dict(seen)["cuts"])
    held = next(line for line in text.splitlines() if "Join" in line and "b_#" in line)
    assert "BroadcastHashJoin" in held
