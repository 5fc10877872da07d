"""Training, cross-validation, scoring and continuous training.

Learned models have no SQL to compare with; nearest neighbours do.
"""

from __future__ import annotations

import functools

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.catalog.data import worded
from tablewarden.catalog.drift import _DECISION, _report
from tablewarden.catalog.registry import query, r6
from tablewarden.catalog.views import SUBJECT_CTE, labelled, request, subject, table
from tablewarden.operators import models
from tablewarden.operators.boosting import BoostParams, fit_trees
from tablewarden.operators.evaluate import evaluate
from tablewarden.operators.knn import knn_join, knn_predict
from tablewarden.operators.models import FULL_SUITE, QUICK_SUITE, Candidate
from tablewarden.plans import monitoring, prepare
from tablewarden.plans.training import RESULT_SCHEMA, cross_validate, cv_summary, score_rows, scored, stored_vectors, train_suite
from tablewarden.session import materialize, scratch_path
from tablewarden.sources.tables import read_csv
from tablewarden.spec import SUBJECT
from tablewarden.streaming.runner import run_available
from tablewarden.streaming.scoring import score_stream

_PARTS: dict[tuple[str, str], tuple] = {}


def prepared(spark, sf_dir):
    """(raw, state, train vectors, test vectors), prepared once per session and directory."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PARTS:
        rows = materialize(worded(subject(spark, sf_dir)), "subject")
        done = prepare.run(rows, SUBJECT, validate=False, store_rows=True)
        _PARTS[key] = (rows, done.state, *(stored_vectors(done, p, SUBJECT) for p in ("train", "test")))
    return _PARTS[key]


def _trained(name: str, fit, **params):
    """Fit on train, report the five test metrics."""

    @query(name)
    def run(spark, sf_dir):
        _, _, train, test = prepared(spark, sf_dir)
        model = Candidate(name.removeprefix("train_"), fit, params).train(train)
        found = evaluate(scored(model, test), models.LABEL, "prediction", "probability")
        return r6(found.select(F.lit(model.name).alias("model"), "*"))

    return run


_trained("train_lr", models.fit_logistic, max_iter=1000)
_trained("train_rf", models.fit_forest, trees=200, depth=20, min_split=10)
_trained("train_gbt", models.fit_boosting, rounds=200, rate=0.1, depth=5)
_trained("train_gbt_deep", models.fit_boosting_deep, rounds=200, rate=0.1, depth=7)
_trained("train_gbt_hist", models.fit_boosting_hist, rounds=200, rate=0.1, depth=7)
_trained("train_svm_rff", models.fit_svm)
_trained("train_knn", models.fit_neighbours, k=7)


_FIRST_TREE = {
    "age": "age", "size_mm": "size_mm", "rate_a": "rate_a", "rate_b": "rate_b", **{
        c: f"(case when {c} = 'Yes' then 1 else 0 end)" for c in ("family_history", "smoking", "genetic", "early_detection")},
    "screening": "(case screening when 'Never' then 0 when 'Irregular' then 1 when 'Sometimes' then 2 else 3 end)",
}


def _first_tree_sql(depth: int) -> str:
    """The first tree of second-order boosting: all labels start at one half, ridge 1, rate 0.1."""
    cells = " union all ".join(
        f"select subject_id id, {f} f, coalesce({e}, -1)::double v from subject" for f, e in enumerate(_FIRST_TREE.values()))
    sql = f"{SUBJECT_CTE}, cells as ({cells}), at0 as (select subject_id id, '' path, (outcome = 'Yes')::int y from subject)"
    for k in range(depth):
        sql += f""",
hist{k} as (select path, f, v, sum(0.5::double - y) g, sum(0.25::double) h, count(*) n from at{k} join cells using (id) group by all),
run{k} as (select path, f, v, sum(g) over w g, sum(h) over w h, sum(g) over a sg, sum(h) over a sh, sum(n) over a n from hist{k}
 window w as (partition by path, f order by v), a as (partition by path, f)),
gain{k} as (select *, (g*g/(h+1) + (sg-g)*(sg-g)/(sh-h+1) - sg*sg/(sh+1))/2 gain from run{k} where h >= 1 and sh - h >= 1),
best{k} as (select * from gain{k} where gain > 1e-9 qualify row_number() over (partition by path order by gain desc, f, v) = 1),
at{k + 1} as (select id, path || case when cells.v <= best{k}.v then 'L' else 'R' end path, y from at{k} join best{k} using (path) join cells using (id, f))"""
    nodes = " union all ".join(
        f"""select a.path, b.f feature, b.v threshold, b.gain, a.g, a.h, a.n from
 (select path, sum(0.5::double - y) g, sum(0.25::double) h, count(*)::bigint n from at{k} group by path) a left join {f'best{k}' if k < depth else '(select * from best0 where false)'} b using (path)"""
        for k in range(depth + 1))
    return f"""{sql}, nodes as ({nodes})
select path, coalesce(feature, -1) feature, coalesce(threshold, 0) threshold, round(coalesce(gain, 0), 6) gain, round(-0.1::double*g/(h+1), 6) "value", n "rows" from nodes"""


@query("boost_first_tree", _first_tree_sql(4))
def boost_first_tree(spark, sf_dir):
    """Gains, thresholds and leaves of the first tree, four levels, on all subjects."""
    rows = subject(spark, sf_dir).select(
        "subject_id", F.array(*[F.coalesce(F.expr(e), F.lit(-1)).cast("double") for e in _FIRST_TREE.values()]).alias("x"),
        (F.col("outcome") == "Yes").cast("double").alias("label"))
    model = fit_trees(rows.select(array_to_vector("x").alias("features"), "label"), "first_tree", BoostParams(rounds=1, depth=4))
    return r6(model.table(spark).select("path", "feature", "threshold", "gain", "value", "rows"), "gain", "value")


@query("train_quick")
def train_quick(spark, sf_dir):
    """The quick suite without cross-validation."""
    _, _, train, test = prepared(spark, sf_dir)
    return train_suite(train, test, quick=True, cv=0, stored=True).table(spark).drop("training_seconds", "cv_auc")


@query("train_suite")
def suite(spark, sf_dir):
    """All seven models at their full sizes and one that fails: logged, stored, and the leaderboard read from its file."""
    _, _, train, test = prepared(spark, sf_dir)
    broken = Candidate("broken", models.fit_forest, {"depth": 99})
    board = scratch_path(spark, "leaderboard")
    train_suite(
        train, test, suite=(*FULL_SUITE, broken), cv=0, log_path=scratch_path(spark, "runs"),
        model_path=scratch_path(spark, "models"), board_path=board, stored=True)
    return read_csv(spark, board, T.StructType.fromDDL(RESULT_SCHEMA)).select("model", "test_auc", F.col("error").isNotNull().alias("failed"))


@query("cv_auc")
def cv_auc(spark, sf_dir):
    """Five folds of every model of the quick suite: mean and deviation."""
    _, _, train, _ = prepared(spark, sf_dir)
    scores = [cross_validate(candidate, train) for candidate in QUICK_SUITE]
    return r6(cv_summary(functools.reduce(DataFrame.unionAll, scores)))


DEPLOYED = (
    QUICK_SUITE[0], Candidate("xgboost", models.fit_boosting_deep, {"rounds": 10}), Candidate("knn", models.fit_neighbours, {"k": 5}))


@query("deployed_scores", f"""{SUBJECT_CTE}, models as (select unnest([{", ".join(f"'{c.name}'" for c in DEPLOYED)}]) model)
select model, count(*)::bigint scored, count(*)::bigint agree from subject, models group by model""")
def deployed_scores(spark, sf_dir):
    """Models of three kinds stored with their preparation, loaded again, and all subjects scored by both."""
    rows, state, train, _ = prepared(spark, sf_dir)
    asked, out = rows.drop("outcome"), []
    for candidate in DEPLOYED:
        model, path = candidate.train(train), scratch_path(spark, "deployed")
        monitoring.deploy(spark, model, state, path)
        stored, prepared_by = monitoring.deployed(spark, path)
        before, after = (
            score_rows(asked, SUBJECT, s, m).select("subject_id", F.round("probability", 9).alias(name))
            for name, s, m in (("before", state, model), ("after", prepared_by, stored)))
        same = F.count_if(F.col("before").eqNullSafe(F.col("after"))).alias("agree")
        out.append(after.join(before, "subject_id").agg(F.lit(stored.name).alias("model"), F.count("*").alias("scored"), same))
    return functools.reduce(DataFrame.unionAll, out).select("model", "scored", "agree")


def _near(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    train = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), (F.col("label") >= 5).cast("double").alias("label"))
    return train, rows.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))


_NEAR_SQL = """with e as (select vec_id, embedding::double[] v, (label>=5)::int y from embeddings),
pairs as (select q.vec_id qid, t.vec_id id, t.y, list_distance(q.v, t.v) d from e q join e t on q.vec_id<>t.vec_id),
near as (select * from pairs qualify row_number() over (partition by qid order by d, id) <= 7)"""


@query("knn_predict", f"{_NEAR_SQL} select qid, round(avg(y),6) probability, (avg(y)>0.5)::double prediction from near group by qid")
def knn_votes(spark, sf_dir):
    """Every vector is classified by its nearest other vectors."""
    train, asked = _near(spark, sf_dir)
    return r6(knn_predict(train, asked, 7, exclude_self=True))


@query("knn_neighbours", f"{_NEAR_SQL} select qid, id, round(d,5) dist from near")
def knn_neighbours(spark, sf_dir):
    train, asked = _near(spark, sf_dir)
    return knn_join(train, asked, 7, exclude_self=True).select("qid", "id", F.round("dist", 5).alias("dist"))


@query("score_batch")
def score_batch(spark, sf_dir):
    rows, state, train, _ = prepared(spark, sf_dir)
    model = QUICK_SUITE[0].train(train)
    scored = score_rows(rows.drop("outcome"), SUBJECT, state, model)
    return r6(scored.select("subject_id", "prediction", "probability", "confidence", F.array_join("risk_factors", "; ").alias("risk_factors")))


@query("stream_score")
def stream_score(spark, sf_dir):
    """The same answers as in a batch, from a stream of requests."""
    rows, state, train, _ = prepared(spark, sf_dir)
    model = QUICK_SUITE[0].train(train)
    path = scratch_path(spark, "requests")
    rows.drop("outcome").write.parquet(path)
    stream = spark.readStream.schema(rows.drop("outcome").schema).parquet(path)
    answers = score_stream(stream, SUBJECT, state, model).select(
        "subject_id", "prediction", "probability", "confidence", F.array_join("risk_factors", "; ").alias("risk_factors"), "destination")
    return r6(run_available(answers, "answers")[0])


@query("continuous_training_skipped", f"""{_DECISION} select case when drift_pct > 10 then 'success' else 'skipped' end status,
 case when drift_pct > 10 then printf('Feature drift: %.1f%%', drift_pct) else 'No drift detected' end reason from verdict""")
def continuous_skipped(spark, sf_dir):
    """The unforced run: without drift it ends before anything is prepared or trained."""
    found = monitoring.continuous_training(
        spark, subject(spark, sf_dir), SUBJECT, _report(spark, sf_dir), labelled(request(spark, sf_dir)),
        scratch_path(spark, "baseline"), suite=QUICK_SUITE[:1], cv=0)
    return found.select("status", "reason")


@query("continuous_training")
def continuous(spark, sf_dir):
    """Drift check, preparation, training of all seven models with five folds each, selection, deployment and the new baseline."""
    rows = subject(spark, sf_dir)
    found = monitoring.continuous_training(
        spark, rows, SUBJECT, _report(spark, sf_dir), labelled(request(spark, sf_dir)), scratch_path(spark, "baseline"),
        force=True, auto_deploy=True, deploy_path=scratch_path(spark, "deployed"))
    return found.drop("duration_seconds")
