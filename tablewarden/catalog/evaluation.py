"""Metrics, leaderboard, selection and the model gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.registry import query, r6
from tablewarden.catalog.views import REFERENCE_END, REQUEST_CTE, labelled, request
from tablewarden.operators import evaluate


def metrics_cte(name: str = "m", where: str = "true", source: str = "labelled") -> str:
    """All five metrics per model; ``model`` may be any grouping column of ``source``."""
    return f""",
{name}_h as (select model, count(*)::bigint n, avg((label=prediction)::int) accuracy,
 count(*) filter (label=1 and prediction=1)::double tp, count(*) filter (prediction=1) pp, count(*) filter (label=1) ap
 from {source} where {where} group by model),
{name}_r as (select model, label, row_number() over (partition by model order by probability) rn,
  count(*) over (partition by model, probability) ties, min(0) over () z, probability from {source} where {where}),
{name}_k as (select model, label, min(rn) over (partition by model, probability) + (ties-1)/2.0::double rk from {name}_r),
{name}_a as (select model, (sum(rk) filter (label=1) - count(*) filter (label=1)*(count(*) filter (label=1)+1)/2.0::double)
  / nullif(count(*) filter (label=1)::double*count(*) filter (label=0),0) auc from {name}_k group by model),
{name} as (select model, n, accuracy, coalesce(tp/nullif(pp,0),0) "precision", coalesce(tp/nullif(ap,0),0) recall,
 coalesce(2*tp/nullif(pp+ap,0),0) f1, auc from {name}_h join {name}_a using (model))"""


_ALL = REQUEST_CTE + ", whole as (select * replace ('all' as model) from labelled)"


@query("binary_metrics", f"""{REQUEST_CTE}{metrics_cte()}
select model, n, round(accuracy,6) accuracy, round("precision",6) "precision", round(recall,6) recall, round(f1,6) f1 from m""")
def binary_metrics(spark, sf_dir):
    return r6(evaluate.binary_metrics(labelled(request(spark, sf_dir)), "label", "prediction", ["model"]))


@query("roc_auc", f"{_ALL}{metrics_cte(source='whole')} select round(auc,6) auc from m")
def roc_auc(spark, sf_dir):
    return r6(evaluate.roc_auc(labelled(request(spark, sf_dir)), "label", "probability"))


@query("roc_auc_by_model", f"{REQUEST_CTE}{metrics_cte()} select model, round(auc,6) auc from m")
def roc_auc_by_model(spark, sf_dir):
    return r6(evaluate.roc_auc(labelled(request(spark, sf_dir)), "label", "probability", ["model"]))


def _by_model(spark, sf_dir):
    return evaluate.evaluate(labelled(request(spark, sf_dir)), "label", "prediction", "probability", ["model"])


@query("leaderboard", f"""{REQUEST_CTE}{metrics_cte()}
select model, round(accuracy,6) test_accuracy, round(auc,6) test_auc, round(f1,6) test_f1 from m order by auc desc, model""")
def leaderboard(spark, sf_dir):
    wide = _by_model(spark, sf_dir).select("model", *[F.col(m).alias(f"test_{m}") for m in ("accuracy", "auc", "f1")])
    return r6(evaluate.leaderboard(wide))


@query("select_best", f"{REQUEST_CTE}{metrics_cte()} select model, 'auc' metric, round(auc,6) score from m order by auc desc, model limit 1")
def select_best(spark, sf_dir):
    return r6(evaluate.select_best(_by_model(spark, sf_dir), "auc"))


def _sides(spark, sf_dir):
    rows, cut = labelled(request(spark, sf_dir)), F.lit(REFERENCE_END).cast("timestamp")
    return [
        evaluate.metric_rows(evaluate.evaluate(rows.where(test), "label", "prediction", "probability"))
        for test in (F.col("ts") < cut, F.col("ts") >= cut)
    ]


_GATE = f"""{_ALL}{metrics_cte("b", "is_ref", "whole")}{metrics_cte("c", "not is_ref", "whole")},
b_rows as (unpivot (select accuracy, auc, f1, "precision", recall from b) on accuracy, auc, f1, "precision" into name metric value v),
c_rows as (unpivot (select accuracy, auc, f1, "precision", recall from c) on accuracy, auc, f1, "precision", recall into name metric value v),
gate as (select metric, coalesce(b_rows.v,0) b, coalesce(c_rows.v,0) c from b_rows full join c_rows using (metric))"""


@query("compare_gate", f"""{_GATE} select metric, round(b,4) baseline, round(c,4) candidate, round(c-b,4) delta, c-b < -0.02::double degraded from gate""")
def compare_gate(spark, sf_dir):
    """The baseline has no recall, which counts as 0."""
    base, candidate = _sides(spark, sf_dir)
    return evaluate.compare_gate(base.where("metric <> 'recall'"), candidate)


@query("gate_decision", f"""{_GATE}, bad as (select string_agg(printf('%s degraded by %.4f', metric, abs(round(c-b,4))), '; ' order by metric) r,
 count(*) n from gate where c-b < -0.02::double)
select n=0 approved, case when n=0 then 'Candidate model meets performance criteria' else r end reasons from bad""")
def gate_decision(spark, sf_dir):
    base, candidate = _sides(spark, sf_dir)
    found = evaluate.gate_decision(evaluate.compare_gate(base.where("metric <> 'recall'"), candidate))
    return found.select("approved", F.array_join("reasons", "; ").alias("reasons"))
