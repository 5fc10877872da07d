"""Feature drift, performance drift and the decisions that follow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.evaluation import metrics_cte
from tablewarden.catalog.features import FEATURE_SQL, NUMERIC, feature_sql
from tablewarden.catalog.registry import query, r6, stamp
from tablewarden.catalog.views import (
    REFERENCE_END, REQUEST_CTE, SUBJECT_CTE, labelled, request, sided, sided_subject, stored_subject, subject, table,
)
from tablewarden.operators import drift
from tablewarden.operators.features import NUMERIC_FEATURES, engineer_features
from tablewarden.operators.traffic import canary_assign
from tablewarden.plans.monitoring import retrain_decision
from tablewarden.spec import SUBJECT

BUCKET_SQL = "('0x'||substr(md5('42:'||event_id::varchar),1,8))::bigint/4294967296.0::double"
_ROUTED = f"{REQUEST_CTE}, routed as (select *, case when {BUCKET_SQL} < 0.3 then 'model_v2' else 'api_v1' end destination from request)"


def _routed(spark, sf_dir):
    return canary_assign(sided(request(spark, sf_dir)), "event_id")


def ks_cte(features, source: str, prefix: str = "ks") -> str:
    """``{prefix}``: distance, sizes, means and p per numeric feature of ``source``."""
    cells = " union all ".join(f"select '{f}' feature, ({e})::double v, is_ref from {source}" for f, e in features.items())
    return f""",
{prefix}_l as (select * from ({cells}) where v is not null),
{prefix}_c as (select feature, v, count(*) filter (is_ref) r, count(*) filter (not is_ref) c from {prefix}_l group by all),
{prefix}_t as (select feature, sum(r)::double n, sum(c)::double m, sum(v*r)/sum(r) ref_mean, sum(v*c)/sum(c) curr_mean
  from {prefix}_c group by feature having sum(r)>0 and sum(c)>0),
{prefix}_w as (select feature, sum(r) over w r, sum(c) over w c from {prefix}_c window w as (partition by feature order by v)),
{prefix}_d as (select feature, any_value(n) n, any_value(m) m, any_value(ref_mean) ref_mean, any_value(curr_mean) curr_mean,
  max(abs(r/n-c/m)) d, round(any_value(n)*any_value(m)/(any_value(n)+any_value(m))) e from {prefix}_w join {prefix}_t using (feature) group by feature),
{prefix}_z as (select *, d*sqrt(e) + 1/(6*sqrt(e)) + (d*sqrt(e)-1)/(4*e) z from {prefix}_d),
{prefix} as (select *, case when z < 0.1 then 1.0::double else least(1.0::double, greatest(0.0::double,
  list_sum(list_transform(range(1,101), lambda k: (case when k%2=1 then 2.0::double else -2.0::double end)*exp(-2*k*k*z*z))))) end p from {prefix}_z)"""


def chi2_cte(features, source: str, prefix: str = "chi") -> str:
    """``{prefix}``: statistic, degrees of freedom and p per categorical feature of ``source``."""
    cells = " union all ".join(f"select '{f}' feature, ({e})::varchar v, is_ref from {source}" for f, e in features.items())
    return f""",
{prefix}_l as (select * from ({cells}) where v is not null),
{prefix}_c as (select feature, v, count(*) filter (is_ref)::double r, count(*) filter (not is_ref)::double c from {prefix}_l group by all),
{prefix}_t as (select feature, sum(r) nr, sum(c) nc, count(*) k from {prefix}_c group by feature),
{prefix}_o as (select feature, k, nr, nc, r obs, (r+c)*nr/(nr+nc) ex from {prefix}_c join {prefix}_t using (feature)
  union all select feature, k, nr, nc, c, (r+c)*nc/(nr+nc) from {prefix}_c join {prefix}_t using (feature)),
{prefix}_s as (select feature, any_value(k)-1 dof, coalesce(sum(power(case when k=2 then greatest(abs(obs-ex)-0.5,0) else abs(obs-ex) end,2)/nullif(ex,0)),0) stat
  from {prefix}_o group by feature),
{prefix} as (select feature, stat, dof, case when dof<1 or stat<=0 then 1.0::double else greatest(0.0::double, 1-list_sum(list_transform(
   range(0, (stat/2+20*sqrt(stat/2)+200)::bigint), lambda i: exp(-stat/2+(dof/2.0::double+i)*ln(stat/2)-lgamma(dof/2.0::double+i+1))))) end p from {prefix}_s)"""


_NUMERIC_REQUEST = {"latency_s": "latency_s", "p": "p", "user_id": "user_id"}


@query("ks_drift", f"""{REQUEST_CTE}{ks_cte(_NUMERIC_REQUEST, "request")}
select feature, round(d,6) statistic, round(p,6) p_value, p < 0.05 drift_detected, round(ref_mean,6) ref_mean, round(curr_mean,6) curr_mean,
 round((curr_mean-ref_mean)/nullif(ref_mean,0)*100,6) mean_change_pct, n::bigint n_ref, m::bigint n_cur from ks""")
def ks_drift(spark, sf_dir):
    """With the limiting p-value at every size."""
    return r6(drift.ks_drift(sided(request(spark, sf_dir)), list(_NUMERIC_REQUEST), "is_ref", exact_rows=0))


PATHS = ("click", "error", "purchase", "signup", "view")
_BY_PATH = {f"latency_{p}": f"case when path = '{p}' then latency_s end" for p in PATHS}


@query("ks_exact", f"""with recursive {REQUEST_CTE.removeprefix("with ")}{ks_cte(_BY_PATH, "request")},
small as (select feature, least(n, m)::bigint n, greatest(n, m)::bigint m, round(d*n*m)::bigint h from ks where greatest(n, m) <= 10000),
walk as (select feature, n, m, h, 0::bigint s, list_transform(range(n+1), lambda x: (x = 0 and h <= 0)::int::double) b from small
 union all select feature, n, m, h, s+1, list_transform(list_zip(range(n+1), list_prepend(0.0::double, b), b), lambda z:
   case when z[1] > s+1 or s+1-z[1] > m then 0.0::double when abs(z[1]*m-(s+1-z[1])*n) >= h then 1.0::double
    else (case when z[1] > 0 then z[2]*z[1] else 0 end + case when z[1] < s+1 then z[3]*(s+1-z[1]) else 0 end)/(s+1) end) b
  from walk where s < n+m)
select ks.feature, round(d,6) statistic, round(coalesce(b[walk.n+1], p),6) p_value, ks.n::bigint n_ref, ks.m::bigint n_cur
 from ks left join walk on walk.feature=ks.feature and walk.s = walk.n+walk.m""")
def ks_exact(spark, sf_dir):
    """Latency of each path: exact p-values where the samples are small."""
    rows = sided(request(spark, sf_dir))
    rows = rows.select("is_ref", *[F.when(F.col("path") == p, F.col("latency_s")).alias(f"latency_{p}") for p in PATHS])
    return r6(drift.ks_drift(rows, list(_BY_PATH), "is_ref").select("feature", "statistic", "p_value", "n_ref", "n_cur"))


_CATEGORICAL_REQUEST = {"path": "path", "status": "status", "destination": "destination"}


@query("chi2_drift", f"""{_ROUTED}{chi2_cte(_CATEGORICAL_REQUEST, "routed")}
select feature, round(stat,6) statistic, dof::bigint dof, round(p,6) p_value, p < 0.05 drift_detected from chi""")
def chi2_drift(spark, sf_dir):
    return r6(drift.chi2_drift(_routed(spark, sf_dir), list(_CATEGORICAL_REQUEST), "is_ref"))


_LINES = "with lines as (select *, l_shipdate < timestamp '2001-01-01' is_ref from lineitem)"


@query("chi2_drift_lines", _LINES + chi2_cte({"l_returnflag": "l_returnflag", "l_linestatus": "l_linestatus", "l_linenumber": "l_linenumber"}, "lines")
       + " select feature, round(stat,6) statistic, dof::bigint dof, round(p,6) p_value, p < 0.05 drift_detected from chi")
def chi2_drift_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("is_ref", F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    return r6(drift.chi2_drift(rows, ["l_returnflag", "l_linestatus", "l_linenumber"], "is_ref"))


@query("category_distribution", f"""{_ROUTED}{chi2_cte(_CATEGORICAL_REQUEST, "routed")}
select feature, v category, round(r/nullif(nr,0),6) ref_share, round(c/nullif(nc,0),6) curr_share from chi_c join chi_t using (feature)""")
def category_distribution(spark, sf_dir):
    return r6(drift.category_distribution(_routed(spark, sf_dir), list(_CATEGORICAL_REQUEST), "is_ref"))


_KS_SUBJECT = {c: c for c in (*NUMERIC, *(f for f in FEATURE_SQL if f in NUMERIC_FEATURES))}
_CHI_SUBJECT = {c: c for c in (*SUBJECT.categorical, "age_group", "tumor_severity")}
_REPORT = f"""{SUBJECT_CTE}, feat as (select *, subject_id*2 <= (select max(subject_id) from subject) is_ref, {feature_sql(FEATURE_SQL, rounded=False)}
  from subject){ks_cte(_KS_SUBJECT, "feat")}{chi2_cte(_CHI_SUBJECT, "feat")},
report as (select feature, 'numerical' "type", d stat, p from ks union all select feature, 'categorical', stat, p from chi)"""


def _report(spark, sf_dir):
    rows = engineer_features(sided_subject(stored_subject(spark, sf_dir)), SUBJECT)
    return drift.feature_drift_report(rows, "is_ref", skip=["subject_id", "outcome"], exact_rows=0)


@query("feature_drift_report", f'{_REPORT} select feature, "type", round(stat,6) statistic, round(p,6) p_value, p < 0.05 drift_detected from report')
def feature_drift_report(spark, sf_dir):
    return r6(_report(spark, sf_dir))


_SIDES = REQUEST_CTE + ", whole as (select * replace ('all' as model) from labelled)" + metrics_cte("b", "is_ref", "whole") + metrics_cte("c", "not is_ref", "whole")
_PERF = f"""{_SIDES},
perf as (select metric, coalesce(b.v, c.v) b, c.v c from (unpivot (select accuracy, auc, f1 from c) on accuracy, auc, f1 into name metric value v) c
 left join (unpivot (select accuracy, auc from b) on accuracy, auc into name metric value v) b using (metric))"""


def _performance(spark, sf_dir):
    """The baseline lacks f1, which is then compared with itself."""
    rows, cut = labelled(request(spark, sf_dir)), F.lit(REFERENCE_END).cast("timestamp")
    old, new = (
        drift.performance_metrics(rows.where(t), "label", "prediction", "probability")
        for t in (F.col("ts") < cut, F.col("ts") >= cut)
    )
    return drift.performance_drift(old.where("metric <> 'f1'"), new)


@query("performance_drift", f"""{_PERF} select metric, round(b,6) baseline, round(c,6) "current", round(b-c,6) degradation,
 round(case when b>0 then (b-c)/b*100 else 0 end,6) degradation_pct, b-c > 0.02::double exceeded from perf""")
def performance_drift(spark, sf_dir):
    return r6(_performance(spark, sf_dir))


_DECISION = f"""{_REPORT}, {_PERF.removeprefix("with ")},
share as (select count(*) filter (p < 0.05)::bigint drifted, count(*)::bigint features, coalesce(count(*) filter (p < 0.05)*100.0::double/nullif(count(*),0),0) drift_pct from report),
decision as (select *, (select coalesce(bool_or(b-c > 0.02::double),false) from perf) degradation_detected from share),
verdict as (select *, drift_pct > 10 or degradation_detected drift_detected,
 array_to_string(list_filter([case when drift_pct > 10 then printf('Feature drift: %.1f%%', drift_pct) end,
  case when degradation_detected then 'Performance degradation detected' end], lambda x: x is not null), ', ') reasons from decision)"""


def _decision(spark, sf_dir):
    return drift.drift_decision(_report(spark, sf_dir), _performance(spark, sf_dir))


@query("drift_decision", f"{_DECISION} select drifted, features, round(drift_pct,6) drift_pct, degradation_detected, drift_detected, reasons from verdict")
def drift_decision(spark, sf_dir):
    return r6(_decision(spark, sf_dir).withColumn("reasons", F.array_join("reasons", ", ")))


@query("retrain_decision", f"""{_DECISION}, n as (select count(*)::bigint n from subject)
select case when drift_detected and n>=1000 then 'success' else 'skipped' end status,
 case when not drift_detected then 'No drift detected' when n<1000 then 'too few samples' else reasons end reason,
 case when drift_detected and n>=1000 then 'staged' end deployment_status, round(drift_pct,6) drift_pct, degradation_detected, n from verdict, n""")
def retrain_query(spark, sf_dir):
    rows = subject(spark, sf_dir).agg(F.count("*").alias("n"))
    return r6(retrain_decision(_decision(spark, sf_dir), rows))


@query("windowed_drift", f"""{REQUEST_CTE},
l as (select 'latency_s' feature, latency_s v, is_ref, date_trunc('day', ts) w from request union all select 'p', p, is_ref, date_trunc('day', ts) from request),
wins as (select distinct feature, w from l where not is_ref),
pool as (select wins.feature, wins.w, v, count(*) filter (is_ref) r, count(*) filter (not is_ref) c from wins join l on l.feature=wins.feature and (is_ref or l.w=wins.w) group by all),
cum as (select feature, w, sum(r) over x r, sum(c) over x c, sum(r) over (partition by feature, w) n, sum(c) over (partition by feature, w) m from pool
  window x as (partition by feature, w order by v)),
d as (select feature, w, max(abs(r/n::double-c/m::double)) d, any_value(m)::bigint m from cum group by all)
select strftime(w, '%Y-%m-%d %H:%M:%S') window_start, feature, round(d,6) statistic, m n_cur, d > 0.1::double breached from d""")
def windowed_drift(spark, sf_dir):
    found = drift.windowed_drift(sided(request(spark, sf_dir)), "ts", ["latency_s", "p"], "is_ref", "1 day")
    return r6(found.withColumn("window_start", stamp("window_start")))
