"""Scoring columns, canary assignment and route checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.data import CONSTRAINT_SQL, worded
from tablewarden.catalog.drift import BUCKET_SQL
from tablewarden.catalog.registry import query, r6
from tablewarden.catalog.views import REQUEST_CTE, SUBJECT_CTE, labelled, request, subject, table
from tablewarden.operators import scoring, traffic
from tablewarden.operators.split import hash_fraction
from tablewarden.spec import SUBJECT

_ROUTED = f"{REQUEST_CTE}, routed as (select *, case when {BUCKET_SQL} < 0.3 then 'model_v2' else 'api_v1' end destination from labelled)"


def routed(spark, sf_dir):
    return traffic.canary_assign(labelled(request(spark, sf_dir)), "event_id")


TIER_SQL = "case when p>0.8::double or p<0.2::double then 'High' when p>0.6::double or p<0.4::double then 'Medium' else 'Low' end"


@query("confidence_tier", f"{REQUEST_CTE} select event_id, {TIER_SQL} confidence from request")
def confidence_tier(spark, sf_dir):
    return request(spark, sf_dir).select("event_id", scoring.confidence_tier(F.col("p")).alias("confidence"))


@query("risk_factors", f"""{SUBJECT_CTE} select subject_id, array_to_string(list_filter([
 case when stage='Metastatic' then 'Advanced cancer stage' end, case when family_history='Yes' then 'Family history present' end,
 case when smoking='Yes' then 'Smoking history' end, case when size_mm>50 then 'Large tumor size' end,
 case when early_detection='No' then 'Late detection' end], lambda x: x is not null), '; ') risk_factors from subject""")
def risk_factors(spark, sf_dir):
    rows = subject(spark, sf_dir)
    return rows.select("subject_id", F.array_join(scoring.risk_factors(rows, SUBJECT), "; ").alias("risk_factors"))


@query("outcome_counts", f"""{_ROUTED} select destination, case when prediction=1 then 'survived' else 'not_survived' end outcome,
 count(*)::bigint n from routed group by all""")
def outcome_counts(spark, sf_dir):
    return scoring.outcome_counts(routed(spark, sf_dir), "destination")


_U = "('0x'||substr(md5('7:'||subject_id::varchar),1,8))::bigint/4294967296.0::double"


@query("batch_predict_envelope", f"""{SUBJECT_CTE}, checked as (select *, {CONSTRAINT_SQL} e, {_U} u from subject)
select subject_id, case when e='' then (u>=0.5::double)::int end prediction, case when e='' then round(u,6) end probability,
 nullif(e,'') error from checked""")
def batch_predict_envelope(spark, sf_dir):
    """Bad rows are answered with their errors. A hash stands for the model."""
    def score(rows):
        u = hash_fraction("subject_id", 7)
        return rows.withColumn("probability", u).withColumn("prediction", (u >= 0.5).cast("int"))

    return r6(scoring.batch_envelope(worded(subject(spark, sf_dir)), SUBJECT, score))


@query("canary_assign", """select o_orderkey, case when ('0x'||substr(md5('42:'||o_orderkey::varchar),1,8))::bigint/4294967296.0::double < 0.3
 then 'model_v2' else 'api_v1' end destination from orders""")
def canary_assign(spark, sf_dir):
    return traffic.canary_assign(table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", "destination")


@query("route_counts", f"{_ROUTED} select destination, path, status, count(*)::bigint n from routed group by all")
def route_counts(spark, sf_dir):
    return traffic.route_counts(routed(spark, sf_dir), ["path", "status"])


@query("canary_verify", f"""{_ROUTED}, c as (select count(*) filter (status='ok' and destination='api_v1')::bigint stable_requests,
 count(*) filter (status='ok' and destination='model_v2')::bigint canary_requests, count(*) filter (status<>'ok')::bigint errors from routed)
select *, round(canary_requests::double/nullif(stable_requests+canary_requests,0),6) canary_share,
 coalesce(abs(canary_requests::double/nullif(stable_requests+canary_requests,0)-0.3::double)<=0.05::double,false) within_tolerance from c""")
def canary_verify(spark, sf_dir):
    return r6(traffic.canary_verify(routed(spark, sf_dir), F.col("status") == "ok"))
