"""The views that registered queries run on, as DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(col, pairs: dict, default=None):
    out = None
    for key, value in pairs.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return out if default is None else out.otherwise(default)


def subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order under the short names of ``spec.SUBJECT``; nulls are natural."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_quantity").alias("q"), F.max("l_discount").alias("d"), F.max("l_tax").alias("t"))
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = (
        orders.join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    o, c = F.col("o_orderkey"), F.col("o_custkey")

    def yes(test):
        return F.when(test, "Yes").otherwise("No")

    def thirds(value):
        return _cases(value % 3, {0: "Low", 1: "Moderate"}, "High")

    noise = ((o * 7919 + 104729) % 1000) * F.lit(0.05)
    return joined.select(
        o.alias("subject_id"), (30 + c % 60).alias("age"), (F.col("q") * 1.6).alias("size_mm"),
        F.col("o_totalprice").alias("cost"), (F.col("d") * 100).alias("rate_a"), (F.col("t") * 100).alias("rate_b"),
        F.col("n_name").alias("country"),
        _cases(c % 2, {0: "M"}, "F").alias("gender"),
        _cases(F.col("o_orderstatus"), {"F": "Localized", "O": "Regional"}, "Metastatic").alias("stage"),
        yes(o % 3 == 0).alias("family_history"), yes(o % 4 == 0).alias("smoking"), yes(c % 5 == 0).alias("alcohol"),
        yes(c % 7 == 0).alias("diabetes"), yes(o % 11 == 0).alias("genetic"), yes(o % 2 == 0).alias("early_detection"),
        _cases(F.col("o_orderpriority"), {
            "1-URGENT": "Obese", "2-HIGH": "Overweight", "3-MEDIUM": "Normal", "5-LOW": "Normal"}).alias("bmi"),
        thirds(o).alias("diet"), thirds(c).alias("activity"), thirds(o + c).alias("access"),
        _cases(F.col("c_mktsegment"), {"BUILDING": "Uninsured"}, "Insured").alias("insurance"),
        F.when(F.col("n_regionkey").isin(0, 1), "Developed").otherwise("Developing").alias("economy"),
        _cases(o % 5, {0: "Never", 1: "Irregular", 2: "Regular", 3: "Regular"}, "Sometimes").alias("screening"),
        yes(F.coalesce(F.col("q") * 1.6, F.lit(40.0)) + noise < 85).alias("outcome"),
    )


def stored_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a stored table, for plans that read their input several times."""
    return materialize(subject(spark, sf_dir), "subject")


def repeated(df: DataFrame) -> DataFrame:
    """The table with one screening group present twice."""
    return df.unionAll(df.where("screening = 'Never'"))


def request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event as a scoring request with a pseudo-probability."""
    return request_columns(table(spark, sf_dir, "events"))


def request_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        F.col("event_type").alias("path"),
        (F.col("value") / 50).alias("latency_s"),
        (((F.col("event_id") * 7919 + 104729) % 1000).cast("double") / 1000.0).alias("p"),
    )


def labelled(df: DataFrame) -> DataFrame:
    """Requests as scored rows of six models: the model is the four-hour part of the day."""
    return df.select(
        "*", F.concat(F.lit("model_"), F.floor(F.hour("ts") / 4).cast("string")).alias("model"),
        (F.col("status") == "error").cast("int").alias("label"),
        (F.col("p") >= 0.5).cast("int").alias("prediction"), F.col("p").alias("probability"),
    )


# Requests before this day are the reference population.
REFERENCE_END = "2024-01-20 00:00:00"


def sided(df: DataFrame) -> DataFrame:
    return df.withColumn("is_ref", F.col("ts") < F.lit(REFERENCE_END).cast("timestamp"))


def sided_subject(df: DataFrame) -> DataFrame:
    """Subjects in two halves of the id range."""
    return df.withColumn("is_ref", F.col("subject_id") * 2 <= df.agg(F.max("subject_id")).scalar())


SUBJECT_CTE = """with li as (
  select l_orderkey, max(l_quantity) q, max(l_discount) d, max(l_tax) t from lineitem group by l_orderkey),
subject as (
  select o.o_orderkey subject_id, 30+o.o_custkey%60 age, li.q*1.6 size_mm, o.o_totalprice as cost,
   li.d*100 rate_a, li.t*100 rate_b, n.n_name country,
   case o.o_custkey%2 when 0 then 'M' else 'F' end gender,
   case o.o_orderstatus when 'F' then 'Localized' when 'O' then 'Regional' else 'Metastatic' end stage,
   case when o.o_orderkey%3=0 then 'Yes' else 'No' end family_history,
   case when o.o_orderkey%4=0 then 'Yes' else 'No' end smoking,
   case when o.o_custkey%5=0 then 'Yes' else 'No' end alcohol,
   case when o.o_custkey%7=0 then 'Yes' else 'No' end diabetes,
   case when o.o_orderkey%11=0 then 'Yes' else 'No' end genetic,
   case when o.o_orderkey%2=0 then 'Yes' else 'No' end early_detection,
   case o.o_orderpriority when '1-URGENT' then 'Obese' when '2-HIGH' then 'Overweight'
        when '3-MEDIUM' then 'Normal' when '5-LOW' then 'Normal' end bmi,
   case o.o_orderkey%3 when 0 then 'Low' when 1 then 'Moderate' else 'High' end diet,
   case o.o_custkey%3 when 0 then 'Low' when 1 then 'Moderate' else 'High' end activity,
   case (o.o_orderkey+o.o_custkey)%3 when 0 then 'Low' when 1 then 'Moderate' else 'High' end access,
   case c.c_mktsegment when 'BUILDING' then 'Uninsured' else 'Insured' end insurance,
   case when n.n_regionkey in (0,1) then 'Developed' else 'Developing' end economy,
   case o.o_orderkey%5 when 0 then 'Never' when 1 then 'Irregular' when 2 then 'Regular'
        when 3 then 'Regular' else 'Sometimes' end screening,
   case when coalesce(li.q*1.6,40)+((o.o_orderkey*7919+104729)%1000)*0.05 < 85 then 'Yes' else 'No' end outcome
  from orders o join customer c on c.c_custkey=o.o_custkey
  join nation n on n.n_nationkey=c.c_nationkey left join li on li.l_orderkey=o.o_orderkey)"""

REPEATED_CTE = SUBJECT_CTE + """,
repeated as (select * from subject union all select * from subject where screening = 'Never')"""

REQUEST_CTE = f"""with request as (
  select event_id, ts, user_id, case event_type when 'error' then 'error' else 'ok' end status, event_type path,
   value/50 latency_s, ((event_id*7919+104729)%1000)::double/1000.0::double p,
   ts < timestamp '{REFERENCE_END}' is_ref from events),
labelled as (
  select *, 'model_' || (extract(hour from ts)::int // 4)::varchar model, (status='error')::int label,
   (p>=0.5)::int prediction, p probability from request)"""


def split_cte(stratum: str = "outcome", source: str = "subject", ident: str = "subject_id") -> str:
    """``split``: the exact stratified split at 20 % test and 10 % validation, seed 42."""
    return f""",
sized as (select {stratum} s, count(*)::bigint n, sum(count(*)) over ()::bigint total from {source} group by 1),
kept as (select *, total - ceil(0.2::double*total)::bigint draws from sized),
kept2 as (select *, n*draws//total base, n*draws%total rest from kept),
kept3 as (select s, n, draws, base + (row_number() over (order by rest desc, s) <= draws - sum(base) over ())::int k from kept2),
tr as (select *, draws - ceil(0.125::double*draws)::bigint draws2 from kept3),
tr2 as (select *, k*draws2//draws base2, k*draws2%draws rest2 from tr),
tr3 as (select *, base2 + (row_number() over (order by rest2 desc, s) <= draws2 - sum(base2) over ())::int t from tr2),
ranked as (select x.*, row_number() over (partition by {stratum} order by md5('42:'||{ident}::varchar), {ident}) rn from {source} x),
split as (select ranked.* exclude (rn), case when rn <= n-k then 'test' when rn <= n-t then 'val' else 'train' end split
  from ranked join tr3 on tr3.s = ranked.{stratum})"""
