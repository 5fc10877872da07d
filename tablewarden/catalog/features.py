"""Derived features, binary and categorical encodings, imputation and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.registry import query, r6
from tablewarden.catalog.views import SUBJECT_CTE, subject
from tablewarden.operators import clean, encode, scale
from tablewarden.operators.features import engineer_features, yes_flag
from tablewarden.spec import SUBJECT

NUMERIC = list(SUBJECT.numerical)

# Feature expressions in SQL, over the columns of ``subject``.
FEATURE_SQL = {
    "age_group": """case when age>0 and age<=40 then '30-40' when age>40 and age<=50 then '40-50' when age>50 and age<=60 then '50-60'
 when age>60 and age<=70 then '60-70' when age>70 and age<=150 then '70+' end""",
    "risk_score": "((family_history='Yes')::int+(smoking='Yes')::int+(alcohol='Yes')::int+(diabetes='Yes')::int+(genetic='Yes')::int)",
    "lifestyle_score": """(case bmi when 'Normal' then 2 when 'Overweight' then 1 when 'Obese' then 0 end
 + case diet when 'Low' then 2 when 'Moderate' then 1 when 'High' then 0 end
 + case activity when 'Low' then 0 when 'Moderate' then 1 when 'High' then 2 end)/3.0::double""",
    "healthcare_quality_score": """(case access when 'Low' then 0 when 'Moderate' then 1 when 'High' then 2 end
 + case insurance when 'Uninsured' then 0 when 'Insured' then 1 end
 + case economy when 'Developing' then 0 when 'Developed' then 1 end
 + case screening when 'Never' then 0 when 'Irregular' then 1 when 'Regular' then 2 end)/4.0::double""",
    "tumor_severity": """case when size_mm>0 and size_mm<=20 then 'Small' when size_mm>20 and size_mm<=40 then 'Medium'
 when size_mm>40 and size_mm<=60 then 'Large' when size_mm>60 and size_mm<=100 then 'Very_Large' end""",
    "age_tumor_interaction": "(age::double/(select max(age) from {frame}))*(size_mm/(select max(size_mm) from {frame}))",
    "cost_per_mm": "cost/(size_mm+1)",
    "stage_severity_score": "case stage when 'Localized' then 1 when 'Regional' then 2 when 'Metastatic' then 3 end",
}
FLOAT_FEATURES = ("lifestyle_score", "healthcare_quality_score", "age_tumor_interaction", "cost_per_mm")


def feature_sql(names, frame: str = "subject", rounded: bool = True) -> str:
    out = []
    for n in names:
        expr = FEATURE_SQL[n].replace("{frame}", frame)
        out.append(f"round({expr},6) {n}" if rounded and n in FLOAT_FEATURES else f"{expr} {n}")
    return ", ".join(out)


def _feature_query(key: str, *names: str):
    @query(key, f"{SUBJECT_CTE} select subject_id, {feature_sql(names)} from subject")
    def run(spark, sf_dir):
        return r6(engineer_features(subject(spark, sf_dir), SUBJECT, only=names).select("subject_id", *names))

    return run


_feature_query("feat_bins", "age_group", "tumor_severity")
_feature_query("feat_risk_score", "risk_score")
_feature_query("feat_lifestyle", "lifestyle_score")
_feature_query("feat_quality", "healthcare_quality_score")
_feature_query("feat_interaction", "age_tumor_interaction")
_feature_query("feat_cost_ratio", "cost_per_mm")
_feature_query("feat_ordinal", "stage_severity_score")


@query("engineer_features", f"{SUBJECT_CTE} select *, {feature_sql(FEATURE_SQL)} from subject")
def engineered(spark, sf_dir):
    rows = engineer_features(subject(spark, sf_dir), SUBJECT)
    return r6(rows, *FLOAT_FEATURES)


# --- imputation --------------------------------------------------------------------------

def _filled_sql(fn: str) -> str:
    cells = ", ".join(f"round(coalesce({c}, (select {fn.format(c=c)} from subject)),6) {c}" for c in NUMERIC)
    return f"{SUBJECT_CTE} select subject_id, {cells} from subject"


def _impute(strategy: str):
    def run(spark, sf_dir):
        rows = subject(spark, sf_dir).select("subject_id", *NUMERIC)
        return r6(clean.handle_missing(rows, SUBJECT, strategy), *NUMERIC)

    return run


query("impute_mean", _filled_sql("avg({c})"))(_impute("mean"))
query("impute_median", _filled_sql("quantile_cont({c}, 0.5)"))(_impute("median"))


_MODE = "(select {c} from subject where {c} is not null group by 1 order by count(*) desc, 1 limit 1)"


@query("impute_mode", f"{SUBJECT_CTE} select subject_id, " + ", ".join(
    f"coalesce({c}, {_MODE.format(c=c)}) {c}" for c in SUBJECT.categorical) + " from subject")
def impute_mode(spark, sf_dir):
    rows = subject(spark, sf_dir).select("subject_id", *SUBJECT.categorical)
    return clean.handle_missing(rows, SUBJECT)


@query("impute_drop", f"{SUBJECT_CTE} select * from subject where size_mm is not null and rate_a is not null and rate_b is not null and bmi is not null")
def impute_drop(spark, sf_dir):
    return clean.handle_missing(subject(spark, sf_dir), SUBJECT, "drop")


# --- encoding ------------------------------------------------------------------------------

@query("encode_binary", f"{SUBJECT_CTE} select subject_id, " + ", ".join(
    f"coalesce(({c}='Yes')::int,0) {c}" for c in SUBJECT.binary) + " from subject")
def encode_binary(spark, sf_dir):
    return encode.encode_binary(subject(spark, sf_dir), SUBJECT).select("subject_id", *SUBJECT.binary)


LEVELS = {
    "country": sorted(f"NATION_{i}" for i in range(25)),
    "stage": ["Localized", "Metastatic", "Regional"],
    "bmi": ["Normal", "Obese", "Overweight"],
    "screening": ["Irregular", "Never", "Regular", "Sometimes"],
}


# Every level of every category, null aside.
ALL_LEVELS = {
    **LEVELS, "gender": ["F", "M"], **{c: ["High", "Low", "Moderate"] for c in ("diet", "activity", "access")},
    "economy": ["Developed", "Developing"], "insurance": ["Insured", "Uninsured"],
    **{c: ["No", "Yes"] for c in SUBJECT.binary if c != "outcome"},
}


@query("encode_onehot", f"{SUBJECT_CTE} select subject_id, " + ", ".join(
    f"coalesce({c}='{v}',false) \"{c}_{v}\"" for c, vs in ALL_LEVELS.items() for v in vs) + " from subject")
def encode_onehot(spark, sf_dir):
    rows = subject(spark, sf_dir).select("subject_id", *ALL_LEVELS)
    return encode.encode_onehot(rows, encode.fit_levels(rows, list(ALL_LEVELS)))


_CELLS = " union all ".join(
    f'select subject_id, {i} pos, \'{c}\' "column", {c} "value" from subject where {c} is not null' for i, c in enumerate(SUBJECT.categorical))


@query("encode_onehot_sparse", f'{SUBJECT_CTE} select subject_id, "column", "value" from ({_CELLS})')
def encode_onehot_sparse(spark, sf_dir):
    return encode.encode_onehot_sparse(subject(spark, sf_dir), "subject_id", list(SUBJECT.categorical))


@query("encode_onehot_indices", f"""{SUBJECT_CTE}, cells as ({_CELLS}),
levels as (select pos, "value", row_number() over (order by pos, "value") - 1 i from (select distinct pos, "value" from cells))
select subject_id, array_to_string(list(i order by i), ',') indices from cells join levels using (pos, "value") group by subject_id""")
def encode_onehot_indices(spark, sf_dir):
    """The hot positions of every row, by a stored index of all levels."""
    rows, columns = subject(spark, sf_dir), list(SUBJECT.categorical)
    found = encode.encode_onehot_indices(rows, "subject_id", columns, encode.fit_level_index(rows, columns))
    return found.select("subject_id", F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"))


@query("encode_label", f"{SUBJECT_CTE} select subject_id, " + ", ".join(
    f"case when {c} is not null then dense_rank() over (order by {c} nulls last)-1 end {c}" for c in SUBJECT.categorical) + " from subject")
def encode_label(spark, sf_dir):
    columns = list(SUBJECT.categorical)
    rows = subject(spark, sf_dir).select("subject_id", *columns)
    return encode.apply_codes(rows, encode.fit_label_codes(rows, columns), columns)


@query("encode_label_wide", """select c_custkey, dense_rank() over (order by c_name)-1 c_name,
 dense_rank() over (order by c_mktsegment)-1 c_mktsegment from customer""")
def encode_label_wide(spark, sf_dir):
    """Label codes of a column with about as many levels as rows."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_mktsegment")
    columns = ["c_name", "c_mktsegment"]
    return encode.apply_codes(rows, encode.fit_label_codes(rows, columns), columns)


@query("encode_target", f"{SUBJECT_CTE} select subject_id, " + ", ".join(
    f"case when {c} is not null then round(avg((outcome='Yes')::int) over (partition by {c}),6) end {c}" for c in SUBJECT.categorical) + " from subject")
def encode_target(spark, sf_dir):
    columns = list(SUBJECT.categorical)
    rows = subject(spark, sf_dir).select("subject_id", "outcome", *columns)
    codes = encode.fit_target_means(rows, columns, yes_flag(F.col("outcome")))
    return r6(encode.apply_codes(rows, codes, columns, unseen="null").drop("outcome"))


# --- scaling ---------------------------------------------------------------------------------

def _scale_sql(center: str, spread: str) -> str:
    cells = ", ".join(
        f"round(({c} - (select {center.format(c=c)} from subject))/(select coalesce(nullif({spread.format(c=c)},0),1) from subject),6) {c}"
        for c in NUMERIC)
    return f"{SUBJECT_CTE} select subject_id, {cells} from subject"


def _scaled(kind: str):
    def run(spark, sf_dir):
        rows = subject(spark, sf_dir).select("subject_id", *NUMERIC)
        return r6(scale.apply_scaler(rows, scale.fit_scaler(rows, NUMERIC, kind)), *NUMERIC)

    return run


query("scale_standard", _scale_sql("avg({c})", "stddev_pop({c})"))(_scaled("standard"))
query("scale_minmax", _scale_sql("min({c})", "max({c})-min({c})"))(_scaled("minmax"))
query("scale_robust", _scale_sql("quantile_cont({c},0.5)", "quantile_cont({c},0.75)-quantile_cont({c},0.25)"))(_scaled("robust"))
