"""Sources, sinks, profile, projections and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.registry import query, r6
from tablewarden.catalog.views import (
    REPEATED_CTE, REQUEST_CTE, REFERENCE_END, SUBJECT_CTE, labelled, repeated, request, split_cte, subject,
)
from tablewarden.operators import clean, validate
from tablewarden.operators.evaluate import binary_metrics, metric_rows
from tablewarden.operators.features import engineer_features
from tablewarden.operators.split import stratified_split
from tablewarden.session import scratch_path
from tablewarden.sources import runlog, tables
from tablewarden.spec import SUBJECT

COLUMNS = SUBJECT.expected_columns
NUMERIC = SUBJECT.numerical


@query("csv_roundtrip", f"{SUBJECT_CTE} select * from subject")
def csv_roundtrip(spark, sf_dir):
    rows = subject(spark, sf_dir)
    path = scratch_path(spark, "csv")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query("csv_inferred", f"{SUBJECT_CTE} select * from subject")
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.write_csv(subject(spark, sf_dir), path)
    return tables.read_csv(spark, path)


@query("processed_splits", f"""{SUBJECT_CTE}{split_cte()}
select subject_id, outcome, case when age<=40 then '30-40' when age<=50 then '40-50' when age<=60 then '50-60'
 when age<=70 then '60-70' else '70+' end age_group from split where split='val'""")
def processed_splits(spark, sf_dir):
    rows = stratified_split(engineer_features(subject(spark, sf_dir), SUBJECT, only=["age_group"]), "outcome", "subject_id")
    path = scratch_path(spark, "splits")
    tables.write_splits(rows, path)
    return tables.read_split(spark, path, "val").select("subject_id", "outcome", "age_group")


_DTYPES = {"subject_id": "bigint", "age": "bigint", "size_mm": "double", "cost": "double", "rate_a": "double", "rate_b": "double"}


def _profile_sql() -> str:
    parts = []
    for c in COLUMNS:
        dtype = _DTYPES.get(c, "string")
        size = f"sum(strlen({c}))" if dtype == "string" else f"count({c})*8"
        parts.append(
            f'select \'{c}\' "column", \'{dtype}\' dtype, count(*)::bigint "rows", {len(COLUMNS)}::bigint "columns", '
            f"count(*) filter ({c} is null)::bigint missing, ({size})::bigint bytes from subject"
        )
    return f"{SUBJECT_CTE} " + " union all ".join(parts)


@query("table_profile", _profile_sql())
def table_profile(spark, sf_dir):
    return validate.table_profile(subject(spark, sf_dir))


_METRIC_SQL = """metrics as (select model, count(*) filter (label=prediction)::double/count(*) accuracy,
 coalesce(count(*) filter (label=1 and prediction=1)::double/nullif(count(*) filter (prediction=1),0),0) "precision",
 coalesce(count(*) filter (label=1 and prediction=1)::double/nullif(count(*) filter (label=1),0),0) recall,
 coalesce(2.0::double*count(*) filter (label=1 and prediction=1)/nullif(count(*) filter (label=1)+count(*) filter (prediction=1),0),0) f1
 from labelled group by model)"""


@query("report_json", f"""{REQUEST_CTE}, {_METRIC_SQL}
select model, round(accuracy,6) accuracy, round("precision",6) "precision", round(recall,6) recall, round(f1,6) f1 from metrics""")
def report_json(spark, sf_dir):
    rows = r6(binary_metrics(labelled(request(spark, sf_dir)), "label", "prediction", ["model"]).drop("n"))
    path = scratch_path(spark, "report")
    tables.write_report(rows, path)
    back = tables.read_report(spark, path, rows.schema)
    return tables.from_json_rows(tables.to_json_rows(back), rows.schema)


@query("baseline_or_current", f"""{REQUEST_CTE},
old as (select 'accuracy' metric, avg((label=prediction)::int) v from labelled where is_ref),
new as (select 'accuracy' metric, avg((label=prediction)::int) v from labelled where not is_ref
 union all select 'precision', count(*) filter (label=1 and prediction=1)::double/nullif(count(*) filter (prediction=1),0) from labelled where not is_ref
 union all select 'recall', count(*) filter (label=1 and prediction=1)::double/nullif(count(*) filter (label=1),0) from labelled where not is_ref)
select new.metric, round(coalesce(old.v,new.v),6) baseline, round(new.v,6) "current" from new left join old using (metric)""")
def baseline_or_current(spark, sf_dir):
    rows = labelled(request(spark, sf_dir))
    cut = F.lit(REFERENCE_END).cast("timestamp")
    old = metric_rows(binary_metrics(rows.where(F.col("ts") < cut), "label", "prediction")).where("metric = 'accuracy'")
    new = metric_rows(binary_metrics(rows.where(F.col("ts") >= cut), "label", "prediction")).where("metric <> 'f1'")
    path = scratch_path(spark, "baseline")
    tables.load_or_start_baseline(old, path)
    return r6(tables.baseline_or_current(tables.load_or_start_baseline(new, path), new))


@query("run_log_pivot", f"""{REQUEST_CTE}, {_METRIC_SQL}
select model run_name, round(accuracy,6) accuracy, round("precision",6) "precision", round(recall,6) recall, round(f1,6) f1 from metrics""")
def run_log_pivot(spark, sf_dir):
    """A run per model, logged by the executors."""
    found = binary_metrics(labelled(request(spark, sf_dir)), "label", "prediction", ["model"])
    path, metrics = scratch_path(spark, "runs"), ["accuracy", "precision", "recall", "f1"]
    runlog.append_runs(found, path, "model", ["n"], metrics)
    return r6(runlog.pivot_metrics(runlog.read_runs(spark, path), metrics))


def _dirty_csv(spark, sf_dir):
    """The subjects as a CSV file in which some ages and rates are no numbers."""
    rows = subject(spark, sf_dir)
    age = F.when(F.col("diet") == "Low", F.concat(F.col("age").cast("string"), F.lit(" years"))).otherwise(F.col("age").cast("string"))
    rate = F.when(F.col("stage") == "Metastatic", "n.k.").otherwise(F.col("rate_a").cast("string"))
    path = scratch_path(spark, "dirty")
    tables.write_csv(rows.withColumns({"age": age, "rate_a": rate}), path)
    return tables.read_csv_rescued(spark, path, rows.schema, "subject_id")


@query("csv_typed", f"""{SUBJECT_CTE} select * replace (case when diet = 'Low' then null else age end as age,
 case when stage = 'Metastatic' then null else rate_a end as rate_a) from subject""")
def csv_typed(spark, sf_dir):
    """What can be read under the schema; the other cells are null here."""
    return _dirty_csv(spark, sf_dir)[0]


@query("csv_rescued", f"""{SUBJECT_CTE} select subject_id::varchar "row", 'age' "column", age || ' years' raw from subject where diet = 'Low'
 union all select subject_id::varchar, 'rate_a', 'n.k.' from subject where stage = 'Metastatic'""")
def csv_rescued(spark, sf_dir):
    """The cells that are not, with their text."""
    return _dirty_csv(spark, sf_dir)[1]


@query("csv_rescued_counts", f"""{SUBJECT_CTE} select 'age' "column", count(*)::bigint cells from subject where diet = 'Low'
 union all select 'rate_a', count(*)::bigint from subject where stage = 'Metastatic'""")
def csv_rescued_counts(spark, sf_dir):
    return tables.rescued_counts(_dirty_csv(spark, sf_dir)[1])


@query("drop_columns", f"{SUBJECT_CTE} select * exclude (subject_id) from subject")
def drop_columns(spark, sf_dir):
    return clean.drop_columns(subject(spark, sf_dir), SUBJECT)


@query("separate_target", f"{SUBJECT_CTE} select * from subject")
def separate_target(spark, sf_dir):
    """Both halves, put together again by the id."""
    features, target = clean.separate_target(subject(spark, sf_dir), SUBJECT)
    return features.join(target, "subject_id")


@query("target_distribution", f"""{SUBJECT_CTE}
select outcome, count(*)::bigint n, round(100.0::double*count(*)/sum(count(*)) over (),6) share_pct from subject group by 1""")
def target_distribution(spark, sf_dir):
    return r6(clean.target_distribution(subject(spark, sf_dir), "outcome"))


@query("align_features", f"{SUBJECT_CTE} select subject_id, cost, 0 region_Other, age, 0 bmi_Extreme, size_mm from subject")
def align_features(spark, sf_dir):
    return clean.align_features(
        subject(spark, sf_dir), ["cost", "region_Other", "age", "bmi_Extreme", "size_mm"], keep=["subject_id"])


@query("drop_duplicates", f"{REPEATED_CTE} select distinct * from repeated")
def drop_duplicates(spark, sf_dir):
    return clean.remove_duplicates(repeated(subject(spark, sf_dir)))


# --- validation ------------------------------------------------------------------------

def _odd(spark, sf_dir):
    """A table with faults: no gender, an extra column, money as text, ages and sizes out of range, repeated rows."""
    rows = repeated(subject(spark, sf_dir)).drop("gender")
    return rows.withColumns({
        "extra": F.when(F.col("bmi").isNotNull(), F.lit("x")),
        "cost": F.concat(F.lit("USD "), F.col("cost").cast("bigint").cast("string")),
        "age": F.col("age") + F.when(F.col("stage") == "Metastatic", 100).otherwise(0),
        "size_mm": F.col("size_mm") - 2,
    })


_ODD_CTE = REPEATED_CTE + """,
odd as (select * exclude (gender) replace ('USD ' || trunc(cost)::bigint::varchar as cost,
  age + case when stage='Metastatic' then 100 else 0 end as age, size_mm - 2 as size_mm),
  case when bmi is not null then 'x' end extra from repeated)"""
_ODD_COLUMNS = [c for c in COLUMNS if c != "gender"] + ["extra"]


def _union(parts) -> str:
    return " union all ".join(parts)


_SCHEMA_SQL = """select 'schema' "check", 'gender' "column", 'missing' detail, count(*)::bigint n from odd
 union all select 'schema', 'extra', 'unexpected', count(extra)::bigint from odd"""
_MISSING_SQL = "select * from (" + _union(
    f'select \'missing\' "check", \'{c}\' "column", \'null values\' detail, count(*) filter ({c} is null)::bigint n from odd'
    for c in _ODD_COLUMNS) + ") where n > 0"
_DUPLICATE_SQL = """select * from (select 'duplicates' "check", '*' "column", 'repeated rows' detail,
 ((select count(*) from odd) - (select count(*) from (select distinct * from odd)))::bigint n) where n > 0"""
_DTYPE_SQL = """select 'dtypes' "check", 'cost' "column", 'expected numeric, got string' detail,
 count(*) filter (cost is not null and try_cast(cost as double) is null)::bigint n from odd"""
_RANGE_SQL = """select * from (select 'age' "column", min(age)::double min_value, max(age)::double max_value,
 count(*) filter (age<0 or age>150)::bigint n from odd
 union all select 'size_mm', min(size_mm), max(size_mm), count(*) filter (size_mm<0)::bigint from odd) where n > 0"""
_DOMAIN_SQL = "select 'domain' \"check\", * from (" + _union(
    f'select \'{c}\' "column", {c} detail, count(*)::bigint n from odd where {c} not in ('
    + ",".join(f"'{v}'" for v in values) + ") group by 2"
    for c, values in SUBJECT.domains.items() if c != "gender") + ")"


@query("validate_schema", f"{_ODD_CTE} {_SCHEMA_SQL}")
def validate_schema(spark, sf_dir):
    return validate.validate_schema(_odd(spark, sf_dir), SUBJECT)


@query("validate_missing", f"{_ODD_CTE} {_MISSING_SQL}")
def validate_missing(spark, sf_dir):
    return validate.validate_missing(_odd(spark, sf_dir))


@query("validate_duplicates", f"{_ODD_CTE} {_DUPLICATE_SQL}")
def validate_duplicates(spark, sf_dir):
    return validate.validate_duplicates(_odd(spark, sf_dir))


@query("validate_dtypes", f"{_ODD_CTE} {_DTYPE_SQL}")
def validate_dtypes(spark, sf_dir):
    return validate.validate_dtypes(_odd(spark, sf_dir), SUBJECT)


def _numeric_only(spec=SUBJECT):
    """The spec without the column that holds text in the faulty table."""
    return spec.with_(roles={r: c for r, c in spec.roles.items() if r != "cost"})


@query("validate_ranges", f"{_ODD_CTE} select \"column\", round(min_value,6) min_value, round(max_value,6) max_value, n from ({_RANGE_SQL})")
def validate_ranges(spark, sf_dir):
    return r6(validate.range_stats(_odd(spark, sf_dir), _numeric_only()))


@query("range_violations", f"""{_ODD_CTE} select subject_id, age, round(size_mm,6) size_mm,
 array_to_string(list_filter([case when age<0 or age>150 then 'age' end, case when size_mm<0 then 'size_mm' end], lambda x: x is not null), ',') violations
 from odd where age<0 or age>150 or size_mm<0""")
def range_violations(spark, sf_dir):
    found = validate.range_violations(_odd(spark, sf_dir), _numeric_only())
    return r6(found.select("subject_id", "age", "size_mm", F.array_join("violations", ",").alias("violations")))


@query("validate_domain", f"{_ODD_CTE} {_DOMAIN_SQL}")
def validate_domain(spark, sf_dir):
    return validate.validate_domain(_odd(spark, sf_dir), SUBJECT)


def _report_sql() -> str:
    counts = {
        "schema": _SCHEMA_SQL, "missing": _MISSING_SQL, "duplicates": _DUPLICATE_SQL, "dtypes": _DTYPE_SQL,
        "ranges": _RANGE_SQL, "domain": _DOMAIN_SQL,
    }
    parts = _union(f"select '{k}' \"check\", (select count(*) from ({v}))::bigint issues" for k, v in counts.items())
    return (f"{_ODD_CTE}, found as ({parts}) select \"check\", issues, issues=0 ok from found "
            "union all select 'overall', sum(issues)::bigint, sum(issues)=0 from found")


@query("validation_report", _report_sql())
def validation_report(spark, sf_dir):
    return validate.validation_report(_odd(spark, sf_dir), _numeric_only())


def worded(df):
    """Requests spell gender out."""
    return df.withColumn("gender", F.when(F.col("gender") == "M", "Male").otherwise("Female"))


CONSTRAINT_SQL = """array_to_string(list_filter([
 case when not coalesce(age between 0 and 120,false) then 'age: outside 0 to 120' end,
 case when not coalesce(size_mm>0,false) then 'size_mm: must be positive' end,
 case when not coalesce(cost>=0,false) then 'cost: must not be negative' end,
 case when not coalesce(rate_a between 0 and 100,false) then 'rate_a: outside 0 to 100' end,
 case when not coalesce(rate_b between 0 and 100,false) then 'rate_b: outside 0 to 100' end,
 case when stage not in ('Localized','Regional','Metastatic') then 'stage: unknown stage' end], lambda x: x is not null), '; ')"""


@query("request_constraints", f"{SUBJECT_CTE} select subject_id, {CONSTRAINT_SQL} errors from subject")
def request_constraints(spark, sf_dir):
    checked = validate.request_constraints(worded(subject(spark, sf_dir)), SUBJECT)
    return checked.select("subject_id", F.array_join("errors", "; ").alias("errors"))

