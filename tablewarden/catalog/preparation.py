"""Splits, folds, fitted state and the whole preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.catalog.drift import chi2_cte, ks_cte
from tablewarden.catalog.features import FEATURE_SQL, FLOAT_FEATURES, LEVELS, NUMERIC, feature_sql
from tablewarden.catalog.registry import query, r6
from tablewarden.catalog.views import SUBJECT_CTE, split_cte, stored_subject, subject, table
from tablewarden.operators.drift import feature_drift_report
from tablewarden.operators.encode import BINNED_LEVELS
from tablewarden.operators.features import NUMERIC_FEATURES
from tablewarden.operators.split import cv_folds, stratified_split
from tablewarden.plans import prepare
from tablewarden.plans.monitoring import with_side
from tablewarden.session import materialize, scratch_path
from tablewarden.spec import SUBJECT


@query("stratified_split", f"{SUBJECT_CTE}{split_cte()} select subject_id, outcome, split from split")
def split_query(spark, sf_dir):
    return stratified_split(subject(spark, sf_dir), "outcome", "subject_id").select("subject_id", "outcome", "split")


_THREE = split_cte("o_orderstatus", "orders", "o_orderkey").lstrip(", \n")


@query("stratified_split_three", f"with {_THREE} select o_orderkey, o_orderstatus, split from split")
def split_three(spark, sf_dir):
    """Three strata of very different size."""
    rows = stratified_split(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey")
    return rows.select("o_orderkey", "o_orderstatus", "split")


@query("split_hashed", """select o_orderkey, case when u < 0.2 then 'test' when u < 0.2+0.1 then 'val' else 'train' end split
 from (select o_orderkey, ('0x'||substr(md5('42:'||o_orderkey::varchar),1,8))::bigint/4294967296.0::double u from orders)""")
def split_hashed(spark, sf_dir):
    rows = stratified_split(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey", exact=False)
    return rows.select("o_orderkey", "split")


@query("cv_folds", f"""{SUBJECT_CTE},
dealt as (select outcome, subject_id, row_number() over (order by outcome) - 1 pos,
  row_number() over (partition by outcome order by md5('42:'||subject_id::varchar), subject_id) rn from subject),
parts as (select outcome, pos % 5 fold, count(*) n from dealt group by all),
ends as (select outcome, fold, sum(n) over (partition by outcome order by fold) hi, sum(n) over (partition by outcome order by fold) - n lo from parts)
select subject_id, d.outcome, ends.fold::int fold from dealt d join ends on ends.outcome=d.outcome and rn > lo and rn <= hi""")
def folds(spark, sf_dir):
    return cv_folds(subject(spark, sf_dir), "outcome", "subject_id").select("subject_id", "outcome", "fold")


# --- preparation -------------------------------------------------------------------------------

_YES = [c for c in SUBJECT.binary if c != "outcome"]
_CATEGORIES = {
    **LEVELS,
    "gender": ["F", "M"],
    **{c: ["0", "1"] for c in _YES},
    **{c: ["High", "Low", "Moderate"] for c in ("diet", "activity", "access")},
    "economy": ["Developed", "Developing"],
    "insurance": ["Insured", "Uninsured"],
    **BINNED_LEVELS,
}
_MODE = "(select {c} from feat where split='train' and {c} is not null group by 1 order by count(*) desc, 1 limit 1)"


def prepared_cte() -> str:
    """``feat``, ``clean`` (imputed, deduplicated) and ``done`` (encoded, scaled) per split."""
    names = list(FEATURE_SQL)
    feats = feature_sql(names, frame="(select * from split where split='train')", rounded=False)
    filled = [f"coalesce({c}, (select avg({c}) from feat where split='train')) {c}" for c in NUMERIC]
    filled += [f"coalesce({c}, {_MODE.format(c=c)}) {c}" for c in SUBJECT.categorical]
    keep = ", ".join([*filled, *names, "outcome", "split"])
    scaled = [
        f"round(({c}-(select avg({c}) from clean where split='train'))/(select coalesce(nullif(stddev_pop({c}),0),1) from clean where split='train'),6) {c}"
        for c in NUMERIC
    ]
    derived = [f"round({n},6) {n}" if n in FLOAT_FEATURES else n for n in names if n in NUMERIC_FEATURES]
    hot = []
    for c, levels in _CATEGORIES.items():
        for v in levels:
            test = f"({c}='Yes')::int='{v}'" if c in _YES else f"{c}='{v}'"
            hot.append(f'coalesce({test},false) "{c}_{v}"')
    return f"""{SUBJECT_CTE}{split_cte()},
feat as (select *, {feats} from split),
clean as (select distinct {keep} from feat),
done as (select split, {", ".join([*scaled, *derived, *hot])}, (outcome='Yes')::int outcome from clean)"""


_PREPARED = prepared_cte()


def _prepared(spark, sf_dir, **options):
    return prepare.run(stored_subject(spark, sf_dir), SUBJECT, validate=False, **options)


_DRIFT_NUMERIC = {c: c for c in (*NUMERIC, *(n for n in FEATURE_SQL if n in NUMERIC_FEATURES))}
_DRIFT_HOT = {f"{c}_{v}": f'"{c}_{v}"' for c, levels in _CATEGORIES.items() for v in levels}


@query("prepared_drift", f"""{_PREPARED}, sides as (select *, split = 'train' is_ref from done where split in ('train', 'val'))
{ks_cte(_DRIFT_NUMERIC, "sides")}{chi2_cte(_DRIFT_HOT, "sides")}
select feature, 'numerical' "type", round(d,6) statistic, round(p,6) p_value, p < 0.05 drift_detected from ks
 union all select feature, 'categorical', round(stat,6), round(p,6), p < 0.05 from chi""")
def prepared_drift(spark, sf_dir):
    """The prepared training part against the validation part, one-hot columns included."""
    done = _prepared(spark, sf_dir)
    rows = materialize(with_side(r6(done.train), r6(done.val)), "sides")
    return r6(feature_drift_report(rows, "is_ref", skip=["outcome"], exact_rows=0))


@query("preprocess_train", f"{_PREPARED} select * exclude (split) from done where split='train'")
def preprocess_train(spark, sf_dir):
    return r6(_prepared(spark, sf_dir).train)


@query("preprocess_test", f"{_PREPARED} select * exclude (split) from done where split='test'")
def preprocess_test(spark, sf_dir):
    return r6(_prepared(spark, sf_dir).test)


@query("prepare_splits", f"""{_PREPARED} select split, count(*)::bigint n, sum(outcome)::bigint positives, round(sum(size_mm),3) sum_size,
 round(sum(cost),3) sum_cost, sum(risk_score)::bigint sum_risk, sum("bmi_Normal"::int)::bigint normal_bmi, round(avg(cost_per_mm),6) mean_cost_per_mm
 from done group by split""")
def prepare_splits(spark, sf_dir):
    """Validate, derive, split, fit, transform and save, then a summary of the saved parts."""
    done = prepare.run(stored_subject(spark, sf_dir), SUBJECT, save_to=scratch_path(spark, "prepared"))
    parts = None
    for name, df in done.frames().items():
        part = df.select(F.lit(name).alias("split"), "outcome", "size_mm", "cost", "risk_score", "bmi_Normal", "cost_per_mm")
        parts = part if parts is None else parts.unionAll(part)
    return parts.groupBy("split").agg(
        F.count("*").alias("n"), F.sum("outcome").alias("positives"),
        F.round(F.sum("size_mm"), 3).alias("sum_size"), F.round(F.sum("cost"), 3).alias("sum_cost"),
        F.sum("risk_score").alias("sum_risk"), F.sum(F.col("bmi_Normal").cast("int")).alias("normal_bmi"),
        F.round(F.avg("cost_per_mm"), 6).alias("mean_cost_per_mm"),
    )


def _state_sql() -> str:
    parts = [f"select 'fill' kind, '{c}' \"column\", 0 pos, null::varchar value_str, round(avg({c}),6) value_dbl from feat where split='train'"
             for c in NUMERIC]
    parts += [f"select 'fill', '{c}', 0, {_MODE.format(c=c)}, null" for c in SUBJECT.categorical]
    for c in NUMERIC:
        parts += [f"select 'scale', '{c}', 0, null, round(avg({c}),6) from clean where split='train'",
                  f"select 'scale', '{c}', 1, null, round(stddev_pop({c}),6) from clean where split='train'"]
    for c, levels in _CATEGORIES.items():
        parts += [f"select 'level', '{c}', {i}, '{v}', null" for i, v in enumerate(levels)]
    parts += ["select 'maximum', 'age', 0, null, max(age)::double from feat where split='train'",
              "select 'maximum', 'size', 0, null, max(size_mm) from feat where split='train'"]
    return f"{_PREPARED} " + " union all ".join(parts)


@query("fit_state", _state_sql())
def fit_state(spark, sf_dir):
    """The fitted state after a round through storage."""
    path = scratch_path(spark, "state")
    _prepared(spark, sf_dir).state.save(spark, path)
    back = prepare.PrepState.load(spark, path).as_table(spark)
    return r6(back.where(F.col("kind").isin("fill", "scale", "level", "maximum")).drop("ord"))
