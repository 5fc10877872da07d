"""Table checks. Each returns issue rows ``(check, column, detail, n)``; no rows means it passed.

Every check is one aggregation whose partial results are combined before the
shuffle, and its output has at most a few rows per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators.clean import cells, present
from tablewarden.spec import REQUEST_AGE, REQUEST_RATE, REQUEST_WORDS, ROLE_DOMAINS, TableSpec

ISSUE_SCHEMA = "check string, column string, detail string, n bigint"


def _rows(stats: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn the one row of an aggregate into one row per struct."""
    return stats.select(F.inline(F.array(*structs)))


def _issue(check: str, column: str, detail: Column | str, n: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"),
        n.cast("long").alias("n"),
    )


def _none(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)


def table_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, rows, columns, missing, bytes) in one pass.

    ``bytes`` is the size of the values: fixed widths, and the encoded length
    of strings. Size is reported from the data, not from one machine's memory.
    """
    widths = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4}
    aggs = [F.count("*").alias("rows")]
    for i, (name, dtype) in enumerate(df.dtypes):
        col = present(df, name)
        aggs.append(F.count_if(col.isNull()).alias(f"null_{i}"))
        if dtype == "string":
            aggs.append(F.coalesce(F.sum(F.octet_length(col)), F.lit(0)).alias(f"size_{i}"))
        else:
            aggs.append((F.count(col) * widths.get(dtype, 8)).alias(f"size_{i}"))
    return _rows(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(name).alias("column"), F.lit(dtype).alias("dtype"), F.col("rows"),
                F.lit(len(df.columns)).cast("long").alias("columns"),
                F.col(f"null_{i}").alias("missing"), F.col(f"size_{i}").alias("bytes"),
            )
            for i, (name, dtype) in enumerate(df.dtypes)
        ],
    )


# A check that one pass can answer is a pair: its aggregates, and the issues built from them.
Parts = tuple[list[Column], list[Column]]


def _schema_parts(df: DataFrame, spec: TableSpec) -> Parts:
    missing = [c for c in spec.expected_columns if c not in df.columns]
    extra = [c for c in df.columns if c not in spec.expected_columns]
    aggs = [F.count("*").alias("__rows")] if missing else []
    aggs += [F.count(f"`{c}`").alias(f"extra__{c}") for c in extra]
    issues = [_issue("schema", c, "missing", F.col("__rows")) for c in missing]
    issues += [_issue("schema", c, "unexpected", F.col(f"`extra__{c}`")) for c in extra]
    return aggs, issues


def _missing_parts(df: DataFrame) -> Parts:
    return (
        [F.count_if(present(df, c).isNull()).alias(f"null__{c}") for c in df.columns],
        [_issue("missing", c, "null values", F.col(f"`null__{c}`")) for c in df.columns],
    )


def _dtype_parts(df: DataFrame, spec: TableSpec) -> Parts:
    aggs, issues = [], []
    for f in df.schema.fields:
        if f.name in spec.numerical and not isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            value = F.col(f"`{f.name}`")
            bad = value.isNotNull() & value.cast("string").try_cast("double").isNull()
            aggs.append(F.count_if(bad).alias(f"type__{f.name}"))
            found = f"expected numeric, got {f.dataType.simpleString()}"
            issues.append(_issue("dtypes", f.name, found, F.col(f"`type__{f.name}`")))
    return aggs, issues


def _range_parts(df: DataFrame, spec: TableSpec) -> Parts:
    aggs, issues = [], []
    for c, (low, high) in spec.ranges.items():
        if c in df.columns:
            aggs += [
                F.min(present(df, c)).cast("double").alias(f"min__{c}"),
                F.max(present(df, c)).cast("double").alias(f"max__{c}"),
                F.count_if(_outside(present(df, c), low, high)).alias(f"out__{c}"),
            ]
            found = F.format_string("out of range: %s - %s", f"min__{c}", f"max__{c}")
            issues.append(_issue("ranges", c, found, F.col(f"out__{c}")))
    return aggs, issues


def _one_pass(df: DataFrame, *parts: Parts) -> DataFrame:
    """Issues of several checks from one scan; counts of 0 are issues only where the names alone decide."""
    aggs, issues = [a for p in parts for a in p[0]], [i for p in parts for i in p[1]]
    if not issues:
        return _none(df)
    return _rows(df.agg(*aggs), issues).where(F.col("check").isin("schema", "dtypes") | (F.col("n") > 0))


def validate_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns the table lacks or should not have; ``n`` counts the values concerned."""
    return _one_pass(df, _schema_parts(df, spec))


def validate_missing(df: DataFrame) -> DataFrame:
    """Columns with nulls or NaN and how many."""
    return _one_pass(df, _missing_parts(df))


def validate_dtypes(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Numeric columns stored as something else; ``n`` counts values that are no number."""
    return _one_pass(df, _dtype_parts(df, spec))


def validate_ranges(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns whose extremes leave their range; ``n`` counts the rows outside. Nulls are ignored."""
    return _one_pass(df, _range_parts(df, spec))


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row ``(n)``: rows beyond the first of each group of equal rows.

    Equal rows collapse in the map-side aggregate, so a group that holds a
    large part of the table costs one shuffled row per task.
    """
    return df.groupBy(*df.columns).agg(F.count("*").alias("__copies")).agg(
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("n")
    )


def validate_duplicates(df: DataFrame) -> DataFrame:
    return _rows(duplicate_count(df), [_issue("duplicates", "*", "repeated rows", F.col("n"))]).where("n > 0")


def _outside(col: Column, low, high) -> Column:
    tests = [col < low] if low is not None else []
    tests += [col > high] if high is not None else []
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def range_stats(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(column, min_value, max_value, n): the range issues with their extremes as numbers."""
    aggs, _ = _range_parts(df, spec)
    stats = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"min__{c}").alias("min_value"),
            F.col(f"max__{c}").alias("max_value"), F.col(f"out__{c}").alias("n"),
        )
        for c in spec.ranges if c in df.columns
    ]
    return _rows(df.agg(*aggs), stats).where("n > 0")


def range_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows outside a range, with the names of the columns concerned."""
    named = [
        F.when(_outside(F.col(c), low, high), F.lit(c))
        for c, (low, high) in spec.ranges.items() if c in df.columns
    ]
    return df.withColumn("violations", F.array_compact(F.array(*named))).where(F.size("violations") > 0)


def validate_domain(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Values outside the closed lists: ``detail`` is the value, ``n`` its count.

    Allowed values are dropped before anything is shuffled.
    """
    domains = {c: v for c, v in spec.domains.items() if c in df.columns}
    if not domains:
        return _none(df)
    unexpected = df.select(*[F.when(~F.col(c).isin(*allowed), F.col(c)).alias(c) for c, allowed in domains.items()])
    found = cells(unexpected, [], list(domains), "string", value="detail")
    return found.groupBy("column", "detail").agg(F.count("*").alias("n")).select(
        F.lit("domain").alias("check"), "column", "detail", "n")


CHECKS = ("schema", "missing", "duplicates", "dtypes", "ranges", "domain")


def validation_issues(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All issue rows of the six checks, from three scans: simple counts, duplicates, domains."""
    simple = _one_pass(
        df, _schema_parts(df, spec), _missing_parts(df), _dtype_parts(df, spec), _range_parts(df, spec))
    return simple.unionByName(validate_duplicates(df)).unionByName(validate_domain(df, spec))


def validation_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(check, issues, ok): one row per check and an ``overall`` row."""
    found = validation_issues(df, spec).groupBy().agg(
        *[F.count_if(F.col("check") == c).alias(c) for c in CHECKS], F.count("*").alias("overall")
    )
    return _rows(
        found,
        [
            F.struct(F.lit(c).alias("check"), F.col(c).alias("issues"), (F.col(c) == 0).alias("ok"))
            for c in (*CHECKS, "overall")
        ],
    )


def request_errors(spec: TableSpec, columns: Sequence[str]) -> Column:
    """Array of the constraints a scoring request breaks; missing values break them too."""
    def failing(role_or_col: str, ok: Column, text: str) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"{role_or_col}: {text}"))

    tests = []
    if age := spec.role("age", columns):
        tests.append(failing(age, F.col(age).between(*REQUEST_AGE), "outside 0 to 120"))
    if size := spec.role("size", columns):
        tests.append(failing(size, F.col(size) > 0, "must be positive"))
    if cost := spec.role("cost", columns):
        tests.append(failing(cost, F.col(cost) >= 0, "must not be negative"))
    for role in ("rate_a", "rate_b"):
        if rate := spec.role(role, columns):
            tests.append(failing(rate, F.col(rate).between(*REQUEST_RATE), "outside 0 to 100"))
    for c in spec.request_binary:
        if c in columns:
            tests.append(failing(c, F.col(c).isin(*REQUEST_WORDS), "no yes/no word"))
    if stage := spec.role("stage", columns):
        tests.append(failing(stage, F.col(stage).isin(*ROLE_DOMAINS["stage"]), "unknown stage"))
    return F.array_compact(F.array(*tests))


def request_constraints(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every row with its ``errors``; accepted rows have an empty array."""
    return df.withColumn("errors", request_errors(spec, df.columns))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") == 0).drop("errors")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") > 0)
