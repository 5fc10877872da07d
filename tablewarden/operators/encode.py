"""Binary, one-hot, label and target encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.functions.sql import name, text
from tablewarden.operators.clean import cells, level_counts, long_form
from tablewarden.operators.features import yes_flag
from tablewarden.operators.ranks import cumulate, range_bits
from tablewarden.session import materialize
from tablewarden.spec import AGE_BINS, SIZE_BINS, TableSpec

# Codes up to this many rows become literals; larger code tables are joined. Both give the same.
MAX_LITERAL_CODES = 2_000
# Levels that may become columns of their own, over all columns of a table.
MAX_WIDE_LEVELS = 20_000

BINNED_LEVELS = {
    "age_group": [label for _, _, label in AGE_BINS],
    "tumor_severity": [label for _, _, label in SIZE_BINS],
}


def encode_binary(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Yes becomes 1; no, null and anything else becomes 0."""
    return df.withColumns({
        c: yes_flag(F.col(c), spec.positive) for c in spec.binary if c in df.columns
    })


def categorical_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Configured categories, then every other string column that is not binary or the target."""
    configured = [c for c in spec.categorical if c in df.columns]
    detected = [
        c for c, dtype in df.dtypes
        if dtype == "string" and c not in spec.binary and c != spec.target and c not in configured
    ]
    return configured + [c for c in detected if c not in spec.drop]


# --- one-hot -----------------------------------------------------------------------

def few_levels(counts: DataFrame) -> list:
    """The rows of a level table that is to become columns; an error beyond ``MAX_WIDE_LEVELS`` of them."""
    rows = counts.limit(MAX_WIDE_LEVELS + 1).collect()
    if len(rows) > MAX_WIDE_LEVELS:
        raise ValueError(
            f"more than {MAX_WIDE_LEVELS} levels: use encode_onehot_indices, or label or target codes, for such columns")
    return rows


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels per column, for columns in their own right. Binned features always have all their labels."""
    seen = [c for c in columns if c not in BINNED_LEVELS]
    found: dict[str, list[str]] = {c: [] for c in columns}
    if seen:
        for r in few_levels(level_counts(df, seen).select("column", "value")):
            found[r["column"]].append(r["value"])
    return {c: BINNED_LEVELS[c] if c in BINNED_LEVELS else sorted(v) for c, v in found.items()}


def onehot_name(column: str, level: str) -> str:
    return f"{column}_{level}"


def encode_onehot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """One boolean column per fitted level; null and unseen values are false everywhere.

    Written as SQL text: one string per column keeps the building of plans
    with thousands of columns cheap.
    """
    rest = [name(c) for c in df.columns if c not in levels]
    dummies = [
        f"coalesce(cast({name(c)} as string) = {text(v)}, false) as {name(onehot_name(c, v))}"
        for c, vs in levels.items() for v in vs
    ]
    return df.selectExpr(*rest, *dummies)


def encode_onehot_sparse(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """(id, column, value) of the cells that are hot: any number of levels, no fit."""
    return cells(df, [id_col], columns, "string")


def fit_level_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored (column, value, n, index): every level of every column, numbered column by column in sorted order.

    Any number of levels: they are ranked in ranges, and neither the driver nor the plan sees them.
    """
    levels = level_counts(df, columns).withColumn("one", F.lit(1).cast("long"))
    bits = range_bits(df)
    bounds = _string_bounds(levels.select("column", "value"), columns, bits)
    placed = materialize(cumulate(levels, ["column"], "value", ["one"], bounds, bits, few_keys=True), "level-ranks")
    # One row per column.
    sizes = placed.groupBy("column").agg(F.max("total_one").alias("size"))
    position = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    before = Window.partitionBy().orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("column", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return materialize(
        placed.join(F.broadcast(offsets), "column").select("column", "value", "n", (F.col("offset") + F.col("below_one")).alias("index")),
        "level-index")


def encode_onehot_indices(df: DataFrame, id_col: str, columns: Sequence[str], index: DataFrame) -> DataFrame:
    """(id, indices): the numbers of a row's levels in rising order, the hot positions of its one-hot vector.

    Null and unseen values have no number. One join with the stored index of any size: levels with more than a
    thousandth of all fitted cells, less than a thousand of them, are broadcast to their rows, so no level is a hot key.
    A row gathers one number per column.
    """
    found = materialize(cells(df, [id_col], columns, "string"), "level-cells")
    limit = (index.agg(F.sum("n")).first()[0] or 0) // 1000
    hot, cold = (index.where(test).drop("n") for test in (F.col("n") > limit, F.col("n") <= limit))
    by = ["column", "value"]
    hits = found.join(F.broadcast(hot), by).unionByName(
        found.join(F.broadcast(hot.select(*by)), by, "left_anti").join(cold, by))
    vectors = hits.groupBy(id_col).agg(F.sort_array(F.collect_list("index")).alias("indices"))
    none = F.lit([]).cast("array<long>")
    return df.select(id_col).join(vectors, id_col, "left").withColumn("indices", F.coalesce("indices", none))


# --- label and target --------------------------------------------------------------

def _string_bounds(levels: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """Range bounds per column: the levels with the smallest hashes, a fair sample.

    At most ``2**bits - 1`` rows per column are gathered (a distributed top-k).
    """
    size = (1 << bits) - 1
    picks = None
    for c in columns:
        part = levels.where(F.col("column") == c).orderBy(F.xxhash64("value"), "value").limit(size)
        picks = part if picks is None else picks.unionAll(part)
    cuts = F.sort_array(F.collect_list("value"))
    pad = F.array_repeat(F.element_at(cuts, -1), F.greatest(F.lit(0), size - F.size(cuts)))
    return picks.groupBy("column").agg(F.concat(cuts, pad).alias("__bounds"))


def fit_label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): rank of each level among the sorted levels of its column."""
    levels = long_form(df, columns, "string").distinct().withColumn("one", F.lit(1).cast("long"))
    bits = range_bits(df)
    bounds = _string_bounds(levels.drop("one"), columns, bits)
    placed = cumulate(levels, ["column"], "value", ["one"], bounds, bits, few_keys=True)
    return placed.select("column", "value", F.col("below_one").alias("code"))


def fit_target_means(df: DataFrame, columns: Sequence[str], target: Column) -> DataFrame:
    """(column, value, code): mean of a 0/1 target per level, without smoothing."""
    rows = cells(df.withColumn("__y", target.cast("double")), ["__y"], columns, "string")
    return rows.groupBy("column", "value").agg(F.avg("__y").alias("code"))


def apply_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], unseen: str = "error") -> DataFrame:
    """Replace each value by its code.

    A small code table (its size is checked) becomes literals; a larger one is
    joined per column, which Spark may split further when a level is hot.
    Codes keep the type of the code table, also in columns without a level. ``unseen`` is ``error`` or ``null``.
    """
    kind = codes.schema["code"].dataType
    rows = codes.select("column", "value", "code").limit(MAX_LITERAL_CODES + 1).collect()
    literal = len(rows) <= MAX_LITERAL_CODES

    def checked(column: str, code: Column) -> Column:
        if unseen == "null":
            return code
        value = F.col(name(column))
        problem = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), value.cast("string")))
        return F.when(value.isNull() | code.isNotNull(), code).otherwise(problem)

    if literal:
        out = {}
        for c in columns:
            entries = [x for r in rows if r["column"] == c for x in (F.lit(r["value"]), F.lit(r["code"]).cast(kind))]
            value = F.col(f"`{c}`").cast("string")
            found = F.try_element_at(F.create_map(*entries), value) if entries else F.lit(None).cast(kind)
            out[c] = checked(c, found)
        return df.withColumns(out)
    for c in columns:
        mine = codes.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        df = df.join(mine, F.col(f"`{c}`").cast("string") == F.col("__value"), "left")
        df = df.withColumn(c, checked(c, F.col("__code"))).drop("__value", "__code")
    return df
