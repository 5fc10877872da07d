"""CSV and Parquet tables, processed splits, JSON reports and baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.spec import METRICS

# --- fixed values: words that mean a missing value in a CSV file ---
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# --------------------------------------------------------------------

CSV_OPTIONS = {"header": "true", "escape": '"'}


def _typed(name: str, dtype: T.DataType) -> Column:
    raw = F.col(f"`{name}`")
    known = F.when(~raw.isin(*NA_TOKENS), raw)
    return (known if isinstance(dtype, T.StringType) else known.try_cast(dtype)).alias(name)


def _may_be_number(text: Column) -> Column:
    """False only for texts that no cast to a number takes: a failing cast costs an exception for every cell.

    White space, signs, points and digits sort before the colon; letters begin a number in nan and inf(inity) only.
    """
    return (text < ":") | F.lower(F.substring(text, 1, 3)).isin("nan", "inf")


def _inferred(raw: DataFrame) -> T.StructType:
    """Integer, else number, else string: one pass over all columns."""
    aggs = []
    for c in raw.columns:
        known = F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`"))
        word = ~_may_be_number(known)
        aggs += [
            F.count_if(known.isNotNull() & (word | known.contains(".") | known.try_cast("bigint").isNull())).alias(f"{c}__i"),
            F.count_if(known.isNotNull() & (word | known.try_cast("double").isNull())).alias(f"{c}__d"),
            F.count_if(known.isNull()).alias(f"{c}__na"),
            F.count("*").alias(f"{c}__n"),
        ]
    row = raw.agg(*aggs).first()

    def kind(c: str) -> T.DataType:
        if row[f"{c}__na"] == row[f"{c}__n"] or row[f"{c}__d"]:
            return T.DoubleType() if not row[f"{c}__d"] else T.StringType()
        return T.DoubleType() if row[f"{c}__i"] else T.LongType()

    return T.StructType([T.StructField(c, kind(c)) for c in raw.columns])


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool = False
) -> DataFrame:
    """A CSV table with a header. Missing-value words become null, also in typed columns.

    A given ``schema`` saves the inference pass. ``multiline`` allows line
    breaks in quoted cells, at the price of unsplit files.
    """
    raw = _raw_csv(spark, path, schema and T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]), multiline)
    return raw.select(*[_typed(f.name, f.dataType) for f in (schema or _inferred(raw)).fields])


def _raw_csv(spark: SparkSession, path: str, schema: T.StructType | None, multiline: bool, **options: str) -> DataFrame:
    try:
        reader = spark.read.options(**CSV_OPTIONS, **options).option("multiLine", multiline)
        return (reader if schema is None else reader.schema(schema)).csv(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from exc
        raise


def read_csv_rescued(
    spark: SparkSession, path: str, schema: T.StructType, row: str, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(the typed table of :func:`read_csv`, its rescued cells): no text of the file is lost.

    A rescued cell is (row, column, raw): the text of column ``row`` in its line, the column whose type its text
    doesn't have, and that text. Lines with more or fewer cells than the schema come as a whole, with a null
    column. Both tables are plans over the same file and read it once each.
    """
    line = "__line"
    while line in schema.names:
        line += "_"
    texts = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    raw = _raw_csv(spark, path, T.StructType([*texts, T.StructField(line, T.StringType())]), multiline,
                   columnNameOfCorruptRecord=line, columnPruning="false")  # a pruned line is not seen to be short

    def rescued(f: T.StructField) -> Column:
        text = F.col(f"`{f.name}`")
        bad = ~text.isin(*NA_TOKENS) & _typed(f.name, f.dataType).isNull()
        return F.when(bad, F.struct(F.lit(f.name).alias("column"), text.alias("raw")))

    whole = F.when(F.col(line).isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), F.col(line).alias("raw")))
    cells = F.array_compact(F.array(whole, *[rescued(f) for f in schema.fields if not isinstance(f.dataType, T.StringType)]))
    return (
        raw.select(*[_typed(f.name, f.dataType) for f in schema.fields]),
        raw.select(F.col(f"`{row}`").alias("row"), F.inline(cells)),
    )


def rescued_counts(rescued: DataFrame) -> DataFrame:
    """(column, cells): how many cells of each column were rescued."""
    return rescued.groupBy("column").agg(F.count("*").alias("cells"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """Processed rows with their ``split`` column, one folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; only its folder is listed and read."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def feature_names(spark: SparkSession, path: str, skip: Sequence[str]) -> list[str]:
    """Feature columns from the stored schema, without a job."""
    return [c for c in spark.read.parquet(path).columns if c not in skip]


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("json"))


def from_json_rows(rows: DataFrame, schema: T.StructType | str) -> DataFrame:
    return rows.select(F.from_json("json", schema).alias("r")).select("r.*")


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON lines, with the time it was made."""
    df.withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("text").load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def baseline_or_current(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(metric, baseline, current): a metric without a baseline is its own."""
    return (
        current.select("metric", F.col("value").alias("current"))
        .join(baseline.select("metric", F.col("value").alias("b")), "metric", "left")
        .select("metric", F.coalesce("b", "current").alias("baseline"), "current")
    )


def load_or_start_baseline(current: DataFrame, path: str) -> DataFrame:
    """The stored (metric, value) baseline; the first run stores its own metrics."""
    spark = current.sparkSession
    if not path_exists(spark, path):
        current.select("metric", "value").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def overwrite_baseline(metrics: DataFrame, path: str, model: str, reasons: Sequence[str]) -> None:
    """Replace the baseline after a retraining; ``metrics`` are (metric, value) rows."""
    rows = metrics.where(F.col("metric").isin(*METRICS)).select(
        "metric", "value",
        F.lit(model).alias("model_name"),
        F.array(*[F.lit(r) for r in reasons]).cast("array<string>").alias("retrained_due_to"),
        F.current_timestamp().alias("timestamp"),
    )
    rows.write.mode("overwrite").parquet(path)
