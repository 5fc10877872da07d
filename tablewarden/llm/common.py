"""Helpers that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.session import materialize

# A word: what contracts count, and what shingles are made of.
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def seeded(seed: str, key: str) -> Column:
    """A hexadecimal hash of a key column; rows sorted by it are in a seeded random order. Null is a key too."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col(key).cast("string"), F.lit("null"))))


def hash_digits(rows: int) -> int:
    """Hexadecimal digits that cut ``rows`` seeded keys into about as many buckets as a bucket has rows."""
    return max(1, math.ceil(math.log(max(rows, 2), 16) / 2))


def sortable(name: str) -> Column:
    """A string column as a key that is never null and sorts by code point, null last."""
    return F.when(col(name).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), col(name).cast("string")))


def numbered(df: DataFrame, by: str, name: str) -> DataFrame:
    """``df`` with its zero-based position in the order of ``by``, without a sort in one task.

    Rows are sorted inside ranges; only one count per range is brought together.
    """
    ranged = materialize(
        df.repartitionByRange(F.col(by).asc()).sortWithinPartitions(by).withColumn("__id", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("__id", 33)
    counts = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    starts, at = [], 0
    for row in counts:
        starts.append((row["__part"], at))
        at += row["n"]
    schema = T.StructType([T.StructField("__part", T.LongType()), T.StructField("__start", T.LongType())])
    table = df.sparkSession.createDataFrame(starts, schema)
    index = F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn("__part", part).join(F.broadcast(table), "__part").withColumn(name, index)
        .drop("__part", "__start", "__id")
    )


def join_groups(rows: DataFrame, groups: DataFrame, by: list[str], size: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` joined to one row per group, where a group may hold any share of the rows.

    Groups of more than a thousandth of ``total`` rows, by their column ``size``, are less than a thousand: these are
    broadcast to their rows, so that no task of the other join gets more than a thousandth by one key. Both tables
    are read twice and should be stored. With ``how="left"`` rows without a group are kept.
    """
    limit = max(1, total // 1000)
    hot, cold = groups.where(F.col(size) > limit), groups.where(F.col(size) <= limit)
    parts = rows.join(F.broadcast(hot), by), rows.join(F.broadcast(hot.select(*by)), by, "left_anti").join(cold, by, how)
    return parts[0].unionByName(parts[1])
