"""Sharding by proportional stratified interleaving.

Rows get a seeded random order within their source, and the fractional rank (2 r + 1) / (2 n) of a row
says how far into its source it stands. Sorting all rows by the fractional rank interleaves the sources
in proportion, and cutting that order into equal runs gives shards that all have the mixture of the whole
table. Row counts of shards differ by one at most, so the law is ``rows``; the shard a row would have if
there were one more shard is not defined by its key alone, and ``grown_shard`` is null.

Null texts have no bytes and the checksum of an empty text. A null source is a source of its own.
Repeated rows are rows like others: they may stand in different shards. With fewer rows than shards,
some shards are empty. Other columns do not matter, whatever their names.

Both orders are built from counts per bucket and positions inside a bucket. Buckets of the seeded order are
hash ranges, those of the interleaved order are ranges of the fractional rank; both are even by
construction, about as many as a bucket has rows, however large one source is.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import col, hash_digits, seeded, sortable
from tablewarden.session import materialize


def interleave(
    df: DataFrame, shards: int = 24, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "shard",
) -> DataFrame:
    """Per row: doc_id, source, size, text_crc32, law, shard, slot and grown_shard."""
    plain = F.coalesce(col(text), F.lit("")).cast("binary")
    rows = materialize(
        df.select(
            col(key).alias("doc_id"), col(source).alias("source"), sortable(source).alias("s"),
            (F.octet_length(plain) + 8).cast("long").alias("size"), F.crc32(plain).alias("text_crc32"),
            seeded(seed, key).alias("h"),
        ),
        "shard-rows",
    )
    n = rows.count()
    rows = rows.withColumn("bucket", F.substring("h", 1, hash_digits(n)))
    ahead = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("s", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "s", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("s")).alias("of_source"),
    )
    within = F.row_number().over(Window.partitionBy("s", "bucket").orderBy("h", "text_crc32", "size"))
    rank = F.col("start") + F.col("within") - 1
    fraction = (2 * rank + 1).cast("double") / (2 * F.col("of_source")).cast("double")
    parts = max(1, math.isqrt(n))
    ranked = materialize(
        rows.withColumn("within", within).join(starts, ["s", "bucket"])
        .select("doc_id", "source", "s", "size", "text_crc32", fraction.alias("fraction"))
        .withColumn("part", F.floor(F.col("fraction") * parts)),
        "shard-ranks",
    )
    # About the square root of all rows, so one window over them stays small.
    offsets = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("fraction", "s"))
    position = F.col("start") + F.col("place") - 1
    shard = F.expr(f"cast(position * {shards} div {max(n, 1)} as int)")
    first = F.expr(f"(cast(shard as long) * {n} + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("place", place).join(offsets, "part").withColumn("position", position)
        .withColumn("shard", shard).withColumn("slot", F.col("position") - first)
        .select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"))
    )
