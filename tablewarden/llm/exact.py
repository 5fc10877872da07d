"""Exact duplicates by progressive refinement, in DataFrame functions only.

Texts can be equal only if their lengths are equal, then only if hashes of their prefixes are equal, then
they are equal if their SHA-256 digests are. Each turn counts groups over all rows and hands the next one
a bitmap of the groups that still have two rows or more; only rows that the bitmap lets through are read
further, so whole texts are hashed for the last groups alone (or for all rows, where the caller wants every
digest). A bitmap has ``BITS`` bits whatever the table's size, which bounds what is broadcast. Two groups that
meet in one bit cost a needless hash and change no result: the groups that are returned come from the
lengths and digests.

Nulls count as empty texts and are equal to them. The row with the largest key stays, a null key being the
smallest; of rows that also share that key exactly one stays. Rows whose text nobody shares are groups of
one. Other columns do not matter, whatever their names; an empty table gives no rows.

A group may hold any share of the table. Its rows are combined on the map side before they are shuffled, and
groups of more than a thousandth of all rows, which are less than a thousand, are broadcast back to
their rows; so no task of the join receives more than that of one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import col
from tablewarden.session import materialize

PREFIX = 256
BITS = 1 << 26  # 8 MB
HOT_SHARE = 1000


def _bit(key: Column) -> Column:
    """The bit of a 64-bit key, from 1."""
    return F.pmod(key, F.lit(BITS)) + 1


def shared(df: DataFrame, key: Column) -> DataFrame:
    """(chunk, bits): a bitmap of the values of ``key`` that two rows or more have. At most BITS bits."""
    groups = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunk = F.bitmap_bucket_number(_bit(F.col("key")))
    return (
        groups.select(chunk.alias("chunk"), F.bitmap_bit_position(_bit(F.col("key"))).alias("position"))
        .repartition("chunk").groupBy("chunk").agg(F.bitmap_construct_agg("position").alias("bits"))
    )


def passing(df: DataFrame, key: Column, bitmap: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean column ``name``: whether the bitmap holds the row's key."""
    marked = F.broadcast(bitmap.select(F.col("chunk").alias("__chunk"), F.col("bits").alias("__bits")))
    at = F.bitmap_bit_position(_bit(key))
    byte = F.conv(F.hex(F.substring("__bits", F.expr("1") + F.shiftright(at, 3).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1
    joined = df.join(marked, F.bitmap_bucket_number(_bit(key)) == F.col("__chunk"), "left")
    return joined.withColumn(name, F.coalesce(held, F.lit(False))).drop("__chunk", "__bits")


def digested(df: DataFrame, key: str = "doc_id", text: str = "text", every_digest: bool = False) -> DataFrame:
    """Per row: doc_id, row (a number of its own), n_bytes, and ``digest`` where the row's group survived.

    ``text_sha256`` is the digest of every row if ``every_digest``, else the same as ``digest``.
    """
    plain = F.coalesce(col(text), F.lit(""))
    texts = df.select(col(key).alias("doc_id"), plain.alias("text"), F.octet_length(plain).cast("long").alias("n_bytes"))
    length, prefix = F.col("n_bytes"), F.xxhash64("n_bytes", F.substring("text", 1, PREFIX))
    lengths = materialize(shared(texts, length), "exact-lengths")
    alike = passing(texts, length, lengths, "same_length")
    prefixes = materialize(shared(alike.where("same_length"), prefix), "exact-prefixes")
    alike = passing(alike, F.when(F.col("same_length"), prefix), prefixes, "same_prefix")
    digest = F.sha2("text", 256)
    found = digest if every_digest else F.when(F.col("same_prefix"), digest)
    return materialize(
        alike.withColumn("text_sha256", found).select(
            "doc_id", F.monotonically_increasing_id().alias("row"), "n_bytes",
            F.when(F.col("same_prefix"), F.col("text_sha256")).alias("digest"), "text_sha256"),
        "exact-rows",
    )


def exact_groups(
    df: DataFrame, key: str = "doc_id", text: str = "text", every_digest: bool = False, hot_rows: int | None = None,
) -> DataFrame:
    """Per row: doc_id, keep_id (key of the row that stays), group_size, kept, n_bytes, text_sha256.

    ``text_sha256`` is null for rows that were told apart by length or prefix, unless ``every_digest``.
    Groups above ``hot_rows`` (a thousandth of all rows) are joined by broadcast.
    """
    rows = digested(df, key, text, every_digest)
    alike, alone = rows.where(F.col("digest").isNotNull()), rows.where(F.col("digest").isNull())
    groups = materialize(
        alike.groupBy("n_bytes", "digest")
        .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"),
        "exact-groups",
    )
    limit = max(1, rows.count() // HOT_SHARE) if hot_rows is None else hot_rows
    hot, cold = groups.where(F.col("group_size") > limit), groups.where(F.col("group_size") <= limit)
    by = ["n_bytes", "digest"]
    parts = (
        alike.join(F.broadcast(hot), by),
        alike.join(F.broadcast(hot.select(*by)), by, "left_anti").join(cold, by, "left"),
        alone.withColumn("best", F.lit(None).cast(groups.schema["best"].dataType)).withColumn("group_size", F.lit(1)),
    )
    names = ("doc_id", "row", "n_bytes", "text_sha256", "best", "group_size")
    single = F.col("best").isNull()
    out = parts[0].select(*names).unionByName(parts[1].select(*names)).unionByName(parts[2].select(*names))
    return out.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("best.row") == F.col("row"))).alias("kept"), "n_bytes", "text_sha256",
    )
