"""Mixing sources to target weights by capped water-filling.

A mix takes ``share_percent`` of all words. Every source gets words in proportion to its weight until it
has been taken ``max_epochs`` times; what is above that is dealt to the others by weight, until nobody is
above. A source is then repeated whole times, and the fraction that remains is filled with whole
documents in a seeded order, up to the document that comes nearest to the target.

Null texts and texts without words have size 0 and nothing is taken of them. A null source is a source of
its own, the last one. Repeated rows are rows like others. An empty table gives an empty result. Other
columns do not matter, whatever their names.

Nothing is sorted in one task: order inside a source is by a hash of the key. Words are summed per
source and hash bucket (about as many buckets as rows in one), and only the one bucket of a source in
which its cut lies is put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import WORD, col, hash_digits, numbered, seeded, sortable
from tablewarden.session import materialize


def water_fill(sources: DataFrame, share_percent: int, max_epochs: int) -> DataFrame:
    """``sources`` (source_size, weight, ...) with ``target``.

    Each turn clamps the sources that the current level lifts above their cap and raises the level for
    the rest; the comparison is exact, in whole numbers. A turn brings four sums to the driver.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    fixed, weight, clamped = 0, sources.agg(F.sum("weight")).first()[0] or 0, 0
    while True:
        wide = "decimal(38,0)"
        left = share_percent * total - 100 * fixed
        above = F.lit(left).cast(wide) * F.col("weight") >= F.lit(100 * weight).cast(wide) * cap
        found = sources.where(above).agg(F.sum(cap).alias("fixed"), F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).first()
        if found["n"] <= clamped:
            break
        free = sources.where(~above).agg(F.sum("weight")).first()[0] or 0
        fixed, weight, clamped = found["fixed"], free, found["n"]
        if not weight:
            break
    level = left / 100.0 / weight if weight else 0.0
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(F.lit(level) * F.col("weight")))


def mix(
    df: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share_percent: int = 150, max_epochs: int = 2,
    key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix",
) -> DataFrame:
    """Per row: key, source, size, source_size, target (its source's), repeats and taken (size x repeats).

    ``weights`` go to the sources by code point, repeating.
    """
    size = F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = materialize(
        df.select(
            col(key).alias("doc_id"), col(source).alias("source"), sortable(source).alias("s"), size.alias("size"),
            seeded(seed, key).alias("h"),
        ),
        "mix-rows",
    )
    sums = rows.groupBy("s").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = materialize(
        numbered(sums, "s", "at").withColumn(
            "weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("long")
        ),
        "mix-sources",
    )
    n = sources.agg(F.sum("n")).first()[0] or 0
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    filled = materialize(
        water_fill(sources, share_percent, max_epochs)
        .withColumn("whole", whole)
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("s", "source_size", "target", "whole", "need"),
        "mix-targets",
    )

    rows = rows.withColumn("bucket", F.substring("h", 1, hash_digits(n)))
    running = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    cuts = (
        buckets.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .join(filled, "s")
        .where((F.col("before") <= F.col("need")) & (F.col("need") < F.col("before") + F.col("words")))
        .select("s", F.col("bucket").alias("cut"), "before")
    )
    plan = materialize(filled.join(cuts, "s", "left"), "mix-plan")

    placed = rows.join(plan, "s")
    inside = F.coalesce(F.col("bucket") == F.col("cut"), F.lit(False))
    outside = placed.where(~inside).withColumn("extra", F.coalesce((F.col("bucket") < F.col("cut")).cast("int"), F.lit(0)))
    order = Window.partitionBy("s").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    at_cut = placed.where(inside).withColumn("extra", (2 * (F.col("need") - ahead) >= F.col("size")).cast("int"))
    repeats = (F.col("whole") + F.when(F.col("size") > 0, F.col("extra")).otherwise(0)).cast("long")
    return outside.unionByName(at_cut).select(
        "doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"),
        (F.col("size") * repeats).alias("taken"),
    )


def repeated(df: DataFrame, plan: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` as often as the plan of ``mix`` says. Rows that share a key share a plan."""
    times = plan.groupBy(F.col("doc_id").alias("__key")).agg(F.max("repeats").cast("int").alias("__times"))
    return (
        df.join(times, col(key).eqNullSafe(F.col("__key"))).where("__times > 0")
        .withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__times"))))
        .select(*(col(c) for c in df.columns))
    )
