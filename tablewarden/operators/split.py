"""Stratified splits with exact sizes, decided per row.

Rows are ordered by a hash of their id inside each stratum. A split is a set of
cut points in that order, found from counts per hash range and a look into the
few ranges a cut falls in. The table itself is never sorted: once the cuts are
known, one row per stratum, membership is a join with them and a projection.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.session import materialize

RANGE_ROWS = 50_000  # rows that a hash range should hold
LITERAL_STRATA = 64  # cuts of up to this many strata go into the plan; those of more are joined


def row_hash(id_col: str | Column, seed: int) -> Column:
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col.cast("string"), F.lit("null"))))


class HashOrder:
    """The rows of each stratum in the order of their hash.

    The number of hash ranges grows with the table, so a range keeps its size. Only the sizes of the
    strata, one row for each, come to the driver.
    """

    def __init__(self, df: DataFrame, stratum: str, id_col: str, seed: int):
        self.df, self.stratum, self.id_col, self.seed = df, stratum, id_col, seed
        # Three narrow columns, written once: sizes, counts and the look into ranges read them.
        self.rows = materialize(
            df.select(F.col(stratum).alias("s"), F.col(id_col).alias("id"), row_hash(id_col, seed).alias("h")), "split-order")
        found = self.rows.groupBy("s").agg(F.count("*").alias("n")).collect()
        self.sizes = dict(sorted(((r["s"], r["n"]) for r in found), key=lambda kv: (kv[0] is None, str(kv[0]))))
        # Hexadecimal digits of the hash that name a range; at most eight, four billion ranges.
        ranges = max(1, sum(self.sizes.values()) // RANGE_ROWS)
        self.digits = min(8, max(1, math.ceil(math.log(ranges, 16))))

    def cuts(self, ranks: Mapping[object, Sequence[int]]) -> DataFrame:
        """(s, cuts): per stratum the (h, id) of the rows at its 1-based ``ranks``, null for rank 0.

        Raises if the row after a cut has the same id: then ids repeat and no exact cut exists.
        """
        spark = self.df.sparkSession
        kind = self.df.schema[self.stratum].dataType
        rows = self.rows.withColumn("b", F.substring("h", 1, self.digits))
        schema = T.StructType([
            T.StructField("s_", kind), T.StructField("pos", T.IntegerType()), T.StructField("rank", T.LongType())])
        wanted = spark.createDataFrame([(s, i, r) for s, rs in ranks.items() for i, r in enumerate(rs)], schema)
        counts = rows.groupBy("s", "b").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("s").orderBy("b"))
        ranges = counts.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("n"))
        place = (F.col("s").eqNullSafe(F.col("s_"))) & (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("upto"))
        # At most one range per cut is ordered, each by itself; the cuts, not the rows, go to where the others are.
        places = ranges.join(wanted, place).groupBy(F.col("s").alias("s_"), F.col("b").alias("b_")).agg(
            F.collect_list(F.struct((F.col("rank") - F.col("below")).alias("inner"), "pos")).alias("at"))
        held = rows.join(F.broadcast(places), F.col("s").eqNullSafe(F.col("s_")) & (F.col("b") == F.col("b_")))
        order = Window.partitionBy("s", "b").orderBy("h", "id")
        picked = (
            held.withColumn("rn", F.row_number().over(order))
            .withColumn("tied", F.coalesce(F.lead("h").over(order) == F.col("h"), F.lit(False)) & F.lead("id").over(order).eqNullSafe(F.col("id")))
            .withColumn("here", F.filter("at", lambda x: x["inner"] == F.col("rn")))
            .where(F.size("here") > 0)
            .select("s", "h", "id", "tied", F.explode("here").alias("cut"))
            .select("s", "h", "id", "tied", F.col("cut.pos").alias("pos"))
        )
        checked = F.when(F.col("tied"), F.raise_error(F.lit(f"repeated values in {self.id_col}: no exact split"))).otherwise(F.col("h"))
        found = picked.select(F.col("s").alias("f_s"), F.col("pos").alias("f_pos"), F.struct(checked.alias("h"), "id").alias("cut"))
        joined = wanted.join(found, F.col("s_").eqNullSafe(F.col("f_s")) & (F.col("pos") == F.col("f_pos")), "left")
        table = joined.groupBy(F.col("s_").alias("__s")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "cut"))), lambda x: x["cut"]).alias("__cuts"))
        return materialize(table, "cuts")

    def part(self, ranks: Mapping[object, Sequence[int]], column: str, names: Sequence[str] | None = None) -> DataFrame:
        """The table with the number (0 first) or name of the part that each row belongs to.

        The cuts have one row per stratum. Few are written into the plan, which then needs no join; for more,
        Spark picks the join from their stored size. Both give the same result.
        """
        if not self.sizes:
            return self.df.withColumn(column, F.lit(None).cast("string" if names else "int"))
        key, ident = row_hash(self.id_col, self.seed), F.col(self.id_col)

        def after(cut: Column) -> Column:
            # Null ids come first, as in the ordering.
            later = F.coalesce(ident > cut["id"], ident.isNotNull() & cut["id"].isNull())
            return F.when(cut.isNull() | (key > cut["h"]) | ((key == cut["h"]) & later), 1).otherwise(0)

        def value(cuts: Column) -> Column:
            number = F.aggregate(cuts, F.lit(0), lambda n, cut: n + after(cut))
            return F.get(F.array(*[F.lit(n) for n in names]), number) if names else number

        cuts = self.cuts(ranks)
        if len(self.sizes) <= LITERAL_STRATA:
            kind, stored = cuts.schema["__cuts"].dataType, None
            for r in cuts.collect():
                here = F.array(*[
                    F.lit(None).cast(kind.elementType) if c is None
                    else F.struct(F.lit(c["h"]).alias("h"), F.lit(c["id"]).alias("id")) for c in r["__cuts"]]).cast(kind)
                same = F.col(self.stratum).eqNullSafe(F.lit(r["__s"]))
                stored = F.when(same, here) if stored is None else stored.when(same, here)
            return self.df.withColumn(column, value(stored))
        return (
            self.df.join(cuts, F.col(self.stratum).eqNullSafe(F.col("__s")))
            .withColumn(column, value(F.col("__cuts"))).drop("__s", "__cuts"))


def _share_out(sizes: Sequence[int], draws: int) -> list[int]:
    """Split ``draws`` over classes in proportion to ``sizes``: whole parts, then largest remainders."""
    total = sum(sizes)
    if not total:
        return [0] * len(sizes)
    whole = [s * draws // total for s in sizes]
    rest = sorted(range(len(sizes)), key=lambda i: (-(sizes[i] * draws % total), i))
    for i in rest[: draws - sum(whole)]:
        whole[i] += 1
    return whole


def split_sizes(sizes: Mapping[object, int], test: float, validation: float) -> dict[object, tuple[int, int, int]]:
    """(test, validation, train) rows per stratum.

    The test part is taken first, the validation part from what is left, each
    rounded up in total and shared over the strata in proportion.
    """
    classes, n = list(sizes), list(sizes.values())
    total = sum(n)
    keep = _share_out(n, total - math.ceil(test * total))
    tests = [a - b for a, b in zip(n, keep, strict=True)]
    if validation > 0:
        left = sum(keep)
        train = _share_out(keep, left - math.ceil(validation / (1 - test) * left))
    else:
        train = keep
    vals = [a - b for a, b in zip(keep, train, strict=True)]
    return {c: (t, v, r) for c, t, v, r in zip(classes, tests, vals, train, strict=True)}


def stratified_split(
    df: DataFrame,
    target: str,
    id_col: str,
    test: float | None = None,
    validation: float | None = None,
    seed: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """Add ``split`` (train, test or val). Empty arguments take the defaults .2, .1 and 42.

    Exact sizes need ids that do not repeat; a repeated id at a cut raises an error. A null id counts as
    one more id. ``exact=False`` compares the hash with the fractions: no job at all, sizes right on average.
    """
    test, validation, seed = test or 0.2, validation or 0.1, seed or 42
    names = ("test", "val", "train")
    if exact:
        order = HashOrder(df, target, id_col, seed)
        sizes = split_sizes(order.sizes, test, validation)
        return order.part({c: (t, t + v) for c, (t, v, _) in sizes.items()}, "split", names)
    u = hash_fraction(id_col, seed)
    part = F.when(u < test, 0).when(u < test + validation, 1).otherwise(2)
    return df.withColumn("split", F.get(F.array(*[F.lit(s) for s in names]), part))


def hash_fraction(id_col: str | Column, seed: int) -> Column:
    """The first 32 bits of the row hash as a number in [0, 1)."""
    return F.conv(F.substring(row_hash(id_col, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def fold_sizes(sizes: Mapping[object, int], folds: int) -> dict[object, list[int]]:
    """Rows per fold and class: classes are dealt round-robin, one after the other."""
    out, start = {}, 0
    for c, n in sizes.items():
        out[c] = [len(range((f - start) % folds, n, folds)) for f in range(folds)]
        start += n
    return out


def cv_folds(df: DataFrame, target: str, id_col: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` (0 .. folds-1): stratified, sizes differ by at most one per class."""
    order = HashOrder(df, target, id_col, seed)
    ranks = {
        c: [sum(parts[: i + 1]) for i in range(folds - 1)] for c, parts in fold_sizes(order.sizes, folds).items()
    }
    return order.part(ranks, "fold")
