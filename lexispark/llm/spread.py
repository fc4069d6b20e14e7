"""Joins, numbers and running values over groups of any size (operators 11-13).

Nothing here gives one group to one task. Frames that are read more than once
are staged by the caller; keys are never null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage

#: A key with more than 1/HOT of all rows is joined by broadcast; fewer than HOT keys can be.
HOT = 1000
#: Rows of one bucket: 2 ** BITS neighbours in the order.
BITS = 12


def hot_join(left: DataFrame, right: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Inner join of ``left`` with ``right``, whose keys are unique and whose
    column ``weight`` counts the rows of ``left`` with that key. Heavy keys (under
    ``HOT`` of them, whatever the input) are broadcast, so that their rows stay
    where they are; the rest is joined by a shuffle."""
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).collect()[0]["n"]
    heavy = F.col(weight) > F.lit(total // HOT)
    hot = F.broadcast(right.filter(heavy))
    rest = left.join(F.broadcast(right.filter(heavy).select(*on)), on, "left_anti")
    return left.join(hot, on).unionByName(rest.join(right.filter(~heavy), on))


def numbered(df: DataFrame, order: list[Column], name: str, s: str = "s") -> DataFrame:
    """``df``, staged, with a whole number that grows in the given order:
    consecutive within each range of the sort, with gaps between ranges."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.withColumn(s, F.monotonically_increasing_id()), name)


def _over(df: DataFrame, group: list[str], s: str, bits: int) -> tuple[DataFrame, list[str]]:
    return df.withColumn("_bucket", F.shiftright(s, bits)), [*group, "_bucket"]


def running(df: DataFrame, group: list[str], s: str, values: dict[str, tuple], bits: int = BITS) -> DataFrame:
    """``df`` with running values (this row's included) in the order of ``s``
    within each group: name -> (aggregate, column), the aggregate being ``F.sum`` or
    ``F.bit_xor``. Neighbours in ``s`` form buckets; a bucket is one task's work,
    and only one row of each bucket takes part in the pass over a whole group."""
    df, keys = _over(df, group, s, bits)
    rows = Window.partitionBy(*keys).orderBy(s).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(*[f(c).alias(f"_{n}") for n, (f, c) in values.items()])
    before = totals.select(*keys, *[F.coalesce(f(F.col(f"_{n}")).over(earlier), F.lit(0)).alias(f"_{n}")
                                    for n, (f, c) in values.items()])
    inside = df.select("*", *[f(c).over(rows).alias(n) for n, (f, c) in values.items()])

    def plus(n, f):
        here, there = F.col(n), F.col(f"_{n}")
        return (here.bitwiseXOR(there) if f is F.bit_xor else here + there).alias(n)

    rest = [c for c in df.columns if c != "_bucket"]
    return inside.join(before, keys).select(*rest, *[plus(n, f) for n, (f, _) in values.items()])


def following(df: DataFrame, group: list[str], s: str, column: str, name: str, bits: int = BITS) -> DataFrame:
    """``df`` with the value of ``column`` (which grows with ``s``) in the group's
    next row, null in its last."""
    df, keys = _over(df, group, s, bits)
    firsts = (df.groupBy(*keys).agg(F.min(column).alias("_first"))
              .select(*keys, F.lead("_first").over(Window.partitionBy(*group).orderBy("_bucket")).alias("_later")))
    inside = df.withColumn(name, F.lead(column).over(Window.partitionBy(*keys).orderBy(s)))
    rest = [c for c in df.columns if c != "_bucket"]
    return inside.join(firsts, keys).select(*rest, F.coalesce(name, "_later").alias(name))
