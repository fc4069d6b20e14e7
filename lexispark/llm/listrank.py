"""Distributed list ranking: the place of every element of one linked list.

A round contracts the list, a later join expands it again:

* local round: ranges of ids (neighbours in the ids are often neighbours in the
  list) contract every chain that stays inside a range to its first element;
* mate round, when a local round leaves over half: each element draws a coin, and
  one with heads takes over a next one with tails, a quarter of all on average. It
  needs no locality, so the rounds are logarithmic for any list.

What is left (at most ``LAST`` elements) is ranked by one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ready, stage

#: Elements ranked by one task at the end.
LAST = 8192
#: Elements of a range at most, on average (a task holds some 60 bytes of each).
RANGE = 1_000_000
#: Elements whose place is sent to every task; beyond, a join.
FEW = 500_000

SCHEMA = "id long, head long, offset long, next long, len long"


def chains(next_at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For elements with the index of the next one (-1: none here): the first
    element of each one's chain and the distance from it."""
    n = len(next_at)
    head, offset = np.arange(n), np.zeros(n, np.int64)
    here = np.flatnonzero(next_at >= 0)
    head[next_at[here]] = here
    offset[next_at[here]] = length[here]
    while True:
        further = head[head]
        if np.array_equal(further, head):
            return head, offset
        offset += offset[head]
        head = further


def _columns(batches):
    parts = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "next", "len")] for b in batches if b.num_rows]
    if not parts:
        return None
    ids, after, length = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))
    order = np.argsort(ids)
    ids, after, length = ids[order], after[order], length[order]
    at = np.minimum(np.searchsorted(ids, after), len(ids) - 1)
    return ids, after, length, np.where(ids[at] == after, at, -1)


def _contract(batches):
    """The rows of a range: each element's chain head and distance; heads also
    get what follows the chain, and its length."""
    found = _columns(batches)
    if found is None:
        return
    ids, after, length, at = found
    head, offset = chains(at, length)
    tails = np.flatnonzero(at < 0)
    follows, total = np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
    follows[head[tails]], total[head[tails]] = after[tails], offset[tails] + length[tails]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, ids[head], offset, follows, total)],
                                     names=["id", "head", "offset", "next", "len"])


def _rank(batches):
    """Places of the elements of what is left of the list."""
    found = _columns(batches)
    if found is not None:
        ids, _, length, at = found
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(chains(at, length)[1])], names=["id", "pos"])


def _mates(rest: DataFrame, draw: int) -> DataFrame:
    coin = lambda c: F.xxhash64(F.lit(draw), c).bitwiseAND(F.lit(1))
    taken = rest.filter(coin("id") == 0).select(F.col("id").alias("mate"), F.col("next").alias("after"), F.col("len").alias("more"))
    met = rest.join(taken, (F.col("next") == F.col("mate")) & (coin("id") == 1), "left")
    gone = met.filter(F.col("mate").isNotNull()).select(F.col("mate").alias("id"), F.col("id").alias("head"),
                                                       F.col("len").alias("offset"))
    took = F.col("mate").isNotNull()
    stays = met.select("id", F.col("id").alias("head"), F.lit(0).cast("long").alias("offset"),
                       F.when(took, F.col("after")).otherwise(F.col("next")).alias("next"),
                       F.when(took, F.col("len") + F.col("more")).otherwise(F.col("len")).alias("len"))
    none = F.lit(None).cast("long")
    return (stays.join(gone.select("id"), "id", "left_anti")
            .unionByName(gone.select("id", "head", "offset", none.alias("next"), none.alias("len"))))


def list_rank(links: DataFrame, last: int = LAST, few: int = FEW) -> DataFrame:
    """(id, pos): the place, from 0, of every element of the list whose links are
    the rows (id, next) of ``links``; ids are unique and not negative, the last
    element's next is null or -1. An empty list has no places."""
    spark = ready(links.sparkSession)
    rest = links.select("id", F.coalesce("next", F.lit(-1).cast("long")).alias("next"), F.lit(1).cast("long").alias("len"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size, levels, draw, local = rest.count(), [], 0, True
    while not levels or size > last:
        if local:
            out = rest.repartitionByRange(max(least, size // RANGE + 1), "id").mapInArrow(_contract, SCHEMA)
        else:
            out, draw = _mates(rest, draw), draw + 1
        out = stage(out, "list-round")
        heads = out.filter(F.col("id") == F.col("head"))
        left = heads.count()
        levels.append((out.select("id", "head", "offset"), left))
        local = local and 2 * left <= size
        size, rest = left, heads.select("id", "next", "len")
    place = rest.repartition(1).mapInArrow(_rank, "id long, pos long")
    for out, heads in reversed(levels):
        place = stage(place, "list-places").toDF("head", "start")
        place = F.broadcast(place) if heads <= few else place
        place = out.join(place, "head").select("id", (F.col("start") + F.col("offset")).alias("pos"))
    return place
