"""Nearest neighbours by inner product: vantage-point trees per shard (operator 7).

A vantage-point tree needs a metric. With M the largest norm of all vectors,
x -> (x, sqrt(M^2 - |x|^2)) and q -> (q, 0) turn the largest inner product into
the smallest Euclidean distance, so the tree's triangle inequality holds.

1. Vectors are dealt to shards of about ``shard_rows`` rows by a hash of id and
   content; each shard becomes one tree (one row of a staged table): arrays of
   vantage points, and of the least and largest distance from its vantage point
   to each half.
2. The queries, in blocks of ``block`` rows, are sent to every shard. A block
   walks a tree together: a half is entered by the queries for which
   ``factor`` x (the triangle inequality's lower bound of any distance in it)
   is no more than the distance of their k-th neighbour so far, nearer half
   first. ``factor`` 1 is exact; a larger one visits less and may miss some.
3. Each (shard, block) gives its k nearest by query. Their inner products, in
   double precision on the original vectors, added from the first component to
   the last, are ranked by query, ties by the smaller id; Spark ranks within
   tasks before the shuffle.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part. Rows whose vec_id is null take no part.
Repeated vectors are all candidates; a query's own row (its id) is none.
A table without usable vectors gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pick, ready, stage

SHARD_ROWS = 8192
BLOCK = 512
LEAF = 256
#: Distances this close, as a share of the largest norm, count as equal (rounding).
SLACK = 1e-6


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec) of the vectors that take part."""
    v = pick(vectors, id=F.col(f"`{id_col}`").cast("long"), vec=F.col(f"`{vec_col}`").cast("array<double>"))
    # an infinite or undefined component makes x - x undefined, a null one makes it null
    sound = F.forall("vec", lambda x: x.isNotNull() & (x - x == 0))
    return v.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & sound & F.exists("vec", lambda x: x != 0))


def exact_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added in the order of components."""
    out = np.zeros(len(rows))
    for i in range(rows.shape[1]):
        out += rows[:, i] * query[i]
    return out


class Tree:
    """A vantage-point tree over the distinct rows of a shard."""

    def __init__(self, x: np.ndarray, slack: float = 0.0):
        self.slack = slack
        self.order = np.arange(len(x))
        self.nodes: list[tuple] = []                    # see _grow
        self.x = x
        self._grow(0, len(x))
        self.x = x[self.order]

    def _grow(self, lo: int, hi: int) -> int:
        """Node over order[lo:hi]: (lo, hi, left, right, bounds of both halves);
        left < 0 for a leaf. The vantage point is the row at ``lo``."""
        me = len(self.nodes)
        self.nodes.append(())
        if hi - lo <= LEAF:
            self.nodes[me] = (lo, hi, -1, -1, None)
            return me
        own = self.order[lo:hi]
        # of a few rows, the one farthest from the middle
        some = own[:: max(1, len(own) // 16)]
        far = some[np.argmax(((self.x[some] - self.x[own].mean(axis=0)) ** 2).sum(axis=1))]
        at = int(np.flatnonzero(own == far)[0])
        own[[0, at]] = own[[at, 0]]
        d = np.sqrt(((self.x[own[1:]] - self.x[own[0]]) ** 2).sum(axis=1))
        by = np.argsort(d, kind="stable")               # halves by count: ties cannot unbalance it
        own[1:] = own[1:][by]
        d, half = d[by], len(by) // 2
        mid = lo + 1 + half
        left, right = self._grow(lo + 1, mid), self._grow(mid, hi)
        self.nodes[me] = (lo, hi, left, right, (d[0], d[half - 1], d[half], d[-1]))
        return me

    def _distances(self, q: np.ndarray, lo: int, hi: int) -> np.ndarray:
        x = self.x[lo:hi]
        d2 = (q * q).sum(axis=1)[:, None] - 2 * (q @ x.T) + (x * x).sum(axis=1)[None, :]
        return np.sqrt(np.maximum(d2, 0))

    def _walk(self, q: np.ndarray, factor: float, reach, offer) -> int:
        """Offers every row that the queries need, leaf by leaf, to
        ``offer(active queries, first row, distances)``; ``reach(active)`` is how
        far each still looks. Returns the number of distances."""
        computed = 0

        def walk(node: int, active: np.ndarray) -> None:
            nonlocal computed
            lo, hi, left, right, bounds = self.nodes[node]
            d = self._distances(q[active], lo, hi if left < 0 else lo + 1)
            computed += d.size
            offer(active, lo, d)
            if left < 0:
                return
            a, b, c, e = bounds
            d = d[:, 0]
            low = {left: np.maximum(np.maximum(a - d, d - b), 0), right: np.maximum(np.maximum(c - d, d - e), 0)}
            near_left = low[left] <= low[right]
            for first in (True, False):                 # each query's nearer half first
                for child, mine in ((left, near_left == first), (right, near_left != first)):
                    go = mine & (factor * low[child] <= reach(active) + self.slack)
                    if go.any():
                        walk(child, active[go])

        walk(0, np.arange(len(q)))
        return computed

    def search(self, q: np.ndarray, k: int, factor: float) -> tuple[list[np.ndarray], int]:
        """For each query the k nearest rows (numbers in the shard), with any
        others as near as the last of them; and the number of distances."""
        best, place = np.full((len(q), k + 1), np.inf), np.full((len(q), k + 1), -1)

        def offer(active, lo, d):
            both = np.concatenate([best[active], d], axis=1)
            which = np.concatenate([place[active], np.broadcast_to(np.arange(lo, lo + d.shape[1]), d.shape)], axis=1)
            near = np.argpartition(both, k, axis=1)[:, :k + 1]
            best[active] = np.take_along_axis(both, near, axis=1)
            place[active] = np.take_along_axis(which, near, axis=1)

        computed = self._walk(q, factor, lambda active: best[active].max(axis=1), offer)
        found = [self.order[p[p >= 0]] for p in place]
        last = np.partition(best, k - 1, axis=1)
        tied = np.flatnonzero(np.isfinite(last[:, k]) & (last[:, k] - last[:, k - 1] <= 2 * self.slack))
        if len(tied):                                   # more may be as near: all of them
            more: dict[int, list[np.ndarray]] = {i: [] for i in range(len(tied))}
            radius = last[tied, k - 1] + 2 * self.slack

            def within(active, lo, d):
                for i, row in zip(active.tolist(), d <= radius[active][:, None], strict=True):
                    more[i].append(self.order[lo + np.flatnonzero(row)])

            computed += self._walk(q[tied], factor, lambda active: radius[active], within)
            for i, t in enumerate(tied.tolist()):
                found[t] = np.union1d(found[t], np.concatenate(more[i]))
        return found, computed


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top * top - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def _packed(schema_name: str):
    """Rows of one group as one row: ids and components, packed."""
    def run(key, rows):
        ids = rows.column("id").to_numpy()
        vec = rows.column("vec").combine_chunks()
        x = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        by = np.lexsort((x[:, 0], ids))
        return pa.table({schema_name: pa.array([key[0].as_py()], pa.int64()),
                         "ids": pa.array([ids[by].astype("<i8").tobytes()], pa.binary()),
                         "vecs": pa.array([x[by].astype("<f8").tobytes()], pa.binary())})
    return run


def _search(dim: int, top: float, k: int, factor: float, stats):
    def run(batches):
        import functools

        @functools.lru_cache(maxsize=1)
        def shard_of(shard: int, ids: bytes, vecs: bytes):
            """The tree of the distinct vectors, these, and the ids of each in
            ascending order; the largest number of rows of one id."""
            x, own = np.frombuffer(vecs, "<f8").reshape(-1, dim), np.frombuffer(ids, "<i8")
            distinct, which = np.unique(x, axis=0, return_inverse=True)
            by = np.lexsort((own, which.ravel()))
            groups = np.split(own[by], np.flatnonzero(np.diff(which.ravel()[by])) + 1)
            return Tree(_lift(distinct, top), SLACK * top), distinct, groups, int(np.unique(own, return_counts=True)[1].max())

        for b in batches:
            for shard, ids, vecs, qids, qvecs in zip(*(b.column(c).to_pylist() for c in (
                    "shard", "ids", "vecs", "qids", "qvecs")), strict=True):
                t, x, groups, spare = shard_of(shard, ids, vecs)
                q, mine = np.frombuffer(qvecs, "<f8").reshape(-1, dim), np.frombuffer(qids, "<i8")
                # rows of the query's own id are found, then dropped
                found, computed = t.search(np.hstack([q, np.zeros((len(q), 1))]), k + spare, factor)
                if stats is not None:
                    stats.add(computed)
                query, cand, score = [], [], []
                for i, at in enumerate(found):
                    s = exact_products(x[at], q[i])
                    own = [groups[a][:k + spare] for a in at.tolist()]
                    s, own = np.repeat(s, [len(o) for o in own]), np.concatenate(own)
                    s, own = s[own != mine[i]], own[own != mine[i]]
                    by = np.lexsort((own, -s))[:k]
                    query += [int(mine[i])] * len(by)
                    cand.append(own[by])
                    score.append(s[by])
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(query, pa.int64()),
                    "vec_id": pa.array(np.concatenate(cand) if cand else [], pa.int64()),
                    "score": pa.array(np.concatenate(score) if score else [], pa.float64())})
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, id_col: str = "vec_id",
            vec_col: str = "embedding", shard_rows: int = SHARD_ROWS, block: int = BLOCK, stats=None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest of each row for
    which ``is_query`` (over the column ``id``) holds, among all other rows.
    ``stats``: an accumulator for the number of distances computed."""
    spark = ready(vectors.sparkSession)
    v = usable(vectors, id_col, vec_col)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    sizes = v.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], empty)
    size = max(sizes, key=lambda r: (r["n"], r["dim"]))
    dim, n, top = size["dim"], size["n"], size["top"]
    v = v.filter(F.size("vec") == dim)
    shards = -(-n // shard_rows)
    # by content too, so that a repeated id does not fill a shard
    place = F.xxhash64("id", "vec")
    rows = v.withColumn("shard", F.pmod(place, F.lit(shards)))
    trees = stage(rows.groupBy("shard").applyInArrow(_packed("shard"), "shard long, ids binary, vecs binary"), "shards")
    queries = v.filter(is_query)
    blocks = max(1, -(-queries.count() // block))
    asked = (queries.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "id", "vec"), F.lit(blocks)))
             .groupBy("block").applyInArrow(_packed("block"), "block long, ids binary, vecs binary")
             .select(F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")))
    found = (trees.join(asked, "shard").sortWithinPartitions("shard")
             .mapInArrow(_search(dim, top, k, factor, stats), "query_id long, vec_id long, score double"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
