import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import ann as A


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
          and np.isfinite(v).all() and np.any(v)]
    dims = [len(v) for _, v in ok]
    ok = [(i, v) for i, v in ok if len(v) == max(set(dims), key=dims.count)]
    out = set()
    for i, q in ok:
        if i % 5 == 0:
            near = sorted((-A.exact_products(v[None], q)[0], j) for j, v in ok if j != i)[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(near, 1)}
    return out


def run(spark, rows, k=4, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).repartition(3)
    got = A.nearest(df, F.pmod(F.col("id"), F.lit(5)) == 0, k=k, **options).collect()
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in got]


def vectors(n=400, dim=6, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return [(i, x[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("shard_rows", [A.SHARD_ROWS, 60])
def test_exact_search_is_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(A, "LEAF", 8)
    got = run(spark, vectors(), shard_rows=shard_rows, block=16)
    assert set(got) == brute(vectors(), 4) and len(got) == len(set(got))


def test_ties_go_to_the_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(A, "LEAF", 4)
    grid = [(i, [float(i % 3), float(i % 2), 1.0]) for i in range(90)]        # many equal vectors and products
    assert set(run(spark, grid, k=7, shard_rows=30)) == brute(grid, 7)


def test_unusable_vectors_take_no_part(spark):
    rows = vectors(30) + [(100, None), (105, [0.0] * 6), (110, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (115, [float("nan")] * 6),
                          (120, [float("inf")] + [0.0] * 5), (125, [1.0, 2.0]), (130, []), (None, [1.0] * 6)]
    assert set(run(spark, rows)) == brute(rows, 4)


def test_few_or_no_candidates(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0, 2.0])]) == []
    assert set(run(spark, vectors(3), k=20)) == brute(vectors(3), 20)


def test_a_larger_factor_visits_less_and_still_recalls(spark, monkeypatch):
    monkeypatch.setattr(A, "LEAF", 16)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(20, 8)) * 3
    rows = [(i, (centre[i % 20] + 0.3 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(2000)]
    exact, seen = {(a, b) for a, _, b, _ in brute(rows, 10)}, []
    for factor in (1.0, 1.5):
        stats = spark.sparkContext.accumulator(0)
        got = {(a, b) for a, _, b, _ in run(spark, rows, k=10, factor=factor, stats=stats)}
        seen.append(stats.value)
        assert len(got & exact) >= (1.0 if factor == 1 else 0.9) * len(exact)
    assert seen[1] <= seen[0] < 400 * 2000
