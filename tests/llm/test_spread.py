import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import listrank as R, spread as S


def test_hot_join_is_an_inner_join(spark):
    keys = [0] * 3000 + list(range(1, 400)) * 2
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), (F.max("i") * 2).alias("v"))
    got = S.hot_join(left, right, ["k"], "n")
    assert sorted(map(tuple, got.select("k", "i", "n", "v").collect())) == sorted(
        map(tuple, left.join(right, "k").select("k", "i", "n", "v").collect()))
    assert S.hot_join(left.limit(0), right.limit(0), ["k"], "n").count() == 0


def test_running_and_following_across_buckets(spark):
    rng = random.Random(3)
    data = sorted((rng.choice([0, 0, 0, 1, 2]), rng.randint(0, 9), rng.getrandbits(62)) for _ in range(500))
    df = S.numbered(spark.createDataFrame(data, "g long, o long, x long").repartition(5), [F.col("g"), F.col("o"), F.col("x")], "t")
    ordered = [tuple(r) for r in df.orderBy("s").select("g", "o", "x").collect()]
    assert ordered == data
    got = S.following(S.running(df, ["g"], "s", {"n": (F.sum, F.col("o")), "y": (F.bit_xor, F.col("x"))}, bits=2),
                      ["g"], "s", "s", "later", bits=2).orderBy("s").collect()
    total, xor = {}, {}
    for k, (r, (g, o, x)) in enumerate(zip(got, data, strict=True)):
        total[g], xor[g] = total.get(g, 0) + o, xor.get(g, 0) ^ x
        assert (r.n, r.y) == (total[g], xor[g])
        assert r.later == (got[k + 1].s if k + 1 < len(data) and data[k + 1][0] == g else None)


@pytest.mark.parametrize("shape, few", [("random", 0), ("random", R.FEW), ("near", R.FEW)])
def test_list_ranks(spark, shape, few):
    rng = np.random.default_rng(1)
    n = 700 if shape == "random" else 5000
    order = rng.permutation(n) if shape == "random" else np.arange(n) ^ 1      # neighbours swapped
    links = [(int(a) * 3, int(b) * 3) for a, b in zip(order[:-1], order[1:])] + [(int(order[-1]) * 3, None)]
    got = R.list_rank(spark.createDataFrame(links, "id long, next long").repartition(4), last=100, few=few).collect()
    assert {r.id: r.pos for r in got} == {int(a) * 3: i for i, a in enumerate(order)}


def test_short_lists(spark):
    assert R.list_rank(spark.createDataFrame([], "id long, next long")).collect() == []
    assert [tuple(r) for r in R.list_rank(spark.createDataFrame([(5, None)], "id long, next long")).collect()] == [(5, 0)]
