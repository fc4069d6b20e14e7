import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexispark.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    again = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        again[c] = tuple(convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    nodes = {}
    for c, turns in again.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[:len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        ends = ",".join(str(c) for c in sorted(members) if len(again[c]) == len(prefix))
        out.append((min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members), len(kids),
                    sum(not any(q[:-1] == p and q for q in nodes) for p in below),
                    sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("conv", "d", "ka", "v", "s", "pos", "n_convs", "a.b"):
            df = df.withColumn(c, F.lit("x"))
    return sorted((tuple(r) for r in T.conversation_trie(df.repartition(3)).collect()), key=str)


def conversations():
    rng = random.Random(11)
    pool = [("user", "a"), ("assistant", "é😀"), (None, "b"), ("user", None), ("", "")]
    out = []
    for c in [*range(-7, 40), 1000, 1003, 10 ** 15 + 2, 2 ** 63 - 1, -2 ** 63]:
        n = rng.randint(1, 12)
        turns = [rng.choice(pool[:2] if c % 3 else pool) for _ in range(n)]
        out += [(c, t if t or c % 4 else None, *x) for t, x in enumerate(turns)]
    same = [("user", "common"), ("assistant", "text"), ("user", "again")]
    out += [(c, t, *x) for c in range(2000, 2060) for t, x in enumerate(same)]
    return out


def test_against_brute_force(spark):
    rows = conversations()
    assert result(spark, rows, extra=True) == brute(rows)


def test_a_long_conversation_nulls_and_repeated_rows(spark):
    rows = [(10, t, "user", f"turn {t % 7}") for t in range(9000)] + [(11, 0, "user", "x"), (11, 0, "user", "x"), (11, None, None, None)]
    rows += [(None, 0, "user", "nobody's"), (12, 1, "user", "z" * 100_000)]
    got = result(spark, rows)
    deep = [r for r in got if r[1] > 20]
    assert len(deep) == 9000 - 20 and all(r[0] == 10 and r[3] == 1 and r[5] == 1 for r in deep)
    short = [r for r in rows if r[0] != 10 or r[1] < 9]
    assert [r for r in got if r[1] < 9 and r[0] != 10] == [r for r in brute(short) if r[1] < 9 and r[0] != 10]


def test_empty_tables(spark):
    assert result(spark, []) == [] and result(spark, [(None, 1, "user", "x")]) == []


def test_hashes_that_collide_are_drawn_again(spark, monkeypatch):
    own = T.lane
    monkeypatch.setattr(T, "lane", lambda draw, which: F.lit(7).cast("long") if draw == 0 else own(draw, which))
    rows = conversations()[:60]
    assert result(spark, rows) == brute(rows)
    monkeypatch.setattr(T, "lane", lambda draw, which: F.lit(7).cast("long"))
    with pytest.raises(RuntimeError):
        result(spark, rows)
