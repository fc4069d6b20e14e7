import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import lm as M

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rest(i, m=5):
    return zlib.crc32(str(i).encode()) % m


def fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))


def corpus():
    random.seed(3)
    vocab = ["the", "The", "cat", "dog", "ran", "über", "x,", "中"] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(random.choices(vocab, weights=[20, 5, 9, 9, 7, 3, 2, 1] + [1] * 60, k=random.randint(0, 50))))
            for i in range(200)]
    return rows + [(300, None), (301, ""), (302, " \t\n"), (303, "the " * 20_000), (3, "the cat"), (3, "the cat"), (None, "the dog")]


def brute(rows):
    """Counts, estimates and EM, token by token."""
    toks = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None]) for d, t in rows]
    kind = lambda d: 2 if d is None or rest(d) == 1 else 1 if rest(d) == 2 else 0

    def count(kinds):
        c1, c2 = collections.Counter(), collections.Counter()
        for d, ws in toks:
            if kind(d) in kinds:
                c1.update(ws)
                c2.update(zip([None] + ws[:-1], ws))
        return c1, c2, sum(c1.values()), len(c1)

    bucket = lambda n: min(int(n).bit_length(), M.FREQUENCY_BUCKETS)

    def parts(h, w, c):
        c1, c2, n, v = c
        return bucket(c1[h]), 1 / (v + 1), c1[w] / max(1, n), c2[h, w] / c1[h] if c1[h] else 0.0

    est, full = count({0}), count({0, 1})
    seen = [parts(h, w, est) for d, ws in toks if kind(d) == 1 for h, w in zip([None] + ws[:-1], ws)]
    weights = M.start_weights()
    for _ in range(M.ROUNDS):
        sums = collections.defaultdict(lambda: np.zeros(3))
        for b, *p in seen:
            s = weights[b] * p
            sums[b] += s / s.sum()
        new = weights.copy()
        for b, s in sums.items():
            new[b] = s / s.sum()
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-4:
            break
    for b in range(2, M.FREQUENCY_BUCKETS + 1):
        if b not in sums:
            weights[b] = weights[b - 1]
    c1, _, n, v = full
    out = []
    for d, ws in toks:
        p = [(parts(h, w, full)) for h, w in zip([None] + ws[:-1], ws)]
        out.append((d, kind(d) == 2, len(ws), sum(c1[w] > 0 for w in ws), n,
                    sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws),
                    sum(math.log10(float((weights[b] * q).sum())) for b, *q in p)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [M.BLOCK_BYTES, 2000])
def test_against_brute_force(frame, monkeypatch, block_bytes):
    monkeypatch.setattr(M, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(M, "BUCKET_ENTRIES", 50 if block_bytes == 2000 else M.BUCKET_ENTRIES)
    got = M.score(frame(corpus()), fold() != 1, fold() == 2).collect()
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=str)
    want = brute(corpus())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=2e-4)


def test_the_model_beats_the_unigrams_on_text_with_order(frame):
    random.seed(1)
    rows = []
    for i in range(300):
        w = ["a"]
        while len(w) < 30:
            w.append({"a": "b", "b": "c", "c": random.choice("ad"), "d": "a"}[w[-1]])
        rows.append((i, " ".join(w)))
    held = [r for r in M.score(frame(rows), fold() != 1, fold() == 2).collect() if r.held_out]
    assert held and sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


def test_no_training_text_and_no_rows(frame):
    r, = M.score(frame([(1, "a b")]), F.lit(False), F.lit(False)).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.score == 0.0 and r.base_score == 0.0
    assert M.score(frame([]), F.lit(True), F.lit(False)).collect() == []
