import random

import numpy as np
import pytest

from lexispark.llm import linededup as L

SP = " \t\n\x0b\x0c\r"


def brute(rows, min_docs, min_chars=1, keep_first=False):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda s: s.strip(SP).translate(low)
    lines = [(d, (t or "").split("\n")) for d, t in rows]
    where, first = {}, {}
    for r, (d, ls) in enumerate(lines):
        for n, x in enumerate(ls):
            where.setdefault(key(x), set()).add(r)
            spot = ((d is not None, d or 0), n)
            first[key(x)] = min(first.get(key(x), spot), spot)
    out = []
    for d, ls in lines:
        gone = [len(key(x)) >= min_chars and len(where[key(x)]) >= max(2, min_docs)
                and not (keep_first and first[key(x)] == ((d is not None, d or 0), n)) for n, x in enumerate(ls)]
        out.append((d, "\n".join(x for x, g in zip(ls, gone) if not g), len(ls), sum(gone)))
    return sorted(out, key=str)


def rows(n=120):
    random.seed(7)
    pool = ["Alpha", "alpha ", "\tALPHA\r", "beta", "", " ", "É line", "é line", "unique"]
    out = [(i, "\n".join(random.choices(pool, k=random.randint(0, 6)) + [f"own {i}"])) for i in range(n)]
    return out + [(None, "beta\nx"), (500, None), (501, ""), (502, "z" * 50_000 + "\nbeta"), (3, "beta"), (3, "beta")]


@pytest.mark.parametrize("options", [dict(min_docs=10), dict(min_docs=10, keep_first=True), dict(min_docs=2, min_chars=5)])
@pytest.mark.parametrize("keys_bytes", [L.KEYS_BYTES, 0])
def test_against_brute_force(frame, options, keys_bytes):
    got = L.line_dedup(frame(rows()), keys_bytes=keys_bytes, **options).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == brute(rows(), **options)


def test_pass_through_keeps_columns_and_rows(frame):
    docs = frame(rows())
    for limit in (L.KEYS_BYTES, 0):
        out = L.without_repeats(docs, min_docs=10, keys_bytes=limit)
        assert out.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
            ((d, t) for d, t, _, _ in brute(rows(), 10, keep_first=True)), key=str)


def test_empty_table(frame):
    assert L.line_dedup(frame([])).collect() == []


def test_filters_never_forget():
    h = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    b = L.Bloom(1 << 12)          # far too small: everything passes, nothing is lost
    b.add(h)
    assert b.has(h).all()
    wide = L.Bloom(1 << 20)
    wide.add(h)
    assert wide.has(h).all() and wide.has(h + np.uint64(1)).mean() < 0.01


def test_saturated_filter_gives_the_same_result(frame, monkeypatch):
    monkeypatch.setattr(L, "filter_bits", lambda n: 1 << 10)
    got = L.line_dedup(frame(rows()), min_docs=10).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == brute(rows(), 10)
