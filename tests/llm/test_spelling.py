import random
import re
import zlib

import pytest

from lexispark.llm import spelling as S


def edit_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(counts, factor=5):
    form, out = {}, []
    near = {w: [v for v in counts if edit_one(w, v)] for w in counts}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def vocabulary(seed=2, n=350):
    rng = random.Random(seed)
    out = {}
    for _ in range(n):
        out["".join(rng.choices("abÿ", k=rng.choice([6, 6, 7, 7, 8, 9])))] = rng.choice([5, 6, 30, 31, 200, 2000])
    long = "qw" * 3000
    return out | {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "abcdefgh": 9, long: 50, long[1:]: 5, long[:999] + long[1000:]: 5,
                  long[:-1] + "z": 5, "z" + long[1:]: 10}


@pytest.mark.parametrize("block", [S.BLOCK, 7])
def test_against_brute_force(spark, block):
    counts = vocabulary()
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = S.spelling_variants(df, block=block)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(counts)


def expected_words(rows, min_chars=6, min_count=5):
    counts = {}
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def test_words_of_texts(frame):
    rng = random.Random(4)
    pool = ["Straße", "ÉCOLIER", "école", "naïveté", "sixsix", "SixSix", "short", "wörter×÷", "ab12cdefgh", "łódź", "abcdef𝒳ghijkl"]
    rows = [(i, " ".join(rng.choices(pool, k=40))) for i in range(400)]
    rows += [(None, "Straße " * 9), (7, None), (8, ""), (9, "x" * 100_000 + " "), (9, "sixsix"), (9, "sixsix")]
    got = {r.word: r.n for r in S.words(frame(rows)).collect()}
    assert got == expected_words(rows) and any(len(w) == 5 + 1 for w in got)
    deleted = set(got) - {re.sub("[A-Z]", lambda m: m[0].lower(), w) for p in pool for w in re.findall("[A-Za-zÀ-ÿ]+", p)}
    assert S.words(frame(rows), change=None).count() == len(got) - len(deleted)


def test_empty_table(frame):
    assert S.spelling_variants(S.words(frame([]))).collect() == []
