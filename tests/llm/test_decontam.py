import random
import re

import pytest

from lexispark.llm import decontam as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = cut(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add("null" if i is None else str(i))
    sizes = {len(g) for g in wins}
    out = []
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                g = tuple(w[k:k + n])
                if g in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[g]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def data():
    random.seed(5)
    vocab = [f"w{i}" for i in range(40)] + ["é", "Z9", "中文"]
    make = lambda n: [random.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(make(random.choice([0, 2, 4, 9, 10, 11, 30])))) for i in range(30)]
    items += [(7, items[3][1]), (99, "w1 " * 40), (None, " ".join(make(15))), (100, None), (101, "!!"), (102, " ".join(make(12)))]
    docs = []
    for d in range(150):
        w = make(random.randint(0, 60))
        if d % 3 == 0:
            src = cut(random.choice(items)[1])
            a = random.randint(0, max(0, len(src) - 1))
            w[5:5] = src[a:a + random.randint(5, 25)]
        docs.append((d, ", ".join(w).upper() if d % 2 else "\n".join(w)))
    return docs + [(900, None), (901, ""), (902, "w1 " * 5000)], items


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 60])
def test_against_brute_force(spark, frame, block_words):
    docs, items = data()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(frame(docs), bench, block_words=block_words).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == brute(docs, items)


def test_decontaminate_keeps_clean_documents(spark, frame):
    docs, items = data()
    bench = spark.createDataFrame(items, "item_id long, text string")
    source = frame(docs)
    out = D.decontaminate(source, bench)
    assert out.columns == source.columns
    assert {r.doc_id for r in out.collect()} == {d for d, _, n, _ in brute(docs, items) if not n}


def test_empty_tables(spark, frame):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in D.contamination(frame([(1, "a b")]), bench).collect()] == [(2, 0)]
    assert D.contamination(frame([]), bench).collect() == []


def test_repeated_rows_and_null_ids(spark, frame):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    got = D.contamination(frame([(None, "x a b c"), (4, "a b c"), (4, "a b c")]), bench).collect()
    assert sorted(((r.doc_id, r.n_hit) for r in got), key=str) == [(4, 3), (4, 3), (None, 3)]


@pytest.mark.parametrize("block_words", [D.BLOCK_WORDS, 60])
def test_rows_under_one_id_or_none_stay_apart(spark, frame, block_words):
    """The same four documents, with one block of the benchmark and with many."""
    random.seed(12)
    items = [" ".join(f"w{random.randint(0, 9999)}" for _ in range(30)) for _ in range(12)]
    bench = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(items)], "item_id string, text string")
    docs = [(1, "x " + items[0]), (1, items[1] + " y " + items[2]), (1, "clean"), (None, items[3]), (None, "nothing here"), (2, items[0]), (2, items[0])]
    got = D.contamination(frame(docs), bench, block_words=block_words).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.items)) for r in got) == sorted([
        ("1", 31, 30, ["i0"]), ("1", 61, 60, ["i1", "i2"]), ("1", 1, 0, []), ("None", 30, 30, ["i3"]), ("None", 2, 0, []),
        ("2", 30, 30, ["i0"]), ("2", 30, 30, ["i0"])])
    kept = D.decontaminate(frame(docs), bench, block_words=block_words)
    assert kept.columns == frame(docs).columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", "clean"), ("None", "nothing here")]
