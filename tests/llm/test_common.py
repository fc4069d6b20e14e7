import random
import re

import numpy as np
import pyarrow as pa

from lexispark.llm.common import Memo, buffers, coded, first_by_hash, grams, pieces, stage, words
from lexispark.llm.decontam import LOWER, WORD, grams_of_rows


def test_words_match_a_regular_expression():
    random.seed(3)
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = ["".join(random.choices("abZ09 .,\n'éß中😀\x7f[`", k=random.randint(0, 40))) for _ in range(500)] + [None, ""]
    data, offsets = buffers(pa.array(texts, pa.string()))
    at, codes, distinct = words(data.translate(LOWER), offsets, WORD)
    vocabulary = [w.decode() for w in distinct.to_pylist()]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for k, text in enumerate(texts):
        assert [vocabulary[c] for c in codes[at[k]:at[k + 1]]] == pattern.findall((text or "").translate(low))


def test_buffers_of_slices_and_nulls():
    a = pa.array(["xx", None, "", "yé", "z"]).slice(1, 3)
    data, offsets = buffers(a)
    assert data == "yé".encode() and offsets.tolist() == [0, 0, 0, 3]
    assert buffers(pa.array([], pa.string()))[1].tolist() == [0]


def test_pieces_keep_rows_and_bound_bytes():
    b = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 30] * 10 + [None] + ["b" * 500])})
    cut = list(pieces(iter([b]), limit=100))
    assert [t for p in cut for t in p.column("text").to_pylist()] == b.column("text").to_pylist()
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 600 for p in cut)
    assert len(cut) > 3


def test_grams_depend_on_order_and_match_rows():
    h = np.array([5, 9, 9, 5, 7], np.uint64)
    assert len(grams(h, 6)) == 0
    assert (grams(h, 3) == grams_of_rows(np.stack([h[0:3], h[1:4], h[2:5]]))).all()
    assert grams(h[:2], 2)[0] != grams(h[:2][::-1].copy(), 2)[0]


def test_coded_and_memo():
    codes, distinct = coded(b"aabbaa", np.array([0, 2, 4]))
    assert [distinct[int(c)].as_py() for c in codes] == [b"aa", b"bb", b"aa"]
    calls = []
    memo = Memo(600, longest=4)
    make = lambda ks: [calls.append(k) or k * 2 for k in ks]
    assert memo.get([b"1", b"2", b"3"], make) == [b"11", b"22", b"33"] and memo.get([b"3", b"1"], make) == [b"33", b"11"]
    assert calls == [b"1", b"2", b"3"]
    memo.get([b"4", b"5", b"6"], make)
    assert memo.get([b"7"], make) == [b"77"] and len(memo.young) + len(memo.old) <= 7
    long = b"long key"                                       # given, but not kept
    assert memo.get([long, b"7"], make) == [long * 2, b"77"] and memo.get([long], make) == [long * 2] and calls.count(long) == 2
    for k in range(100):                                     # bounded by bytes, whatever the number of calls
        memo.get([str(k).encode() for k in range(4 * k, 4 * k + 4)], make)
        assert len(memo.young) + len(memo.old) <= 12


def test_first_by_hash_is_the_plain_ranking(spark):
    from pyspark.sql import Window, functions as F
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 10 == 0, "few").when(F.col("id") < 9, "tiny").otherwise("hot").alias("g"),
                                      F.xxhash64("id").alias("h")).repartition(5)
    plain = rows.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("h", "id"))).filter("r <= 200").drop("r")
    got = first_by_hash(rows, "g", "id", 200)
    assert sorted(got.collect()) == sorted(plain.collect()) and got.columns == rows.columns
    assert first_by_hash(rows.filter("false"), "g", "id", 200).collect() == []


def test_a_stage_of_wide_rows_has_small_row_groups(spark):
    """F1 of round 4: rows of 6 MB, as blocks of words are, a few to a row group and one to a page;
    before, all rows of a file (up to 100) were one row group, which a task held whole."""
    import pyarrow.parquet as pq

    def made(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            for i in b.column("id").to_pylist():
                data = np.random.default_rng(i).bytes(6 << 20)
                yield pa.RecordBatch.from_pydict({"id": pa.array([i], pa.int64()), "data": pa.array([data], pa.binary())})

    staged = stage(spark.range(0, 12, 1, 1).mapInArrow(made, "id long, data binary"), "wide", wide=True)
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in staged.inputFiles()]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 12 and max(g.total_byte_size for g in groups) <= 24 << 20
    assert staged.select("id").distinct().count() == 12
