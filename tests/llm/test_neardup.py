import collections
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lexispark.llm import neardup as N

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold=0.8):
    """Class of each document by all pairs that share a shingle; and the pairs
    within 0.01 of the threshold, which rounding may decide."""
    w = {d: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW)) for d, t in rows if d is not None}
    df, n = collections.Counter(x for ws in w.values() for x in set(ws)), len(w)
    idf = {x: 1 + math.log((1 + n) / (1 + c)) / math.log(1 + n) for x, c in df.items()}
    sets, by = {}, collections.defaultdict(set)
    for d, ws in w.items():
        c = collections.Counter(tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))) if ws else {}
        sets[d] = {g: k * sum(idf[x] for x in g) / len(g) for g, k in c.items()}
        for g in c or [()]:
            by[g].add(d)
    parent = {d: d for d in w}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    close = set()
    for a, b in {(a, b) for ds in by.values() for a in ds for b in ds if a < b}:
        x, y = sets[a], sets[b]
        shared = sum(min(v, y[g]) for g, v in x.items() if g in y)
        j = 1.0 if w[a] == w[b] else shared / (sum(x.values()) + sum(y.values()) - shared)
        if abs(j - threshold) < 0.01:
            close.add((a, b))
        if j >= threshold:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in w}, close


def corpus():
    random.seed(11)
    word = lambda: "".join(random.choices("abcdefghij", k=random.randint(2, 6)))
    docs = []
    for _ in range(40):                                          # groups of copies, near and exact
        base = [word() for _ in range(random.choice([3, 8, 220, 320]))]
        for _ in range(random.choice([1, 1, 2, 5, 9])):
            own = list(base)
            for _ in range(random.choice([0, 0, 1, 1])):
                own[random.randrange(len(own))] = word()
            docs.append(" ".join(own))
    hot = [word() for _ in range(70)]                            # a passage that many unlike documents share
    for _ in range(60):
        docs.append(" ".join([word() for _ in range(30)] + hot + [word() for _ in range(30)]))
    twin = [word() for _ in range(30)]
    docs += [" ".join(twin + hot + [word() for _ in range(2)]) for _ in range(3)]
    rows = [(i * 3, t) for i, t in enumerate(docs)]
    random.shuffle(rows)
    return rows + [(9001, ""), (9002, None), (9003, "!!"), (9004, "one"), (9005, "One."), (9006, "x " * 20_000), (None, "one")]


@pytest.mark.parametrize("spread", [N.SPREAD, 4])
def test_classes_are_those_of_brute_force(frame, monkeypatch, spread):
    monkeypatch.setattr(N, "SPREAD", spread)
    rows = corpus()
    truth, close = brute(rows)
    assert not close, "the corpus should not hang on rounding"
    got = N.near_duplicates(frame(rows)).collect()
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == truth
    assert [r.class_id for r in got if r.doc_id is None] == [9004] and len(got) == len(rows)     # of equal words with 9004


def test_one_document_of_each_class_stays(frame):
    rows = corpus()
    docs = frame(rows)
    out = N.representatives(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(set(brute(rows)[0].values())) and len(got) == len(set(brute(rows)[0].values()))


def test_rows_are_told_apart_by_themselves_not_by_their_ids(frame):
    """Two unlike texts under one id, each with a near copy under another; repeated and null ids."""
    rng = random.Random(8)
    one, two = (" ".join(f"{side}{rng.randint(0, 10 ** 6)}" for _ in range(80)) for side in "ab")
    rows = [(5, one), (5, two), (2, one + " more"), (3, two + " else"), (None, two + " again"), (None, "quite alone"), (7, one), (7, one)]
    got = N.near_duplicates(frame(rows)).collect()
    classes = sorted((str(r.doc_id), str(r.class_id)) for r in got)
    assert classes == sorted([("5", "2"), ("5", "3"), ("2", "2"), ("3", "3"), ("None", "3"), ("None", "None"), ("7", "2"), ("7", "2")])
    kept = N.representatives(frame(rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("2", one + " more"), ("3", two + " else"), ("None", "quite alone")])
    nobody = N.representatives(frame([(None, one), (None, one + " x"), (None, two)])).collect()
    assert len(nobody) == 2


def test_the_filter_of_shared_shingles_forgets_none():
    codes = np.random.default_rng(2).integers(0, 1 << 62, 4000).astype(np.uint64)
    shared = N.Held.sized(7, 1 << 18)
    bucket = (N.mix(codes) % np.uint64(7)).astype(int)
    for k in range(7):
        shared.data[k] = np.frombuffer(shared.slice_of(codes[:2000][bucket[:2000] == k]), np.uint8)
    assert shared.has(codes[:2000]).all() and shared.has(codes[2000:]).mean() < 0.05 and shared.data.nbytes <= (1 << 18) // 8


def test_samples_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 1 << 31, 3000).astype(np.uint64) << np.uint64(8) | rng.integers(0, 256, 3000).astype(np.uint64)
    hits = []
    for trial in range(30):
        a, b = np.unique(shared[100 * trial:100 * trial + 90]), np.unique(shared[100 * trial + 10:100 * trial + 100])
        na, nb = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
        sa, sb = N.samples(a, na, 1), N.samples(b, nb, 1)
        hits.append((float((sa == sb).mean()), N.similarity(a, na, b, nb)))
    seen, true = np.mean(hits, axis=0)
    assert abs(seen - true) < 0.05


def test_packing():
    code = np.array([1 << 8 | 3, 5 << 8 | 255, (1 << 40) - 1], np.uint64)
    for count in (np.array([1, 2, 255]), np.array([1, 70_000, 2])):
        a, n = N.unpack(N.pack(code, count))
        assert (a == code).all() and (n == count).all()


def test_empty_table(frame):
    assert N.near_duplicates(frame([])).collect() == []


def test_classes_follow_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    assert {r.id: r.label for r in N.classes(edges).collect()} == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}


def vector(lo, hi):
    return N.pack(np.arange(lo, hi, dtype=np.uint64) << np.uint64(8), np.ones(hi - lo, np.int64))


def test_a_pair_is_skipped_only_within_one_class(spark):
    """Chains in one meeting each: a text is like its neighbours (0.786) and like no other."""
    chains, length = 40, 8
    rows = [(length * c + k, (np.arange(N.SAMPLES) + 100 * c).astype("<f4").tobytes(), vector(12 * k, 12 * k + 100))
            for c in range(chains) for k in range(length)]
    texts = spark.createDataFrame(rows, "id long, sample binary, vec binary")
    edges = N.links(texts.select("id", "sample"), lambda _: texts.select("id", "vec"), 0.75)
    assert {r.id: r.label for r in N.classes(edges).collect()} == {d: d - d % length for d, _, _ in rows}


def licensed(pairs, alone):
    """Documents that share a licence, 0.74 alike, and for some of them a near copy, 0.82 alike."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=9))
    licence, rows = [word() for _ in range(280)], []
    for k in range(pairs + alone):
        own = [word() for _ in range(26)]
        rows.append((2 * k, " ".join(own + licence)))
        if k < pairs:
            rows.append((2 * k + 1, " ".join(own[:13] + [word() for _ in range(13)] + licence)))
    rng.shuffle(rows)
    return rows


def test_near_copies_among_documents_that_share_a_licence(frame):
    truth, close = brute(licensed(20, 60))
    assert not close and truth == {d: d - d % 2 for d in truth}
    rows = licensed(400, 1600)
    got = {r.doc_id: r.class_id for r in N.near_duplicates(frame(rows)).collect()}
    assert len(got) == 2400 and [d for d in got if got[d] != d - d % 2] == []


def test_prefixes_find_every_linked_pair(spark):
    rng = np.random.default_rng(3)
    texts = []
    for k in range(250):
        base = np.arange(100) if k % 2 else np.arange(1000 * (k // 10), 1000 * (k // 10) + 100)
        code = np.unique(np.concatenate([base[rng.random(100) < 0.93], rng.integers(200, 240, rng.integers(1, 12))]))
        code = code.astype(np.uint64) << np.uint64(8) | (code % 256).astype(np.uint64)
        texts.append((k, code, rng.integers(1, 4, len(code)) if k % 3 else np.ones(len(code), np.int64)))
    label = {k: k if k % 5 else 0 for k, _, _ in texts}
    frame = spark.createDataFrame([(k, label[k], N.pack(c, n)) for k, c, n in texts], "id long, label long, vec binary")
    for heavy in (N.HEAVY, 20):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(N, "HEAVY", heavy)
            got = {(r.leader, r.member) for r in N._close(frame, 0.8).collect()}
        want = {(a, b) for a, x, nx in texts for b, y, ny in texts
                if a < b and label[a] != label[b] and N.similarity(x, nx, y, ny) >= 0.8}
        assert len(want) > 100 and want <= got and not any(label[a] == label[b] for a, b in got)


@pytest.mark.parametrize("few", [N.FEW_LINKS, 0])
def test_classes_on_the_driver_and_by_joins(spark, monkeypatch, few):
    monkeypatch.setattr(N, "FEW_LINKS", few)
    links = [(i, i + 1) for i in range(1, 60)] + [(3, 200), (90, 200), (100, 101), (7, 100_000)]
    got = {r.id: r.label for r in N.classes(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in [*range(1, 61), 90, 200, 100_000]}, 100: 100, 101: 100}
    assert N.classes(spark.createDataFrame([], "a long, b long")).collect() == []


def block_of(docs, words, vocab):
    """A block of texts of random words, as a table, and what is known of its words."""
    rng = np.random.default_rng(6)
    tokens = rng.integers(0, vocab, docs * words).astype("<u4")
    block = pa.table({
        "block": ["0-1"], "ids": [np.arange(docs, dtype="<i8").tobytes()], "nulls": [bytes(docs)], "keys": [bytes(16 * docs)],
        "ends": [(np.arange(1, docs + 1, dtype="<i8") * words).tobytes()], "vocab": [np.sort(N.mix(np.arange(vocab, dtype="<u8"))).tobytes()],
        "df": [np.full(vocab, 3, "<u4").tobytes()], "tokens": [tokens.tobytes()]})
    asked = pa.Table.from_batches(N._ask(1)(block.to_batches()))
    return block, N._add(None, asked)


def traced(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_block_is_signed_within_bounded_memory():
    """A million words: 105 MB (vectors: 110) before, when all shingles of the block were held."""
    block, answers = block_of(2000, 500, 20_000)
    signed, peak = traced(lambda: N._sign(1, 5000)(None, block, answers))
    assert signed.num_rows == 2000 and peak < 45
    places = pa.table({"block": ["0-1"] * 2000, "bucket": pa.nulls(2000, pa.int32()), "total": pa.nulls(2000, pa.binary()),
                       "place": pa.array(range(2000), pa.int32()), "id": pa.array(range(2000), pa.int64())})
    known = answers.append_column("place", pa.nulls(1, pa.int32())).append_column("id", pa.nulls(1, pa.int64()))
    vectors, peak = traced(lambda: N._vectors(1, 5000)(None, block, pa.concat_tables([known, places])))
    assert vectors.num_rows == 2000 and peak < 45


def test_steps_change_no_signature(monkeypatch):
    block, answers = block_of(60, 7, 90)
    got = []
    for words in (1, 50, 1 << 17):
        monkeypatch.setattr(N, "STEP_WORDS", words)
        got.append(N._sign(1, 60)(None, block, answers))
    assert got[0] == got[1] == got[2]


def test_blocks_count_the_documents_of_each_word(monkeypatch):
    from pyspark import TaskContext
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 4})()))
    texts = ["a b a", None, "", "b c", "!!", "A d"]
    rows = pa.record_batch({"doc_id": pa.array([1, 2, None, 4, 5, 6], pa.int64()), "text": pa.array(texts)})
    for cut in (1, 4, 1 << 20):
        monkeypatch.setattr(N, "CUT_BYTES", cut)
        (block,) = [b.to_pylist()[0] for b in N._blocks([rows])]
        vocab, df = np.frombuffer(block["vocab"], "<u8"), np.frombuffer(block["df"], "<u4")
        df = dict(zip(vocab.tolist(), df.tolist(), strict=True))
        a, b, c, d = (int(h) for h in N.word_hashes(pa.array([b"a", b"b", b"c", b"d"])))
        assert df == {a: 2, b: 2, c: 1, d: 1}
        assert vocab[np.frombuffer(block["tokens"], "<u4")].tolist() == [a, b, a, b, c, a, d]
        assert np.frombuffer(block["ends"], "<i8").tolist() == [3, 3, 3, 5, 5, 7] and block["nulls"] == bytes([0, 0, 1, 0, 0, 0])
