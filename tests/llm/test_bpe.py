import hashlib
import pickle
import random

import numpy as np
import pytest
import tiktoken

from lexispark.llm import bpe as B

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_multi_50k.tiktoken")
TOKENS = B.read_ranks(PATH)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


def texts():
    random.seed(1)
    letters = list("abcdeE tsdé ÉçñßÆ×÷'’,.!?;:|$-_ \n\t\r\x0b\x0c\x85\xa0　 0123456789٣½中文字😀́\x1c\x00<>") + [
        " the", "'s", "'re", "  ", "\n\n", "<|endoftext|>"]
    return ["".join(random.choices(letters, k=random.randint(0, 80))) for _ in range(3000)] + [
        "a" * 30_000, "é" * 3000, " " * 5000, "ab" * 20_000, "", None, "same", "same"]


def test_ids_are_those_of_the_library_and_decode_back(frame):
    rows = list(enumerate(texts())) + [(None, "null id"), (0, "repeated id")]
    got = B.encode(frame(rows), PATH, P.PATTERN, columns=("n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"))
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, by.values())) == len(rows)
    for i, t in rows:
        ids = ENC.encode_ordinary(t or "")
        r = next(r for r in by[i] if r.ids == ids)
        assert r.n_tokens == len(ids) and bytes(r.decoded) == (t or "").encode()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_decode_from_ids_alone(spark, frame):
    rows = [(1, "Ünïcode text, 中文!"), (2, ""), (3, None)]
    got = B.decode(B.encode(frame(rows), PATH, P.PATTERN), PATH).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in got} == {1: rows[0][1], 2: "", 3: ""}


def test_perfect_hash_is_minimal_and_finds_every_token():
    h = B.PerfectHash(TOKENS)
    assert (h.find(TOKENS) == range(len(TOKENS))).all() and sorted(h.owner.tolist()) == list(range(len(TOKENS)))


def test_empty_table(frame):
    assert B.encode(frame([]), PATH, P.PATTERN).collect() == []


def test_short_words_are_merged_side_by_side_with_the_heap_s_ids(monkeypatch):
    bpe = B.ByteBPE(TOKENS, P.PATTERN)
    random.seed(2)
    words = list({bytes(random.choices(b"eeantiorn h\xc3\xa9\xf1\x00Z", k=random.randint(1, B.SHORT + 8))) for _ in range(4000)})
    heap = [bpe.merge(w) for w in words]
    long = []
    monkeypatch.setattr(bpe, "merge", lambda w: long.append(w) or B.ByteBPE.merge(bpe, w))
    ids, sizes = bpe.encode_words(words)
    assert sizes.tolist() == list(map(len, heap)) and ids.tolist() == [i for h in heap for i in h]
    assert long and min(map(len, long)) > B.SHORT            # a heap for none of the others


def test_pair_table_has_every_pair_and_no_other():
    bpe = B.ByteBPE(TOKENS, P.PATTERN)
    left, right = np.asarray([k >> 24 for k in bpe.pairs]), np.asarray([k & 0xFFFFFF for k in bpe.pairs])
    assert (bpe.table.find(left, right) == list(bpe.pairs.values())).all()
    found = bpe.table.find(right, left).tolist()
    assert found == [bpe.pairs.get(b << 24 | a, B.NONE) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    sent = pickle.dumps(bpe)
    assert len(sent) < 4 << 20 and (pickle.loads(sent).table.ranks == bpe.table.ranks).all()   # the table is not sent
    assert bpe.table.find(left[:0], right[:0]).tolist() == [] and B.PairTable({}).find(left[:3], right[:3]).tolist() == [B.NONE] * 3
