import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexispark.llm import tokenfile as T

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    out, at = [], 0
    packed = [(d, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for d, t in rows]
    for d, ids in sorted(packed, key=lambda r: (r[0] is not None, r[0] or 0, r[1].astype("<u2").tobytes())):
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def texts():
    random.seed(2)
    letters = list("abcdeE tsdé ÉçñßÆ×÷'’,.!?;:|$-_ \n\t\r\x0b\x0c\x85\xa0　 0123456789٣½中文字😀́\x1c\x00\x02<>İΣΌς") + [
        " the", "'s", "don't", "Étion ", "<|endoftext|>", "ÀÖ!", "end. ", "H\u0331", "h\u0331!", "I\u0307", "e\u0301.", ">\u0338", "a1b22", "7's", "!'s", "Kªx"]
    return ["".join(random.choices(letters, k=random.randint(0, 60))) for _ in range(1500)] + ["a" * 3000, None, ""]


@pytest.mark.parametrize("shard_chars", [T.SHARD_CHARS, 5000])
def test_documents_read_back_from_the_files(frame, shard_chars):
    rows = list(enumerate(texts())) + [(None, "null id"), (5, "repeated id"), (5, "repeated id")]
    random.shuffle(rows)
    files = T.write_token_files(frame(rows), PATH, shard_chars=shard_chars)
    assert files.count() >= (1 if shard_chars == T.SHARD_CHARS else 5)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in T.read_documents(files).collect())
    assert [(d, s, n, c) for s, d, n, c in got] == expected(rows)


def test_access_rank_select():
    rng = np.random.default_rng(0)
    ids = (rng.zipf(1.4, 700_000) % 49_000).astype(np.uint16)
    m = T.WaveletMatrix(T.build(ids, [(1, len(ids))]))
    assert (m.all() == ids).all()
    assert [m.access(i) for i in (0, 1, 262_143, 262_144, 699_999)] == ids[[0, 1, 262_143, 262_144, 699_999]].tolist()
    for token in (int(ids[0]), int(ids[5]), 3, 48_999):
        where = np.flatnonzero(ids == token)
        assert m.rank(token) == len(where) and m.rank(token, 300_000) == (where < 300_000).sum()
        assert m.select(token, len(where)) == -1
        for n in {0, len(where) // 2, len(where) - 1} if len(where) else ():
            assert m.select(token, n) == where[n]
    with pytest.raises(IndexError):
        m.access(700_000)


def test_lookup_and_empty(spark, frame):
    files = T.write_token_files(frame([(1, "the cat the"), (2, None)]), PATH)
    the = Tokenizer.from_file(PATH).encode("the", add_special_tokens=False).ids[0]
    assert [(r.occurrences, r["first"]) for r in T.lookup(spark, files, the).collect()] == [(2, 0)]
    assert T.read_documents(T.write_token_files(frame([]), PATH)).collect() == []
    assert T.WaveletMatrix(T.build(np.zeros(0, np.uint16), [])).all().tolist() == []


def test_added_tokens_as_the_library_encodes_them(frame):
    tok = Tokenizer.from_file(PATH)
    rows = list(enumerate(texts() + ["a<|endoftext|>b", "x <|startoftext|> y", "<|endoftext|><|endoftext|>", "end <|ENDOFTEXT|>"]))
    packed = [(d, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for d, t in rows]
    ends = np.cumsum([len(ids) for _, ids in packed])
    got = T.read_documents(T.write_token_files(frame(rows), PATH, added=True, shard_chars=5000)).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == [
        (d, e - len(ids), len(ids), zlib.crc32(ids.tobytes())) for (d, ids), e in zip(packed, ends.tolist(), strict=True)]
    plain = T.write_token_files(frame(rows), PATH)
    assert T.lookup(frame([]).sparkSession, plain, 49407).collect()[0].occurrences == 0 < sum((ids == 49407).sum() for _, ids in packed)
