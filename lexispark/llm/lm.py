"""Language-model scoring by deleted interpolation (operator 8).

Texts (null: empty) are lower-cased (A-Z) and cut into words
``[^\\x20\\x09-\\x0D]+``; one end token follows the last. The model mixes three
estimates of a token after its context (the token before, the end token at a
text's start):

    P(w | h) = l2[b] c(h w) / c(h) + l1[b] c(w) / N + l0[b] / (V + 1)

with counts over the training texts and b the bucket of the context's
frequency c(h), one bucket for each power of two. The weights come from
expectation-maximisation on deleted counts: a share of the training texts is
taken out, the others' counts estimate, and the weights are fitted to the
tokens taken out. (Contexts without a count have no bigram estimate; they are a
bucket of their own, whose l2 is 0.) Then all training texts are counted.

Counting is exact and distributed, and nothing of the corpus' size is sent to
the driver or to every task:

1. Each task turns its texts into blocks, one row each: the hashes of the
   block's distinct words and the texts as numbers into them, written once to the
   shared folder. A block is of one kind: estimating, deleted or only scored.
2. A block asks for the counts of its distinct words and pairs of words: it
   sends their hashes, each once with its count in the block, packed by bucket.
   A hot word is one number from each block, however often it occurs. A bucket's
   task adds the numbers up and answers each block in the order it asked.
3. The deleted blocks, with their answers, give the evidence for the weights;
   all blocks, with theirs, the scores.

Output, one row for each input row: doc_id, held_out, n_tokens, n_known (tokens
with a training count), train_tokens (N), base_score (log10, each token (c +
1/2) / (N + (V + 1) / 2)) and score (log10 of P). Words are told apart by 64-bit
hashes, pairs by 48 bits within a bucket (``SENT``). Without
training texts N = V = 0 and every estimate is the uniform one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import buffers, byte_table, grams_pair, pick, pieces, ready, release, stage, word_hashes, words
from .decontam import LOWER

WORD = byte_table(bytes(b for b in range(256) if b not in b" \t\n\x0b\x0c\r"))
#: The end token; no word's hash by more than chance.
END = np.uint64(0x5EED0F7E9D70CE11)
BLOCK_BYTES = 8 << 20
#: Text bytes of one step on the way to a block; what is made of them takes some forty times as much.
STEP_BYTES = 2 << 20
#: Distinct words or pairs that a bucket's task adds up.
BUCKET_ENTRIES = 400_000
FREQUENCY_BUCKETS = 40
ROUNDS = 30
ESTIMATE, DELETED, SCORED = 0, 1, 2


def distinct_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and each value's number (32 bits) into them."""
    order = np.argsort(values)
    values = values[order]
    new = np.empty(len(values), bool)
    new[:1] = True
    np.not_equal(values[1:], values[:-1], out=new[1:])
    values = values[new]
    which = np.cumsum(new, dtype=np.uint32)
    which -= np.uint32(1)
    out = np.empty(len(order), np.uint32)
    out[order] = which
    return values, out


# ------------------------------------------------------------ 1 blocks

BLOCKS = ("block string, kind int, ids binary, nulls binary, ends binary, vocab binary, tokens binary")


def _blocks(batches):
    """Blocks of each kind, of about BLOCK_BYTES of text."""
    from pyspark import TaskContext
    task, made = TaskContext.get().partitionId(), 0
    held: dict[int, list] = {}
    size: dict[int, int] = {}

    def close(kind: int):
        nonlocal made
        ids, nulls, lengths, hashes, codes = zip(*held.pop(kind), strict=True)
        size.pop(kind)
        vocab, back = np.unique(np.concatenate(hashes), return_inverse=True)
        back = back.astype(np.uint32)
        tokens, at, offset = np.empty(sum(map(len, codes)), np.uint32), 0, 0
        for own, hashed in zip(codes, hashes, strict=True):
            np.take(back[offset:offset + len(hashed)], own, out=tokens[at:at + len(own)])
            at, offset = at + len(own), offset + len(hashed)
        made += 1
        pack = lambda parts, t: np.concatenate(parts).astype(t).tobytes()
        return pa.RecordBatch.from_pydict({
            "block": pa.array([f"{task}-{made}"]), "kind": pa.array([kind], pa.int32()),
            "ids": pa.array([pack(ids, "<i8")]), "nulls": pa.array([pack(nulls, "u1")]),
            "ends": pa.array([np.cumsum(np.concatenate(lengths)).astype("<i8").tobytes()]),
            "vocab": pa.array([vocab.astype("<u8").tobytes()]), "tokens": pa.array([tokens.astype("<u4").tobytes()])})

    for batch in pieces(batches, limit=STEP_BYTES):
        kinds = batch.column("kind").to_numpy()
        for kind in np.unique(kinds).tolist():
            b = batch.filter(pa.array(kinds == kind))
            data, offsets = buffers(b.column("text"))
            at, codes, distinct = words(data.translate(LOWER), offsets, WORD)
            vocab = np.append(word_hashes(distinct), END)
            # the end token closes each text
            tokens = np.full(len(codes) + len(at) - 1, len(distinct), np.int64)
            tokens[np.arange(len(codes)) + np.searchsorted(at[1:], np.arange(len(codes)), side="right")] = codes
            used, tokens = distinct_of(tokens)
            doc = b.column("doc_id")
            held.setdefault(kind, []).append((doc.fill_null(0).to_numpy(), np.asarray(doc.is_null()),
                                              np.diff(at) + 1, vocab[used], tokens))
            size[kind] = size.get(kind, 0) + len(data)
            if size[kind] >= BLOCK_BYTES:
                yield close(kind)
    for kind in sorted(held):
        yield close(kind)


class Block:
    """A block's row, unpacked. ``pairs``: the distinct (context, token) codes,
    sorted; ``pair``: each token's number into them."""

    def __init__(self, row: dict):
        self.name, self.kind = row["block"], row["kind"]
        self.ids, self.nulls = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nulls"], bool)
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.vocab, self.tokens = np.frombuffer(row["vocab"], "<u8"), np.frombuffer(row["tokens"], "<u4")
        end = np.uint32(np.searchsorted(self.vocab, END))
        both = np.empty(len(self.tokens), np.uint64)
        both[:1] = end                                  # a text's end is the next one's start
        both[1:] = self.tokens[:-1]
        both <<= np.uint64(32)
        both |= self.tokens
        self.pairs, self.pair = distinct_of(both)

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct pair: the context and the token."""
        return (self.pairs >> np.uint64(32)).astype(np.uint32), self.pairs.astype(np.uint32)

    def asked(self, counted: bool = True):
        """(order, hashes, counts if wanted) of the words (1), then of the pairs (2)."""
        yield 1, self.vocab, np.bincount(self.tokens, minlength=len(self.vocab)) if counted else None
        left, right = self.sides()
        hashes = grams_pair(self.vocab[left], self.vocab[right])
        del left, right
        yield 2, hashes, np.bincount(self.pair, minlength=len(self.pairs)) if counted else None


#: Bytes of a hash that are sent. A bucket has other bits in common, and holds
#: few enough pairs for six bytes; words are sent whole.
SENT = {1: 8, 2: 6}


def _bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of hashes by bucket, and where each bucket begins."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _short(hashes: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view("u1").reshape(-1, 8)[:, :width]).tobytes()


def _long(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, "u1").reshape(-1, width)
    out = np.zeros((len(raw), 8), "u1")
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _rows(batches):
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]
            release()


# ------------------------------------------------------------ 2 counts

ASKED = "block string, kind int, n int, bucket int, hashes binary, counts binary"


def _ask(buckets: dict[int, int]):
    def run(batches):
        for row in _rows(batches):
            block = Block(row)
            for n, hashes, counts in block.asked():
                order, cuts = _bucket(hashes, buckets[n])
                train = counts if block.kind != SCORED else np.zeros_like(counts)
                full = [k for k in range(buckets[n]) if cuts[k + 1] > cuts[k]]
                own = [order[cuts[k]:cuts[k + 1]] for k in full]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block.name] * len(full)), "kind": pa.array([block.kind] * len(full), pa.int32()),
                    "n": pa.array([n] * len(full), pa.int32()), "bucket": pa.array(full, pa.int32()),
                    "hashes": pa.array([_short(hashes[o], SENT[n]) for o in own], pa.binary()),
                    "counts": pa.array([_small(train[o]) for o in own], pa.binary())})
    return run


ANSWER = "block string, n int, bucket int, total binary, estimate binary, vocabulary long, est_vocabulary long"


def _add(key, rows):
    """One bucket: its counts added up, and the answers. The bucket's distinct
    words with a training count are reported once, with its first block."""
    kinds, names = rows.column("kind").to_numpy(), rows.column("block").to_pylist()
    hashes = [_long(x, SENT[key[0].as_py()]) for x in rows.column("hashes").to_pylist()]
    counts = [_wide(x) for x in rows.column("counts").to_pylist()]
    found, where = np.unique(np.concatenate(hashes), return_inverse=True)
    sizes = np.array([len(h) for h in hashes])
    part = np.repeat(kinds, sizes)
    every = np.concatenate(counts).astype(np.float64)
    total = np.bincount(where, every, len(found)).astype(np.int64)
    estimate = np.bincount(where, every * (part == ESTIMATE), len(found)).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    answers, deleted = [], []
    for k in range(len(names)):
        own = where[edge[k]:edge[k + 1]]
        answers.append(_small(total[own]))
        deleted.append(_small(estimate[own]) if kinds[k] == DELETED else b"")
    first = np.arange(len(names)) == 0
    return pa.table({
        "block": names, "n": pa.array([key[0].as_py()] * len(names), pa.int32()),
        "bucket": pa.array([key[1].as_py()] * len(names), pa.int32()), "total": pa.array(answers, pa.binary()),
        "estimate": pa.array(deleted, pa.binary()),
        "vocabulary": pa.array(np.where(first, (total > 0).sum(), 0), pa.int64()),
        "est_vocabulary": pa.array(np.where(first, (estimate > 0).sum(), 0), pa.int64())})


def _small(counts: np.ndarray) -> bytes:
    """Counts as bytes of their own width: most are small."""
    width = 1 if not len(counts) or counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 8
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _answered(block: Block, answers: list[dict], field: str, buckets: dict[int, int]):
    """Counts of the block's words and pairs, in their order."""
    got = {(a["n"], a["bucket"]): a[field] for a in answers}
    out = []
    for n, hashes, _ in block.asked(counted=False):
        counts = np.zeros(len(hashes), np.int64)
        order, cuts = _bucket(hashes, buckets[n])
        for k in range(buckets[n]):
            if cuts[k + 1] > cuts[k]:
                counts[order[cuts[k]:cuts[k + 1]]] = _wide(got[n, k])
        out.append(counts)
    return out


# ------------------------------------------------------------ 3 estimates

def frequency_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context without a count, else 1 + log2 of it, cut off."""
    return np.where(counts > 0, np.minimum(np.frexp(np.maximum(counts, 1).astype(np.float64))[1], FREQUENCY_BUCKETS), 0)


def estimates(block: Block, word: np.ndarray, pair: np.ndarray, total: int):
    """Of each distinct pair: bucket, bigram and unigram estimate."""
    left, right = block.sides()
    context = word[left]
    return (frequency_bucket(context), np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0),
            word[right] / max(1, total))


def mixture(weights: np.ndarray, bucket: np.ndarray, two: np.ndarray, one: np.ndarray, vocabulary: int) -> np.ndarray:
    if not len(weights):                                # nothing to learn from
        return np.full(len(bucket), 1 / (vocabulary + 1))
    out = weights[:, 2][bucket] * two
    out += weights[:, 1][bucket] * one
    out += (weights[:, 0] / (vocabulary + 1))[bucket]
    return out


def start_weights() -> np.ndarray:
    w = np.tile([0.2, 0.4, 0.4], (FREQUENCY_BUCKETS + 1, 1))
    w[0] = [0.5, 0.5, 0.0]
    return w


def learn(evidence: DataFrame, vocabulary: int, rounds: int = ROUNDS, tolerance: float = 1e-4) -> np.ndarray:
    """The weights (by bucket: uniform, unigram, bigram) by EM; a round sums
    three numbers for each bucket over the evidence."""
    weights = start_weights()
    for _ in range(rounds):
        now = weights.copy()

        def expect(batches, now=now):
            out = np.zeros((FREQUENCY_BUCKETS + 1, 3))
            for row in _rows(batches):
                b, two, one, n = (np.frombuffer(row[c], t) for c, t in (
                    ("bucket", "u1"), ("two", "<f4"), ("one", "<f4"), ("n", "<u4")))
                w = now[b]
                share = np.stack([w[:, 0] / (vocabulary + 1), w[:, 1] * one, w[:, 2] * two])
                share *= n / np.maximum(share.sum(axis=0), 1e-300)
                for k in range(3):
                    out[:, k] += np.bincount(b, share[k], FREQUENCY_BUCKETS + 1)
            bucket = np.flatnonzero(out.sum(axis=1))
            yield pa.RecordBatch.from_pydict({"b": pa.array(bucket, pa.int32()), **{
                f"s{k}": pa.array(out[bucket, k], pa.float64()) for k in range(3)}})

        sums = (evidence.mapInArrow(expect, "b int, s0 double, s1 double, s2 double")
                .groupBy("b").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(3)]).collect())
        for r in sums:
            s = np.array([r["s0"], r["s1"], r["s2"]])
            weights[r["b"]] = s / s.sum()
        if np.abs(weights - now).max() < tolerance:
            break
    # a frequency that the deleted texts never met goes by the one below it
    met = {r["b"] for r in sums} if rounds else set()
    for b in range(2, FREQUENCY_BUCKETS + 1):
        if b not in met:
            weights[b] = weights[b - 1]
    return weights


def _with_answers(use):
    """For cogroups of a block and its answers."""
    def run(_, block, answers):
        release()
        if not block.num_rows:
            return use(None, [])
        return use(Block(block.slice(0, 1).to_pylist()[0]), answers.to_pylist())
    return run


def score(docs: DataFrame, train: Column, deleted: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text; learns from those for which ``train`` holds (of
    these, ``deleted`` ones fit the weights). Both over the column ``doc_id``."""
    spark = ready(docs.sparkSession)
    held_out = ~F.coalesce(train, F.lit(False))
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string")).select(
        "doc_id", "text", F.when(held_out, SCORED).when(F.coalesce(deleted, F.lit(False)), DELETED)
        .otherwise(ESTIMATE).alias("kind"))
    blocks = stage(texts.mapInArrow(_blocks, BLOCKS), "lm-blocks")
    size = blocks.agg(
        F.coalesce(F.sum(F.octet_length("tokens") / 4), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.octet_length("vocab") / 8), F.lit(0)).alias("words"),
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.octet_length("tokens") / 4)), F.lit(0)).alias(f"n{k}")
          for k in (ESTIMATE, DELETED)]).collect()[0]
    total, est_total = int(size["n0"] + size["n1"]), int(size["n0"])
    buckets = {1: 1 + int(size["words"]) // BUCKET_ENTRIES, 2: 1 + int(size["tokens"]) // BUCKET_ENTRIES}
    answers = stage(blocks.mapInArrow(_ask(buckets), ASKED).groupBy("n", "bucket").applyInArrow(_add, ANSWER), "lm-counts")
    sizes = answers.filter("n = 1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("vocabulary", "est_vocabulary")]).collect()[0]
    vocabulary, est_vocabulary = int(sizes[0]), int(sizes[1])

    def weigh(block, got):
        rows = {"bucket": [], "two": [], "one": [], "n": []}
        if block is not None:
            word, pair = _answered(block, got, "estimate", buckets)
            b, two, one = estimates(block, word, pair, est_total)
            n = np.bincount(block.pair, minlength=len(block.pairs))
            rows = {"bucket": [b.astype("u1").tobytes()], "two": [two.astype("<f4").tobytes()],
                    "one": [one.astype("<f4").tobytes()], "n": [n.astype("<u4").tobytes()]}
        return pa.table({c: pa.array(v, pa.binary()) for c, v in rows.items()})

    reply = answers.select("block", "n", "bucket", "total")
    gone = blocks.filter(F.col("kind") == DELETED)
    # the deleted blocks' own answers only
    theirs = answers.filter(F.octet_length("estimate") > 0).select("block", "n", "bucket", "estimate")
    evidence = stage(gone.groupBy("block").cogroup(theirs.groupBy("block")).applyInArrow(
        _with_answers(weigh), "bucket binary, two binary, one binary, n binary"), "lm-evidence")
    weights = learn(evidence, est_vocabulary) if total else np.zeros((0, 3))

    def mark(block, got):
        if block is None:
            out = [np.zeros(0)] * 6
        else:
            word, pair = _answered(block, got, "total", buckets)
            p = mixture(weights, *estimates(block, word, pair, total), vocabulary)
            base = np.log10((word + 0.5) / (total + 0.5 * (vocabulary + 1)))
            starts = np.concatenate([[0], block.ends[:-1]])
            add = lambda x: np.add.reduceat(x, starts)
            out = [block.ids, block.nulls, np.diff(np.concatenate([[0], block.ends])),
                   add((word > 0)[block.tokens].astype(np.int64)), add(base[block.tokens]), add(np.log10(p)[block.pair])]
        kind = SCORED if block is None else block.kind
        return pa.table({
            "doc_id": pa.array(out[0].astype(np.int64), pa.int64(), mask=out[1].astype(bool)),
            "held_out": pa.array([kind == SCORED] * len(out[0]), pa.bool_()),
            "n_tokens": pa.array(out[2].astype(np.int64)), "n_known": pa.array(out[3].astype(np.int64)),
            "train_tokens": pa.array([total] * len(out[0]), pa.int64()),
            "base_score": pa.array(out[4].astype(np.float64)), "score": pa.array(out[5].astype(np.float64))})

    return blocks.groupBy("block").cogroup(reply.groupBy("block")).applyInArrow(
        _with_answers(mark), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
