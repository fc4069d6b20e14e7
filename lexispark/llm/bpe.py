"""Byte-level BPE encoding and decoding with a two-tier lookup (operator 4).

Text is cut by the tokenizer's pattern into pre-tokens. A pre-token that is
itself in the vocabulary is resolved by a minimal perfect hash over the whole
vocabulary: one slot per token, its bytes compared, no probing. Any other
pre-token is merged: of the ranks of its neighbouring pairs the lowest (leftmost
first) is merged until none is left. Pre-tokens of up to ``SHORT`` bytes are merged
side by side, all of one length as the rows of a matrix, one merge of each row at a
time; in longer ones the ranks wait in a heap over a doubly linked list of the bytes,
n log n in the length of the pre-token.

Inside a task the texts are first cut at safe places, which are always
pre-token boundaries: before a space or line end that follows a visible
character, and between a Latin letter and ASCII punctuation. Equal chunks of a piece of text are found by Arrow's dictionary
encoding, so that the pattern, the hash and the merges run once for each
distinct chunk; a memo of bounded size keeps chunks between pieces.

Row-local: no shuffle, whatever the input. Null texts are encoded as empty
ones; rows, repeated or not, and ids, null or not, are kept as they are.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Memo, buffers, byte_table, coded, mix, pick, pieces, ready, release

#: What a worker keeps between pieces of text: bytes of a generation of kept chunks.
MEMO = 24 << 20
#: Text bytes of one step: what is made of them takes some fifty times as much.
STEP_BYTES = 1 << 20
BUCKET = 4
#: Bytes of a pre-token up to which it is merged side by side with others of its length.
SHORT = 40
#: The rank of a pair that no token is made of.
NONE = np.iinfo(np.int32).max
COLUMNS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(), "decoded": pa.binary(),
           "decoded_sha256": pa.string()}
SQL = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "binary", "decoded_sha256": "string"}


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash: n distinct keys to n slots (hash and displace)."""

    def __init__(self, keys: list[bytes]):
        self.n = max(1, len(keys))
        self.buckets = max(1, self.n // BUCKET)
        h = self.hashes(keys)
        group = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.uint64)
        self.owner = np.full(self.n, -1, np.int32)
        for b in np.argsort(-np.diff(cuts), kind="stable"):      # the fullest buckets choose first
            own = order[cuts[b]:cuts[b + 1]]
            if not len(own):
                break
            tries, d, at = 4096 // len(own), 0, None
            while at is None:                                     # many shifts at once
                all_at = self._slot(h[own][None, :], np.arange(d, d + tries, dtype=np.uint64)[:, None])
                free = (self.owner[all_at] < 0).all(axis=1)
                for t in np.flatnonzero(free).tolist():
                    if len(set(all_at[t].tolist())) == len(own):
                        at, d = all_at[t], d + t
                        break
                else:
                    d += tries
            self.shift[b] = d
            self.owner[at] = own

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        import xxhash
        h = xxhash.xxh3_64_intdigest
        return np.fromiter((h(k) for k in keys), np.uint64, len(keys))

    def _slot(self, h: np.ndarray, d) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(h + d * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """For each key the only key of the set that it can be (its number)."""
        h = self.hashes(keys)
        return self.owner[self._slot(h, self.shift[(h % np.uint64(self.buckets)).astype(np.int64)])]


class PairTable:
    """Ranks of pairs of ids, looked up many at once (open addressing, a quarter full at most)."""

    def __init__(self, pairs: dict[int, int]):
        self.mask = (4 << max(1, len(pairs)).bit_length()) - 1
        self.keys, self.ranks = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NONE, np.int32)
        self.pairs = pairs
        keys, ranks = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            self.keys[at[free]] = keys[free]                  # of several for one slot, the last
            left = self.keys[at] != keys
            self.ranks[at[~left]] = ranks[~left]
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & self.mask

    def __reduce__(self):
        return PairTable, (self.pairs,)                       # made again where it is sent to

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` if it has none."""
        keys = left.astype(np.int64) << 24 | right
        at = self._slot(keys)
        held = self.keys[at]
        out = self.ranks[at]
        other = np.flatnonzero(held != keys)
        while len(other):
            out[other] = NONE
            other = other[held[other] >= 0]                   # the slot is another pair's: the next one
            at[other] = (at[other] + 1) & self.mask
            held[other], out[other] = self.keys[at[other]], self.ranks[at[other]]
            other = other[held[other] != keys[other]]
        return out


class ByteBPE:
    def __init__(self, tokens: list[bytes], pattern: str, memo: int = MEMO):
        self.tokens, self.pattern = tokens, pattern
        ranks = {t: i for i, t in enumerate(tokens) if t}
        self.byte = [ranks[bytes([b])] for b in range(256)]
        #: Two neighbours' ids to the id of both, for each way to cut a token in two.
        self.pairs = {ranks[t[:k]] << 24 | ranks[t[k:]]: i for t, i in ranks.items() for k in range(1, len(t))
                      if t[:k] in ranks and t[k:] in ranks}
        self.table = PairTable(self.pairs)
        self.byte_ids = np.asarray(self.byte, np.int32)
        #: The rank of each two bytes.
        self.bytes_rank = self.table.find(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))
        self.by_hash = PerfectHash(tokens)
        #: Of a worker process, for all its tasks.
        self.memo = Memo(memo)

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token that is not in the vocabulary."""
        get, n = self.pairs.get, len(word)
        byte, push, pop = self.byte, heapq.heappush, heapq.heappop
        part = [byte[b] for b in word]
        part.append(-1)                                 # after the last and before the first: in no pair
        left, right = list(range(-1, n)), list(range(1, n + 2))
        shift = n.bit_length()
        mask = (1 << shift) - 1
        heap = [r << shift | i for i in range(n - 1)    # the lowest rank, then the leftmost
                if (r := get(part[i] << 24 | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            x = pop(heap)
            i, rank = x & mask, x >> shift
            j = right[i]
            if get(part[i] << 24 | part[j]) != rank:    # one of the two has been merged since
                continue
            part[i], part[j] = rank, -1
            k = right[i] = right[j]
            left[k] = i
            if (r := get(rank << 24 | part[k])) is not None:
                push(heap, r << shift | i)
            h = left[i]
            if (r := get(part[h] << 24 | rank)) is not None:
                push(heap, r << shift | h)
        return [p for p in part if p >= 0]

    def merge_rows(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of pre-tokens of one length, as the rows of a matrix of bytes: numbers
        of rows and their ids, for each number of ids that a row is left with."""
        out, which, parts = [], np.arange(len(rows)), self.byte_ids[rows]
        ranks = self.bytes_rank[rows[:, :-1].astype(np.int64) << 8 | rows[:, 1:]]
        while ranks.shape[1]:
            at = ranks.argmin(axis=1)                       # the lowest rank, then the leftmost
            low = ranks[np.arange(len(at)), at]
            more = low != NONE
            if not more.all():
                out.append((which[~more], parts[~more]))
                which, parts, ranks, at, low = which[more], parts[more], ranks[more], at[more], low[more]
            if not len(which):
                return out
            n, wide = parts.shape
            column = np.arange(wide)
            parts = parts[column != at[:, None] + 1].reshape(n, wide - 1)
            ranks = ranks[column[:-1] != at[:, None]].reshape(n, wide - 2)
            parts[np.arange(n), at] = low
            i = np.flatnonzero(at < wide - 2)
            ranks[i, at[i]] = self.table.find(low[i], parts[i, at[i] + 1])
            i = np.flatnonzero(at)
            ranks[i, at[i] - 1] = self.table.find(parts[i, at[i] - 1], low[i])
        return [*out, (which, parts)]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens, end to end, and their number for each."""
        found, tokens = self.by_hash.find(words), self.tokens
        rest = np.asarray([k for k, (w, i) in enumerate(zip(words, found.tolist(), strict=True)) if tokens[i] != w], np.int64)
        length = np.fromiter((len(words[k]) for k in rest.tolist()), np.int64, len(rest))
        order = np.argsort(length, kind="stable")
        rest, length = rest[order], length[order]
        parts = []
        short = int(np.searchsorted(length, SHORT, "right"))
        data, at = np.frombuffer(b"".join([words[k] for k in rest[:short].tolist()]), np.uint8), 0
        cuts = np.flatnonzero(np.diff(length[:short], prepend=0, append=0))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            size = int(length[lo])
            rows = data[at:at + (hi - lo) * size].reshape(hi - lo, size)
            parts += [(rest[lo:hi][which], ids) for which, ids in self.merge_rows(rows)]
            at += rows.size
        parts += [(np.asarray([k]), np.asarray([self.merge(words[k])], np.int32)) for k in rest[short:].tolist()]
        sizes = np.ones(len(words), np.int64)
        for which, ids in parts:
            sizes[which] = ids.shape[1]
        first = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int32)
        out[first] = found                                    # for the rest, what follows takes its place
        for which, ids in parts:
            out[first[which][:, None] + np.arange(ids.shape[1])] = ids
        return out, sizes

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, end to end, and their number for each."""
        import regex
        split = regex.compile(self.pattern).findall
        cut = [split(c.decode()) for c in chunks]
        number: dict[str, int] = {}
        word = np.asarray([number.setdefault(w, len(number)) for ws in cut for w in ws], np.int64)
        if not len(word):
            return np.zeros(0, np.int32), np.zeros(len(chunks), np.int64)
        ids, sizes = self.encode_words([w.encode() for w in number])
        first, each = np.cumsum(sizes) - sizes, sizes[word]
        total = np.concatenate([[0], np.cumsum(each)])
        edge = total[np.concatenate([[0], np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))])]
        return ids[np.arange(total[-1]) + np.repeat(first[word] - total[:-1], each)], np.diff(edge)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


LETTER = byte_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
GAP = byte_table(b" \n")
#: White space, and punctuation that starts no pre-token with letters in it.
MARKS = byte_table(b" \n" + bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"))


def _is(table: bytes, at: np.ndarray) -> np.ndarray:
    return np.frombuffer(table, bool)[at]


def chunk_starts(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Where texts laid end to end can be cut without changing pre-tokens."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    mark = np.flatnonzero(np.frombuffer(data.translate(MARKS), np.uint8))
    gap = _is(GAP, raw[mark])
    before, lead = raw[np.maximum(mark - 1, 0)], raw[np.maximum(mark - 2, 0)]
    # two-byte characters: none from 0xC3 on is white space, those of 0xC3 are letters but two
    two = (before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead < 0xE0)
    latin = two & (lead == 0xC3) & (before != 0x97) & (before != 0xB7)
    visible = (before > 0x20) & (before < 0x7F)
    cut = np.where(gap, visible | two, _is(LETTER, before) | latin)
    after = mark[~gap] + 1
    after = after[after < n]
    edge = np.zeros(n, bool)
    edge[mark[cut]] = True
    edge[after[_is(LETTER, raw[after])]] = True
    edge[offsets[:-1][offsets[:-1] < n]] = True
    edge[0] = True
    return np.flatnonzero(edge)


def _encode(sent, columns: tuple[str, ...]):
    def run(batches):
        bpe: ByteBPE = sent.value

        def ids_and_text(chunks: list[bytes]) -> list[tuple[bytes, bytes]]:
            ids, sizes = bpe.encode_chunks(chunks)
            raw, text = ids.astype("<i4").tobytes(), list(map(str, ids.tolist()))
            end = np.cumsum(sizes)
            return [(raw[4 * lo:4 * hi], ",".join(text[lo:hi]).encode())
                    for lo, hi in zip((end - sizes).tolist(), end.tolist(), strict=True)]

        for b in pieces(batches, limit=STEP_BYTES):
            data, offsets = buffers(b.column("text"))
            starts = chunk_starts(data, offsets)
            codes, distinct = coded(data, starts)
            found = bpe.memo.get(distinct.to_pylist(), ids_and_text)
            sizes = np.fromiter((len(ids) for ids, _ in found), np.int64, len(found)) // 4
            at = np.searchsorted(starts, offsets)
            each = sizes[codes]
            total = np.concatenate([[0], np.cumsum(each)])
            edge = total[at]
            out = {"doc_id": b.column("doc_id"), "n_tokens": pa.array(np.diff(edge), pa.int64())}
            made: dict[str, list] = {c: [] for c in columns if c not in ("n_tokens", "ids")}
            if "ids" in columns or "decoded" in made or "decoded_sha256" in made:
                known = np.frombuffer(b"".join(ids for ids, _ in found), "<i4")
                first = np.cumsum(sizes) - sizes
                ids = known[np.arange(total[-1]) + np.repeat(first[codes] - total[:-1], each)]
                if "ids" in columns:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids))
                for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if len(made) > ("ids_sha256" in made) else ():
                    raw = bpe.decode(ids[lo:hi].tolist())
                    if "decoded" in made:
                        made["decoded"].append(raw)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(hashlib.sha256(raw).hexdigest())
            if "ids_sha256" in made:
                text_of = np.empty(len(found), object)
                text_of[:] = [t for _, t in found]
                made["ids_sha256"] = [hashlib.sha256(b",".join(text_of[codes[lo:hi]].tolist())).hexdigest()
                                      for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            out |= {c: pa.array(v, COLUMNS[c]) for c, v in made.items()}
            yield pa.RecordBatch.from_pydict({c: out[c] for c in ("doc_id", *columns)})
        bpe.memo.forget()
        release()
    return run


def _sent(spark, path: str, pattern: str, memo: int = MEMO):
    """The vocabulary, bounded by its file, for the tasks."""
    return ready(spark).sparkContext.broadcast(ByteBPE(read_ranks(path), pattern, memo))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           columns: tuple[str, ...] = ("n_tokens", "ids"), memo: int = MEMO) -> DataFrame:
    """doc_id and the wanted ``columns``: n_tokens; ids (array); ids_sha256, of
    the decimal ids joined by commas; decoded (the bytes that the ids stand
    for); decoded_sha256. ``memo``: bytes that a worker may keep, some four times."""
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    schema = "doc_id long, " + ", ".join(f"{c} {SQL[c]}" for c in columns)
    return texts.mapInArrow(_encode(_sent(docs.sparkSession, path, pattern, memo), columns), schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, decoded: the bytes of a document's ids (null ids: no bytes)."""
    sent = _sent(encoded.sparkSession, path, "")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "decoded": pa.array(
                [sent.value.decode(ids or []) for ids in b.column("ids").to_pylist()], pa.binary())})

    return pick(encoded, doc_id=F.col(f"`{id_col}`").cast("long"), ids=ids_col).mapInArrow(
        run, "doc_id long, decoded binary")
