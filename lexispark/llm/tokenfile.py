"""Token-id files: a wavelet matrix per shard (operator 9).

Documents are encoded with the ``tokenizers`` library, an end id is appended
to each, and the ids are written in ascending document order, one file per
shard of neighbouring documents. A file is the wavelet matrix of the shard's
ids: for each bit of an id, from the highest, a plane with that bit of every
id, in the order in which the planes above have sorted them (zeros first). A
plane is stored in compressed (zstd) blocks of ``BLOCK`` bits with the number of ones
before each block, so that ``access`` (the id at a place), ``rank`` (how often an
id occurs before a place) and ``select`` (where its n-th occurrence is) read one
block or a few from each plane, and not the file.

Shards: bounds on doc_id by approximate percentiles, so that each has about
``SHARD_CHARS`` characters; encoded documents move once, as packed ids, to
their shard, and each shard is written as one row of a Parquet table of files
(path, first and last id, number of ids, content) in the folder given or the
shared one. Readers need nothing but Spark.

White space separates tokens of the vocabularies meant here (it is dropped), and so
do the changes between Latin letters, digits and ASCII punctuation, so each distinct
chunk between such places is encoded once for a piece of text; a memo of bounded
size keeps them between pieces. ASCII letters are lower-cased first, as the library
would, but for those that a combining mark may follow.

Null texts are encoded as empty ones (the end id alone). Null ids come first;
rows of one id are ordered by their ids. An empty table gives no file.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import Memo, buffers, coded, pick, pieces, ready, stage
from .decontam import LOWER

SHARD_CHARS = 8_000_000
BLOCK = 1 << 18                                     # bits
#: Bytes of a generation of kept chunks.
MEMO = 64 << 20
#: Files whose numbers of ids are sent to every task; beyond, a join.
FEW_FILES = 1_000_000
#: Classes of bytes: white space, all others, ASCII letters, digits, and the ASCII
#: punctuation that is in no pre-token with letters (no apostrophe).
WHITE, OTHER, LETTER, DIGIT, PUNCT = range(5)
CLASS = bytes(WHITE if b in b" \t\n\x0b\x0c\r" else LETTER if chr(b).isalpha() and b < 128 else DIGIT if b in b"0123456789"
              else PUNCT if 0x21 <= b < 0x7F and b != 0x27 else OTHER for b in range(256))
#: Whether a text can be cut between two classes (first * 5 + second): a pre-token is
#: one digit, or letters, or neither.
CUT = np.array([(a == WHITE) != (b == WHITE) or {a, b} == {LETTER, PUNCT} or DIGIT in (a, b) and min(a, b) >= LETTER
                for a in range(5) for b in range(5)])
MAGIC = b"WVMX1\n"
MARK = "\x02"
ZSTD = pa.Codec("zstd", 1)


# ------------------------------------------------------------ wavelet matrix

def build(ids: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    """The file of a shard: its ids, and (doc_id, number of ids) of each document."""
    depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    kind = np.uint16 if depth <= 16 else np.uint32
    order, planes, body = ids.astype(kind), [], bytearray()
    for level in range(depth - 1, -1, -1):
        up = (order & kind(1 << level)) != 0
        packed = np.packbits(up, bitorder="little")
        blocks, ones = [], 0
        for k in range(0, len(packed), BLOCK // 8):
            part = packed[k:k + BLOCK // 8]
            data = ZSTD.compress(part.tobytes(), asbytes=True)
            blocks.append((len(body), len(data), ones))
            body += data
            ones += int(np.bitwise_count(part).sum())
        planes.append({"zeros": len(ids) - ones, "blocks": blocks})
        order = np.concatenate([order.take(np.flatnonzero(~up)), order.take(np.flatnonzero(up))])
    head = zlib.compress(json.dumps({"n": len(ids), "depth": depth, "docs": docs, "planes": planes}).encode(), 1)
    return MAGIC + struct.pack("<Q", len(head)) + head + bytes(body)


class WaveletMatrix:
    """Reads the file of a shard."""

    def __init__(self, data: bytes):
        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack_from("<Q", data, len(MAGIC))[0]
        at = len(MAGIC) + 8
        head = json.loads(zlib.decompress(data[at:at + size]))
        self.n, self.depth, self.docs, self.planes = head["n"], head["depth"], head["docs"], head["planes"]
        self.body = memoryview(data)[at + size:]
        self.held: dict[tuple[int, int], np.ndarray] = {}

    def _raw(self, level: int, block: int) -> bytes:
        at, size, _ = self.planes[level]["blocks"][block]
        bits = min(BLOCK, self.n - block * BLOCK)
        return ZSTD.decompress(self.body[at:at + size], -(-bits // 8), asbytes=True)

    def _bits(self, level: int, block: int) -> np.ndarray:
        if (level, block) not in self.held:
            if len(self.held) >= 4 * self.depth:
                self.held.clear()
            raw = np.frombuffer(self._raw(level, block), np.uint8)
            self.held[level, block] = np.unpackbits(raw, bitorder="little")
        return self.held[level, block]

    def _ones(self, level: int, place: int) -> int:
        """Ones of a plane before a place."""
        if place <= 0:
            return 0
        block, rest = divmod(place, BLOCK)
        blocks = self.planes[level]["blocks"]
        if block == len(blocks):
            return self.n - self.planes[level]["zeros"]
        return blocks[block][2] + int(self._bits(level, block)[:rest].sum())

    def access(self, place: int) -> int:
        """The id at a place."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        out = 0
        for level in range(self.depth):
            bit = int(self._bits(level, place // BLOCK)[place % BLOCK])
            ones = self._ones(level, place)
            place = self.planes[level]["zeros"] + ones if bit else place - ones
            out = out << 1 | bit
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of an id before ``end`` lie after the last plane."""
        lo, hi = 0, end
        for level in range(self.depth):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (self.depth - 1 - level) & 1:
                z = self.planes[level]["zeros"]
                lo, hi = z + a, z + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, end: int | None = None) -> int:
        """How often an id occurs before ``end``."""
        if token < 0 or token.bit_length() > self.depth:
            return 0
        lo, hi = self._range(token, self.n if end is None else max(0, min(end, self.n)))
        return hi - lo

    def select(self, token: int, nth: int) -> int:
        """The place of an id's occurrence number ``nth`` (from 0), or -1."""
        if nth < 0 or nth >= self.rank(token):
            return -1
        place = self._range(token, self.n)[0] + nth
        for level in range(self.depth - 1, -1, -1):
            zeros = self.planes[level]["zeros"]
            one = place >= zeros
            want, lo, hi = (place - zeros if one else place), 0, self.n - 1
            while lo < hi:                              # first place with want + 1 such bits up to it
                mid = (lo + hi) // 2
                ones = self._ones(level, mid + 1)
                if (ones if one else mid + 1 - ones) > want:
                    hi = mid
                else:
                    lo = mid + 1
            place = lo
        return place

    def all(self) -> np.ndarray:
        """Every id: the planes' sorting undone from the last to the first."""
        kind = np.uint16 if self.depth <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for level in range(self.depth - 1, -1, -1):
            plane = self.planes[level]
            raw = b"".join(self._raw(level, k) for k in range(len(plane["blocks"])))
            up = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n, bitorder="little").astype(bool)
            before = np.empty(self.n, kind)
            before[np.flatnonzero(~up)] = out[:plane["zeros"]]
            before[np.flatnonzero(up)] = out[plane["zeros"]:] | kind(1 << (self.depth - 1 - level))
            out = before
        return out


# ------------------------------------------------------------ writing

def _bounds(docs: DataFrame, shard_chars: int) -> list[int]:
    """Upper doc_ids of all shards but the last."""
    n, total = docs.agg(F.count("doc_id"), F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).collect()[0]
    shards = -(-int(total) // shard_chars)
    if n == 0 or shards < 2:
        return []
    # ever finer percentiles cost little: one sketch of bounded size for each task
    cuts = [k / shards for k in range(1, shards)]
    return sorted(set(docs.approxQuantile("doc_id", cuts, 0.25 / shards)))


def encode_runs(tok, runs: list[str], kind: np.dtype) -> list[bytes]:
    """Packed ids of each run without white space. Many runs are encoded as one
    text, with a mark between them that is a pre-token and a token of its own;
    runs that hold the mark (or a vocabulary without such a token) go one by one."""
    mark = tok.encode(MARK, add_special_tokens=False).ids
    plain = [i for i, r in enumerate(runs) if MARK not in r] if len(mark) == 1 else []
    out: list[bytes] = [b""] * len(runs)
    for k in range(0, len(plain), 50_000):
        part = plain[k:k + 50_000]
        texts = [f" {MARK} ".join([runs[i] for i in part[j:j + 500]]) + f" {MARK}" for j in range(0, len(part), 500)]
        ids = np.concatenate([np.asarray(e.ids, np.uint32) for e in tok.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(ids == mark[0])
        packed, width = ids.astype(kind).tobytes(), kind.itemsize
        lo = 0
        for i, hi in zip(part, ends.tolist(), strict=True):
            out[i] = packed[lo * width:hi * width]
            lo = hi + 1
    for i in set(range(len(runs))).difference(plain):
        out[i] = np.asarray(tok.encode(runs[i], add_special_tokens=False).ids, np.uint32).astype(kind).tobytes()
    return out


def lowered(data: bytes) -> bytes:
    """A-Z in lower case, but before a character that might combine with the letter
    (the library composes first; ASCII and U+00C0 to U+00FF never combine)."""
    raw = np.frombuffer(data, np.uint8)
    wide = np.flatnonzero((raw[1:] >= 0xC4) | (raw[1:] == 0xC2))
    wide = wide[(raw[wide] >= 0x41) & (raw[wide] <= 0x5A)]
    data = data.translate(LOWER)
    if len(wide):
        out = np.frombuffer(data, np.uint8).copy()
        out[wide] = raw[wide]
        data = out.tobytes()
    return data


def chunks(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The texts, laid end to end, cut where their ids do not change: each text's
    range of chunks (n + 1 offsets), every chunk as a code, and the distinct
    chunks (white space, which has no ids, among these only)."""
    if not data:
        return np.zeros(len(offsets), np.int64), np.zeros(0, np.int32), pa.array([], pa.binary())
    kind = np.frombuffer(data.translate(CLASS), np.uint8)
    edge = np.empty(len(kind), bool)
    edge[0] = True
    edge[1:] = CUT[kind[:-1] * np.uint8(5) + kind[1:]]
    # after a letter of U+00C0 to U+00FF (all but two are), as after an ASCII one
    raw = np.frombuffer(data, np.uint8)
    after = np.flatnonzero(raw[:-2] == 0xC3) + 2
    after = after[(kind[after] >= DIGIT) & (raw[after - 1] != 0x97) & (raw[after - 1] != 0xB7)]
    edge[after] = True
    edge[offsets[:-1][offsets[:-1] < len(kind)]] = True
    starts = np.flatnonzero(edge)
    codes, distinct = coded(data, starts)
    word = kind[starts] != WHITE
    at = np.concatenate([[0], np.cumsum(word)])
    return at[np.searchsorted(starts, offsets)], codes[word], distinct


class Runs:
    """Packed ids of chunks, with a memo of those met."""

    def __init__(self, tok, kind: np.dtype, added: list):
        import re
        self.added = re.compile(b"|".join(re.escape(a.content.encode()) for a in added),
                                re.I if any(a.normalized for a in added) else 0) if added else None
        self.tok, self.kind, self.memo = tok, kind, Memo(MEMO)

    def holding(self, data: bytes, offsets: np.ndarray) -> list[int]:
        """Texts that may hold an added token; these are encoded as they are."""
        if self.added is None:
            return []
        at = np.fromiter((m.start() for m in self.added.finditer(data)), np.int64)
        return np.unique(np.searchsorted(offsets, at, side="right") - 1).tolist()

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, np.uint32).astype(self.kind).tobytes()

    def __call__(self, runs: list[bytes]) -> list[bytes]:
        return self.memo.get(runs, lambda new: encode_runs(self.tok, [r.decode() for r in new], self.kind))


class Vocabulary:
    """Sent to the tasks as text; a worker process makes the tokenizer and the
    memo once, for all its tasks."""

    def __init__(self, text: str):
        self.text, self.made = text, {}

    def __getstate__(self):
        return {"text": self.text, "made": {}}

    def runs(self, end_id: int, added: bool = False) -> Runs:
        if (end_id, added) not in self.made:
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            tok = Tokenizer.from_str(self.text)
            tok.encode_special_tokens = not added           # else their strings are ordinary text
            kind = np.dtype("<u2" if max(tok.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4")
            self.made[end_id, added] = Runs(tok, kind, list(tok.get_added_tokens_decoder().values()) if added else [])
        return self.made[end_id, added]


def laid_out(found: list[bytes], codes: np.ndarray, at: np.ndarray, kind: np.dtype, end_id: int) -> pa.Array:
    """Packed ids of texts, each with the end id: text i has the runs ``codes[at[i]:
    at[i + 1]]``, and ``found`` the ids of each run."""
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // kind.itemsize
    known = np.frombuffer(b"".join(found), kind)
    first, each = np.cumsum(sizes) - sizes, sizes[codes]
    total = np.concatenate([[0], np.cumsum(each)])
    ids = known[np.arange(total[-1]) + np.repeat(first[codes] - total[:-1], each)]
    edge = total[at]
    ids = np.insert(ids, edge[1:], end_id)
    ends = (edge + np.arange(len(edge))) * kind.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(
        ids.astype(kind).tobytes())]).cast(pa.binary())


def _encode(sent, end_id: int, bounds: list[int], added: bool):
    def run(batches):
        runs = sent.value.runs(end_id, added)
        kind = runs.kind
        end = np.asarray([end_id], kind).tobytes()
        upper = np.asarray(bounds, np.float64)
        for b in pieces(batches):
            data, offsets = buffers(b.column("text"))
            at, codes, distinct = chunks(lowered(data), offsets)
            packed = laid_out(runs(distinct.to_pylist()), codes, at, kind, end_id)
            whole = runs.holding(data, offsets)              # an added token may take the white space beside it
            if whole:
                packed = packed.to_pylist()
                for k in whole:
                    packed[k] = runs.whole(data[offsets[k]:offsets[k + 1]].decode()) + end
                packed = pa.array(packed, pa.binary())
            doc = b.column("doc_id")
            where = np.searchsorted(upper, np.nan_to_num(doc.to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf))
            where[np.asarray(doc.is_null())] = 0
            yield pa.RecordBatch.from_pydict({"shard": pa.array(where, pa.int32()), "doc_id": doc,
                                              "width": pa.array([kind.itemsize] * len(packed), pa.int32()),
                                              "packed": packed})
    return run


def _files(batches):
    """One file for each shard; rows come sorted by shard and document."""
    shard, docs, parts = None, [], []

    def file():
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return pa.RecordBatch.from_pydict({
            "path": pa.array([f"shard-{shard:08d}.wvmx"]), "shard": pa.array([shard], pa.int32()),
            "first_doc": pa.array([docs[0][0]], pa.int64()), "last_doc": pa.array([docs[-1][0]], pa.int64()),
            "n_ids": pa.array([len(ids)], pa.int64()), "content": pa.array([build(ids, docs)], pa.binary())})

    for b in batches:
        for s, doc, width, packed in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "width", "packed")),
                                         strict=True):
            if s != shard and docs:
                yield file()
                docs, parts = [], []
            shard = s
            ids = np.frombuffer(packed, "<u2" if width == 2 else "<u4")
            docs.append((doc, len(ids)))
            parts.append(ids)
    if docs:
        yield file()


FILE = "path string, shard int, first_doc long, last_doc long, n_ids long, content binary"


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id",
                      text_col: str = "text", shard_chars: int = SHARD_CHARS, added: bool = False) -> DataFrame:
    """Encodes and writes; returns the written table of files. ``added``: strings
    of added tokens get their own ids, as the library does by default; else they
    are ordinary text."""
    spark = ready(docs.sparkSession)
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    bounds = _bounds(texts, shard_chars)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(Vocabulary(f.read()))     # bounded by its file
    rows = texts.mapInArrow(_encode(sent, end_id, bounds, added), "shard int, doc_id long, width int, packed binary")
    files = (rows.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "doc_id", "packed")
             .mapInArrow(_files, FILE))
    return stage(files, "token-files")


# ------------------------------------------------------------ reading

def _docs(batches):
    for b in batches:
        for shard, content in zip(b.column("shard").to_pylist(), b.column("content").to_pylist(), strict=True):
            matrix = WaveletMatrix(content)
            ids = matrix.all().astype("<u4")
            ends = np.cumsum([n for _, n in matrix.docs])
            starts = ends - [n for _, n in matrix.docs]
            for k in range(0, len(ends), 256):
                lo, hi = starts[k:k + 256], ends[k:k + 256]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard] * len(lo), pa.int32()),
                    "doc_id": pa.array([d for d, _ in matrix.docs[k:k + 256]], pa.int64()),
                    "at": pa.array(lo, pa.int64()), "n_tokens": pa.array(hi - lo, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:z].tobytes()) for a, z in zip(lo, hi, strict=True)], pa.int64())})


def read_documents(files: DataFrame) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""
    spark = ready(files.sparkSession)
    before = files.select("shard", (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("before"))
    rows = files.select("shard", "content").mapInArrow(
        _docs, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    few = files.count() <= FEW_FILES                         # two numbers for each file
    out = rows.join(F.broadcast(before) if few else before, "shard")
    return out.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, files: DataFrame, token: int) -> DataFrame:
    """shard, occurrences of an id, and the place of the first, without
    unpacking the files."""
    def run(batches):
        for b in batches:
            for shard, content in zip(b.column("shard").to_pylist(), b.column("content").to_pylist(), strict=True):
                matrix = WaveletMatrix(content)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "occurrences": pa.array([matrix.rank(token)], pa.int64()),
                    "first": pa.array([matrix.select(token, 0)], pa.int64())})

    ready(spark)
    return files.select("shard", "content").mapInArrow(run, "shard int, occurrences long, first long")
