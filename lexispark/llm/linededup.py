"""Line deduplication with two Bloom filters (operator 3).

A text is split at ``\\n`` (null or empty: one empty line). A line's key is the
line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points found in at least ``min_docs``
documents are repeated. Their lines go everywhere (``keep_first=False``), or
everywhere but at the first occurrence by (doc id, line number).

1. Each task feeds the keys of its documents, once per document, to a
   once-seen filter; a key already there goes to a twice-seen filter. The
   tasks' filters, cut into chunks, are merged chunk by chunk on the executors:
   what two tasks have seen once has been seen twice. A key in two documents is
   in the merged twice-seen filter for certain.
2. The merged filter (at most ``MAX_BITS`` bits, whatever the input) goes to
   the tasks, and only lines in it shuffle, by their whole key: a partial count
   in each task, then the exact number of documents and the first occurrence.
   On more lines than the filter is made for, it only lets more lines pass.
3. The repeated keys are applied. If they fit ``KEYS_BYTES`` (their counted
   size), each task gets them and rewrites its texts in place; else the
   suspected lines are joined with them, salted, and the line numbers to drop
   joined to the documents.

Every row counts as a document. A null id is allowed (and comes first).
Output: doc_id, text (kept lines, joined by ``\\n``), n_lines, n_dropped.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix, pick, pieces, ready, row_local, stage

SPACE = b" \t\n\x0b\x0c\r"
#: Bits of each filter for a document, and at most (32 MB).
BITS_PER_DOC, MAX_BITS = 256, 1 << 28
CHUNK = 1 << 16
PROBES = 4
#: Repeated keys that are sent to every task, in bytes.
KEYS_BYTES = 64 << 20
SALT = 16


def keys_of(text: str | None) -> list[bytes]:
    return [line.strip(SPACE).lower() for line in (text or "").encode().split(b"\n")]


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def hashes(keys: list[bytes]) -> np.ndarray:
    import xxhash
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(k) for k in keys), np.uint64, len(keys))


class Bloom:
    def __init__(self, bits: int, data: bytes | None = None):
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(bits >> 3, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    def _places(self, h: np.ndarray):
        step = mix(h) | np.uint64(1)
        with np.errstate(over="ignore"):
            for i in range(PROBES):
                p = (h + np.uint64(i) * step) & self.mask
                yield (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for at, bit in self._places(h):
            np.bitwise_or.at(self.data, at, bit)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at, bit in self._places(h):
            out &= (self.data[at] & bit) != 0
        return out


def filter_bits(n_docs: int) -> int:
    want = max(1 << 20, n_docs * BITS_PER_DOC)
    return min(MAX_BITS, 1 << (want - 1).bit_length())


def _seen(bits: int, min_chars: int):
    def run(batches):
        once, twice = Bloom(bits), Bloom(bits)
        for b in pieces(batches):
            keys: list[bytes] = []
            for text in b.column("text").to_pylist():
                keys += {k for k in keys_of(text) if long_enough(k, min_chars)}
            if keys:
                h, n = np.unique(hashes(keys), return_counts=True)
                twice.add(h[once.has(h) | (n > 1)])
                once.add(h)
        size = min(CHUNK, bits >> 3)
        for k in range(0, bits >> 3, size):
            a, b = once.data[k:k + size], twice.data[k:k + size]
            if a.any():
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([k // size], pa.int32()),
                    "once": pa.array([zlib.compress(a.tobytes(), 1)], pa.binary()),
                    "twice": pa.array([zlib.compress(b.tobytes(), 1)], pa.binary())})
    return run


def _merge(batches):
    """Merges the tasks' chunks one after the other; holds only its own chunks."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for chunk, once, twice in zip(*(batch.column(c).to_pylist() for c in ("chunk", "once", "twice")), strict=True):
            a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (once, twice))
            if chunk in held:
                a0, b0 = held[chunk]
                b0 |= b
                b0 |= a0 & a
                a0 |= a
            else:
                held[chunk] = a.copy(), b.copy()
    for chunk, (_, b) in held.items():
        if b.any():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()),
                                              "twice": pa.array([zlib.compress(b.tobytes(), 1)], pa.binary())})


def twice_seen(texts: DataFrame, bits: int, min_chars: int) -> bytes:
    """The merged twice-seen filter (``bits`` / 8 bytes)."""
    size = min(CHUNK, bits >> 3)
    chunks = (texts.mapInArrow(_seen(bits, min_chars), "chunk int, once binary, twice binary")
              .repartition((bits >> 3) // size, "chunk")
              .mapInArrow(_merge, "chunk int, twice binary"))
    out = np.zeros(bits >> 3, np.uint8)
    for r in chunks.collect():                # bounded: the filter itself
        out[r["chunk"] * size:][:size] = np.frombuffer(zlib.decompress(bytes(r["twice"])), np.uint8)
    return out.tobytes()


def _suspects(sent, bits: int, min_chars: int):
    """Lines whose key is in the filter: each key once per row, at its first line."""
    def run(batches):
        bloom = Bloom(bits, sent.value)
        for b in pieces(batches):
            row, line, key = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                seen = set()
                for n, k in enumerate(keys_of(text)):
                    if k not in seen and long_enough(k, min_chars):
                        seen.add(k)
                        row.append(i)
                        line.append(n)
                        key.append(k)
            keep = np.flatnonzero(bloom.has(hashes(key)))
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([key[j] for j in keep], pa.binary()),
                "doc_id": b.column("doc_id").take(pa.array(np.asarray(row, np.int64)[keep])),
                "line": pa.array(np.asarray(line, np.int32)[keep], pa.int32())})
    return run


def repeated_keys(texts: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(key, docs, doc_id, line): each key in at least ``min_docs`` documents,
    with its first occurrence."""
    spark = ready(texts.sparkSession)
    bits = filter_bits(texts.count())
    sent = spark.sparkContext.broadcast(twice_seen(texts, bits, min_chars))
    lines = texts.mapInArrow(_suspects(sent, bits, min_chars), "key binary, doc_id long, line int")
    return (lines.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "line")).alias("first"))
            .filter(F.col("docs") >= max(2, min_docs))
            .select("key", "docs", "first.doc_id", "first.line"))


def kept_lines(repeated: dict, doc: int | None, text: str | None, keep_first: bool) -> tuple[str, int, int]:
    """A text without its repeated lines; its lines, before and dropped."""
    lines = (text or "").encode().split(b"\n")
    stay = []
    for n, line in enumerate(lines):
        first = repeated.get(line.strip(SPACE).lower())
        if first is None or keep_first and first == (doc, n):
            stay.append(line)
    return b"\n".join(stay).decode(), len(lines), len(lines) - len(stay)


def _rewrite(sent, keep_first: bool):
    def run(batches):
        for b in pieces(batches):
            rows = [kept_lines(sent.value, doc, text, keep_first) for doc, text in
                    zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)]
            kept, total, dropped = zip(*rows, strict=True)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": pa.array(kept, pa.string()),
                                              "n_lines": pa.array(total, pa.int64()),
                                              "n_dropped": pa.array(dropped, pa.int64())})
    return run


def _all_lines(batches):
    for b in pieces(batches):
        doc, mark, line, key = [], [], [], []
        for d, m, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "mark", "text")), strict=True):
            for n, k in enumerate(keys_of(text)):
                doc.append(d)
                mark.append(m)
                line.append(n)
                key.append(k)
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc, pa.int64()), "mark": pa.array(mark, pa.int64()),
                                          "line": pa.array(line, pa.int32()), "key": pa.array(key, pa.binary())})


def _joined(texts: DataFrame, repeated: DataFrame, keep_first: bool) -> DataFrame:
    """Step 3 by joins, for repeated keys of any size. A column ``rest`` stays."""
    marked = texts.withColumn("mark", F.xxhash64("text"))
    rest = ["rest"] if "rest" in texts.columns else []
    lines = (marked.select("doc_id", "text", "mark").mapInArrow(_all_lines, "doc_id long, mark long, line int, key binary")
             .withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark", "line"), F.lit(SALT)).cast("int")))
    gone = (repeated.select("key", F.col("doc_id").alias("_doc"), F.col("line").alias("_line"),
                            F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))
    hits = lines.join(gone, ["key", "salt"])
    if keep_first:
        hits = hits.filter(~(F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("line") == F.col("_line"))))
    drop = (hits.groupBy(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"))
            .agg(F.collect_set("line").alias("gone")))
    docs = marked.join(drop, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")), "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    stay = F.when(F.col("gone").isNull(), lines).otherwise(
        F.filter(lines, lambda _, i: ~F.array_contains("gone", i)))
    return docs.select(*rest, "doc_id", F.array_join(stay, "\n").alias("text"), F.size(lines).cast("long").alias("n_lines"),
                       (F.size(lines) - F.size(stay)).cast("long").alias("n_dropped"))


def _repeated(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int, keys_bytes: int):
    """Texts, repeated keys, and these as a broadcast if they fit."""
    spark = ready(docs.sparkSession)
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    repeated = stage(repeated_keys(texts, min_docs, min_chars), "repeated-lines")
    size = repeated.agg(F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0)).alias("n")).collect()[0]["n"]
    if size > keys_bytes:
        return texts, repeated, None
    return texts, repeated, spark.sparkContext.broadcast(
        {bytes(r["key"]): (r["doc_id"], r["line"]) for r in repeated.collect()})


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
               min_chars: int = 1, keep_first: bool = False, keys_bytes: int = KEYS_BYTES) -> DataFrame:
    """Documents without their repeated lines: doc_id, text, n_lines, n_dropped
    (see the module's docstring). One row for each input row."""
    texts, repeated, sent = _repeated(docs, id_col, text_col, min_docs, min_chars, keys_bytes)
    if sent is None:
        return _joined(texts, repeated, keep_first)
    return texts.mapInArrow(_rewrite(sent, keep_first), "doc_id long, text string, n_lines long, n_dropped long")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                    min_chars: int = 1, keep_first: bool = True, keys_bytes: int = KEYS_BYTES) -> DataFrame:
    """``docs``, all rows and columns, with the repeated lines gone from the texts."""
    _, repeated, sent = _repeated(docs, id_col, text_col, min_docs, min_chars, keys_bytes)
    if sent is None:
        whole = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"))
        out = _joined(whole, repeated, keep_first)
        return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])

    def change(ids, texts):
        return None, {text_col: pa.array([kept_lines(sent.value, doc, text, keep_first)[0] for doc, text in zip(
            ids.to_pylist(), texts.to_pylist(), strict=True)], pa.string())}

    return row_local(docs, id_col, text_col, change)
