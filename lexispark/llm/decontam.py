"""Benchmark decontamination by winnowing (operator 5).

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
A window is ``window`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window. A document word inside any occurrence of a
window is hit.

Winnowing: of every ``window - k + 1`` consecutive k-gram hashes the smallest
is a fingerprint. Two texts that share ``window`` words pick the same
fingerprint inside them, so a document can only hold a window around one of
the benchmark's fingerprints: the documents' fingerprints are joined with the
benchmark's, and each match is extended to the windows that contain it, which
are looked up and then compared word by word. (Items shorter than a window are
looked up at every word, for each length that occurs.)

The benchmark goes to the tasks in blocks of at most ``BLOCK_WORDS`` words
(their counted size), one pass over the documents for each block; a row-local
join, so no document row moves and a hot passage costs no more than others.
With several blocks, rows get numbers of their own, and only rows that are hit meet
again, to unite their hit words. Documents are rows: repeated and null ids are
rows like any other. Null texts have no words; an empty benchmark hits
nothing; items with null ids are kept as item ``null``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import buffers, byte_table, grams, pick, pieces, ready, row_local, stage, word_hashes, words

#: Bytes of words, once A-Z is lower-cased.
WORD = byte_table(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Benchmark words in one block.
BLOCK_WORDS = 4_000_000


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Each text's range of words, the words as codes, the distinct words and
    the words' hashes."""
    data, offsets = buffers(texts)
    at, codes, distinct = words(data.translate(LOWER), offsets, WORD)
    return at, codes, distinct, word_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places of the smallest of each ``w`` consecutive hashes."""
    if len(hashes) < w:
        return np.zeros(0, np.int64)
    low = hashes[:len(hashes) - w + 1].copy()
    for i in range(1, w):
        np.minimum(low, hashes[i:i + len(low)], out=low)
    picked = np.zeros(len(hashes), bool)
    for i in range(w):
        picked[i:i + len(low)] |= hashes[i:i + len(low)] == low
    return np.flatnonzero(picked)


def inside(at: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of the first n - length + 1 places start a run of ``length`` words
    within one text."""
    ok = np.ones(max(0, n - length + 1), bool)
    for edge in at[1:-1]:
        ok[max(0, edge - length + 1):edge] = False
    return ok


class Index:
    """The windows of some benchmark items."""

    def __init__(self, ids: list[int | None], texts: list[str | None], window: int, k: int):
        self.window, self.k, self.ids = window, k, ids
        at, codes, distinct, hashes = cut(pa.array(texts, pa.string()))
        vocabulary = distinct.to_pylist()
        self.words = [vocabulary[c] for c in codes.tolist()]
        starts, sizes, items = [], [], []
        for item, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if hi > lo:
                size = min(window, hi - lo)
                own = range(lo, hi - size + 1)
                starts += own
                sizes += [size] * len(own)
                items += [item] * len(own)
        starts, sizes, items = (np.asarray(x, np.int64) for x in (starts, sizes, items))
        #: by window length: sorted distinct hashes, a start of each, its items (CSR)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in np.unique(sizes).tolist():
            own = sizes == size
            h = grams(hashes, size)[starts[own]]
            order = np.argsort(h, kind="stable")
            found, first = np.unique(h[order], return_index=True)
            self.by_length[size] = (found, starts[own][order][first], items[own][order], np.append(first, len(order)))
        prints = []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            h = grams(hashes[lo:hi], k)
            prints.append(h[winnow(h, window - k + 1)])
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array, or -1."""
    if not len(of):
        return np.full(len(values), -1)
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return np.where(of[at] == values, at, -1)


def hits(index: Index, at: np.ndarray, codes: np.ndarray, distinct: pa.Array, hashes: np.ndarray):
    """(starts, length, windows) of the occurrences of the index's windows in
    texts laid end to end, for each window length."""
    n, w = len(hashes), index.window - index.k + 1
    out = []
    for size, (found, first, _, _) in index.by_length.items():
        if size == index.window:
            h = grams(hashes, index.k)
            place = winnow(h, w)
            place = place[member(h[place], index.prints) >= 0]
            starts = np.unique((place[:, None] - np.arange(w)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts <= n - size)]
        else:
            starts = np.arange(max(0, n - size + 1))
        starts = starts[inside(at, n, size)[starts]]
        if size == index.window:
            own = np.zeros(len(starts), np.uint64)
            if len(starts):
                wide = hashes[starts[:, None] + np.arange(size)[None, :]]
                own = grams_of_rows(wide)
        else:
            own = grams(hashes, size)[starts]
        window = member(own, found)
        starts, window = starts[window >= 0], window[window >= 0]
        same = [all(distinct[int(codes[s + i])].as_py() == index.words[f + i] for i in range(size))
                for s, f in zip(starts.tolist(), first[window].tolist(), strict=True)]
        same = np.asarray(same, bool)
        out.append((starts[same], size, window[same]))
    return out


def grams_of_rows(rows: np.ndarray) -> np.ndarray:
    """``grams`` of each row of hashes, whole."""
    from .common import mix
    out = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows.shape[1]):
            out = (out + rows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return mix(out)


def spans(covered: np.ndarray) -> list[dict]:
    """Runs of true values as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


SCHEMA = "doc_id long, n_words long, hits array<struct<start:int,end:int>>, items array<string>"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                   ("hits", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                   ("items", pa.list_(pa.string()))])


def _scan(sent):
    def run(batches):
        index: Index = sent.value
        for b in pieces(batches):
            at, codes, distinct, hashes = cut(b.column("text"))
            covered = np.zeros(len(codes) + 1, np.int32)
            found: dict[int, set[int]] = {}
            for starts, size, window in hits(index, at, codes, distinct, hashes):
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + size, -1)
                _, _, items, edge = index.by_length[size]
                doc = np.searchsorted(at, starts, side="right") - 1
                for d, v in set(zip(doc.tolist(), window.tolist(), strict=True)):
                    found.setdefault(d, set()).update(items[edge[v]:edge[v + 1]].tolist())
            hit = np.cumsum(covered[:-1]) > 0
            row = {"row": b.column("row")} if "row" in b.schema.names else {}
            yield pa.RecordBatch.from_pydict(row | {
                "doc_id": b.column("doc_id"), "n_words": pa.array(np.diff(at), pa.int64()),
                "hits": pa.array([spans(hit[lo:hi]) if d in found else [] for d, (lo, hi) in
                                  enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))], ARROW.field(2).type),
                "items": pa.array([sorted({"null" if index.ids[i] is None else str(index.ids[i]) for i in found[d]})
                                   if d in found else [] for d in range(len(at) - 1)], ARROW.field(3).type)},
                schema=ARROW if not row else pa.schema([("row", pa.int64()), *ARROW]))
    return run


def _indexes(spark, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, k: int, block_words: int):
    """The number of blocks of the benchmark, and their indexes, sent one by one."""
    if not 1 <= k <= window:
        raise ValueError("k must be between 1 and the window")
    items = pick(benchmark, item_id=item_col, text=F.col(f"`{item_text_col}`").cast("string"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).collect()[0]["n"]
    blocks = 1 + int(size) // (2 * block_words)          # a word has two bytes at least, with what follows it

    def sent():
        for block in range(blocks):
            part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
            yield spark.sparkContext.broadcast(Index([r["item_id"] for r in part], [r["text"] for r in part], window, k))

    return blocks, sent()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10, k: int = 6,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document: doc_id, n_words, hits (word spans, end
    excluded), n_hit, items (ids with occurring windows, sorted as strings)."""
    spark = ready(docs.sparkSession)
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    blocks, indexes = _indexes(spark, benchmark, item_col, item_text_col, window, k, block_words)
    if blocks > 1:
        texts = stage(texts.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    schema = f"row long, {SCHEMA}" if blocks > 1 else SCHEMA
    scans = [texts.mapInArrow(_scan(index), schema) for index in indexes]
    out = scans[0]
    if blocks > 1:
        for s in scans[1:]:
            out = out.unionByName(s.filter(F.size("items") > 0))
        # spans that overlap are counted word by word, in documents that are hit
        out = (out.groupBy("row").agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
        joined = F.aggregate("hits", F.expr("cast(array() as array<struct<start:int,end:int>>)"), lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
            .otherwise(F.concat(acc, F.array(x))))
        out = out.withColumn("hits", F.when(F.size("hits") > 0, joined).otherwise(F.col("hits")))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_words", "hits", n_hit.alias("n_hit"), "items")


def _clean(sent):
    def keep(ids, texts):
        at, codes, distinct, hashes = cut(texts)
        clean = np.ones(len(at) - 1, bool)
        for starts, _, _ in hits(sent.value, at, codes, distinct, hashes):
            clean[np.searchsorted(at, starts, side="right") - 1] = False
        return clean, {}
    return keep


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10, k: int = 6,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows without a hit, all columns kept. Each is judged by its own text,
    whatever its id; a benchmark of several blocks takes a pass for each, over
    what the one before has kept."""
    blocks, indexes = _indexes(ready(docs.sparkSession), benchmark, item_col, item_text_col, window, k, block_words)
    for n, index in enumerate(indexes, 1):
        docs = row_local(docs, id_col, text_col, _clean(index))
        if n < blocks:
            docs = stage(docs, "decontaminated")
    return docs
