"""Helpers shared by the training-data operators.

Every operator picks the columns it needs by name and gives them its own
names first (``pick``), so extra columns of the input, whatever they are
called, can neither clash with an operator's columns nor reach the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..plans.stages import WIDE_ROWS, materialize
from ..session import ship_package

#: Text bytes handled by one vectorized step inside a task; bounds its memory.
PIECE_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers."""
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str | Column) -> DataFrame:
    """``df`` reduced to the given columns under the operator's own names."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def stage(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Written once to the shared folder and read back: later steps neither
    replay the plan nor depend on the executors that computed it. ``wide``: for
    rows of megabytes, of which a task then holds a few at once."""
    return materialize(df, name, WIDE_ROWS if wide else None)


def buffers(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """UTF-8 bytes of a string array (null: empty) and its n + 1 offsets."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return b"", np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    body = b"" if data is None else data[int(at[0]):int(at[-1])].to_pybytes()
    return body, at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``limit`` text bytes at most
    (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.nan_to_num(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
                              .astype(np.float64)).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield batch.slice(lo, hi - lo)
            release()


def coded(data: bytes, starts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The byte ranges that begin at ``starts`` (each ends where the next
    begins) as codes into the array of distinct ranges."""
    ends = np.append(starts, len(data)).astype(np.int32)
    ranges = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    found = ranges.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def row_local(docs: DataFrame, id_col: str, text_col: str, change) -> DataFrame:
    """``docs`` with the same columns, changed row by row: ``change(ids, texts)``
    gives the rows to keep (a mask, or None for all) and new columns by name.
    All columns travel under names of their own, whatever they are called."""
    names = docs.columns
    own = docs.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)])
    at, text = names.index(id_col), names.index(text_col)

    def run(batches):
        for b in pieces(batches, f"c{text}", PIECE_BYTES // 2):
            keep, new = change(b.column(at), b.column(text))
            columns = [new.get(n, b.column(i)) for i, n in enumerate(names)]
            out = pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                [pa.field(f"c{i}", c.type) for i, c in enumerate(columns)]))
            yield out if keep is None else out.filter(pa.array(keep))

    return own.mapInArrow(run, own.schema).toDF(*names)


#: Ids that are sent to every task (8 bytes each); beyond, a join.
FEW_IDS = 4_000_000


def without(docs: DataFrame, id_col: str, bad: DataFrame, few: int = FEW_IDS) -> DataFrame:
    """``docs`` but those whose id is in the one column of ``bad`` (staged)."""
    bad = bad.toDF("_bad_id")
    if bad.count() <= few:
        bad = F.broadcast(bad)
    return docs.join(bad, F.col(f"`{id_col}`").cast("long") == F.col("_bad_id"), "left_anti")


def byte_table(inside: bytes) -> bytes:
    """For ``bytes.translate``: 1 for the given bytes, else 0."""
    return bytes(1 if b in set(inside) else 0 for b in range(256))


def words(data: bytes, offsets: np.ndarray, inside: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Maximal runs of word bytes (``inside``: a ``byte_table``) in texts laid
    end to end: each text's range of words (n + 1 offsets), every word as a
    code, and the distinct words (which may include runs between words)."""
    if not data:
        return np.zeros(len(offsets), np.int64), np.zeros(0, np.int32), pa.array([], pa.binary())
    kind = np.frombuffer(data.translate(inside), np.uint8)
    edge = np.empty(len(kind), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(kind)]] = True
    starts = np.flatnonzero(edge)
    codes, distinct = coded(data, starts)
    word = kind[starts].astype(bool)
    at = np.concatenate([[0], np.cumsum(word)])
    return at[np.searchsorted(starts, offsets)], codes[word], distinct


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply, xor-shift): spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(distinct: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    import xxhash
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` consecutive hashes (length - n + 1)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out + hashes[i:i + m]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return mix(out)


def grams_pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of each ordered pair of hashes."""
    with np.errstate(over="ignore"):
        return mix(mix(left + np.uint64(0x9E3779B97F4A7C15)) ^ (right * np.uint64(0xD6E8FEB86659FD93)))


#: What an entry of a memo takes besides its bytes, about.
ENTRY_BYTES = 220


def _bytes(values: list) -> int:
    return sum(map(len, values)) if not values or isinstance(values[0], bytes) else sum(sum(map(len, v)) for v in values)


class Memo:
    """Values (bytes, or tuples of them) of keys met lately, in at most two
    generations of ``limit`` bytes (and one call's): what the older one holds and is
    asked for again stays. Keys of more than ``longest`` bytes are not kept."""

    def __init__(self, limit: int, longest: int = 64):
        self.limit, self.longest = limit, longest
        self.young, self.old, self.held = {}, {}, 0

    def __getstate__(self):
        return {"limit": self.limit, "longest": self.longest, "young": {}, "old": {}, "held": 0}

    def forget(self) -> None:
        """Drops the older generation, as at the end of a task."""
        self.old = {}

    def get(self, keys: list, make) -> list:
        """The values of distinct ``keys``; ``make`` gives those not known."""
        if self.held > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        out = list(map(self.young.get, keys))
        missing = [i for i, v in enumerate(out) if v is None]
        if not missing:
            return out
        asked = [keys[i] for i in missing]
        known = list(map(self.old.get, asked)) if self.old else [None] * len(asked)
        new = [k for k, v in zip(asked, known, strict=True) if v is None]
        made = iter(make(new))
        known = [next(made) if v is None else v for v in known]
        for i, v in zip(missing, known, strict=True):
            out[i] = v
        kept = dict(zip(asked, known, strict=True))
        if max(map(len, asked)) > self.longest:
            kept = {k: v for k, v in kept.items() if len(k) <= self.longest}
        self.young.update(kept)
        self.held += _bytes(list(kept)) + _bytes(list(kept.values())) + ENTRY_BYTES * len(kept)
        return out


def release() -> None:
    """Gives the memory that is free in this worker back to the system: workers
    live on after their task, and an executor's limit counts them all."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)           # glibc only
    if trim is not None:
        trim(0)


def first_by_hash(rows: DataFrame, group: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the smallest hashes ``h`` (ties: by ``tie``).
    Hashes are spread evenly, so a bound from the group's count leaves few more than
    ``n`` rows of it to rank, whatever its size (fewer than ``n`` once in 10**9, or if
    repeated rows, which share a hash, fall beyond the bound). The counts are
    broadcast: one row of a group, of which the caller keeps ``n`` rows."""
    counts = rows.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_n"))
    some = n + 6 * n ** 0.5 + 6
    near = rows.join(F.broadcast(counts), F.col(group) == F.col("_g")).filter(
        F.col("h").cast("double") <= F.lit(some) / F.col("_n") * 2.0 ** 64 - 2.0 ** 63)
    ranked = near.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy("h", tie)))
    return ranked.filter(F.col("_r") <= n).drop("_g", "_n", "_r")
