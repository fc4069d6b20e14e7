"""MinHash near-duplicates: consistent weighted sampling of TF-IDF shingles
(operator 6).

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A
shingle is five consecutive words (a shorter text, but not an empty one, is one
shingle). Its weight in a text is how often it occurs there times the mean
inverse document frequency of its words, 1 + ln((1 + n) / (1 + df)) / ln(1 + n):
from 1 for words of all documents to 2, from counts over all documents. By words
and not by shingles, a large group of copies cannot make its own shingles
worthless. Documents are linked if the weighted Jaccard similarity, the sum of
the smaller weights by that of the larger, is at least ``threshold``; texts of
equal words are linked too, those without words among them. A class is what
links join, and its id the least doc id.

1. Tasks write their texts as blocks of numbered words, once; the document
   frequency of each block's words comes back from an exchange of packed hashes
   (each word once from each block, so a hot word is no hot key).
2. Improved consistent weighted sampling gives each text ``BANDS`` x ``ROWS``
   samples; two texts agree on one with the probability of their similarity.
   Texts of equal words go on as one. Texts that agree on a band meet.
3. In each meeting, all members are compared with one of them, the leader:
   pairs grow with the members, not their square. The exact weighted Jaccard is
   computed from the texts' shingles; a leader's comparisons are spread over
   tasks of ``SPREAD`` members. Members that are not like the leader meet again,
   with the other members but without it, in meetings split by the samples of
   one, two, four and four more bands (all then) and with ``LEADERS`` leaders,
   until none is left. After each turn the links found so far give classes; only
   pairs of one class are skipped, and meetings of one class end.
4. What the turns leave open, the first meetings with members of several classes,
   goes an exact way: texts that share a shingle of their prefixes (their rarest
   shingles among these texts, as many as a link needs one of) are compared
   unless their class is the same. Linked pairs that met are all found.
5. Classes by least labels with pointer jumping, over linked texts only: on the
   driver for up to ``FEW_LINKS`` links (counted first), else by joins, every
   round of which is written to the shared folder.

Output, one row for each input row: doc_id, class_id, n_links (verified links of
the text with other texts). Rows with a null id get a null class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import buffers, grams, mix, pick, pieces, ready, release, stage, without, word_hashes, words
from .decontam import LOWER, WORD, grams_of_rows
from .lm import _rows, _small, _wide
from .spread import hot_join, numbered

SHINGLE = 5
BANDS, ROWS = 12, 3
SAMPLES = BANDS * ROWS
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 1 << 18
#: Text bytes that a task cuts into words at once, and words whose shingles it holds at once
#: (one text at least): bounds of a worker's memory.
CUT_BYTES, STEP_WORDS = 2 << 20, 1 << 17
BUCKET_ENTRIES = 400_000
#: Members that one task compares with a leader before the next task shares in.
SPREAD = 256
#: Leaders of a meeting after the first turn.
LEADERS = 4
#: Shingles whose counts among the open texts are sent to every task; others count as rare.
HEAVY = 1_000_000
#: Bits of the filter of shingles that two open texts hold; beyond its size more others pass.
SHARED_BITS = 1 << 28
#: Width of a class of total weights (natural logarithm).
STEP = 0.05
#: Links (16 bytes each) whose classes the driver finds; beyond, rounds of joins.
FEW_LINKS = 1_000_000
TABLE = 1 << 16


# ------------------------------------------------------------ 1 blocks

BLOCKS = "block string, ids binary, nulls binary, keys binary, ends binary, vocab binary, df binary, tokens binary"


def _blocks(batches):
    import xxhash
    from pyspark import TaskContext
    task, made, held, size, docs = TaskContext.get().partitionId(), 0, [], 0, 0

    def close():
        nonlocal made, held, size, docs
        vocab, back = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True)
        offsets = np.cumsum([0] + [len(h[3]) for h in held])
        tokens = [back[at:to].astype("<u4")[h[4]].tobytes() for h, at, to in zip(held, offsets[:-1], offsets[1:], strict=True)]
        lengths = np.concatenate([h[2] for h in held])
        df = np.bincount(back, np.concatenate([h[6] for h in held]), len(vocab))
        made += 1
        out = pa.RecordBatch.from_pydict({
            "block": pa.array([f"{task}-{made}"]), "ids": pa.array([np.concatenate([h[0] for h in held]).astype("<i8").tobytes()]),
            "nulls": pa.array([np.concatenate([h[5] for h in held]).astype("u1").tobytes()]),
            "keys": pa.array([b"".join(k for h in held for k in h[1])]),
            "ends": pa.array([np.cumsum(lengths).astype("<i8").tobytes()]), "vocab": pa.array([vocab.astype("<u8").tobytes()]),
            "df": pa.array([df.astype("<u4").tobytes()]), "tokens": pa.array([b"".join(tokens)])})
        held, size, docs = [], 0, 0
        return out

    for b in pieces(batches, limit=CUT_BYTES):
        data, offsets = buffers(b.column("text"))
        at, codes, distinct = words(data.translate(LOWER), offsets, WORD)
        hashes = word_hashes(distinct)
        sequence = hashes[codes]
        keys = [xxhash.xxh3_128_digest(sequence[lo:hi].tobytes()) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        used, own = np.unique(codes, return_inverse=True)
        # documents that hold each word
        met = np.unique(np.repeat(np.arange(len(keys), dtype=np.uint64), np.diff(at)) << np.uint64(32) | own.astype(np.uint64))
        df = np.bincount((met & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(used))
        doc = b.column("doc_id")
        held.append((doc.fill_null(0).to_numpy(), keys, np.diff(at), hashes[used], own.astype("<u4"), np.asarray(doc.is_null()), df))
        size, docs = size + len(data), docs + b.num_rows
        if size >= BLOCK_BYTES or docs >= BLOCK_DOCS:
            yield close()
    if held:
        yield close()
    release()


def _cut(hashes: np.ndarray, buckets: int):
    """Order of hashes by bucket, and where each begins."""
    bucket = (hashes >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _ask(buckets: int):
    def run(batches):
        for row in _rows(batches):
            vocab, df = np.frombuffer(row["vocab"], "<u8"), np.frombuffer(row["df"], "<u4")
            order, cuts = _cut(vocab, buckets)
            full = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
            own = [order[cuts[k]:cuts[k + 1]] for k in full]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([row["block"]] * len(full)), "bucket": pa.array(full, pa.int32()),
                "hashes": pa.array([vocab[o].tobytes() for o in own], pa.binary()),
                "df": pa.array([df[o].tobytes() for o in own], pa.binary())})
    return run


def _add(key, rows):
    hashes = [np.frombuffer(x, "<u8") for x in rows.column("hashes").to_pylist()]
    found, where = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in rows.column("df").to_pylist()])
    total = np.bincount(where, counts, len(found)).astype(np.int64)
    edge = np.cumsum([0] + [len(h) for h in hashes])
    return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"),
                     "total": pa.array([_small(total[where[a:b]]) for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())})


# ------------------------------------------------------------ shingles

def word_idf(row: dict, answers: list[dict], buckets: int, n_docs: int) -> np.ndarray:
    """The inverse document frequency of each word of a block."""
    vocab = np.frombuffer(row["vocab"], "<u8")
    df = np.zeros(len(vocab), np.int64)
    order, cuts = _cut(vocab, buckets)
    for a in answers:
        df[order[cuts[a["bucket"]]:cuts[a["bucket"] + 1]]] = _wide(a["total"])
    return (1 + np.log((1 + n_docs) / (1 + df)) / np.log(1 + n_docs)).astype(np.float32)


def steps(row: dict, places: np.ndarray) -> list[np.ndarray]:
    """``places`` of a block's documents, in parts of about ``STEP_WORDS`` words."""
    lengths = np.diff(np.frombuffer(row["ends"], "<i8"), prepend=0)[places]
    part = (np.cumsum(lengths) - lengths) // STEP_WORDS
    return np.split(places, np.flatnonzero(np.diff(part)) + 1) if len(places) else []


def shingles(row: dict, idf: np.ndarray, only: np.ndarray):
    """Sorted codes (number << 40 | shingle << 8 | idf) of the distinct shingles
    of a block's documents at the places ``only``, numbered in this order, and
    how often each occurs."""
    vocab, tokens = np.frombuffer(row["vocab"], "<u8"), np.frombuffer(row["tokens"], "<u4")
    ends = np.frombuffer(row["ends"], "<i8")
    starts = np.concatenate([[0], ends[:-1]])
    tokens = np.concatenate([tokens[starts[p]:ends[p]] for p in only] or [tokens[:0]])
    lengths, n = (ends - starts)[only], len(tokens)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    hashes, weight = vocab[tokens], idf[tokens]
    doc = np.repeat(np.arange(len(ends), dtype=np.uint64), lengths)
    m = max(0, n - SHINGLE + 1)
    inside = doc[:m] == doc[SHINGLE - 1:] if m else np.zeros(0, bool)
    g = grams(hashes, SHINGLE)[inside]
    sums = np.cumsum(np.concatenate([[0], weight.astype(np.float64)]))
    w = ((sums[SHINGLE:] - sums[:-SHINGLE])[inside] / SHINGLE) if m else np.zeros(0)
    d = doc[:m][inside]
    short = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
    if len(short):
        g = np.concatenate([g, [grams_of_rows(hashes[None, starts[p]:ends[p]])[0] for p in short]]).astype(np.uint64)
        w = np.concatenate([w, [weight[starts[p]:ends[p]].mean() for p in short]])
        d = np.concatenate([d, short.astype(np.uint64)])
    level = np.clip(np.rint((w - 1) * 255), 0, 255).astype(np.uint64)
    code = d << np.uint64(40) | (g >> np.uint64(32)) << np.uint64(8) | level
    code.sort()
    edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[edge], np.diff(np.append(edge, len(code)))


def idf_of(code: np.ndarray) -> np.ndarray:
    return 1 + (code & np.uint64(255)).astype(np.float32) / np.float32(255)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles: r and ln c of the sampling are Gamma(2, 1), by the sum of two
    exponential variables; each entry is one draw, fixed for good."""
    k = np.arange(2 * TABLE, dtype=np.uint64)
    u = ((mix(k * np.uint64(4) + np.uint64(1)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
    v = ((mix(k * np.uint64(4) + np.uint64(2)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
    gamma = -np.log(u * v)
    return gamma[:TABLE].astype(np.float32), np.log(gamma[TABLE:]).astype(np.float32), (1 / gamma[:TABLE]).astype(np.float32)


def samples(code: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """ICWS: for each of ``n`` documents SAMPLES values, each that of the chosen
    (shingle, level): equal for two texts with the probability of their weighted
    Jaccard similarity. Documents without shingles keep +inf."""
    radius, log_c, inverse = _tables()
    out = np.full((n, SAMPLES), np.inf, np.float32)
    doc = (code >> np.uint64(40)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    cut = [0]
    for s in starts.tolist():                            # about 64k shingles at once, whole documents
        if s - cut[-1] >= 1 << 16:
            cut.append(s)
    if len(code):
        cut.append(len(code))
    low = np.uint64(TABLE - 1)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        own = starts[(starts >= a) & (starts < b)]
        key = mix(code[a:b] & np.uint64((1 << 40) - 1))
        log_w = np.log(count[a:b] * idf_of(code[a:b])).astype(np.float32)
        for k in range(SAMPLES):
            h = mix(key + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            pick_r = (h & low).astype(np.int32)
            r, c = radius[pick_r], log_c[((h >> np.uint64(16)) & low).astype(np.int32)]
            beta = ((h >> np.uint64(32)) & low).astype(np.float32) / np.float32(TABLE)
            t = np.floor(log_w * inverse[pick_r] + beta)
            out[doc[own], k] = np.minimum.reduceat(c - r * (t - beta + 1), own - a)
    return out


def similarity(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> float:
    """Weighted Jaccard of two texts: sorted shingle codes and counts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    wa, wb = float((na * idf_of(a)).sum()), float((nb * idf_of(b)).sum())
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = b[at] == a
    shared = float((np.minimum(na[both], nb[at[both]]) * idf_of(a[both])).sum())
    return shared / (wa + wb - shared)


def pack(code: np.ndarray, count: np.ndarray) -> bytes:
    """Shingle codes of one text, 5 bytes each, and counts."""
    code = code & np.uint64((1 << 40) - 1)
    n = np.minimum(count, 255).astype("u1") if count.max(initial=0) < 256 else count.astype("<u4")
    return (len(code).to_bytes(4, "little") + (code >> np.uint64(8)).astype("<u4").tobytes()
            + (code & np.uint64(255)).astype("u1").tobytes() + n.tobytes())


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    code = np.frombuffer(data, "<u4", n, 4).astype(np.uint64) << np.uint64(8) | np.frombuffer(data, "u1", n, 4 + 4 * n)
    return code, np.frombuffer(data, "u1" if len(data) == 4 + 6 * n else "<u4", n, 4 + 5 * n).astype(np.int64)


# ------------------------------------------------------------ 2 signatures

def _sign(buckets: int, n_docs: int):
    def run(_, block, answers):
        out, nulls = {"block": [], "place": [], "doc_id": [], "key": [], "sample": []}, np.zeros(0, bool)
        if block.num_rows:
            row = block.slice(0, 1).to_pylist()[0]
            ids, nulls = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nulls"], bool)
            idf = word_idf(row, answers.to_pylist(), buckets, n_docs)
            sample = [s for only in steps(row, np.arange(len(ids))) for s in samples(*shingles(row, idf, only), len(only))]
            release()
            out = {"block": [row["block"]] * len(ids), "place": np.arange(len(ids)), "doc_id": ids,
                   "key": [row["keys"][16 * i:16 * i + 16] for i in range(len(ids))],
                   "sample": [s.tobytes() if np.isfinite(s[0]) else None for s in sample]}
        return pa.table({"block": pa.array(out["block"], pa.string()), "place": pa.array(out["place"], pa.int32()),
                         "doc_id": pa.array(np.asarray(out["doc_id"], np.int64), pa.int64(), mask=nulls), "key": pa.array(out["key"], pa.binary()),
                         "sample": pa.array(out["sample"], pa.binary())})
    return run


def _vectors(buckets: int, n_docs: int):
    """Packed shingles of the wanted places (rows with a place) of a block."""
    def run(_, block, others):
        ids, vecs = [], []
        rows = others.to_pylist() if block.num_rows else []
        wanted = {r["place"]: r["id"] for r in rows if r["place"] is not None}
        if wanted:
            row = block.slice(0, 1).to_pylist()[0]
            idf = word_idf(row, [r for r in rows if r["place"] is None], buckets, n_docs)
            for only in steps(row, np.array(sorted(wanted), np.int64)):
                code, count = shingles(row, idf, only)
                edge = np.searchsorted(code >> np.uint64(40), np.arange(len(only) + 1))
                ids += [wanted[p] for p in only.tolist()]
                vecs += [pack(code[a:b], count[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            release()
        return pa.table({"id": pa.array(ids, pa.int64()), "vec": pa.array(vecs, pa.binary())})
    return run


# ------------------------------------------------------------ 3 comparisons

def _compare(threshold: float):
    """Rows sorted by leader, spread and member; the leader's own row first."""
    def run(batches):
        leader, mine = None, None
        for b in pieces(batches, "vec"):
            a, m, ok = [], [], []
            for lead, spread, member, vec in zip(*(b.column(c).to_pylist() for c in ("leader", "spread", "member", "vec")),
                                                 strict=True):
                if member is None:
                    leader, mine = (lead, spread), unpack(vec)
                elif leader == (lead, spread):
                    a.append(lead)
                    m.append(member)
                    ok.append(similarity(*mine, *unpack(vec)) >= threshold)
                else:
                    raise ValueError("a leader's row is missing")
            yield pa.RecordBatch.from_pydict({"leader": pa.array(a, pa.int64()), "member": pa.array(m, pa.int64()),
                                              "linked": pa.array(ok, pa.bool_())})
    return run


def compare(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """(leader, member, linked) of (leader, member, spreads): a member's vector
    goes to one of its leader's ``spreads`` tasks, the leader's to all of them."""
    members = pairs.select("leader", F.pmod(F.xxhash64("member"), F.col("spreads")).alias("spread"), "member",
                           F.col("member").alias("id"))
    leaders = (pairs.groupBy("leader").agg(F.max("spreads").alias("n"))
               .select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("spread"),
                       F.lit(None).cast("long").alias("member"), F.col("leader").alias("id")))
    rows = members.unionByName(leaders).join(vectors, "id").select("leader", "spread", "member", "vec")
    return (rows.repartition("leader", "spread").sortWithinPartitions("leader", "spread", F.col("member").asc_nulls_first())
            .mapInArrow(_compare(threshold), "leader long, member long, linked boolean"))


def links(texts: DataFrame, vectors_of, threshold: float) -> DataFrame:
    """(a, b): verified links among texts (id, sample)."""
    band = F.explode(F.array(*[F.struct(F.lit(k).alias("band"), F.xxhash64(F.lit(k), F.expr(
        f"substring(sample, {4 * ROWS * k + 1}, {4 * ROWS})")).alias("meeting")) for k in range(BANDS)]))
    rows = texts.filter(F.col("sample").isNotNull()).select("id", "sample", band.alias("b")).select(
        "id", "b.band", "b.meeting", F.col("id").alias("label"))
    rows = stage(_led(rows, 0), "meetings")
    met = rows.select("id", "meeting")
    vectors = vectors_of(rows.select("id").distinct())
    found, turn = None, 0
    while True:
        led = rows.select("id", "label", "size", F.explode("leaders").alias("l"))
        pairs = (led.filter((F.col("id") != F.col("l.leader")) & (F.col("label") != F.col("l.label")))
                 .groupBy(F.col("l.leader").alias("leader"), F.col("id").alias("member"))
                 .agg((1 + F.floor(F.max("size") / SPREAD)).cast("long").alias("spreads")))
        found = _joined(found, compare(pairs, vectors, threshold))
        labels = classes(found)
        more = 1 << turn                                 # bands that split the next turn's meetings
        turn += 1
        if more >= BANDS:
            break
        # who is left, under the classes found so far
        left = _labelled(rows.filter(~F.exists("leaders", lambda x: x["leader"] == F.col("id"))).select("id", "band", "meeting"), labels)
        # split by the samples of the bands after its own and those that have split it already
        at = (F.col("open.band") + more) * (4 * ROWS) + 1
        each = (left.join(_open(left), "meeting", "left_semi").groupBy("id")      # at most BANDS meetings of a text
                .agg(F.min("label").alias("label"), F.collect_list(F.struct("band", "meeting")).alias("open")))
        again = (each.join(texts.select("id", "sample"), "id").select("id", "label", "sample", F.explode("open").alias("open"))
                 .select("id", "open.band", F.xxhash64("open.meeting", F.substring(
                     F.concat("sample", "sample"), at, F.lit(4 * ROWS * min(more, BANDS - more)))).alias("meeting"), "label"))
        rows = stage(_led(again, turn), "meetings")
        if not rows.limit(1).count():
            break
    met = _labelled(met, labels)
    rest = stage(met.join(_open(met), "meeting", "left_semi").select("id", "label").distinct(), "open")
    if not rest.limit(1).count():
        return found
    pairs = _close(rest.join(vectors, "id"), threshold)
    sizes = pairs.groupBy("leader").agg((1 + F.floor(F.count(F.lit(1)) / SPREAD)).cast("long").alias("spreads"))
    return _joined(found, compare(pairs.join(sizes, "leader"), vectors, threshold))


def _joined(found: DataFrame | None, compared: DataFrame) -> DataFrame:
    """Links found so far and those of a comparison, each once."""
    new = compared.filter("linked").select(F.least("leader", "member").alias("a"), F.greatest("leader", "member").alias("b"))
    return stage((new if found is None else found.unionByName(new)).distinct(), "found")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the class of each id: its own id, if it has no link."""
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _open(rows: DataFrame) -> DataFrame:
    """Meetings whose members are of several classes."""
    return rows.groupBy("meeting").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l < h").select("meeting")


def _led(rows: DataFrame, turn: int) -> DataFrame:
    """Members of meetings that have anything to compare, with the meeting's
    size and leaders: the least hashes of each of LEADERS shares of its members
    (of all of them in the first turn), others each turn."""
    h = F.xxhash64(F.lit(turn), "id")
    lead = F.struct(h.alias("h"), F.col("id").alias("leader"), "label")
    shares = [lead] if not turn else [F.when(F.pmod(h, F.lit(LEADERS)) == k, lead) for k in range(LEADERS)]
    meetings = (rows.groupBy("meeting").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"),
                                            *[F.min(s).alias(f"l{k}") for k, s in enumerate(shares)])
                .filter("low < high")
                .select("meeting", "size", F.filter(F.array(*[f"l{k}" for k in range(len(shares))]), lambda x: x.isNotNull()).alias("leaders")))
    return rows.join(meetings, "meeting")


# ------------------------------------------------------------ 4 what is left open

class Held:
    """Which shingles two texts or more hold, in a filter of ``buckets`` slices: no
    such shingle is missing, and few others pass."""

    PROBES = 4

    def __init__(self, buckets: int, bits: int, data: np.ndarray | None = None):
        self.buckets, self.bits = buckets, bits
        self.data = np.zeros((buckets, bits >> 3), np.uint8) if data is None else data

    @classmethod
    def sized(cls, buckets: int, bits: int) -> "Held":
        """Slices of a power of two, all of them at most ``bits``."""
        return cls(buckets, 1 << max(6, int(np.log2(max(64, bits // buckets)))))

    def places(self, code: np.ndarray):
        a, b = mix(code ^ np.uint64(0x9E3779B97F4A7C15)), mix(code ^ np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
        with np.errstate(over="ignore"):
            for i in range(self.PROBES):
                p = (a + np.uint64(i) * b) & np.uint64(self.bits - 1)
                yield (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)

    def slice_of(self, code: np.ndarray) -> bytes:
        """The slice of a bucket that holds these shingles."""
        out = np.zeros(self.bits >> 3, np.uint8)
        for at, bit in self.places(code):
            np.bitwise_or.at(out, at, bit)
        return out.tobytes()

    def has(self, code: np.ndarray) -> np.ndarray:
        bucket = (mix(code) % np.uint64(self.buckets)).astype(np.int64)
        out = np.ones(len(code), bool)
        for at, bit in self.places(code):
            out &= (self.data[bucket, at] & bit) != 0
        return out


def _tally(buckets: int):
    """Shingle codes of texts and how many of a piece's texts hold them, by bucket."""
    def run(batches):
        for b in pieces(batches, "vec"):
            codes, n = np.unique(np.concatenate([unpack(v)[0] for v in b.column("vec").to_pylist()]), return_counts=True)
            bucket = (mix(codes) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = [order[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True) if y > x]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([bucket[o[0]] for o in full], pa.int32()),
                "codes": pa.array([codes[o].astype("<u8").tobytes() for o in full], pa.binary()),
                "n": pa.array([n[o].astype("<u4").tobytes() for o in full], pa.binary())})
    return run


def _heaviest(most: int, shared: Held):
    """The ``most`` shingles of a bucket that most texts hold, of those that two
    hold, and the slice of all that two hold."""
    def run(key, rows):
        codes, where = np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in rows.column("codes").to_pylist()]), return_inverse=True)
        n = np.bincount(where, np.concatenate([np.frombuffer(x, "<u4") for x in rows.column("n").to_pylist()]), len(codes)).astype(np.int64)
        own = np.flatnonzero(n > 1)
        top = own[np.argsort(-n[own], kind="stable")[:most]]
        return pa.table({"codes": pa.array([codes[top].astype("<u8").tobytes()]), "n": pa.array([n[top].astype("<i8").tobytes()]),
                         "bucket": pa.array([key[0].as_py()], pa.int32()),
                         "shared": pa.array([shared.slice_of(codes[own])], pa.binary())})
    return run


PREFIX = "shingle long, step int, probe boolean, id long, label long, weight double, rest double"
#: Sums of weights are compared with this much room for rounding.
ROOM = 1e-5


def prefix(code: np.ndarray, count: np.ndarray, heavy: np.ndarray, held: np.ndarray, shared: Held, threshold: float):
    """A text's total weight, and of the shingles by which it can be found, the
    rarest first: the codes, and the weight from each on. A pair is linked only
    if the smaller texts' weights shared are t / (1 + t) of both totals; their
    first common shingle has all of that from its place on in both texts."""
    w = count * idf_of(code).astype(np.float64)
    n = 1 + shared.has(code).astype(np.int64)            # the same for every text that holds it
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, code), len(heavy) - 1)
        n = np.where(heavy[at] == code, held[at], n)
    order = np.lexsort((code, n))
    total = float(w.sum())
    rest = total - np.concatenate([[0.0], np.cumsum(w[order])[:-1]])
    keep = (rest >= threshold * total * (1 - ROOM)) & (n[order] > 1)      # one text's own shingles find no other
    return total, code[order][keep], rest[keep]


def _prefixes(sent, threshold: float):
    """Each text among those of its class of weights, by the shingles by which a
    heavier text can find it, and (``probe``) in the classes of weights where
    it can find lighter ones."""
    share = threshold / (1 + threshold)

    def run(batches):
        heavy, held, shared = sent.value
        for b in pieces(batches, "vec"):
            out = {c: [] for c in ("shingle", "step", "probe", "id", "label", "weight", "rest")}

            def add(codes, steps, probe, rest, text, label, total, out=out):
                out["shingle"].append(codes.astype(np.int64))
                out["step"].append(np.broadcast_to(steps, len(codes)))
                out["rest"].append(rest)
                for c, v in (("probe", probe), ("id", text), ("label", label), ("weight", total)):
                    out[c].append(np.full(len(codes), v))

            for text, label, vec in zip(*(b.column(c).to_pylist() for c in ("id", "label", "vec")), strict=True):
                total, codes, rest = prefix(*unpack(vec), heavy, held, shared, threshold)
                if not len(codes):
                    continue
                found = rest >= 2 * share * total * (1 - ROOM)
                add(codes[found], int(np.floor(np.log(total) / STEP)), False, rest[found], text, label, total)
                low = int(np.floor(np.log(threshold * total * (1 - ROOM)) / STEP))
                top = np.minimum(total, rest * (1 + ROOM) / share - total)       # the heaviest that still fits
                high = np.floor(np.log(np.maximum(top, 1e-9)) / STEP).astype(np.int64)
                n = np.maximum(high - low + 1, 0)
                steps = low + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                add(np.repeat(codes, n), steps, True, np.repeat(rest, n), text, label, total)
            if out["id"]:
                joined = {c: np.concatenate(v) for c, v in out.items()}
                yield pa.RecordBatch.from_pydict({
                    "shingle": pa.array(joined["shingle"], pa.int64()), "step": pa.array(joined["step"].astype(np.int32)),
                    "probe": pa.array(joined["probe"].astype(bool)), "id": pa.array(joined["id"], pa.int64()),
                    "label": pa.array(joined["label"], pa.int64()), "weight": pa.array(joined["weight"], pa.float64()),
                    "rest": pa.array(joined["rest"], pa.float64())})
    return run


def _close(texts: DataFrame, threshold: float) -> DataFrame:
    """(leader, member): every pair of texts (id, label, vec) of different labels
    that may be linked."""
    spark = texts.sparkSession
    texts = stage(texts.select("id", "label", "vec"), "open-texts")
    size = texts.agg(F.sum(F.octet_length("vec"))).collect()[0][0]
    buckets = 1 + int(size) // (6 * BUCKET_ENTRIES)
    shared = Held.sized(buckets, min(SHARED_BITS, 16 * BUCKET_ENTRIES * buckets))
    heavy = (texts.select("vec").mapInArrow(_tally(buckets), "bucket int, codes binary, n binary").groupBy("bucket")
             .applyInArrow(_heaviest(max(1, HEAVY // buckets), shared), "codes binary, n binary, bucket int, shared binary").collect())
    for r in heavy:
        shared.data[r["bucket"]] = np.frombuffer(r["shared"], np.uint8)
    codes = np.concatenate([np.frombuffer(r["codes"], "<u8") for r in heavy])
    order = np.argsort(codes)
    held = np.concatenate([np.frombuffer(r["n"], "<i8") for r in heavy])
    sent = spark.sparkContext.broadcast((codes[order], held[order], shared))          # at most HEAVY and SHARED_BITS
    rows = stage(texts.mapInArrow(_prefixes(sent, threshold), PREFIX), "prefixes")
    x = rows.filter("not probe").select("shingle", "step", *[F.col(c).alias(f"x_{c}") for c in ("id", "label", "weight", "rest")])
    y = rows.filter("probe").select("shingle", "step", *[F.col(c).alias(f"y_{c}") for c in ("id", "label", "weight", "rest")])
    lighter = (F.col("x_weight") < F.col("y_weight")) | ((F.col("x_weight") == F.col("y_weight")) & (F.col("x_id") < F.col("y_id")))
    enough = F.least("x_rest", "y_rest") >= (F.col("x_weight") + F.col("y_weight")) * (threshold / (1 + threshold) * (1 - ROOM))
    pairs = (x.join(y, (x["shingle"] == y["shingle"]) & (x["step"] == y["step"]) & (F.col("x_label") != F.col("y_label")) & lighter & enough)
             .select(F.least("x_id", "y_id").alias("leader"), F.greatest("x_id", "y_id").alias("member")).distinct())
    return stage(pairs, "close-pairs")


# ------------------------------------------------------------ 5 classes

def _classes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked ids in order, and the least id that links lead to."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = at[:len(a)], at[len(a):], np.arange(len(ids))
    while (label[x] != label[y]).any():
        least = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y):                              # the class's own label follows too
            np.minimum.at(new, label[side], least)
            np.minimum.at(new, side, least)
        while (new[new] != new).any():
            new = new[new]
        label = new
    return ids, ids[label]


def classes(edges: DataFrame) -> DataFrame:
    """(id, label): the least id that links lead to, for every linked id."""
    if edges.count() <= FEW_LINKS:
        held = edges.select("a", "b").toArrow()
        ids, label = _classes(held.column("a").to_numpy(), held.column("b").to_numpy())
        return edges.sparkSession.createDataFrame(pa.table({"id": pa.array(ids, pa.int64()), "label": pa.array(label, pa.int64())}))
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id"))
                .agg(F.min("label").alias("near")))
        step = labels.join(near, "id").select("id", F.least("label", "near").alias("label"),
                                              F.col("label").alias("before"))
        # where the label's own label has moved on already, follow it
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        step = stage(step.join(jump, "label", "left").select(
            "id", F.least("label", F.coalesce("further", "label")).alias("label"), "before"), "labels")
        if not step.filter("label <> before").limit(1).count():
            return step.select("id", "label")
        labels = step.select("id", "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id and n_links of every row (see the module's docstring)."""
    ready(docs.sparkSession)
    every = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    blocks = stage(every.mapInArrow(_blocks, BLOCKS), "word-blocks", wide=True)
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("ids") / 8), F.lit(0)),
                      F.coalesce(F.sum(F.octet_length("vocab") / 8), F.lit(0))).collect()[0]
    n_docs, buckets = max(1, int(size[0])), 1 + int(size[1]) // BUCKET_ENTRIES
    answers = stage(blocks.select("block", "vocab", "df").mapInArrow(
        _ask(buckets), "block string, bucket int, hashes binary, df binary").groupBy("bucket").applyInArrow(
        _add, "block string, bucket int, total binary"), "word-counts")
    signed = stage(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _sign(buckets, n_docs), "block string, place int, doc_id long, key binary, sample binary"), "signatures")
    # texts of equal words are one, with the least doc id (null: the last); numbers in the order of these, since
    # a doc id may belong to several texts
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "block", "place", "sample")).alias("first")
    texts = (signed.groupBy("key").agg(first, F.count(F.lit(1)).alias("copies"))
             .select("key", "copies", "first.none", "first.doc_id", "first.block", "first.place", "first.sample"))
    texts = numbered(texts, [F.col("none"), F.col("doc_id"), F.col("key")], "texts", "id")

    def vectors_of(wanted: DataFrame) -> DataFrame:
        places = texts.join(wanted, "id", "left_semi").select(
            "block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("total"), "place", "id")
        others = answers.select("block", "bucket", "total", F.lit(None).cast("int").alias("place"),
                                F.lit(None).cast("long").alias("id")).unionByName(places)
        return stage(blocks.groupBy("block").cogroup(others.groupBy("block")).applyInArrow(
            _vectors(buckets, n_docs), "id long, vec binary"), "shingles")

    edges = links(texts, vectors_of, threshold)
    label = classes(edges)
    degree = (edges.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")))
    named = stage(texts.select("key", "copies", "id").join(label, "id", "left").join(degree, "id", "left")
                  .select("key", "copies", F.coalesce("label", "id").alias("label"), F.coalesce("n", F.lit(0)).alias("n_links")), "labelled")
    names = stage(named.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
                  .join(texts.select(F.col("id").alias("label"), F.col("doc_id").alias("class_id")), "label"), "class-names")
    named = stage(hot_join(named, names, ["label"], "members").select("key", "copies", "class_id", "n_links"), "named-texts")
    return hot_join(signed.select("doc_id", "key"), named, ["key"], "copies").select("doc_id", "class_id", "n_links")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs``, all columns, with one row of each class: the one with the least
    id (a null id comes last), then the first read. Rows are told apart by
    numbers of their own, not by their ids."""
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered-documents")
    found = near_duplicates(rows, "_row", text_col, threshold).select(F.col("doc_id").alias("_row"), "class_id")
    ids = rows.select("_row", F.col(f"`{id_col}`").cast("long").alias("_id"))
    found = stage(found.join(ids, "_row"), "row-classes")
    kept = found.groupBy("class_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("first"))
    gone = stage(found.select("_row").join(kept.select(F.col("first._row").alias("_row")), "_row", "left_anti"), "near-copies")
    return without(rows, "_row", gone).select(*[F.col(f"`{c}`") for c in docs.columns])
