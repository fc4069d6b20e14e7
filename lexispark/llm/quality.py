"""Quality by hierarchical empirical Bayes (operator 1).

Three levels share evidence: a document's text, its host and its path on the
host. A logistic regression over the form of the text (``FEATURES``) gives each
document's own probability p of good quality. Sites get beta posteriors by
grouped aggregation of p over *all* documents, each level shrunk towards the
one above by as many pseudo-documents as the data ask for (method of moments):

    host:  (k0 m + sum p) / (k0 + n),   m: the mean of all documents
    path:  (k1 host + sum p) / (k1 + n)

A sparse site stays near its prior, a large one speaks for itself. A document's
own p is taken out of its site's sums before they speak about it. The result is

    logit(score) = logit(p) + weight * (logit(path posterior) - logit(m))

Fit: at most ``per_class`` labelled documents of each class, those with the
smallest hashes of their ids. Sites' sums are aggregated in the tasks first, so
a host with a third of all documents is one row from each task; posteriors go to
the documents by broadcast while their counted rows are few (``SITE_ROWS``),
else by a join in which adaptive execution splits hot sites.

Output, one row for each input row: doc_id, doc_score (p), host_posterior,
path_posterior, score, keep (score >= threshold). Null texts are scored as empty
ones; null hosts and paths are sites of their own. Labels other than 0 and 1 are
ignored; of several for one document the least counts. Without labels of both
classes p is 1/2 everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import buffers, byte_table, first_by_hash, pick, pieces, ready, stage, words

PER_CLASS = 4000
SITE_ROWS = 500_000
WEIGHT = 0.5
RIDGE = 1.0
FEATURES = ("log_bytes", "log_words", "mean_word", "upper", "digit", "space", "newline", "bang", "symbol", "bar", "other_punct",
            "high", "distinct", "repeat", "top_word", "symbol_words", "sentence_ends")
#: Classes of bytes, one letter each, in the order of the columns they feed.
CLASS = bytes(
    1 if 0x41 <= b <= 0x5A else 2 if 0x30 <= b <= 0x39 else 3 if b in b" \t\r\x0b\x0c" else 4 if b == 10 else 5 if b in b"!?"
    else 6 if b in b"#$%&*+<=>@\\^_`{}~" else 7 if b == 0x7C else 8 if 0x21 <= b < 0x7F and not chr(b).isalnum() else
    9 if b >= 0x80 else 0 for b in range(256))
GRAPH = byte_table(bytes(b for b in range(256) if b not in b" \t\n\x0b\x0c\r"))


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text; whole texts, a few passes over bytes."""
    data, offsets = buffers(texts)
    n, out = len(texts), np.zeros((len(texts), len(FEATURES)))
    size = np.diff(offsets)
    if not data:
        return out
    kind = np.frombuffer(data.translate(CLASS), np.uint8)
    doc = np.repeat(np.arange(n, dtype=np.int64), size)
    counts = np.bincount(doc * 10 + kind, minlength=10 * n).reshape(n, 10)
    at, codes, _ = words(data, offsets, GRAPH)
    length = np.diff(at)
    safe, some = np.maximum(length, 1), np.maximum(size, 1)
    owner = np.repeat(np.arange(n, dtype=np.int64), length)
    own, times = np.unique(owner << 32 | codes.astype(np.int64), return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, own >> 32, times)
    same = np.zeros(n)
    if len(codes) > 1:
        again = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
        same = np.bincount(owner[1:][again], minlength=n)
    # words that end in a symbol: a symbol before a space or at the end
    ends = np.flatnonzero((kind[:-1] == 6) & ((kind[1:] == 3) | (kind[1:] == 4))) if len(kind) > 1 else np.zeros(0, np.int64)
    stops = np.frombuffer(data, np.uint8) == 0x2E
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(length)
    out[:, 2] = (size - counts[:, 3] - counts[:, 4]) / safe
    for j, c in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 9), start=3):
        out[:, j] = np.sqrt(counts[:, c] / some)
    out[:, 12] = np.bincount(own >> 32, minlength=n) / safe
    out[:, 13], out[:, 14] = same / safe, top / safe
    out[:, 15] = np.bincount(doc[ends], minlength=n) / safe
    out[:, 16] = np.bincount(doc[stops], minlength=n) / safe
    return out


class Classifier:
    """Logistic regression by Newton's method, on standardized features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 25):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        w, penalty = np.zeros(z.shape[1]), ridge * np.eye(z.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve(z.T @ (z * np.maximum(p * (1 - p), 1e-6)[:, None]) + penalty, z.T @ (y - p) - penalty @ w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w

    def __call__(self, texts: pa.Array) -> np.ndarray:
        z = (features(texts) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(np.clip(z, -8, 8) @ self.w[:-1] + self.w[-1], -12, 12)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
        label_col: str = "quality", per_class: int = PER_CLASS) -> Classifier | None:
    """The document classifier; None unless both classes have labelled texts."""
    spark = ready(docs.sparkSession)
    known = (pick(labels, id=F.col(f"`{label_id_col}`").cast("long"), y=F.col(f"`{label_col}`").cast("int"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.min("y").alias("y")))
    chosen = first_by_hash(known.withColumn("h", F.xxhash64("id")), "y", "id", per_class)
    chosen = chosen.select("id", "y").collect()                                 # at most 2 x per_class
    if not chosen:
        return None
    wanted = F.broadcast(spark.createDataFrame([(r["id"], r["y"]) for r in chosen], "id long, y int"))
    texts = pick(docs, id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string")).join(wanted, "id")

    def run(batches):
        for b in pieces(batches):
            x = features(b.column("text"))
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "y": b.column("y"),
                                              "x": pa.array(list(x), pa.list_(pa.float64()))})

    rows = sorted((r["id"], r["y"], tuple(r["x"])) for r in texts.select("id", "y", "text").mapInArrow(
        run, "id long, y int, x array<double>").collect())
    if len({y for _, y, _ in rows}) < 2:
        return None
    return Classifier(np.array([x for *_, x in rows]), np.array([y for _, y, _ in rows], float))


def _logit(c: Column) -> Column:
    return F.log(c / (1 - c))


def _squash(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def _strength(groups: DataFrame, parent: str) -> float:
    """Pseudo-documents of a level's prior: the variance within its sites over
    that between them (of sites around their parents), by moments."""
    r = groups.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"),
                   F.sum(F.col("ss") - F.col("s") * F.col("s") / F.col("n")).alias("within"),
                   F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(parent), 2)).alias("between"),
                   F.sum(F.col("n") * F.col("n")).alias("nn")).collect()[0]
    n, g = r["n"] or 0, r["g"]
    if n <= g or g < 2:
        return 10.0
    within = max(r["within"], 0.0) / (n - g)
    between = max(0.0, (r["between"] - (g - 1) * within) / max(1.0, n - r["nn"] / n))
    return float(min(1e6, max(1.0, within / between))) if between > 0 else 1e6


def quality(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text",
            host: str | Column = "host", path: str | Column = "path", weight: float = WEIGHT,
            threshold: float = 0.5) -> DataFrame:
    """Scores every document (see the module's docstring)."""
    spark = ready(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), host=host, path=path,
                 text=F.col(f"`{text_col}`").cast("string")).select(
        "doc_id", F.struct("host").alias("host"), F.struct("host", "path").alias("path"), "text").select(
        "doc_id", F.to_json("host").alias("host"), F.to_json("path").alias("path"), "text")

    def run(batches):
        for b in pieces(batches):
            p = np.full(b.num_rows, 0.5) if sent.value is None else sent.value(b.column("text"))
            yield pa.RecordBatch.from_pydict({**{c: b.column(c) for c in ("doc_id", "host", "path")}, "p": pa.array(p)})

    scored = stage(texts.mapInArrow(run, "doc_id long, host string, path string, p double"), "quality")
    paths = stage(scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s"),
                                                     F.sum(F.col("p") * F.col("p")).alias("ss")), "paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")])
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("rows")).collect()[0]
    if not total["n"]:
        return spark.createDataFrame([], "doc_id long, doc_score double, host_posterior double, path_posterior double, "
                                         "score double, keep boolean")
    mean = min(1 - 1e-6, max(1e-6, total["s"] / total["n"]))
    k0 = _strength(hosts.withColumn("m", F.lit(mean)), "m")
    hosts = hosts.select("host", F.col("n").alias("hn"), F.col("s").alias("hs"))
    sites = stage(paths.join(hosts, "host").withColumn("hm", F.col("hs") / F.col("hn")), "sites")
    k1 = _strength(sites, "hm")
    few = sites.count() <= SITE_ROWS
    posts = sites.select("path", "n", "s", "hn", "hs")
    joined = scored.select("doc_id", "path", "p").join(F.broadcast(posts) if few else posts, "path")
    p = F.col("p")
    # without the document itself
    at_host = (k0 * mean + F.col("hs") - p) / (k0 + F.col("hn") - 1)
    at_path = (k1 * F.col("host_posterior") + F.col("s") - p) / (k1 + F.col("n") - 1)
    clip = lambda c: F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), c))
    return (joined.withColumn("host_posterior", clip(at_host)).withColumn("path_posterior", clip(at_path))
            .withColumn("score", _squash(_logit(clip(p)) + weight * (_logit(F.col("path_posterior")) - F.lit(float(np.log(mean / (1 - mean)))))))
            .select("doc_id", p.alias("doc_score"), "host_posterior", "path_posterior", "score",
                    (F.col("score") >= threshold).alias("keep")))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host of a URL, and its first path segment."""
    return F.lower(F.try_parse_url(url, F.lit("HOST"))), F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "^/([^/]*)", 1)
