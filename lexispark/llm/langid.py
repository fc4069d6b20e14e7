"""Language identification with string kernels (operator 10).

A text is a set of byte n-grams (n = 1 to 3) of its letters, lower-cased, with
one space for each run of anything else: the blended-spectrum presence kernel
of two texts counts the n-grams that both hold, divided by the roots of their
own counts. Nyström: ``landmarks`` training texts (as many for each language)
span the feature space; the kernel is taken over their n-grams, so a text is a
0/1 row over a bounded vocabulary, and all kernel values of a block of texts
are one matrix product. One-versus-rest kernel ridge regression in that space
has a closed form.

Fit: a bounded sample, at most ``per_lang`` labelled texts of each language by
the smallest hash of doc id, fits landmarks and weights. The model is a few MB
at most, whatever the input. Every whole text is then scored, row-local.

A text that is null or has no letter is ``und`` with score 0. Languages are
those of the training rows with a text with letters; without any, every text
is ``und``. Repeated rows give repeated results; ids may be null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import buffers, first_by_hash, pick, pieces, ready, row_local, stage

LANDMARKS = 48                    # for each language
PER_LANG = 800
RIDGE = 1e-3
SHARPNESS = 6.0
#: Symbols: 0 for what is no letter, 1-26 a-z, then bytes from 0x80.
CODE = bytes((b - 96) if 97 <= b <= 122 else (b - 64) if 65 <= b <= 90 else (b - 101) if b >= 0x80 else 0
             for b in range(256))
SYMBOLS = 256 - 101
UND = "und"
#: Texts whose kernel values are one matrix product.
STEP_TEXTS = 128


def _symbols(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts laid end to end, each with a gap (0) before and after,
    runs of gaps made one, and the text of each symbol."""
    raw = np.frombuffer(data.translate(CODE), np.uint8)
    keep = raw != 0
    keep[1:] |= raw[:-1] != 0                                   # the first gap after a letter
    first = offsets[:-1]
    at = np.flatnonzero(keep)
    doc = np.searchsorted(first, at, side="right") - 1
    # a gap in front of every text
    n = len(first)
    sym = np.zeros(len(at) + n, np.uint8)
    owner = np.empty(len(at) + n, np.int64)
    place = np.arange(len(at)) + doc + 1
    sym[place] = raw[at]
    owner[place] = doc
    head = np.searchsorted(doc, np.arange(n)) + np.arange(n)
    owner[head] = np.arange(n)
    return sym, owner


def _codes(sym: np.ndarray, owner: np.ndarray):
    """(n-gram, text) codes for n = 1, 2, 3, each as a number over the
    symbols, offset by n; n-grams do not cross texts."""
    s = sym.astype(np.int32)
    base = SYMBOLS + 1
    yield s, owner
    two = s[:-1] * base + s[1:]
    ok = owner[1:] == owner[:-1]
    yield (two + base)[ok], owner[1:][ok]
    three = two[:-1] * base + s[2:]
    ok = owner[2:] == owner[:-2]
    yield (three + base + base * base)[ok], owner[2:][ok]


SPACE = (SYMBOLS + 1) + (SYMBOLS + 1) ** 2 + (SYMBOLS + 1) ** 3


def _has_letter(texts: list[str | None]) -> np.ndarray:
    return np.fromiter((t is not None and any(map(str.isalpha, t)) for t in texts), bool, len(texts))


class Model:
    """Landmarks' n-grams, the Nyström map and the regression weights."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int, ridge: float):
        self.langs = sorted(set(langs))
        self.columns = np.full(SPACE, -1, np.int32)
        chosen = []
        for lang in self.langs:
            chosen += [i for i, x in enumerate(langs) if x == lang][:landmarks]
        data, offsets = buffers(pa.array([texts[i] for i in chosen], pa.string()))
        found = np.unique(np.concatenate([c for c, _ in _codes(*_symbols(data, offsets))]))
        self.columns[found] = np.arange(len(found), dtype=np.int32)
        self.width = len(found)
        self.basis = self.rows(pa.array([texts[i] for i in chosen], pa.string()))
        gram = self.basis @ self.basis.T
        value, vector = np.linalg.eigh(gram.astype(np.float64))
        keep = value > 1e-6 * value.max()
        self.project = (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)
        x = np.concatenate([self.features(pa.array(texts[k:k + 256], pa.string())) for k in range(0, len(texts), 256)])
        x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
        y = np.where(np.asarray(langs)[:, None] == np.asarray(self.langs)[None, :], 1.0, -1.0)
        weight = 1.0 / np.asarray([langs.count(a) for a in self.langs])[[self.langs.index(a) for a in langs]]
        a = x.T @ (x * weight[:, None]) + ridge * np.eye(x.shape[1])
        w = np.linalg.solve(a, x.T @ (y * weight[:, None]))
        # both maps are linear: from kernel values with the landmarks to scores
        self.weights = (self.project.astype(np.float64) @ w[:-1]).astype(np.float32)
        self.bias = w[-1].astype(np.float32)

    def __getstate__(self):
        state = dict(self.__dict__)
        held = np.flatnonzero(self.columns >= 0)
        state["columns"] = held[np.argsort(self.columns[held])].astype(np.int32)
        return state

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.columns = np.full(SPACE, -1, np.int32)
        self.columns[state["columns"]] = np.arange(len(state["columns"]), dtype=np.int32)

    def rows(self, texts: pa.Array) -> np.ndarray:
        """Presence rows over the landmarks' n-grams, of length 1 (or 0)."""
        data, offsets = buffers(texts)
        out = np.zeros((len(texts), self.width), np.float32)
        if data:
            for code, owner in _codes(*_symbols(data, offsets)):
                column = self.columns[code]
                known = np.flatnonzero(column >= 0)
                out[owner[known], column[known]] = 1
        size = np.sqrt(out.sum(axis=1, keepdims=True))
        out /= np.maximum(size, 1)
        return out

    def features(self, texts: pa.Array) -> np.ndarray:
        return (self.rows(texts) @ self.basis.T) @ self.project

    def scores(self, texts: pa.Array) -> np.ndarray:
        return (self.rows(texts) @ self.basis.T) @ self.weights + self.bias

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The best language's number and its share of all (softmax), by text."""
        s = self.scores(texts)
        best = s.argmax(axis=1)
        e = np.exp(SHARPNESS * (s - s.max(axis=1, keepdims=True)))
        return best, (1 / e.sum(axis=1)).astype(np.float64)


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Fits on at most ``per_lang`` texts of each language for which ``train``
    holds: those with the smallest hashes. None without any."""
    rows = docs.filter(train).select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # ranks over ids alone
    named = stage(rows.select("lang", "id", F.xxhash64("id").alias("h")), "lang-ids")
    ids = first_by_hash(named, "lang", "id", per_lang).select("lang", "id").distinct()
    keys = {(r["lang"], r["id"]) for r in ids.collect()}        # bounded by languages and per_lang
    if not keys:
        return None
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame(sorted(keys, key=str), "lang string, id string"))
    sample = rows.join(wanted, (rows["lang"] == wanted["lang"]) & rows["id"].eqNullSafe(wanted["id"]), "left_semi").collect()
    sample = sorted({(r["id"] or "", r["lang"], r["text"]) for r in sample})
    # one order for all languages, not by the hash's text
    import zlib
    sample.sort(key=lambda r: (zlib.crc32((r[0] + "|landmark").encode()), r))
    return Model([t for _, _, t in sample], [a for _, a, _ in sample], landmarks, ridge)


def _predict(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, a bounded block at a time."""
    langs, scores = [], [np.zeros(0)]
    for k in range(0, len(texts), STEP_TEXTS):
        part = texts.slice(k, STEP_TEXTS)
        known = _has_letter(part.to_pylist())
        if model is None:
            known[:] = False
            best, share = np.zeros(len(known), np.int64), np.zeros(len(known))
        else:
            best, share = model.predict(part)
        langs += [model.langs[i] if ok else UND for i, ok in zip(best.tolist(), known, strict=True)]
        scores.append(np.where(known, share, 0.0))
    return langs, np.concatenate(scores)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text."""
    spark = ready(docs.sparkSession)
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in pieces(batches, limit=2 << 20):
            langs, scores = _predict(sent.value, b.column("text"))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "lang_pred": pa.array(langs, pa.string()),
                                              "score": pa.array(scores, pa.float64())})

    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def accept(docs: DataFrame, model: Model | None, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang") -> DataFrame:
    """The documents of a known language (score at least ``min_score``), with it
    as their ``lang_col``; the other columns as they are."""
    sent = ready(docs.sparkSession).sparkContext.broadcast(model)

    def change(_, texts):
        langs, scores = _predict(sent.value, texts)
        return (np.asarray(langs) != UND) & (scores >= min_score), {lang_col: pa.array(langs, pa.string())}

    return row_local(docs, id_col, text_col, change)
