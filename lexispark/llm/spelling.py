"""Spelling variant grouping by dense prefix-suffix tiling (operator 11).

Runs are the maximal stretches of ``[A-Za-z\\u00C0-\\u00FF]`` in a text, with A-Z
lower-cased (null text: none). ``planted`` deletes one code point of some runs, as
the registered query asks for. Words are the distinct results of at least
``min_chars`` code points that occur at least ``min_count`` times in all.

Two words are near if one inserted, deleted or replaced code point turns one into
the other: their common prefix and common suffix together reach the longer
length L minus one. So the prefix or the suffix has at least L // 2 code points, and
words are compared within groups of equal (side, L, those L // 2 code points); a pair
found by its suffixes counts only if its prefix is shorter, hence once.

A group's words are cut by their hash into blocks of about ``BLOCK``; one row holds a
pair of blocks, whatever the group's size. Inside it, code points make padded
matrices, left- and right-aligned; prefix and suffix lengths of all pairs of the tile
come from comparing columns. What leaves a tile is, for each word, its number
of near words there and the best of them, never the pairs.

A word's form is its near word of largest n (ties: smallest in code-point order), if
that n is at least ``factor`` times the word's; its root is the end of the chain of
forms (n grows along it, so it ends). Output: word, form, root, n, n_near, form_n, one
row for each word. A null id counts as an empty one in ``planted``; repeated rows count
again; an empty table has no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import pick, ready, stage
from .spread import hot_join

#: Words of one block, on average.
BLOCK = 256
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def planted(doc_id: Column, run: Column, every: int = 199) -> Column:
    """The run without one code point if ``every`` divides h, the CRC-32 of
    ``<doc_id>:<run>``: the one at h modulo the length, from 0."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5,
          change=planted) -> DataFrame:
    """Staged (word, n). ``change(doc_id, run)`` must not make a run longer: runs
    under ``min_chars`` are left out before it."""
    texts = pick(docs, doc_id=f"{id_col}", text=F.col(f"`{text_col}`").cast("string"))
    found = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    runs = texts.select("doc_id", F.explode(found).alias("run")).select(
        "doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run") if change is None else change(F.col("doc_id"), F.col("run"))
    counts = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stage(counts.filter((F.length("word") >= min_chars) & (F.col("n") >= min_count)), "words")


def _members(vocabulary: DataFrame) -> DataFrame:
    """Each word in its groups: (side, len, piece, word, n). Its own length is the
    longer one of a pair, or the longer one has one more."""
    size = F.length("word")

    def key(side, length):
        half = F.floor(length / 2).cast("int")
        piece = F.substring("word", F.lit(1), half) if side == 0 else F.substring("word", size - half + 1, half)
        return F.struct(F.lit(side).alias("side"), length.alias("len"), piece.alias("piece"))

    keys = F.array(*[key(side, length) for side in (0, 1) for length in (size, size + 1)])
    return vocabulary.select("word", "n", F.explode(keys).alias("k")).select("k.side", "k.len", "k.piece", "word", "n")


def _tiles(vocabulary: DataFrame, block: int) -> DataFrame:
    """(side, len, words): a pair of blocks of a group as one list of (word, n,
    second), where ``second`` marks the words of the second block; null in a block
    compared with itself."""
    key = ["side", "len", "piece"]
    members = _members(vocabulary)
    own = (F.length("word") == F.col("len")).cast("int")
    groups = stage(members.groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.sum(own).alias("longs"))
                   .filter((F.col("m") > 1) & (F.col("longs") > 0)).select(*key, "m"), "word-groups")
    blocks = F.ceil(F.col("m") / block).cast("int")
    placed = hot_join(members, groups, key, "m").select(
        *key, "word", "n", blocks.alias("blocks"), F.pmod(F.xxhash64("word"), blocks).cast("int").alias("b"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda other: F.struct(F.least("b", other).alias("x"), F.greatest("b", other).alias("y")))
    dealt = placed.select("*", F.explode(pairs).alias("t"))
    second = F.when(F.col("t.x") < F.col("t.y"), F.col("b") == F.col("t.y"))
    return (dealt.groupBy(*key, "t").agg(F.collect_list(F.struct("word", "n", second.alias("second"))).alias("words"))
            .filter(F.size("words") > 1).select("side", "len", "words"))


def _matrix(words: list[str], width: int, right: bool) -> np.ndarray:
    text = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray, columns, known: int) -> np.ndarray:
    """For all pairs of rows: ``known`` and the number of leading ``columns`` that agree."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.full((len(a), len(b)), known, np.int32)
    for c in columns:
        alive &= a[:, c, None] == b[None, :, c]
        if not alive.any():
            break
        out += alive
    return out


def near_pairs(first: list[str], second: list[str], width: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of near words of the two lists, all of a group (side, width);
    the longer length is ``width``, equal words aren't near."""
    half = width // 2
    left, right = ([_matrix(w, width, r) for w in (first, second)] for r in (False, True))
    back = range(width - 1, -1, -1)
    if side == 0:
        prefix = _common(*left, range(half, width), half)
        suffix = _common(*right, back[:width - 1 - half], 0)
        near = (prefix < width) & (prefix + suffix >= width - 1)
    else:
        prefix = _common(*left, range(half), 0)
        suffix = _common(*right, back[half:], half)
        near = (prefix < half) & (prefix + suffix >= width - 1)
    return np.nonzero(near)


def _compare(batches):
    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for side, width, row in zip(*(batch.column(c).to_pylist() for c in ("side", "len", "words")), strict=True):
            row.sort(key=lambda w: (-w["n"], w["word"]))             # an index is the rank of a word as a form
            text = [w["word"] for w in row]
            long = np.array([len(w) == width for w in text])
            of = np.array([w["second"] is True for w in row])
            n = len(row)
            near, best = np.zeros(n, np.int64), np.full(n, n, np.int64)
            whole = row[0]["second"] is None
            # Long words with all of the other block (or their own), long ones of the second with the first's short ones.
            for rows, columns in (((long, np.ones(n, bool)),) if whole else ((long & ~of, of), (long & of, ~of & ~long))):
                i, j = np.flatnonzero(rows), np.flatnonzero(columns)
                if not len(i) or not len(j):
                    continue
                x, y = near_pairs([text[k] for k in i], [text[k] for k in j], width, side)
                x, y = i[x], j[y]
                if whole:
                    once = (x < y) | ~long[y]                        # two long words meet twice in their own block
                    x, y = x[once], y[once]
                for a, b in ((x, y), (y, x)):
                    np.add.at(near, a, 1)
                    np.minimum.at(best, a, b)
            for k in np.flatnonzero(near).tolist():
                for column, value in zip(out, (text[k], int(near[k]), row[best[k]]["n"], text[best[k]]), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                          pa.array(out[3], pa.string())], names=["word", "near", "best_n", "best"])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): pointers are doubled until none moves."""
    while True:
        after = forms.select(F.col("word").alias("form"), F.col("form").alias("later"))
        moved = stage(forms.join(after, "form", "left").select("word", F.coalesce("later", "form").alias("form"),
                                                               F.col("later").isNotNull().alias("moved")), "roots")
        forms = moved.select("word", "form")
        if moved.filter("moved").isEmpty():
            return forms.withColumnRenamed("form", "root")


def spelling_variants(vocabulary: DataFrame, factor: int = 5, block: int = BLOCK) -> DataFrame:
    """Words (word, n), staged and distinct, with near words, form and root; see the
    module's text."""
    ready(vocabulary.sparkSession)
    found = _tiles(vocabulary, block).mapInArrow(_compare, "word string, near long, best_n long, best string")
    near = found.groupBy("word").agg(F.sum("near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first"))
    chosen = (-F.col("first.less")) >= factor * F.col("n")
    out = stage(vocabulary.join(near, "word", "left").select(
        "word", F.when(chosen, F.col("first.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(chosen, -F.col("first.less")).alias("form_n")), "word-forms")
    roots = _roots(out.filter(F.col("form").isNotNull()).select("word", "form"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
