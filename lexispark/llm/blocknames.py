"""Exact deduplication by deterministic block naming (operator 13, native).

Two texts are equal if they are the same after every character of
``[\\x20\\x09-\\x0D]`` is deleted (null: empty). Of equal texts the row with the
most code points in the original text stays, then the smallest id (a null id
comes last), then the first row read.

1. A normalised text is cut into blocks of ``BLOCK`` code points (the last one
   may be shorter; an empty text is one empty block).
2. The distinct blocks are sorted and their places in that order become their
   names. They are sorted by a 64-bit fingerprint, and by their characters where
   two different blocks share one, so block contents move once, after a partial
   distinct in each task; what joins the names to the documents is the fingerprint.
3. Adjacent names of a document make pairs (an odd last one: name and -1), the
   distinct pairs are sorted into names again, and so on, until a document has one
   name. Every step is one to one, so (number of steps, name) is the text's
   identity: no two different texts share it, whatever the fingerprints do.

Blocks, pairs or texts with many copies are joined by broadcast (``hot_join``);
groups are only ever aggregated. The work is DataFrame operations throughout;
each level is staged, so that lost executors cost one level.

Rows are told apart by a key of their own: repeated and null ids are rows like
any other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import pick, stage
from .spread import hot_join, numbered

#: Code points of a block.
BLOCK = 2048
SPACE = r"[\x20\x09-\x0D]+"


def fingerprint(block: Column) -> Column:
    """Orders blocks before their contents do; need not be one to one."""
    return F.xxhash64(block)


def _texts(docs: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """Staged: row, doc_id, n (code points), sha, blocks and their fingerprints."""
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"),
                 text=F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    bare = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.length("text").alias("n"),
                        F.regexp_replace("text", SPACE, "").alias("bare"))
    # One pass whatever the length: a substring for each block would start from the text's beginning.
    cut = bare.select("row", "doc_id", "n", F.sha2(F.col("bare").cast("binary"), 256).alias("sha"),
                      F.regexp_extract_all("bare", F.lit(f"(?s).{{1,{block}}}|^$"), F.lit(0)).alias("blocks"))
    return stage(cut.withColumn("prints", F.transform("blocks", fingerprint)), "block-texts")


def _blocks(texts: DataFrame, *more: str) -> DataFrame:
    zipped = F.posexplode(F.arrays_zip(F.col("prints").alias("print"), F.col("blocks").alias("block")))
    return texts.select(*more, zipped.alias("pos", "b")).select(*more, "pos", F.col("b.print").alias("x"),
                                                                F.col("b.block").alias("block"))


def _level_zero(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of every block (row, m, pos, x, y) and distinct keys (x, y, copies):
    x is the fingerprint, y counts different blocks of one fingerprint."""
    distinct = _blocks(texts).groupBy("x", "block").agg(F.count(F.lit(1)).alias("copies"))
    prints = stage(distinct.groupBy("x").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("kinds")), "block-prints")
    keys = (texts.select("row", F.size("prints").alias("m"), F.posexplode("prints").alias("pos", "x"))
            .withColumn("y", F.lit(0).cast("long")))
    shared = prints.filter(F.col("kinds") > 1).select("x")
    if shared.isEmpty():
        return keys, prints.select("x", F.lit(0).cast("long").alias("y"), "copies")
    # Different blocks of one fingerprint: these, and only these, are told apart by their characters.
    contents = _blocks(texts).join(shared, "x", "left_semi").groupBy("x", "block").agg(F.count(F.lit(1)).alias("copies"))
    ordered = numbered(contents, [F.col("x"), F.col("block")], "block-contents", "y")
    named = hot_join(_blocks(texts.withColumn("m", F.size("prints")), "row", "m").join(shared, "x", "left_semi"),
                     ordered, ["x", "block"], "copies")
    alone = keys.join(shared, "x", "left_anti")
    return (alone.unionByName(named.select("row", "m", "pos", "x", "y")),
            prints.filter(F.col("kinds") == 1).select("x", F.lit(0).cast("long").alias("y"), "copies")
            .unionByName(ordered.select("x", "y", "copies")))


def identities(texts: DataFrame) -> DataFrame:
    """(row, level, name): one identity for each staged text."""
    keys, distinct = _level_zero(texts)
    done, level = None, 0
    while True:
        names = numbered(distinct, [F.col("x"), F.col("y")], f"block-names-{level}", "name")
        named = stage(hot_join(keys, names, ["x", "y"], "copies").select("row", "m", "pos", "name"), f"block-named-{level}")
        ended = named.filter(F.col("m") == 1).select("row", F.lit(level).alias("level"), "name")
        done = ended if done is None else done.unionByName(ended)
        rest = named.filter(F.col("m") > 1)
        if rest.isEmpty():
            return done
        left = F.col("pos") % 2 == 0
        keys = stage(rest.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                     .agg(F.ceil(F.max("m") / 2).cast("int").alias("m"),
                          F.max(F.when(left, F.col("name"))).alias("x"),
                          F.coalesce(F.max(F.when(~left, F.col("name"))), F.lit(-1)).alias("y")), f"block-pairs-{level}")
        distinct = keys.groupBy("x", "y").agg(F.count(F.lit(1)).alias("copies"))
        level += 1


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id (id of the row that stays
    for this text), group_size, kept, text_sha256 (of the normalised text)."""
    texts = _texts(docs, id_col, text_col, block)
    known = stage(identities(texts).join(texts.select("row", "doc_id", "n", "sha"), "row"), "block-identities")
    best = F.min(F.struct(-F.col("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = stage(known.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "block-groups")
    return hot_join(known, groups, ["level", "name"], "group_size").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"))
