"""Conversation prefix trie by the Euler-tour technique (operator 12).

A conversation's turns are ordered by ``turn`` (null first; ties by hashes of
role and text, so equal turns are interchangeable); null role or text is empty,
rows without a conv_id are no conversation. ``rebuilt`` gives conversation c the
first h turns of conversation c - c % 5 and then its own turns after its first h;
``prefix_trie`` takes any turns.

1. Each distinct sequence of first d turns is a node; a running exclusive-or of 2 x
   64-bit hashes of (place, turn) stands for it. All rows of a node must have one last
   turn and one parent, or other hashes are drawn, so no two sequences share a
   node but for equal 128-bit hashes of two different turns. A node is named by its
   smallest conversation and its depth.
2. Children are ordered by name. Each node has an enter and an exit arc; enter
   leads to the first child's enter or the own exit, exit to the next sibling's enter
   or the parent's exit: a list, which ``listrank`` ranks.
3. Leaves and savings weigh on enter arcs. Running sums over the ranked arcs, taken
   at a node's exit less those before its enter, are those of its subtree.
4. The ids of the conversations that end at a node are joined in pieces and
   digested as a stream.

Common turns, nodes with many children and long conversations are split: keys
with many rows are broadcast (``hot_join``), running values go by buckets of 4096.

Output, one row for each node: conv_id, depth, parent_conv_id, n_convs, n_children,
n_leaves, saved_tokens, ends_sha256. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import pick, ready, stage
from .listrank import list_rank
from .spread import BITS, following, hot_join, numbered, running

#: Turns that a conversation takes from another at most.
MOST_LENT = 8
#: Draws of hashes before giving up; one suffices but for a chance of about n * n / 2 ** 129.
DRAWS = 4


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Staged (conv, pos from 1, bytes, a, b): each turn's place, text size and hashes."""
    own = pick(conversations, conv=F.col(f"`{conv_col}`").cast("long"), turn=F.col(f"`{turn_col}`").cast("long"),
               role=F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")),
               text=F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    marked = own.filter(F.col("conv").isNotNull()).select(
        "conv", "turn", F.octet_length("text").cast("long").alias("bytes"),
        F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"))
    sorted_ = numbered(marked, [F.col("conv"), F.asc_nulls_first("turn"), F.col("a"), F.col("b")], "turns")
    placed = running(sorted_, ["conv"], "s", {"pos": (F.sum, F.lit(1).cast("long"))})
    return stage(placed.select("conv", "pos", "bytes", "a", "b"), "turn-places")


def rebuilt(turns: DataFrame, lender: Column | None = None, lent: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, size) and turns (conv, d from 1, bytes, a, b), staged:
    the first ``lent`` turns of conversation ``lender``, then the own turns after
    the first ``lent`` (expressions of ``conv``; by default as in the module's text)."""
    conv = F.col("conv")
    lender = conv - conv % 5 if lender is None else lender
    lent = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(9)) if lent is None else lent
    sizes = stage(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "conv-sizes")
    wanted = sizes.select("conv", "n", lender.alias("base"), lent.cast("long").alias("h"))
    convs = stage(wanted.join(sizes.select(conv.alias("base"), F.col("n").alias("nb")), "base", "left").select(
        "conv", "base", "n", "h", F.least("h", F.coalesce("nb", F.lit(0))).alias("cut")), "convs")
    own = hot_join(turns, convs, ["conv"], "n").filter(F.col("pos") > F.col("h")).select(
        "conv", (F.col("cut") + F.col("pos") - F.col("h")).alias("d"), "bytes", "a", "b")
    firsts = turns.filter(F.col("pos") <= MOST_LENT).withColumnRenamed("conv", "base")
    borrowed = convs.select("conv", "base", "cut").join(firsts, "base").filter(F.col("pos") <= F.col("cut")).select(
        "conv", F.col("pos").alias("d"), "bytes", "a", "b")
    size = F.col("cut") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return convs.select("conv", size.alias("size")), stage(own.unionByName(borrowed), "rebuilt-turns")


def lane(draw: int, which: int) -> Column:
    """A turn's hash at its place, of which a prefix's hash is the exclusive-or."""
    return F.xxhash64(F.lit(2 * draw + which), "d", "a", "b")


def _prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with the hash of their prefix (ka, kb), and nodes below the root:
    (d, ka, kb, conv, n_convs, bytes, pa, pb)."""
    for draw in range(DRAWS):
        rows = stage(running(turns, ["conv"], "d", {"ka": (F.bit_xor, lane(draw, 0)), "kb": (F.bit_xor, lane(draw, 1))}),
                     "prefixes")
        up = rows.withColumn("pa", F.col("ka").bitwiseXOR(lane(draw, 0))).withColumn("pb", F.col("kb").bitwiseXOR(lane(draw, 1)))
        same = ["bytes", "a", "b", "pa", "pb"]
        nodes = stage(up.groupBy("d", "ka", "kb").agg(
            F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in same],
            *[F.max(c).alias(f"{c}_most") for c in same]), "trie-nodes")
        mixed = " OR ".join(f"{c} <> {c}_most" for c in same)
        if nodes.filter(mixed).isEmpty():
            return rows, nodes.select("d", "ka", "kb", "conv", "n_convs", "bytes", "pa", "pb")
    raise RuntimeError("prefix hashes collide in every draw")


def _digest(batches):
    """Rows (d, ka, kb, piece) in order: the digest of each key's pieces."""
    key, digest = None, None

    def row():
        return pa.RecordBatch.from_pydict({"d": pa.array([key[0]], pa.int64()), "ka": pa.array([key[1]], pa.int64()),
                                           "kb": pa.array([key[2]], pa.int64()), "sha": pa.array([digest.hexdigest()])})

    for b in batches:
        for *found, piece in zip(*(b.column(c).to_pylist() for c in ("d", "ka", "kb", "piece")), strict=True):
            if found != key:
                if key is not None:
                    yield row()
                key, digest = found, hashlib.sha256(piece.encode())
            else:
                digest.update(b",")
                digest.update(piece.encode())
    if key is not None:
        yield row()


def _ends(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(d, ka, kb, sha): digest of the conversations that end at each node."""
    zero = F.lit(0).cast("long")
    last = rows.select("conv", "d", "ka", "kb").join(convs, "conv").filter(F.col("d") == F.col("size")).select("conv", "d", "ka", "kb")
    none = convs.filter(F.col("size") == 0).select("conv", zero.alias("d"), zero.alias("ka"), zero.alias("kb"))
    at = numbered(stage(last.unionByName(none), "trie-ends"), [F.col(c) for c in ("d", "ka", "kb", "conv")], "trie-ends-sorted")
    keys = ["d", "ka", "kb"]
    pieces = (at.groupBy(*keys, F.shiftright("s", BITS).alias("bucket"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("piece")))
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "bucket").select(*keys, "piece").mapInArrow(
        _digest, "d long, ka long, kb long, sha string")


def _numbered_nodes(convs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes and the root, staged, with a number v in the order of their names and
    with n_children."""
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter(F.col("n_convs") > 0).select(
        "conv", "n_convs", *[zero.alias(c) for c in ("d", "ka", "kb", "bytes")],
        *[F.lit(None).cast("long").alias(c) for c in ("pa", "pb")])
    named = numbered(nodes.unionByName(root), [F.col("conv"), F.col("d")], "trie-numbers", "v")
    kids = named.filter(F.col("d") > 0).groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(
        F.count(F.lit(1)).alias("n_children"))
    return stage(named.join(kids, ["d", "ka", "kb"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
                 "trie-families")


def _tour(nodes: DataFrame) -> DataFrame:
    """Staged nodes with the parent (pv, pconv), the first child and the next sibling."""
    parents = nodes.filter(F.col("n_children") > 0).select(
        F.col("d").alias("pd"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("v").alias("pv"),
        F.col("conv").alias("pconv"), "n_children")
    children = nodes.filter(F.col("d") > 0).select("v", (F.col("d") - 1).alias("pd"), "pa", "pb")
    known = stage(hot_join(children, parents, ["pd", "pa", "pb"], "n_children").select("v", "pv", "pconv"), "trie-children")
    siblings = following(numbered(known, [F.col("pv"), F.col("v")], "trie-siblings"), ["pv"], "s", "v", "sibling")
    first = known.groupBy(F.col("pv").alias("v")).agg(F.min("v").alias("child"))
    return stage(nodes.drop("pa", "pb").join(siblings.drop("s"), "v", "left").join(first, "v", "left"), "trie-tour")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The trie of conversations (conv, size) and their turns (conv, d from 1 to
    size, bytes, a, b), both staged; see the module's text."""
    ready(convs.sparkSession)
    rows, nodes = _prefixes(turns)
    tour = _tour(_numbered_nodes(convs, nodes))
    enter, exit_ = 2 * F.col("v"), 2 * F.col("v") + 1
    links = tour.select(F.explode(F.array(
        F.struct(enter.alias("id"), F.coalesce(2 * F.col("child"), exit_).alias("next")),
        F.struct(exit_.alias("id"), F.coalesce(2 * F.col("sibling"), 2 * F.col("pv") + 1).alias("next")))).alias("arc")).select("arc.*")
    ranked = list_rank(links)
    leaf = (F.col("n_children") == 0).cast("long")
    weights = tour.select(enter.alias("id"), leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    arcs = stage(ranked.join(weights, "id", "left").select(
        "id", "pos", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("leaf", "saved")]), "trie-arcs")
    sums = running(arcs, [], "pos", {"leaves": (F.sum, F.col("leaf")), "savings": (F.sum, F.col("saved"))}, bits=16)
    is_exit = F.col("id") % 2 == 1

    def inside(total, own):
        return (F.max(F.when(is_exit, F.col(total))) - F.max(F.when(~is_exit, F.col(total) - F.col(own))))

    subtree = sums.groupBy(F.shiftright("id", 1).alias("v")).agg(
        inside("leaves", "leaf").alias("n_leaves"), inside("savings", "saved").alias("saved_tokens"))
    out = tour.join(subtree, "v").join(_ends(convs, rows), ["d", "ka", "kb"], "left")
    return out.select(F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("pconv").alias("parent_conv_id"), "n_convs",
                      "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt conversations."""
    return prefix_trie(*rebuilt(turns_of(conversations)))
