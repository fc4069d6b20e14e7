"""Organization / adjective profile (E1-E12) and community filters.

Plan shape (word_count job): one row-local projection computes the encoded
sequences of every comment; two ``explode -> groupBy`` branches (mentions and
adjective pairs) aggregate with map-side partial aggregation, so a hot key is
combined before it is shuffled; one left join on (org_lower, subreddit); one
``groupBy ... collect_list`` on the same key, which reuses the join's hash
partitioning; one range-partitioned sort. Broadcasts are decided by AQE from
the measured size of a side, never from an estimate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.tags import encode_ents, encode_tags
from ..functions.text import java_split, lower_split
from ..functions import jsonfn
from ..plans.stages import materialize
from .annotate import DEFAULT_BACKEND, TEST_LEXICON, Lexicon, annotate, annotate_arrow
from .sequence import connected_pairs, direct_pairs, merged_values, org_mentions


# ------------------------------------------------------------ tagged comments

def tagged_from_text(df: DataFrame, lex: Lexicon = TEST_LEXICON, id_col: str = "id",
                     group_col: str = "subreddit", text_col: str = "body",
                     backend: str = DEFAULT_BACKEND) -> DataFrame:
    """Annotate raw comments and keep what the sequence operators read:
    (id, subreddit, tags, values, ents, enc, enc_ents). ``values`` are the
    lemmas (the original fills both value and rawValue from lemmas)."""
    base = df.select(F.col(id_col).alias("id"), F.col(group_col).alias("subreddit"), F.col(text_col).alias("_text"))
    if backend == "arrow":
        a = annotate_arrow(base, "_text", lex, encode=True)
        return a.select("id", "subreddit", "tags", F.col("lemmas").alias("values"), "ents", "enc", "enc_ents",
                        "sentence")
    a = annotate(base, "_text", lex, backend="expr")
    return _encode(a.select("id", "subreddit", "tags", F.col("lemmas").alias("values"), "ents"))


def tagged_from_annotated(df: DataFrame, strict: bool = False, raw_from: str = "lemmas") -> DataFrame:
    """Annotated JSON lines (``value``) -> tagged comments. The four
    space-joined strings are split with Java rules; unequal lengths, and lines
    that the nlp job wrote as errors, make an error row (``error`` not null)
    instead of failing the job, unless ``strict``. ``raws`` (D4's raw values) are the lemmas, as originally, or the
    words as written with ``raw_from="tokens"``."""
    if raw_from not in ("lemmas", "tokens"):
        raise ValueError("raw_from is lemmas or tokens")
    v = jsonfn.parse("value")
    d = df.select(
        (F.col("id") if "id" in df.columns else F.monotonically_increasing_id()).alias("id"),
        jsonfn.string_field(v, "subreddit").alias("subreddit"),
        java_split(jsonfn.string_field(v, "tags")).alias("tags"),
        java_split(jsonfn.string_field(v, "lemmas")).alias("values"),
        java_split(jsonfn.string_field(v, raw_from)).alias("raws"),
        java_split(jsonfn.string_field(v, "ents")).alias("ents"),
        jsonfn.string_field(v, "error").alias("_said"), v.isNull().alias("_bad_json"))
    same = ((F.size("tags") == F.size("values")) & (F.size("values") == F.size("ents"))
            & (F.size("values") == F.size("raws")))
    names = "tags, lemmas and ents" if raw_from == "lemmas" else "tags, lemmas, tokens and ents"
    err = (F.when(F.col("_bad_json"), F.lit(jsonfn.PARSE_ERROR)).when(F.col("_said") != "", F.col("_said"))
           .when(~same, F.lit(f"{names} differ in length")))
    ok = err.isNull()
    if strict:
        err = F.when(~ok, F.raise_error(F.lit("malformed annotated line")))
    d = d.withColumn("error", err).drop("_bad_json", "_said")
    empty = F.array().cast("array<string>")
    d = d.withColumns({c: F.when(F.col("error").isNull(), F.col(c)).otherwise(empty)
                       for c in ("tags", "values", "raws", "ents")})
    return _encode(d)


def _encode(d: DataFrame) -> DataFrame:
    return d.withColumns({"enc": encode_tags("tags", "values"),
                          "enc_ents": encode_ents("ents", "values")})


# ------------------------------------------------------------ E3 / E4

def mentions(tagged: DataFrame, flush_tail: bool = False) -> DataFrame:
    """One row per organization mention (id, subreddit, org)."""
    return tagged.select("id", "subreddit", F.explode(_mentions(tagged, flush_tail)).alias("org"))


def _mentions(tagged: DataFrame, flush_tail: bool = False) -> Column:
    """The mentions of a comment, computed already (``compact``) or not."""
    return F.col("mentions") if "mentions" in tagged.columns else org_mentions("enc_ents", flush_tail)


def compact(tagged: DataFrame, skip_articles: bool = False, flush_tail: bool = False) -> DataFrame:
    """What several branches of a job read, computed in one pass: mentions and
    pairs of each comment, and its sentence where it has a mention. Smaller than
    the text; comments with neither are left out."""
    sentence = F.col("sentence") if "sentence" in tagged.columns else merged_values("values", "ents")
    pairs = F.concat(connected_pairs("enc", skip_articles, flush_tail), direct_pairs("enc", flush_tail))
    out = tagged.select("id", "subreddit", org_mentions("enc_ents", flush_tail).alias("mentions"), pairs.alias("pairs"),
                        sentence.alias("sentence"))
    return out.select("id", "subreddit", "mentions", "pairs",
                      F.when(F.size("mentions") > 0, F.col("sentence")).alias("sentence"))


def casing_counts(tagged: DataFrame, flush_tail: bool = False) -> DataFrame:
    """E4's first level: mentions per (org_lower, subreddit, org), every casing
    by itself. Counts of parts of a corpus add up to those of the whole."""
    return (mentions(tagged, flush_tail).groupBy(F.lower("org").alias("org_lower"), "subreddit", "org")
            .agg(F.count(F.lit(1)).alias("n")))


def org_counts_of(casings: DataFrame) -> DataFrame:
    """E4 from (partial) counts of casings."""
    return (casings.groupBy("org_lower", "subreddit")
            .agg(F.min("org").alias("org"), F.sum("n").cast("bigint").alias("count")))


def org_counts(tagged: DataFrame, flush_tail: bool = False) -> DataFrame:
    """Mentions per (lower-cased org, community); the display casing kept
    is the smallest one (deterministic).

    Two levels: a hash aggregation with map-side combine counts every
    (org_lower, subreddit, casing) - a hot organization is combined before the
    shuffle - and only the few casings per organization reach the ``min``
    (whose string buffer would otherwise force a sort-based aggregation over
    every mention)."""
    if tagged.isStreaming:
        # one stateful aggregation (chained aggregations need event-time
        # watermarks in Structured Streaming); state lives in the state store
        return (mentions(tagged, flush_tail).groupBy(F.lower("org").alias("org_lower"), "subreddit")
                .agg(F.min("org").alias("org"), F.count(F.lit(1)).alias("count")))
    return org_counts_of(casing_counts(tagged, flush_tail))


# ------------------------------------------------------------ E5 / E6

def adj_pairs(tagged: DataFrame, skip_articles: bool = False, flush_tail: bool = False) -> DataFrame:
    """E5: connected pairs UNION ALL direct pairs, one pass over each comment."""
    both = F.col("pairs") if "pairs" in tagged.columns else F.concat(
        connected_pairs("enc", skip_articles, flush_tail), direct_pairs("enc", flush_tail))
    return (tagged.select("id", "subreddit", F.explode(both).alias("p"))
            .select("id", "subreddit", "p.is_direct", "p.noun", "p.adj"))


def adj_counts(pairs: DataFrame) -> DataFrame:
    """Pairs per (lower noun, community, adjective, is_direct)."""
    return (pairs.groupBy(F.lower("noun").alias("org_lower"), "subreddit", "adj", "is_direct")
            .agg(F.count(F.lit(1)).alias("adj_count")))


# ------------------------------------------------------------ E7 - E11

def org_adj_join(orgs: DataFrame, adjs: DataFrame) -> DataFrame:
    """Left outer equi-join; organizations without adjectives stay."""
    return orgs.join(adjs, ["org_lower", "subreddit"], "left")


def _sorted_adjs(is_direct: bool) -> Column:
    # sort by count desc, ties by adjective asc, via a codegen'd struct order
    picked = F.collect_list(F.when(F.col("is_direct") == F.lit(is_direct),
                                   F.struct((-F.col("adj_count")).alias("k"), F.col("adj"),
                                            F.col("adj_count").alias("count"))))
    return F.transform(F.sort_array(picked), lambda s: F.struct(s["adj"].alias("adj"), s["count"].alias("count")))


def _ranked(prof: DataFrame, sort: bool) -> DataFrame:
    return prof.orderBy(F.desc("numNoun"), F.desc("noun"), F.desc("subreddit")) if sort else prof


def short_profile(joined: DataFrame, sort: bool = True) -> DataFrame:
    """E8-E11 where the lists are short (``top_adjs``): grouping keeps the join's
    key, so the join's partitioning is reused."""
    prof = (joined.groupBy("org_lower", "subreddit")
            .agg(F.first("org").alias("noun"), F.first("count").alias("numNoun"),
                 _sorted_adjs(True).alias("directAdj"), _sorted_adjs(False).alias("connectedAdj"))
            .select("noun", "subreddit", F.col("numNoun").cast("bigint").alias("numNoun"),
                    "directAdj", "connectedAdj"))
    return _ranked(prof, sort)


_ROW = "noun string, subreddit string, numNoun bigint, {0}, {1}".format(
    *(f"{c} array<struct<adj:string,count:bigint>>" for c in ("directAdj", "connectedAdj")))


def _lists(rows, piece: int | None):
    """Rows (org_lower, subreddit, kind, name, count) of whole groups, in order, as
    profiles; a group that does not begin with its organization has none."""
    import numpy as np
    import pyarrow as pa
    kind = rows.column("kind").to_numpy()
    starts = _starts(rows, None)
    owned = np.repeat(kind[starts] == 0, np.diff(np.append(starts, len(kind))))
    heads = starts[kind[starts] == 0]
    group = np.cumsum(np.isin(np.arange(len(kind)), heads)) - 1

    def nested(which):
        picked = np.flatnonzero(owned & (kind == which))
        ends = np.concatenate([[0], np.cumsum(np.bincount(group[picked], minlength=len(heads)))]) if len(heads) else [0]
        values = pa.StructArray.from_arrays([rows.column("name").take(pa.array(picked)), rows.column("count").take(pa.array(picked))],
                                            ["adj", "count"])
        return pa.ListArray.from_arrays(pa.array(np.asarray(ends, np.int32)), values)

    own = rows.take(pa.array(heads))
    columns = [own.column("name"), own.column("subreddit"), own.column("count"), nested(1), nested(2)]
    names = ["noun", "subreddit", "numNoun", "directAdj", "connectedAdj"]
    if piece is not None:
        columns, names = [*columns, pa.array(np.full(len(heads), piece, np.int32))], [*names, "piece"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _starts(rows, before: tuple | None):
    """Places where a group begins; ``before``: the key of the row before, if any."""
    import numpy as np
    import pyarrow.compute as pc
    n = rows.num_rows
    new = np.zeros(n, bool)
    for c in ("org_lower", "subreddit"):
        x = rows.column(c)
        a, b = x.slice(1), x.slice(0, n - 1)
        same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
        same |= pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
        new[1:] |= ~same
    first = (rows.column("org_lower")[0].as_py(), rows.column("subreddit")[0].as_py())
    new[0] = before is None or first != before
    return np.flatnonzero(new)


def _stream(piece_rows: int | None):
    """Sorted rows to profiles, one group after the other; held are the open
    group's rows, in Arrow buffers, at most ``piece_rows`` of them if it is given."""
    def run(batches):
        import pyarrow as pa
        held, key, count, piece = [], None, 0, 0

        def close():
            return _lists(pa.Table.from_batches(held).combine_chunks().to_batches()[0], piece if piece_rows else None)

        for b in batches:
            if not b.num_rows:
                continue
            starts = _starts(b, key).tolist()
            first, last = (starts[0], starts[-1]) if starts else (b.num_rows, None)
            at = 0
            while at < first:                                             # the open group goes on
                room = first - at if piece_rows is None else min(first - at, max(1, piece_rows - count))
                held.append(b.slice(at, room))
                count, at = count + room, at + room
                if piece_rows is not None and count >= piece_rows:
                    yield close()
                    held, count, piece = [held[0].slice(0, 1)], 0, piece + 1
            if last is None:
                continue
            if held and (count or not piece):
                yield close()
            if last > first:
                yield _lists(b.slice(first, last - first), 0 if piece_rows else None)
            held, count, piece = [b.slice(last)], b.num_rows - last - 1, 0
            key = (b.column("org_lower")[last].as_py(), b.column("subreddit")[last].as_py())
        if held and (count or not piece):
            yield close()
    return run


def org_profile(orgs: DataFrame, adjs: DataFrame, sort: bool = True, piece_rows: int | None = None) -> DataFrame:
    """T8 rows (noun, subreddit, numNoun, directAdj, connectedAdj) of
    organizations (E4) and counted adjectives (E6).

    A secondary sort in place of join, group and lists in an aggregation
    buffer: both sides are shuffled once by (org_lower, subreddit) and sorted (Spark's
    external sort), an organization before its adjectives, these by count; a
    task then cuts the stream into rows. No group is sorted or buffered in the JVM, and
    only the lists of one output row are held. With ``piece_rows`` an organization
    with more adjectives makes several rows, numbered by a column ``piece``, for
    rows beyond what one line should hold; readers of organizations take piece 0."""
    both = (orgs.select("org_lower", "subreddit", F.lit(0).alias("kind"), F.col("org").alias("name"), F.col("count").cast("bigint"))
            .unionByName(adjs.filter(F.col("org_lower").isNotNull() & F.col("subreddit").isNotNull()).select(
                "org_lower", "subreddit", F.when(F.col("is_direct"), 1).otherwise(2).alias("kind"), F.col("adj").alias("name"),
                F.col("adj_count").cast("bigint").alias("count"))))
    rows = both.repartition("org_lower", "subreddit").sortWithinPartitions("org_lower", "subreddit", "kind", F.desc("count"), "name")
    return _ranked(rows.mapInArrow(_stream(piece_rows), _ROW + (", piece int" if piece_rows else "")), sort)


def profile_from_tagged(tagged: DataFrame, skip_articles: bool = False, sort: bool = True,
                        flush_tail: bool = False, top: int | None = None, piece_rows: int | None = None) -> DataFrame:
    """E3-E11; ``top``: only the so many most frequent adjectives of each kind."""
    orgs, adjs = org_counts(tagged, flush_tail), adj_counts(adj_pairs(tagged, skip_articles, flush_tail))
    if top is not None:
        return short_profile(org_adj_join(orgs, top_adjs(adjs, top)), sort)
    return org_profile(orgs, adjs, sort, piece_rows)


def top_adjs(adjs: DataFrame, top: int) -> DataFrame:
    """The ``top`` most frequent adjectives of each (organization, community,
    kind); ranked within tasks before the shuffle, so no list grows with the
    corpus."""
    w = Window.partitionBy("org_lower", "subreddit", "is_direct").orderBy(F.desc("adj_count"), "adj")
    return adjs.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= top).drop("_rank")


# ------------------------------------------------------------ E12

def org_sentences(tagged: DataFrame, flush_tail: bool = False) -> DataFrame:
    """One row per comment with at least one mention; the sentence is the
    org-merged value sequence joined by one space."""
    sentence = F.col("sentence") if "sentence" in tagged.columns else merged_values("values", "ents")
    return (tagged.filter(F.size(_mentions(tagged, flush_tail)) > 0)
            .select("id", "subreddit", sentence.alias("sentence")))


# ------------------------------------------------------------ E1 / E2

def value_count(df: DataFrame, c: str) -> DataFrame:
    """Count of each value."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("count"))


def value_count_sorted(df: DataFrame, c: str) -> DataFrame:
    """E1 sorted by count descending (range-partitioned, not one task)."""
    return value_count(df, c).orderBy(F.desc("count"), F.asc(c))


# ------------------------------------------------------------ E13 - E20

def orgs_readback(profile_lines: DataFrame) -> DataFrame:
    """T8 JSON lines (``value``) -> (subreddit, org, count)."""
    v = jsonfn.parse("value")
    first = profile_lines.filter(jsonfn.long_field(v, "piece") == 0)        # later pieces repeat their organization
    return first.select(jsonfn.string_field(v, "subreddit").alias("subreddit"),
                        jsonfn.string_field(v, "noun").alias("org"),
                        jsonfn.long_field(v, "numNoun").alias("count"))


def sentence_tokens(sentence_lines: DataFrame) -> DataFrame:
    """T9 JSON lines (``value``) -> (subreddit, text ARRAY<STRING>)."""
    v = jsonfn.parse("value")
    return sentence_lines.select(
        *([c for c in ("id",) if c in sentence_lines.columns]),
        jsonfn.string_field(v, "subreddit").alias("subreddit"),
        lower_split(jsonfn.string_field(v, "sentence")).alias("text"))


def group_counts(sentences: DataFrame) -> DataFrame:
    """Comments (with a mention) per community."""
    return sentences.groupBy("subreddit").agg(F.count(F.lit(1)).alias("commentsNum"))


def group_counts_sorted(sentences: DataFrame) -> DataFrame:
    """E16."""
    return group_counts(sentences).orderBy(F.desc("commentsNum"), F.asc("subreddit"))


def groups_over_threshold(sentences: DataFrame, min_group_comments: int) -> DataFrame:
    """Communities with more than ``min_group_comments`` comments."""
    return group_counts(sentences).filter(F.col("commentsNum") > min_group_comments)


def orgs_over_threshold(orgs: DataFrame, groups: DataFrame, min_org_count: int) -> DataFrame:
    """Organizations of qualifying communities with count >= threshold
    (semi-join on the community; the group table is one row per community)."""
    return _in_groups(orgs.filter(F.col("count") >= min_org_count), groups)


def group_sentences(sentences: DataFrame, groups: DataFrame) -> DataFrame:
    """Sentences of qualifying communities."""
    return _in_groups(sentences, groups)


#: Communities whose names are sent to every task; beyond, a shuffled semi join.
FEW_GROUPS = 200_000


def _in_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Semi join on the community. The list, one row per community, is written
    once and broadcast if its counted rows are few, so that the texts of a hot
    community need not move."""
    names = materialize(groups.select(F.col("subreddit").alias("_group")).distinct(), "groups")
    if names.count() <= FEW_GROUPS:
        names = F.broadcast(names)
    return rows.join(names, F.col("subreddit").eqNullSafe(F.col("_group")), "left_semi")


def org_totals(orgs: DataFrame, min_org_count: int) -> DataFrame:
    """Totals over all communities by case-sensitive name, >= threshold."""
    return (orgs.groupBy("org").agg(F.sum("count").cast("bigint").alias("count"))
            .filter(F.col("count") >= min_org_count))
