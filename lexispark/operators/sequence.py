"""Sequence operators over one comment's tagged sequence.

Every function returns a Column evaluated row by row: no shuffle, no Python.
The inputs are the encoded strings of ``functions.tags`` (``encode_tags`` for
D1/D2, ``encode_ents`` for D3). The regular expressions below restate the
left-to-right state machines exactly (see tests/test_sequence.py, which checks
them against a plain state machine on random sequences):

D1 direct pairs.  A maximal run of adverb/adjective/conjunction/noun tokens
    that is *followed by* any other token emits one pair per adjective in the
    run; the adjective is prefixed by the adverbs directly before it and the
    noun is the run's trailing noun run. A run at the end emits nothing
    unless ``flush_tail``.
D2 connected pairs. ``N+ B [RJC]* T`` (B = verb with value ``be``, T any
    other class) matched leftmost and non-overlapping; the terminator T is
    consumed. With ``flush_tail`` the end of the comment terminates too. Adjectives come from the middle part; a noun terminator also
    yields ``adj noun2`` and ``noun2``. With ``skip_articles`` determiners and
    prepositions inside the middle part are skipped instead of terminating.
D3 organization mentions: maximal runs of ORGANIZATION tokens followed by
    another token (tail run dropped unless ``flush_tail``), joined by space;
    empty values before the first word are skipped, and a run of nothing else
    is no mention.
D4 merged sequence: each run of ORGANIZATION tokens becomes one token whose
    value/rawValue are joined by ``_``; tag and entity of the first token win.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions._util import col
from ..functions.tags import ORGANIZATION, decode

TOK = "[^ ]*"  # the value part of one encoded token


# Every repeated group is possessive: it consumes a whole run, which keeps
# matching linear (nothing is retried inside a run) and iterative (a group that
# could backtrack is matched by recursion, as deep as the run is long). Unwanted
# matches are filtered afterwards.


def _adjectives(fragment: Column) -> Column:
    """Adjectives of a run: each J with the adverbs directly before it (an
    adverb run not followed by an adjective is consumed and dropped)."""
    m = F.regexp_extract_all(fragment, F.lit(f"(?: R{TOK})++(?: J{TOK})?| J{TOK}"), 0)
    return F.transform(F.filter(m, lambda x: x.contains(" J")), decode)


def direct_pairs(encoded, flush_tail: bool = False) -> Column:
    """D1 -> ARRAY<STRUCT<is_direct, noun, adj>>."""
    # each maximal run with the class letter of the token after it (if any)
    # (run tokens are R/J/C/N, so a trailing " <B|V|D|X>" is the terminator)
    m = F.regexp_extract_all(col(encoded), F.lit(f"(?: [RJCN]{TOK})++(?: [BVDX])?"), 0)
    if not flush_tail:
        m = F.filter(m, lambda x: x.rlike(" [BVDX]$"))
    runs = F.transform(m, lambda x: F.regexp_replace(x, " [BVDX]$", ""))

    def per_run(run: Column) -> Column:
        # up to the last token that is no noun, then nouns only
        nouns = F.regexp_extract(run, f"(?s)^(?:.* [RJC]{TOK})?+((?: N{TOK})*+)$", 1)
        return F.struct(decode(nouns).alias("noun"), _adjectives(run).alias("adjs"))

    # one noun for each run, then its pairs: nothing is matched again for each adjective
    found = F.filter(F.transform(runs, per_run), lambda r: r["noun"] != "")
    return F.flatten(F.transform(found, lambda r: _pairs(True, r["noun"], r["adjs"])))


def _pairs(is_direct: bool, noun: Column, adjs: Column) -> Column:
    return F.transform(adjs, lambda a: F.struct(F.lit(is_direct).alias("is_direct"), noun.alias("noun"), a.alias("adj")))


def connected_pairs(encoded, skip_articles: bool = False, flush_tail: bool = False) -> Column:
    """D2 -> ARRAY<STRUCT<is_direct, noun, adj>>."""
    mid = "[RJCD]" if skip_articles else "[RJC]"
    stop = "[^RJCD]" if skip_articles else "[^RJC]"
    end = f"(?: {stop}{TOK}|$)" if flush_tail else f" {stop}{TOK}"
    # every noun run is consumed; only those continuing "be ... terminator" count
    matches = F.filter(F.regexp_extract_all(
        col(encoded), F.lit(f"(?: N{TOK})++(?: B{TOK}(?: {mid}{TOK})*+{end})?"), 0),
        lambda x: x.contains(" B"))

    def per_match(m: Column) -> Column:
        whole = f"^((?: N{TOK})++) B{TOK}((?: {mid}{TOK})*+)(?: ({stop}{TOK}))?$"
        middle = F.regexp_extract(m, whole, 2)
        if skip_articles:
            middle = F.regexp_replace(middle, f" D{TOK}", "")
        return F.struct(decode(F.regexp_extract(m, whole, 1)).alias("noun"), _adjectives(middle).alias("adjs"),
                        F.regexp_extract(m, whole, 3).alias("term"))        # empty at the end of the comment

    def described(r: Column) -> Column:
        value = F.substring(r["term"], 2, 1 << 30)
        return F.when(r["term"].startswith("N"), F.concat(
            F.transform(r["adjs"], lambda a: F.concat(a, F.lit(" "), value)), F.array(value))).otherwise(r["adjs"])

    found = F.transform(F.transform(matches, per_match), lambda r: F.struct(r["noun"].alias("noun"), described(r).alias("adjs")))
    return F.flatten(F.transform(found, lambda r: _pairs(False, r["noun"], r["adjs"])))


def org_mentions(encoded_ents, flush_tail: bool = False) -> Column:
    """D3 -> ARRAY<STRING>."""
    m = F.regexp_extract_all(col(encoded_ents), F.lit(f"(?: G{TOK})++(?: O)?"), 0)
    if not flush_tail:
        m = F.filter(m, lambda x: x.endswith(" O"))
    return F.filter(F.transform(m, lambda x: F.ltrim(decode(F.regexp_replace(x, " O$", "")))), lambda x: x != "")


def _continues_org(ents: Column):
    """Predicate on (entity, index): this token continues an organization run."""
    return lambda e, i: (i > 0) & (e == ORGANIZATION) & (F.get(ents, i - 1) == ORGANIZATION)


def merged_values(values, ents) -> Column:
    """D4 values joined by one space: the sentence of E12."""
    values, ents = col(values), col(ents)
    cont = _continues_org(ents)
    pieces = F.transform(values, lambda v, i: F.concat(
        F.when(i == 0, F.lit("")).when(cont(F.get(ents, i), i), F.lit("_")).otherwise(F.lit(" ")),
        F.coalesce(v, F.lit(""))))
    return F.array_join(pieces, "")


def combine_orgs(tags, values, raw_values, ents) -> Column:
    """D4 -> ARRAY<STRUCT<tag, value, rawValue, ent>>."""
    tags, values, raw_values, ents = col(tags), col(values), col(raw_values), col(ents)
    cont = _continues_org(ents)
    keep = lambda arr: F.filter(arr, lambda x, i: ~cont(F.get(ents, i), i))
    none = F.array().cast("array<string>")
    merged_v = F.when(F.size(values) == 0, none).otherwise(F.split(merged_values(values, ents), " ", -1))
    merged_r = F.when(F.size(values) == 0, none).otherwise(F.split(merged_values(raw_values, ents), " ", -1))
    z = F.arrays_zip(keep(tags).alias("tag"), merged_v.alias("value"),
                     merged_r.alias("rawValue"), keep(ents).alias("ent"))
    return z
