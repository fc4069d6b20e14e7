"""Named batch jobs (H1-H4), chained through files.

    body_extract  comments JSON lines -> one body per line (or an error row)
    nlp           comments JSON lines -> comment + tokens/lemmas/tags/ents
    word_count    annotated lines     -> /orgs profiles, /orgsSentences, /errors
    word_to_vec   word_count output   -> /subreddits, /all, /orgSynonyms/<c>
    report        word_count + word_to_vec output -> two report tables
    vec_example   built-in sentences  -> embedding demo with its assertion

Run with ``spark-submit run_job.py JOB --input IN --output OUT
[--partitions N] [--profile local|prod] [--on-write-error raise|log]``. Options
are named. ``nlp`` takes a lexicon from files (``--lexicon words.tsv --gazetteer
LABEL=path ...``, see ``annotate.read_lexicon``) or a tagger (``--tagger
module:callable``, see ``annotate.annotate_with_tagger``), or ``--demo`` for the
lexicon of the test tables. ``word_count`` takes ``--skip-articles
--flush-tail --strict --raw-from --state --piece-rows``, ``report`` ``--min-count``. ``vec_example``
takes none. A job removes what it has staged when its output is written.
"""

from __future__ import annotations

import argparse
import hashlib
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import jsonfn
from ..operators import embed as E, orgs as O, report as R
from ..operators.annotate import (TEST_LEXICON, Lexicon, annotate, annotate_with_tagger, annotation_strings,
                                  read_gazetteer, read_lexicon)
from ..operators.gazetteer import annotate_with_gazetteer
from ..profile import Profile, by_name
from ..schemas import ORG_PROFILE, SYNONYMS
from ..sources import sinks
from ..sources.outputs import input_files, remove_folder, settle
from ..sources.text import read_comments, read_lines
from . import incremental
from .incremental import Counts
from .stages import materialize, materialize_by, remove_stages

ANNOTATIONS = ["tokens", "lemmas", "tags", "ents"]


def body_extract(spark: SparkSession, inp: str, out: str, partitions: int | None = None,
                 on_write_error: str = "raise") -> DataFrame:
    """The body of each comment, or ``{"error": ...}`` for a bad line."""
    c = read_comments(spark, inp, partitions)
    lines = c.select(F.when(F.col("error").isNull(), F.col("body"))
                     .otherwise(F.to_json(F.struct("error"))).alias("line"))
    sinks.guarded_write(lambda p: sinks.write_text(lines, "line", p), out, on_write_error)
    return lines


def nlp(spark: SparkSession, inp: str, out: str, partitions: int | None = None, lexicon: Lexicon | None = None,
        on_write_error: str = "raise", make_tagger=None, gazetteer: tuple[DataFrame, list[str]] | None = None) -> DataFrame:
    """Annotate each body, by a lexicon (its own gazetteers, or a table of
    phrases of any size, see ``read_gazetteer``) or by a tagger, and merge the four
    strings into the original object (unknown fields kept). A bad line, and a
    text that the tagger fails on, becomes ``{"error", "raw"}``."""
    if (lexicon is None) == (make_tagger is None):
        raise ValueError("annotation needs a lexicon or a tagger")
    c = read_comments(spark, inp, partitions)
    if make_tagger:
        a = annotate_with_tagger(c, "body", make_tagger)
    elif gazetteer:
        a = annotate_with_gazetteer(c, "body", *gazetteer, lexicon)
    else:
        a = annotate(c, "body", lexicon)
    said = F.col("tagger_error") if make_tagger else F.lit(None).cast("string")
    a = annotation_strings(a)
    merged = jsonfn.merge_fields("value", ANNOTATIONS)
    err = F.coalesce(F.col("error"), said, F.when(merged.isNull(), F.lit("not a JSON object")))
    lines = a.select(F.when(err.isNull(), merged)
                     .otherwise(F.to_json(F.struct(err.alias("error"), F.col("value").alias("raw"))))
                     .alias("line"))
    sinks.guarded_write(lambda p: sinks.write_text(lines, "line", p, escape=False), out, on_write_error)
    return lines


def word_count(spark: SparkSession, inp: str, out: str, partitions: int | None = None,
               skip_articles: bool = False, on_write_error: str = "raise", flush_tail: bool = False,
               strict: bool = False, raw_from: str = "lemmas", state: str | None = None,
               piece_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """T8 + T9 from annotated lines. Each comment's mentions, pairs and sentence
    are computed once, staged, and read by the branches. Malformed lines are counted
    by their error in /errors (with ``strict`` they fail the job). With ``state`` the
    job is incremental: only input files that it has not seen are read (see
    ``incremental``), and the outputs are those of all files."""
    settle(spark, inp)

    def counted(lines: DataFrame) -> Counts:
        tagged = materialize(_staged(O.tagged_from_annotated(lines, strict, raw_from), skip_articles, flush_tail), "tagged")
        good = tagged.filter(F.col("error").isNull())
        errors = tagged.filter(F.col("error").isNotNull()).groupBy("error").agg(F.count(F.lit(1)).alias("lines"))
        return Counts(O.casing_counts(good), O.adj_counts(O.adj_pairs(good)), O.org_sentences(good).select("subreddit", "sentence"), errors)

    if state is None:
        c = counted(read_lines(spark, inp, partitions))
    else:
        c = incremental.advance(spark, inp, state, lambda paths: counted(read_lines(spark, paths, partitions)),
                                f"{skip_articles} {flush_tail} {raw_from}")
    prof = O.org_profile(O.org_counts_of(c.casings), c.adjs, piece_rows=piece_rows)
    sinks.guarded_write(lambda p: sinks.write_json_lines(c.errors, p), f"{out}/errors", on_write_error)
    sinks.guarded_write(lambda p: sinks.write_json_lines(prof, p), f"{out}/orgs", on_write_error)
    sinks.guarded_write(lambda p: sinks.write_json_lines(c.sentences, p), f"{out}/orgsSentences", on_write_error)
    return prof, c.sentences


def _staged(lines: DataFrame, skip_articles: bool, flush_tail: bool) -> DataFrame:
    """``orgs.compact`` of annotated lines, with their error."""
    c = O.compact(lines.withColumn("subreddit", F.struct("subreddit", "error")), skip_articles, flush_tail)
    return c.select("id", "subreddit.subreddit", "subreddit.error", "mentions", "pairs", "sentence")


def word_to_vec(spark: SparkSession, inp: str, out: str, profile: Profile, partitions: int | None = None,
                on_write_error: str = "raise") -> DataFrame:
    """T10 + T13: community counts, whole-corpus and per-community synonyms. The
    communities' results are kept in a hidden folder of ``out`` until all are there, by
    the files they come from: a run that was cut off is resumed."""
    for folder in ("orgs", "orgsSentences"):
        settle(spark, f"{inp}/{folder}")
    files = input_files(spark, f"{inp}/orgs") + input_files(spark, f"{inp}/orgsSentences")
    ledger = f"{out}/_models/{hashlib.sha256(repr(files).encode()).hexdigest()[:32]}"
    orgs = materialize(O.orgs_readback(read_lines(spark, f"{inp}/orgs", partitions)), "orgs")
    sents = materialize(O.sentence_tokens(read_lines(spark, f"{inp}/orgsSentences", partitions)), "sentences")
    counts = O.group_counts_sorted(sents)
    sinks.guarded_write(lambda p: sinks.write_json_lines(counts, p), f"{out}/subreddits", on_write_error)
    all_syn = E.synonyms_all(sents, O.org_totals(orgs, profile.min_org_count), profile)
    sinks.guarded_write(lambda p: sinks.write_json_lines(all_syn, p), f"{out}/all", on_write_error)
    groups = materialize(O.groups_over_threshold(sents, profile.min_group_comments), "groups")
    # qualifying communities only, clustered: each fit reads little but its own
    by_group = E.synonyms_by_group(materialize_by(O.group_sentences(sents, groups), "subreddit", "group-sentences"),
                                   materialize_by(O.orgs_over_threshold(orgs, groups, profile.min_org_count),
                                                  "subreddit", "group-orgs"), groups, profile, ledger=ledger)
    by_group = materialize(by_group, "group-synonyms")
    written = sinks.guarded_write(lambda p: sinks.write_by_value(by_group, "subreddit", p), f"{out}/orgSynonyms", on_write_error)
    if written:
        remove_folder(spark, f"{out}/_models")
    return all_syn.unionByName(by_group)


def report(spark: SparkSession, word_count_out: str, word_to_vec_out: str, out: str,
           min_count: int = R.REPORT_MIN_COUNT, on_write_error: str = "raise",
           partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """T14 + T15 (A7/A8: many part files, whole-corpus and per-community
    synonyms read and unioned)."""
    for path in (f"{word_count_out}/orgs", f"{word_to_vec_out}/all", f"{word_to_vec_out}/orgSynonyms"):
        settle(spark, path)
    prof = spark.read.schema(ORG_PROFILE).json(f"{word_count_out}/orgs")
    adj = R.adjective_report(prof, min_count)
    syn_schema = SYNONYMS
    all_syn = spark.read.schema(syn_schema).json(f"{word_to_vec_out}/all")
    by_group = spark.read.json(f"{word_to_vec_out}/orgSynonyms",
                               schema="org string, count bigint, "
                                      "synonyms array<struct<word:string,similarity:double>>, subreddit string")
    syn = R.synonym_report(by_group.unionByName(all_syn))
    sinks.guarded_write(lambda p: sinks.write_report(adj, p, partitions=partitions), f"{out}/data-word-count", on_write_error)
    sinks.guarded_write(lambda p: sinks.write_report(syn, p, partitions=partitions), f"{out}/data-word-to-vec", on_write_error)
    return adj, syn


# The demo: two names that occur in the same company, each with each phrase.
EXAMPLE_NAMES = ("Gamma", "Delta")
EXAMPLE_PHRASES = ("{} sells tea in town", "people like how {} works", "they saw {} grow last year", "{} grows", "few know {} yet",
                   "{} opened a shop by the river")
EXAMPLE_SENTENCES = tuple(p.format(n) for p in EXAMPLE_PHRASES for n in EXAMPLE_NAMES)
EXAMPLE_PROFILE = Profile(vector_size=300, min_word_count=0, max_iter=50, seed=42, num_synonyms=20,
                          train_partitions=1)


def vec_example(spark: SparkSession, profile: Profile = EXAMPLE_PROFILE,
                sentences: tuple[str, ...] = EXAMPLE_SENTENCES) -> DataFrame:
    """Fit on literal sentences; the nearest word of Gamma must be Delta
    and the nearest of Delta must be Gamma."""
    docs = spark.createDataFrame([(s.split(" "),) for s in sentences], "text array<string>").coalesce(1)
    model = E.fit(docs, profile)
    vecs = E.word_vectors(model, spark)
    top = E.top_k_similar(vecs.select(F.col("word").alias("qid"), "vec"),
                          vecs.select(F.col("word").alias("cid"), "vec"), profile.num_synonyms)
    first = {r["qid"]: r["cid"] for r in top.filter((F.col("rank") == 1) & F.col("qid").isin("Gamma", "Delta"))
             .collect()}
    assert first.get("Gamma") == "Delta", f"Expected Delta, got: {first.get('Gamma')}"
    assert first.get("Delta") == "Gamma", f"Expected Gamma, got: {first.get('Delta')}"
    return top


JOBS = ("body_extract", "nlp", "word_count", "word_to_vec", "report", "vec_example")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lexispark-job")
    ap.add_argument("job", choices=JOBS)
    ap.add_argument("--input", help="input path (word_count output for report)")
    ap.add_argument("--input2", help="word_to_vec output (report only)")
    ap.add_argument("--output")
    ap.add_argument("--partitions", type=int, default=None)
    ap.add_argument("--profile", default="local", choices=["local", "prod"])
    ap.add_argument("--on-write-error", default="raise", choices=["raise", "log"])
    ap.add_argument("--skip-articles", action="store_true")
    ap.add_argument("--flush-tail", action="store_true")
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--raw-from", default="lemmas", choices=["lemmas", "tokens"])
    ap.add_argument("--state", help="folder of an incremental word_count")
    ap.add_argument("--piece-rows", type=int, default=None, help="adjectives of one output row (word_count)")
    ap.add_argument("--min-count", type=int, default=R.REPORT_MIN_COUNT)
    ap.add_argument("--lexicon", help="word table (nlp)")
    ap.add_argument("--gazetteer", action="append", default=[], metavar="LABEL=PATH")
    ap.add_argument("--tagger", metavar="MODULE:CALLABLE", help="makes the tagger (nlp)")
    ap.add_argument("--demo", action="store_true", help="annotate with the lexicon of the test tables (nlp)")
    a = ap.parse_args(argv)
    if a.job == "nlp" and [bool(a.lexicon), bool(a.tagger), a.demo].count(True) != 1:
        ap.error("nlp needs one of --lexicon, --tagger and --demo")
    if a.gazetteer and not a.lexicon:
        ap.error("gazetteers need a lexicon")
    from ..session import get_session
    spark = get_session(app=f"lexispark-{a.job}")
    if a.job == "body_extract":
        body_extract(spark, a.input, a.output, a.partitions, a.on_write_error)
    elif a.job == "nlp":
        lexicon = read_lexicon(spark, a.lexicon) if a.lexicon else TEST_LEXICON if a.demo else None
        nlp(spark, a.input, a.output, a.partitions, lexicon, a.on_write_error, _callable(a.tagger),
            read_gazetteer(spark, a.gazetteer) if a.gazetteer else None)
    elif a.job == "word_count":
        word_count(spark, a.input, a.output, a.partitions, a.skip_articles, a.on_write_error, a.flush_tail, a.strict,
                   a.raw_from, a.state, a.piece_rows)
    elif a.job == "word_to_vec":
        word_to_vec(spark, a.input, a.output, by_name(a.profile), a.partitions, a.on_write_error)
    elif a.job == "report":
        report(spark, a.input, a.input2, a.output, a.min_count, a.on_write_error, a.partitions)
    else:
        vec_example(spark).show(truncate=False)
    remove_stages(spark)
    return 0


def _callable(name: str | None):
    """``module:callable``; the module must be importable by the workers."""
    if not name:
        return None
    module, _, attribute = name.partition(":")
    import importlib
    return getattr(importlib.import_module(module), attribute)


if __name__ == "__main__":
    sys.exit(main())
