"""Registered queries: one per operator of the inventory, over the given
tables. Each takes (spark, sf_dir) and returns a DataFrame with scalar
columns (nested lists are rendered as ``adj=count|...`` strings so that the
SQL oracle can compare them). Parameters are fixed here, never tuned per run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import jsonfn
from ..functions.text import clean, java_split, lower_split, vocab_word
from ..operators import embed as E, orgs as O, report as R
from ..operators.annotate import PHRASE_LEXICON, TEST_LEXICON, annotate, annotation_strings
from ..operators.gazetteer import annotate_with_gazetteer, shared_runs
from ..operators.sequence import combine_orgs, connected_pairs, direct_pairs
from ..profile import LOCAL
from ..sources import tables
from .joins import sent_parts
from .stages import materialize, materialize_by

# Parameters of the registered queries (sized for the test tables).
# Words that occur at least ten times are embedded, as in the prod profile: MLlib
# holds a model's vectors on the driver, so their number must not follow the corpus'.
QUERY_PROFILE = LOCAL.with_(vector_size=32, num_synonyms=5, seed=42, min_word_count=10)
REPORT_MIN_COUNT = 2
TOPK = 5

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ----------------------------------------------------------------- shared

def tagged(spark: SparkSession, sf_dir: str, stage: bool = True) -> DataFrame:
    """The annotated corpus (nlp stage output). ``stage=True`` computes what the
    operators take from a comment once (mentions, pairs, sentence: less than its
    text) and writes that, for queries with several branches; a query with one
    branch streams the annotation straight into its operator."""
    t = O.tagged_from_text(tables.comments(spark, sf_dir).transform(spread))
    return materialize(O.compact(t), "tagged") if stage else t


def spread(df: DataFrame) -> DataFrame:
    """Repartition a plain scan only when it has fewer partitions than the
    cluster has cores (small files ahead of the CPU-heavy annotation). A large
    input already has enough splits and is not shuffled."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def annotated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nlp job's output as JSON lines (``id``, ``value``)."""
    a = annotation_strings(annotate(tables.comments(spark, sf_dir).transform(spread), "body", TEST_LEXICON))
    return a.select("id", F.to_json(F.struct("id", "subreddit", "body", "tokens", "lemmas", "tags", "ents"))
                    .alias("value"))


def flat_adjs(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda x: F.concat(x["adj"], F.lit("="), x["count"].cast("string"))), "|")


def profile(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    return O.profile_from_tagged(tagged(spark, sf_dir), sort=sort)


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.org_sentences(tagged(spark, sf_dir, stage=False))


# ----------------------------------------------------------------- A / B

@query("json_parse")
def q_json_parse(spark, sf_dir):
    v = jsonfn.parse("value")
    return tables.comment_lines(spark, sf_dir).select(
        F.variant_get(v, "$.id", "bigint").alias("id"),
        F.variant_get(v, "$.subreddit", "string").alias("subreddit"),
        F.variant_get(v, "$.body", "string").alias("body"))


@query("json_extract_string")
def q_json_extract_string(spark, sf_dir):
    v = jsonfn.parse("value")
    return tables.comment_lines(spark, sf_dir).select(
        "id", jsonfn.string_field(v, "body").alias("body"),
        jsonfn.string_field(v, "id").alias("id_text"),
        jsonfn.string_field(v, "missing").alias("missing"))


@query("json_extract_int")
def q_json_extract_int(spark, sf_dir):
    v = jsonfn.parse("props")
    return tables.table(spark, sf_dir, "events").select(
        "event_id", jsonfn.int_field(v, "k").alias("k"), jsonfn.int_field(v, "missing").alias("missing"))


@query("body_extract")
def q_body_extract(spark, sf_dir):
    return tables.comment_lines(spark, sf_dir).select("id", jsonfn.body("value").alias("body"))


@query("json_error_rows")
def q_json_error_rows(spark, sf_dir):
    lines = (tables.table(spark, sf_dir, "events").select(F.lit("events").alias("source"),
                                                          F.col("event_id").alias("line_id"),
                                                          F.col("props").alias("line"))
             .unionByName(tables.table(spark, sf_dir, "pages").select(
                 F.lit("pages").alias("source"), F.col("page_id").alias("line_id"), F.col("html").alias("line"))))
    return lines.select("source", "line_id", jsonfn.error_of("line").alias("error"),
                        jsonfn.int_field(jsonfn.parse("line"), "k").alias("k"))


@query("text_clean")
def q_text_clean(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").select("page_id", clean("html").alias("clean"))


@query("annotated_merge")
def q_annotated_merge(spark, sf_dir):
    lines = tables.comment_lines(spark, sf_dir).transform(spread)
    a = annotation_strings(annotate(lines.withColumn("body", jsonfn.body("value")), "body", TEST_LEXICON))
    merged = a.select(jsonfn.merge_fields("value", ["tokens", "lemmas", "tags", "ents"]).alias("m"))
    v = jsonfn.parse("m")
    return merged.select(
        F.variant_get(v, "$.id", "bigint").alias("id"),
        *[jsonfn.string_field(v, f).alias(f) for f in ("subreddit", "tokens", "lemmas", "tags", "ents")],
        F.size(F.json_object_keys("m")).alias("n_keys"))


@query("split_tokens")
def q_split_tokens(spark, sf_dir):
    parts = java_split("body")
    return tables.comments(spark, sf_dir).select(
        "id", F.size(parts).cast("bigint").alias("n_parts"), F.array_join(parts, "|").alias("parts"))


@query("tag_sequence")
def q_tag_sequence(spark, sf_dir):
    t = O.tagged_from_annotated(annotated_lines(spark, sf_dir))
    return t.select("id", "subreddit", F.size("tags").cast("bigint").alias("seq_len"),
                    *[F.array_join(c, "|").alias(c) for c in ("values", "tags", "ents")], "error")


# ----------------------------------------------------------------- C

def _annotated(spark, sf_dir):
    return annotation_strings(annotate(tables.comments(spark, sf_dir).transform(spread), "body", TEST_LEXICON))


@query("annotate_tokens")
def q_annotate_tokens(spark, sf_dir):
    a = annotate(tables.comments(spark, sf_dir).transform(spread), "body", TEST_LEXICON)
    return a.select("id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query("annotate_tags")
def q_annotate_tags(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "tags")


@query("annotate_lemmas")
def q_annotate_lemmas(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "lemmas")


@query("annotate_ents")
def q_annotate_ents(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "ents")


@query("annotate_full")
def q_annotate_full(spark, sf_dir):
    return _annotated(spark, sf_dir).select("id", "subreddit", "tokens", "lemmas", "tags", "ents")


# ----------------------------------------------------------------- D

def _pairs(t: DataFrame, col: F.Column) -> DataFrame:
    return (t.select("id", "subreddit", F.explode(col).alias("p"))
            .select("id", "subreddit", "p.is_direct", "p.noun", "p.adj"))


@query("direct_pairs")
def q_direct_pairs(spark, sf_dir):
    return _pairs(tagged(spark, sf_dir, stage=False), direct_pairs("enc"))


@query("connected_pairs")
def q_connected_pairs(spark, sf_dir):
    return _pairs(tagged(spark, sf_dir, stage=False), connected_pairs("enc"))


@query("org_mentions")
def q_org_mentions(spark, sf_dir):
    return O.mentions(tagged(spark, sf_dir, stage=False))


@query("combine_orgs")
def q_combine_orgs(spark, sf_dir):
    t = tagged(spark, sf_dir, stage=False)
    c = t.select("id", "subreddit", combine_orgs("tags", "values", "values", "ents").alias("seq"))
    return c.select("id", "subreddit", F.size("seq").cast("bigint").alias("n_merged"),
                    F.array_join(F.transform("seq", lambda x: x["value"]), " ").alias("sentence"),
                    F.array_join(F.transform("seq", lambda x: x["tag"]), " ").alias("tags"),
                    F.array_join(F.transform("seq", lambda x: x["ent"]), " ").alias("ents"))


# ----------------------------------------------------------------- E

@query("value_count")
def q_value_count(spark, sf_dir):
    return O.value_count(tables.table(spark, sf_dir, "events"), "event_type")


@query("value_count_sorted")
def q_value_count_sorted(spark, sf_dir):
    return O.value_count_sorted(tables.table(spark, sf_dir, "events"), "event_type")


@query("org_counts")
def q_org_counts(spark, sf_dir):
    return O.org_counts(tagged(spark, sf_dir, stage=False))


@query("adj_noun_union")
def q_adj_noun_union(spark, sf_dir):
    return O.adj_pairs(tagged(spark, sf_dir, stage=False))


@query("adj_counts")
def q_adj_counts(spark, sf_dir):
    return O.adj_counts(O.adj_pairs(tagged(spark, sf_dir, stage=False)))


@query("org_adj_join")
def q_org_adj_join(spark, sf_dir):
    t = tagged(spark, sf_dir)
    j = O.org_adj_join(O.org_counts(t), O.adj_counts(O.adj_pairs(t)))
    return j.select("org_lower", "subreddit", "org", "count", "adj",
                    F.when(F.col("is_direct"), "direct").when(~F.col("is_direct"), "connected").alias("adj_kind"),
                    F.coalesce("adj_count", F.lit(0)).alias("adj_count"))


@query("org_adj_profile")
def q_org_adj_profile(spark, sf_dir):
    return profile(spark, sf_dir).select(
        "noun", "subreddit", "numNoun",
        flat_adjs("directAdj").alias("directAdj"), flat_adjs("connectedAdj").alias("connectedAdj"))


@query("org_sentences")
def q_org_sentences(spark, sf_dir):
    return sentences(spark, sf_dir)


def orgs_table(spark, sf_dir, t: DataFrame | None = None) -> DataFrame:
    """word_to_vec stage input: /orgs lines read back (stage boundary)."""
    prof = O.profile_from_tagged(t if t is not None else tagged(spark, sf_dir), sort=False)
    lines = prof.select(F.to_json(F.struct("noun", "subreddit", "numNoun", "directAdj", "connectedAdj"))
                        .alias("value"))
    return O.orgs_readback(materialize(lines, "orgs"))


def sentence_table(spark, sf_dir, t: DataFrame | None = None) -> DataFrame:
    """word_to_vec stage input: /orgsSentences lines read back (stage boundary)."""
    s = O.org_sentences(t if t is not None else tagged(spark, sf_dir))
    lines = s.select("id", F.to_json(F.struct("subreddit", "sentence")).alias("value"))
    return O.sentence_tokens(lines)


def wc_orgs(spark, sf_dir, t: DataFrame | None = None) -> DataFrame:
    """(subreddit, org, count) of the word_count stage, columnar: the /orgs
    rows without their adjective lists (one row per organization count)."""
    t = t if t is not None else tagged(spark, sf_dir, stage=False)
    return O.org_counts(t).select("subreddit", "org", "count")


def wc_sentences(spark, sf_dir, t: DataFrame | None = None, stage: bool = True) -> DataFrame:
    """(id, subreddit, text) of the word_count stage, columnar."""
    t = t if t is not None else tagged(spark, sf_dir, stage=False)
    s = O.org_sentences(t).select("id", "subreddit", lower_split("sentence").alias("text"))
    return materialize(s, "sentences") if stage else s


def word_count_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Both word_count outputs from one annotation of the corpus."""
    t = tagged(spark, sf_dir)
    return materialize(wc_orgs(spark, sf_dir, t), "orgs"), wc_sentences(spark, sf_dir, t, stage=False)


@query("orgs_readback")
def q_orgs_readback(spark, sf_dir):
    return orgs_table(spark, sf_dir)


@query("sentence_tokens")
def q_sentence_tokens(spark, sf_dir):
    return sentence_table(spark, sf_dir).select(
        "id", "subreddit", F.size("text").cast("bigint").alias("n_tokens"), F.array_join("text", " ").alias("text"))


@query("group_counts")
def q_group_counts(spark, sf_dir):
    return O.group_counts(wc_sentences(spark, sf_dir, stage=False))


@query("group_counts_sorted")
def q_group_counts_sorted(spark, sf_dir):
    return O.group_counts_sorted(wc_sentences(spark, sf_dir, stage=False))


@query("groups_over_threshold")
def q_groups_over_threshold(spark, sf_dir):
    return O.groups_over_threshold(wc_sentences(spark, sf_dir, stage=False), QUERY_PROFILE.min_group_comments)


@query("orgs_over_threshold")
def q_orgs_over_threshold(spark, sf_dir):
    orgs, sents = word_count_tables(spark, sf_dir)
    groups = O.groups_over_threshold(sents, QUERY_PROFILE.min_group_comments)
    return O.orgs_over_threshold(orgs, groups, QUERY_PROFILE.min_org_count)


@query("group_sentences")
def q_group_sentences(spark, sf_dir):
    s = sentences(spark, sf_dir)
    groups = O.groups_over_threshold(s, QUERY_PROFILE.min_group_comments)
    return O.group_sentences(s, groups)


@query("org_totals")
def q_org_totals(spark, sf_dir):
    return O.org_totals(wc_orgs(spark, sf_dir), QUERY_PROFILE.min_org_count)


# ----------------------------------------------------------------- F

def _vectors(spark, sf_dir) -> DataFrame:
    """The ``embeddings`` table as (id STRING-comparable, vec ARRAY<DOUBLE>)."""
    return tables.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


@query("w2v_vocab")
def q_w2v_vocab(spark, sf_dir):
    s = wc_sentences(spark, sf_dir)
    words = E.word_vectors(E.fit(s, QUERY_PROFILE), spark).select("word")
    return words.join(E.vocabulary_counts(s, QUERY_PROFILE.min_word_count), "word")


@query("w2v_doc_vectors")
def q_w2v_doc_vectors(spark, sf_dir):
    s = wc_sentences(spark, sf_dir)
    model = E.fit(s, QUERY_PROFILE)
    vecs = E.word_vectors(model, spark)
    docs = materialize(E.doc_vectors(vecs, s, dims=QUERY_PROFILE.vector_size), "doc-vectors")
    # the definition, by joins: the mean of the vectors of a sentence's words, component by component
    words = docs.select("id", F.size("text").alias("n"), F.explode("text").alias("word"))
    dims = QUERY_PROFILE.vector_size
    parts = [materialize(words.join(part, "word").groupBy("id").agg(*E.component_sums(dims), F.first("n").alias("n")), "definition")
             for part in E.vector_parts(vecs, dims)]
    parts = reduce(DataFrame.unionByName, parts).groupBy("id").agg(
        F.array(*[F.sum(f"_x{i}") / F.first("n") for i in range(dims)]).alias("mean"))
    vocabulary = materialize(E.vocabulary_counts(s, QUERY_PROFILE.min_word_count).select("word"), "vocabulary")
    known = [materialize(words.join(part, "word", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("known")), "known")
             for part in sent_parts(vocabulary, "word", F.octet_length("word") + F.lit(64))]
    known = reduce(DataFrame.unionByName, known).groupBy("id").agg(F.sum("known").alias("known"))
    mean = F.coalesce("mean", F.transform("result", lambda _: F.lit(0.0)))
    off = F.aggregate(F.zip_with("result", mean, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: F.greatest(a, b))
    return docs.join(known, "id", "left").join(parts, "id", "left").select(
        "id", "subreddit", F.size("result").alias("dims"), F.coalesce("known", F.lit(0)).alias("known_words"),
        (off < 1e-5).alias("is_mean"))


@query("similar_topk")
def q_similar_topk(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    top = E.top_k_similar(v.select(F.col("id").alias("qid"), "vec"), v.select(F.col("id").alias("cid"), "vec"), TOPK)
    return top.select(F.col("qid").cast("bigint").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"),
                      F.col("cid").cast("bigint").alias("other_id"),
                      F.round("similarity", 4).alias("similarity"))


@query("mutual_nearest")
def q_mutual_nearest(spark, sf_dir):
    m = E.mutual_nearest(_vectors(spark, sf_dir))
    return m.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b"),
                    F.round("similarity", 4).alias("similarity"))


@query("w2v_oov")
def q_w2v_oov(spark, sf_dir):
    # an organization outside the vocabulary is one whose list is empty
    return synonyms_all(spark, sf_dir).select(
        "org", "count", vocab_word("org").alias("qword"), (F.size("synonyms") > 0).alias("in_vocab"))


def _flat_synonyms(df: DataFrame) -> DataFrame:
    """Training differs from run to run, so the words are not compared; what
    holds for any vectors is: the number of synonyms, their order, that they are
    different words and none the organization's own."""
    sims = F.transform("synonyms", lambda s: s["similarity"])
    names = F.transform("synonyms", lambda s: s["word"])
    return df.select("subreddit", "org", "count", F.size("synonyms").alias("n_synonyms"),
                     (F.reverse(F.array_sort(sims)) == sims).alias("descending"),
                     ((F.size(F.array_distinct(names)) == F.size(names))
                      & ~F.array_contains(names, vocab_word("org"))).alias("other_words"))


def synonyms_all(spark, sf_dir, tables_=None) -> DataFrame:
    orgs, sents = tables_ or word_count_tables(spark, sf_dir)
    return E.synonyms_all(sents, O.org_totals(orgs, QUERY_PROFILE.min_org_count), QUERY_PROFILE)


def synonyms_by_group(spark, sf_dir, tables_=None) -> DataFrame:
    orgs, sents = tables_ or word_count_tables(spark, sf_dir)
    groups = materialize(O.groups_over_threshold(sents, QUERY_PROFILE.min_group_comments), "groups")
    # only qualifying communities are staged, each where its fit finds it
    return E.synonyms_by_group(materialize_by(O.group_sentences(sents, groups), "subreddit", "group-sentences"),
                               materialize_by(O.orgs_over_threshold(orgs, groups, QUERY_PROFILE.min_org_count),
                                              "subreddit", "group-orgs"), groups, QUERY_PROFILE)


@query("w2v_synonyms_all")
def q_w2v_synonyms_all(spark, sf_dir):
    return _flat_synonyms(synonyms_all(spark, sf_dir))


@query("w2v_synonyms_by_group")
def q_w2v_synonyms_by_group(spark, sf_dir):
    return _flat_synonyms(synonyms_by_group(spark, sf_dir))


# ----------------------------------------------------------------- G

def flat_items(c: str, name: str = "adjective") -> F.Column:
    return F.array_join(F.transform(c, lambda x: F.concat(x[name], F.lit("="), x["count"].cast("string"))), "|")


@query("adjective_report")
def q_adjective_report(spark, sf_dir):
    t = tagged(spark, sf_dir)
    adjs = R.report_adjs(O.adj_counts(O.adj_pairs(t)))
    r = R.adjective_report(O.short_profile(O.org_adj_join(O.org_counts(t), adjs), sort=False), REPORT_MIN_COUNT)
    return r.select("id", "data.noun", "data.subreddit", "data.count",
                    flat_items("data.directAdjectives").alias("directAdjectives"),
                    flat_items("data.connectedAdjectives").alias("connectedAdjectives"))


@query("synonym_report")
def q_synonym_report(spark, sf_dir):
    t = word_count_tables(spark, sf_dir)
    both = synonyms_by_group(spark, sf_dir, t).unionByName(synonyms_all(spark, sf_dir, t))
    r = R.synonym_report(both)
    return r.select("id", "data.org", "data.subreddit", "data.count", F.size("data.synonyms").alias("n_synonyms"),
                    F.forall("data.synonyms", lambda x: F.round(x["similarity"], 4) == x["similarity"]).alias("rounded"))


@query("synonyms_of_vectors")
def q_synonyms_of_vectors(spark, sf_dir):
    """F8 and G5 over given vectors, so that words and similarities have an
    exact answer. A vector's id is its word; every seventh is asked for, and
    words that do not exist with them."""
    v = tables.table(spark, sf_dir, "embeddings")
    vecs = v.select(F.concat(F.lit("v_"), F.col("vec_id").cast("string")).alias("word"),
                    F.col("embedding").cast("array<double>").alias("vec"))
    orgs = v.filter(F.col("vec_id") % 7 == 0).select(
        F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit("None "), F.col("vec_id").cast("string")))
        .otherwise(F.concat(F.lit("V "), F.col("vec_id").cast("string"))).alias("org"),
        F.col("label").cast("bigint").alias("count"))
    r = R.synonym_report(E.synonyms_of(vecs, orgs, "all", TOPK))
    return r.select("id", "data.org", "data.subreddit", "data.count", F.array_join(F.transform(
        "data.synonyms", lambda x: F.concat(x["word"], F.lit("="), F.format_string("%.4f", x["similarity"]))), "|").alias("synonyms"))


@query("annotate_phrases")
def q_annotate_phrases(spark, sf_dir):
    """C4 with two gazetteers in priority order, one of phrases."""
    a = annotate(tables.comments(spark, sf_dir).transform(spread), "body", PHRASE_LEXICON)
    return annotation_strings(a).select("id", "ents")


def _shared_runs(texts: DataFrame, n: int, label: str) -> DataFrame:
    """A gazetteer made from the corpus: runs of ``n`` tokens in two texts or more. The
    definition, by DataFrame operations alone; ``shared_runs`` gives the same rows (tests)."""
    last = F.size("tokens") - n
    runs = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("tokens", i + 1, n), " ")))
    # two texts: two ids, of which one may be null; counted without a row for each (id, run)
    ids = texts.select("id", F.explode(runs).alias("phrase")).groupBy("phrase").agg(
        F.min("id").alias("a"), F.max("id").alias("b"), F.max(F.col("id").isNull()).alias("none"))
    return ids.filter((F.col("a") < F.col("b")) | (F.col("none") & F.col("a").isNotNull())).select(F.lit(label).alias("label"), "phrase")


@query("annotate_gazetteer")
def q_annotate_gazetteer(spark, sf_dir):
    """C4 with a gazetteer that is a table (130,000 phrases at sf0.01) of two
    labels in priority order."""
    docs = tables.comments(spark, sf_dir).transform(spread)
    gazetteer = shared_runs(docs.select("id", "body"), "body", {3: "PLACE", 2: "ORGANIZATION"})
    a = annotate_with_gazetteer(docs, "body", gazetteer, ["PLACE", "ORGANIZATION"], TEST_LEXICON)
    return annotation_strings(a).select("id", "ents")
