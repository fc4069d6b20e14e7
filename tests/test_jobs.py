import json
import os

from pyspark.sql import functions as F

from conftest import SF0001
from lexispark.operators.annotate import TEST_LEXICON
from lexispark.plans import jobs
from lexispark.profile import LOCAL
from lexispark.sources import tables


def test_job_chain(spark, tmpdir_path):
    corpus = os.path.join(tmpdir_path, "comments")
    lines = tables.comment_lines(spark, SF0001).select("value")
    bad = spark.createDataFrame([("{bad",), ('[1]',)], "value string")
    lines.unionByName(bad).write.text(corpus)

    bodies = jobs.body_extract(spark, corpus, os.path.join(tmpdir_path, "bodies"))
    assert bodies.count() == 202
    nlp_out = os.path.join(tmpdir_path, "nlp")
    jobs.nlp(spark, corpus, nlp_out, partitions=4, lexicon=TEST_LEXICON)
    ann = spark.read.text(nlp_out)
    assert ann.count() == 202
    errs = [json.loads(r["value"]) for r in ann.filter(F.col("value").contains('"error"')).collect()]
    assert len(errs) == 2 and all("raw" in e for e in errs)

    wc = os.path.join(tmpdir_path, "wc")
    prof, sents = jobs.word_count(spark, nlp_out, wc)
    assert spark.read.json(f"{wc}/orgs").count() == prof.count() > 0
    assert spark.read.json(f"{wc}/orgsSentences").count() == sents.count() > 0
    bad_lines = {r["error"]: r["lines"] for r in spark.read.json(f"{wc}/errors").collect()}
    assert sum(bad_lines.values()) == 2          # malformed annotated lines are counted, not lost

    wv = os.path.join(tmpdir_path, "wv")
    p = LOCAL.with_(vector_size=16, min_group_comments=5, num_synonyms=3)
    syn = jobs.word_to_vec(spark, wc, wv, p)
    assert syn.count() > 0
    assert spark.read.json(f"{wv}/subreddits").count() == 20
    assert os.path.isdir(f"{wv}/orgSynonyms")

    rep = os.path.join(tmpdir_path, "report")
    adj, synr = jobs.report(spark, wc, wv, rep, min_count=2)
    assert synr.count() > 0
    ids = [r["id"] for r in spark.read.json(f"{rep}/data-word-to-vec").collect()]
    assert sorted(ids) == list(range(len(ids)))


def test_cli_named_options(spark, tmpdir_path):
    corpus = os.path.join(tmpdir_path, "c")
    tables.comment_lines(spark, SF0001).select("value").write.text(corpus)
    out = os.path.join(tmpdir_path, "bodies")
    assert jobs.main(["body_extract", "--input", corpus, "--output", out, "--partitions", "4",
                      "--on-write-error", "log"]) == 0
    assert spark.read.text(out).count() == 200   # newlines inside a body are escaped (one line each)


def test_word_to_vec_with_odd_communities(spark, tmpdir_path):
    """Comments without a community pass the threshold like any others."""
    wc, wv = (os.path.join(tmpdir_path, n) for n in ("wc", "wv"))
    names = ["", "a/b=c", "cars"]
    sents = [json.dumps({"subreddit": n, "sentence": "acme be big and old ."}) for n in names for _ in range(4)]
    orgs = [json.dumps({"noun": "Acme", "subreddit": n, "numNoun": 3_000_000_000}) for n in names]
    for folder, lines in (("orgsSentences", sents), ("orgs", orgs)):
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(os.path.join(wc, folder))
    p = LOCAL.with_(vector_size=4, min_group_comments=2, num_synonyms=2, train_partitions=1)
    got = jobs.word_to_vec(spark, wc, wv, p).collect()
    assert sorted((r["subreddit"], r["org"], r["count"]) for r in got) == sorted(
        [(n, "Acme", 3_000_000_000) for n in names] + [("all", "Acme", 9_000_000_000)])


def test_a_failing_write_is_raised_or_logged(spark, tmpdir_path):
    import pytest

    from lexispark.sources import sinks
    taken = os.path.join(tmpdir_path, "taken")
    spark.range(1).write.parquet(taken)
    write = lambda p: spark.range(1).write.mode("error").parquet(p)
    with pytest.raises(Exception):
        sinks.guarded_write(write, taken)
    assert sinks.guarded_write(write, taken, "log") is False
    assert sinks.guarded_write(write, taken + "2", "log") is True


def test_flush_tail_and_report_options(spark, tmpdir_path):
    at = lambda n: os.path.join(tmpdir_path, n)
    line = {"subreddit": "s", "tags": "JJ NN VBZ JJ", "lemmas": "big acme be red", "ents": "O ORGANIZATION O O"}
    last = {"subreddit": "s", "tags": "JJ NN", "lemmas": "old acme", "ents": "O ORGANIZATION"}
    spark.createDataFrame([(json.dumps(x),) for x in (line, last)], "value string").write.text(at("in"))
    jobs.main(["word_count", "--input", at("in"), "--output", at("wc"), "--flush-tail"])
    (r,) = spark.read.json(at("wc") + "/orgs").collect()
    assert r["numNoun"] == 2 and {a["adj"] for a in r["directAdj"]} == {"big", "old"} and r["connectedAdj"][0]["adj"] == "red"
    jobs.main(["word_count", "--input", at("in"), "--output", at("wc2")])
    (r,) = spark.read.json(at("wc2") + "/orgs").collect()
    assert r["numNoun"] == 1 and [a["adj"] for a in r["directAdj"]] == ["big"] and not r["connectedAdj"]
