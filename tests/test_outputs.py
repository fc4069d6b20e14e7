"""Outputs that replace each other, folders per value, incremental counts."""

import collections
import glob
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from lexispark.operators.annotate import TEST_LEXICON
from lexispark.plans import incremental, jobs
from lexispark.sources import sinks, tables
from lexispark.sources.outputs import input_files, replace_output, settle


def values(spark, path):
    return sorted(r["v"] for r in spark.read.json(path).collect())


def hidden(path):
    return glob.glob(os.path.join(os.path.dirname(path), f"_*-{os.path.basename(path)}-*"))


def test_a_write_that_fails_leaves_the_old_output(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "out")
    sinks.write_json_lines(spark.createDataFrame([(1,), (2,)], "v long"), path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("in its middle"))).otherwise(F.col("id")).alias("v"))
    with pytest.raises(Exception):
        sinks.write_json_lines(broken, path)
    assert values(spark, path) == [1, 2] and hidden(path) == []
    assert sinks.guarded_write(lambda p: sinks.write_json_lines(broken, p), path, "log") is False
    assert values(spark, path) == [1, 2]
    sinks.write_json_lines(spark.createDataFrame([(3,)], "v long"), path)
    assert values(spark, path) == [3] and hidden(path) == []


def test_an_output_is_settled_after_a_driver_died(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "out")
    sinks.write_json_lines(spark.createDataFrame([(1,)], "v long"), path)
    # between the renames: the old output aside, the new one not in its place; and an unfinished run
    os.rename(path, os.path.join(tmpdir_path, "_old-out-1"))
    for name in ("_new-out-1", "_new-out-2"):
        spark.createDataFrame([(5,)], "v long").write.json(os.path.join(tmpdir_path, name))
    spark.createDataFrame([(7,)], "v long").write.json(os.path.join(tmpdir_path, "_new-output-3"))     # another output's
    settle(spark, path)
    assert values(spark, path) == [1] and hidden(path) == [] and os.path.isdir(os.path.join(tmpdir_path, "_new-output-3"))
    replace_output(spark, path, lambda p: spark.createDataFrame([(2,)], "v long").write.json(p))
    assert values(spark, path) == [2]


def test_folders_per_value_hold_few_files(spark, tmpdir_path):
    """2,000 communities, one with half of all rows: at most bytes / target + 1 files each."""
    path, target = os.path.join(tmpdir_path, "out"), 50_000
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c/"), F.col("id") % 4001)).alias("subreddit"),
                                      F.col("id").alias("v"), F.lit("x" * 40).alias("text"))
    odd = spark.createDataFrame([(None, 50_000, "null"), ("", 50_001, "empty")], "subreddit string, v long, text string")
    made = sinks.write_by_value(rows.unionByName(odd).repartition(6), "subreddit", path, target_bytes=target)
    folders = collections.defaultdict(list)
    for f in glob.glob(f"{path}/subreddit=*/part-*"):
        folders[os.path.dirname(f)].append(os.path.getsize(f))
    assert made == 1 and len(folders) >= 2000
    for files in folders.values():
        assert len(files) <= math.ceil((sum(files) + 30 * len(files)) / target) + 1
    hot = next(v for k, v in folders.items() if k.endswith("=hot"))
    assert len(hot) > 5 and max(hot) < 5 * target
    back = spark.read.schema("v long, text string, subreddit string").json(path)
    assert back.count() == 20_002 and back.filter("subreddit = 'hot'").count() == 10_000


def test_input_files_are_what_spark_reads(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "in")
    spark.range(10).repartition(3).write.json(path)
    found = input_files(spark, path)
    assert len(found) == 3 and all("/part-" in p and n > 0 for p, n, _ in found)


def test_an_incremental_run_reads_new_files_only(spark, tmpdir_path, monkeypatch):
    at = lambda n: os.path.join(tmpdir_path, n)
    corpus = tables.comment_lines(spark, SF0001).select("value")
    corpus.repartition(3).write.text(at("comments"))
    jobs.nlp(spark, at("comments"), at("nlp"), lexicon=TEST_LEXICON)
    parts = sorted(glob.glob(at("nlp") + "/part-*"))
    assert len(parts) == 3
    os.makedirs(at("grown"))

    def add(k):
        os.rename(parts[k], os.path.join(at("grown"), f"part-{k}"))

    read, real = [], jobs.read_lines
    monkeypatch.setattr(jobs, "read_lines", lambda s, paths, n=None: (read.append(paths), real(s, paths, n))[1])

    def outputs(folder):
        return [sorted(map(json.dumps, map(json.loads, (r[0] for r in spark.read.text(f"{at(folder)}/{name}").collect()))))
                for name in ("orgs", "orgsSentences")]

    add(0), add(1)
    with open(os.path.join(at("grown"), "part-bad"), "w") as f:
        f.write("{bad\n")
    jobs.word_count(spark, at("grown"), at("wc"), state=at("state"))
    add(2)
    read.clear()
    jobs.word_count(spark, at("grown"), at("wc"), state=at("state"))
    assert [[os.path.basename(p) for p in paths] for paths in read] == [["part-2"]]
    read.clear()
    jobs.word_count(spark, at("grown"), at("again"), state=at("state"))
    assert read == [] and outputs("again") == outputs("wc")
    jobs.word_count(spark, at("grown"), at("full"))
    assert outputs("wc") == outputs("full") and len(outputs("full")[0]) > 10
    assert spark.read.json(at("wc") + "/errors").collect() == spark.read.json(at("full") + "/errors").collect()

    # a batch that was cut off counts nothing
    spark.createDataFrame([("zzz", "s", "zzz", 5)], incremental.SCHEMAS.casings).write.parquet(at("state") + "/batch=cut/casings")
    assert incremental.merged(spark, at("state")).casings.filter("org_lower = 'zzz'").count() == 0
    with pytest.raises(ValueError, match="changed"):
        jobs.word_count(spark, at("grown"), at("wc"), state=at("state"), flush_tail=True)
    with open(os.path.join(at("grown"), "part-2"), "a") as f:
        f.write("{more\n")
    with pytest.raises(ValueError, match="changed"):
        jobs.word_count(spark, at("grown"), at("wc"), state=at("state"))
