import glob

from pyspark.sql import functions as F

from lexispark.plans.stages import FOLDER, materialize, materialize_by, of_value, remove_stages


def test_materialize_roundtrip(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("g"))
    out = materialize(df)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_clustered_stage_spreads_a_hot_value_and_keeps_odd_ones(spark):
    hot = spark.range(20000).select(F.col("id"), F.lit("123").alias("subreddit"))
    odd = spark.createDataFrame([(30000, ""), (30001, None), (30002, "a/b=c%"), (30003, " ")], "id long, subreddit string")
    df = hot.unionByName(odd)
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}      # makes the split visible on test data
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        out = materialize_by(df.repartition(4), "subreddit")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, out.drop(FOLDER).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    for value, n in (("123", 20000), ("", 1), (None, 1), ("a/b=c%", 1), (" ", 1), ("none", 0)):
        got = of_value(out, "subreddit", value)
        assert got.columns == ["id", "subreddit"] and got.count() == n
    # inputFiles() lists every folder's files, whatever the filter: the hot value's own folder is asked for
    (folder,) = out.filter(F.col("subreddit") == "123").select(FOLDER).distinct().collect()
    files = [f for f in out.inputFiles() if f"/{FOLDER}={folder[0]}/" in f]
    assert len(files) > 1                                                # the hot value is written by several tasks


def test_stages_are_removed(spark):
    out = materialize(spark.range(3))
    path = out.inputFiles()[0].rsplit("/", 1)[0].replace("file:", "")
    assert glob.glob(path) and remove_stages(spark) >= 1 and not glob.glob(path)
