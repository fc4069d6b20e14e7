import os

from conftest import SF0001
from lexispark.operators import orgs as O
from lexispark.plans.queries import tagged
from lexispark.sources import tables
from lexispark.streaming.comments import start_counts


def test_streaming_counts_match_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    tables.comment_lines(spark, SF0001).select("value").repartition(3).write.text(src)
    q = start_counts(spark, src, os.path.join(tmpdir_path, "ckpt"), query_name="org_counts_test",
                     mode="complete")
    q.processAllAvailable()
    got = {(r["org_lower"], r["subreddit"]): r["count"] for r in spark.sql("SELECT * FROM org_counts_test").collect()}
    q.stop()
    want = {(r["org_lower"], r["subreddit"]): r["count"] for r in O.org_counts(tagged(spark, SF0001)).collect()}
    assert got == want and len(want) > 0
