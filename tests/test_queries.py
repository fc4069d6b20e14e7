"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF0001  # noqa: E402

import __spark_entry__ as E  # noqa: E402

def test_every_query_has_an_oracle():
    from lexispark.plans.oracle import oracle
    from lexispark.plans.queries import REGISTRY
    assert set(REGISTRY) == set(oracle()) <= set(E.queries()) & set(E.oracle_sql())


def test_queries_match_oracle(spark):
    from compare import compare
    from lexispark.plans.oracle import oracle
    names = sorted(oracle())
    res = compare(spark, SF0001, names)
    bad = {k: v for k, v in res.items() if not v.startswith("OK")}
    assert not bad, bad


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["noun", "subreddit", "numNoun", "directAdj", "connectedAdj"]
