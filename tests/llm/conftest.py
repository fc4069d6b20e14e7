import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
#: The same name as in the folder above: either file may be imported as ``conftest``.
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """docs(rows): rows of (doc_id, text), with extra columns whose names clash
    with the operators' own."""
    def make(rows, clash=True):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        if clash:
            for name in ("score", "key", "block", "n_lines", "ids", "kind", "a.b", "member"):
                df = df.withColumn(name, df["doc_id"] * 0 - 1)
        return df.repartition(3)
    return make
