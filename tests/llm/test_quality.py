import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import quality as Q
from lexispark.llm.queries import op1_quality

SF001 = "/root/testdata/sf0.01"


def test_labelled_documents_are_told_apart(spark):
    got = op1_quality(spark, SF001).join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id").collect()
    good, bad = [r.keep for r in got if r.quality == 1], [r.keep for r in got if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1
    toxic = [r.keep for r in got if r.quality == 1 and r.toxic == 1]
    assert np.mean(toxic) >= 0.95


class Fixed(Q.Classifier):
    """p is the number that the text begins with."""

    def __init__(self):
        pass

    def __call__(self, texts):
        return np.array([float((t or "0.5").split()[0]) for t in texts.to_pylist()])


def sites(spark):
    rng = np.random.default_rng(1)
    rows = []
    for h, (level, n) in enumerate([(0.9, 400), (0.2, 150), (0.5, 100), (0.1, 1), (0.8, 30)]):
        for _ in range(n):
            path = str(rng.integers(0, 3))
            p = float(np.clip(rng.normal(level + (0.05 if path == "0" else 0), 0.08), 0.01, 0.99))
            rows.append((len(rows), f"{p:.6f} text", f"h{h}", path))
    rows += [(9000, None, None, None), (9001, "0.3", None, "a"), (None, "0.7", "h0", "0"), (5, "0.4", "h0", "0")]
    return rows


def brute(rows, weight):
    p = np.array([float((t or "0.5").split()[0]) for _, t, _, _ in rows])
    m = p.mean()

    def strength(keys, parent):
        groups = {k: p[[x == k for x in keys]] for k in set(keys)}
        n, g = len(p), len(groups)
        within = sum(((v - v.mean()) ** 2).sum() for v in groups.values()) / (n - g)
        between = sum(len(v) * (v.mean() - parent(k)) ** 2 for k, v in groups.items())
        between = (between - (g - 1) * within) / (n - sum(len(v) ** 2 for v in groups.values()) / n)
        return min(1e6, max(1, within / between)) if between > 0 else 1e6

    hosts = [r[2] for r in rows]
    paths = [(r[2], r[3]) for r in rows]
    host_mean = {h: p[[x == h for x in hosts]].mean() for h in set(hosts)}
    k0, k1 = strength(hosts, lambda _: m), strength(paths, lambda k: host_mean[k[0]])
    logit = lambda x: np.log(x / (1 - x))
    out = []
    for i, r in enumerate(rows):
        h, q = p[[x == hosts[i] for x in hosts]], p[[x == paths[i] for x in paths]]
        at_host = (k0 * m + h.sum() - p[i]) / (k0 + len(h) - 1)
        at_path = (k1 * at_host + q.sum() - p[i]) / (k1 + len(q) - 1)
        out.append((r[0], p[i], at_host, at_path, 1 / (1 + np.exp(-(logit(p[i]) + weight * (logit(at_path) - logit(m)))))))
    return out


@pytest.mark.parametrize("site_rows", [Q.SITE_ROWS, 0])
def test_posteriors_are_those_of_the_formulas(spark, monkeypatch, site_rows):
    monkeypatch.setattr(Q, "SITE_ROWS", site_rows)
    spark.sparkContext.addPyFile(__file__)
    rows = sites(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string").withColumn("score", F.lit(9)).withColumn("p", F.lit(9))
    got = Q.quality(docs.repartition(4), Fixed(), weight=0.5).collect()
    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r.doc_id, r.doc_score, r.host_posterior, r.path_posterior, r.score) for r in got), key=key)
    want = sorted(brute(rows, 0.5), key=key)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1:] for g in got], [w[1:] for w in want], atol=1e-6)


def test_sparse_sites_shrink_and_large_ones_speak(spark):
    spark.sparkContext.addPyFile(__file__)
    docs = spark.createDataFrame(sites(spark), "doc_id long, text string, host string, path string")
    got = {r.doc_id: r for r in Q.quality(docs, Fixed()).collect()}
    assert got[0].host_posterior > 0.85 and got[450].host_posterior < 0.25
    alone = got[650]                                       # the host with one document: all prior
    assert abs(alone.host_posterior - np.mean([r.doc_score for r in got.values()])) < 0.05


def test_features_and_empty_inputs(spark, frame):
    import pyarrow as pa
    x = Q.features(pa.array(["", None, "A!! b$$ | 1.", "the the the", "x" * 100_000]))
    assert x.shape == (5, len(Q.FEATURES)) and np.isfinite(x).all() and not x[:2].any()
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 7)], "doc_id long, quality int")
    docs = frame([(1, "abc"), (2, None)]).withColumns({"host": F.lit("h"), "path": F.lit(None).cast("string")})
    model = Q.fit(docs, labels)
    assert model is None and [r.doc_score for r in Q.quality(docs, model).collect()] == [0.5, 0.5]
    assert Q.quality(docs.limit(0), model).collect() == []


def test_host_and_path(spark):
    h, p = Q.host_and_path(F.col("u"))
    got = spark.createDataFrame([("http://A.example.com/fr/825?x=1",), ("https://b.org",), (None,), ("not a url",)], "u string").select(
        h.alias("h"), p.alias("p")).collect()
    assert [tuple(r) for r in got][:2] == [("a.example.com", "fr"), ("b.org", "")] and got[2].h is None
