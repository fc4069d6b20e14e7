import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexispark.llm import langid as G
from lexispark.llm.queries import op10_language_id

SF001 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op10_language_id(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def corpus(spark):
    random.seed(0)
    parts = {"x": ["ka", "ko", "zu", "ri"], "y": ["the", "ing", "ous", "ent"], "ж": ["жа", "бо", "щи"]}
    rows = [(i, " ".join("".join(random.choices(parts[lang], k=3)) for _ in range(random.randint(3, 40))), lang)
            for i, lang in enumerate(random.choices(list(parts), k=300))]
    rows += [(400, None, "x"), (401, "", "y"), (402, "123 !! \n", "y"), (403, "kakozu rizuka", None), (None, "ingous theent", "y"),
             (404, "ouse" * 30_000, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1)).repartition(3)


def test_small_corpus_and_und(spark):
    docs = corpus(spark)
    model = G.fit(docs, F.col("doc_id") < 200)
    got = {r.doc_id: r for r in G.identify(docs, model).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (400, 401, 402))
    assert got[403].lang_pred == "x" and got[None].lang_pred == "y"
    rest = [i for i in truth if i is not None and 200 <= i < 300]
    assert sum(got[i].lang_pred == truth[i] for i in rest) >= 0.97 * len(rest)


def test_accept_drops_und_and_keeps_columns(spark):
    docs = corpus(spark)
    out = G.accept(docs, G.fit(docs, F.lit(True)))
    assert out.columns == docs.columns
    ids = {r.doc_id for r in out.collect()}
    assert not ids & {400, 401, 402} and len(ids) >= 300


def test_the_sample_is_bounded_and_the_model_deterministic(spark):
    docs = corpus(spark)
    a, b = (G.fit(docs.repartition(n), F.lit(True), per_lang=20, landmarks=5) for n in (1, 4))
    assert len(a.basis) == 15 and (a.weights == b.weights).all()


def test_nothing_to_learn_from(spark, frame):
    docs = frame([(1, "abc"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    model = G.fit(docs, F.lit(True))
    assert model is None and {r.lang_pred for r in G.identify(docs, model).collect()} == {"und"}
    assert G.identify(frame([]), model).collect() == []


def test_texts_are_judged_within_bounded_memory(monkeypatch):
    """Kernel values of some texts at once; the parts change no language."""
    rng = random.Random(4)
    text = lambda parts, n: " ".join("".join(rng.choices(parts, k=3)) for _ in range(n))
    parts = {"x": ["ka", "ko", "zu", "ri"], "y": ["the", "ing", "ous", "ent"]}
    langs = ["x", "y"] * 40
    model = G.Model([text(parts[a], 30) for a in langs], langs, 8, 1e-3)
    texts = pa.array([text(parts["xy"[k % 2]], 350) for k in range(512)])
    tracemalloc.start()
    got, scores = G._predict(model, texts)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 40 and got == ["x", "y"] * 256
    monkeypatch.setattr(G, "STEP_TEXTS", 512)
    again, others = G._predict(model, texts)
    assert got == again and np.allclose(scores, others, atol=1e-5)
