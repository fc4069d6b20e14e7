from lexispark.operators.annotate import TEST_LEXICON, Lexicon, annotate, annotation_strings

# The golden sentence and its annotation.
SENTENCE = "The large and very purple sports car is somewhat red and also not green. The plump singing duck was hungry."

# Fixture lexicon holding the words of the golden sentence.
GOLDEN = Lexicon(
    words={"the": ("DT", "the"), "large": ("JJ", "large"), "and": ("CC", "and"), "very": ("RB", "very"),
           "purple": ("JJ", "purple"), "sports": ("NNS", "sport"), "car": ("NN", "car"), "is": ("VBZ", "be"),
           "somewhat": ("RB", "somewhat"), "red": ("JJ", "red"), "also": ("RB", "also"), "not": ("RB", "not"),
           "green": ("JJ", "green"), "plump": ("JJ", "plump"), "singing": ("NN", "singing"),
           "duck": ("NN", "duck"), "was": ("VBD", "be"), "hungry": ("JJ", "hungry")},
    default_tag="NN",
)


def test_golden_annotation(spark):
    df = spark.createDataFrame([(SENTENCE,)], "body string")
    r = annotation_strings(annotate(df, "body", GOLDEN)).first()
    assert r["tokens"] == ("The large and very purple sports car is somewhat red and also not green . "
                           "The plump singing duck was hungry .")
    assert r["lemmas"] == ("the large and very purple sport car be somewhat red and also not green . "
                           "the plump singing duck be hungry .")
    assert r["tags"] == "DT JJ CC RB JJ NNS NN VBZ RB JJ CC RB RB JJ . DT JJ NN NN VBD JJ ."
    assert r["ents"] == " ".join(["O"] * 22)


def test_test_lexicon_rules(spark):
    df = spark.createDataFrame([("Ertion quickly was nicht 42 <b>x</b>, testing é",)], "body string")
    r = annotate(df, "body", TEST_LEXICON).first()
    assert r["tokens"] == ["Ertion", "quickly", "was", "nicht", "42", "x", ",", "testing"]
    assert r["tags"] == ["NNP", "RB", "VBD", "NN", "CD", "FW", ",", "VBG"]
    assert r["lemmas"] == ["Ertion", "quickly", "be", "nicht", "42", "x", ",", "testing"]
    assert r["ents"] == ["ORGANIZATION", "O", "O", "ORGANIZATION", "O", "O", "O", "O"]
    assert len(r["tokens"]) == len(r["tags"]) == len(r["lemmas"]) == len(r["ents"])


def test_tagger_backend(spark):
    from lexispark.operators.annotate import annotate_with_tagger

    def make():
        def tag(text):
            toks = text.split()
            return toks, [t.lower() for t in toks], ["NN"] * len(toks), ["O"] * len(toks)
        return tag

    df = spark.createDataFrame([("A b", 1)], "body string, id int")
    r = annotate_with_tagger(df, "body", make).first()
    assert r["tokens"] == ["A", "b"] and r["lemmas"] == ["a", "b"] and r["id"] == 1


def test_backends_agree(spark):
    from conftest import SF0001
    from lexispark.operators import orgs as O
    from lexispark.sources import tables
    c = tables.comments(spark, SF0001)
    cols = ["id", "tokens", "tags", "lemmas", "ents"]
    a = annotate(c, "body", TEST_LEXICON, backend="expr").select(cols)
    b = annotate(c, "body", TEST_LEXICON, backend="arrow").select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    from lexispark.operators.sequence import merged_values
    t1 = O.tagged_from_text(c, backend="expr").withColumn("sentence", merged_values("values", "ents"))
    t2 = O.tagged_from_text(c, backend="arrow")
    assert t1.exceptAll(t2).count() == 0 and t2.exceptAll(t1).count() == 0


def test_golden_annotation_arrow(spark):
    df = spark.createDataFrame([(SENTENCE,), (None,), ("",)], "body string")
    r = annotation_strings(annotate(df, "body", GOLDEN, backend="arrow")).collect()
    assert r[0]["tags"] == "DT JJ CC RB JJ NNS NN VBZ RB JJ CC RB RB JJ . DT JJ NN NN VBD JJ ."
    assert r[0]["lemmas"].startswith("the large and very purple sport car be")
    assert r[1]["tokens"] is None and r[2]["tokens"] == ""


def both(spark, lex, *texts):
    """Annotations by the two evaluations of the rule table, which must agree."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")
    cols = ["id", "tokens", "tags", "lemmas", "ents"]
    a, b = (sorted(annotate(df, "body", lex, backend=k).select(cols).collect()) for k in ("arrow", "expr"))
    assert a == b
    return a


def test_clitics_decimals_and_abbreviations(spark):
    lex = Lexicon(words={"car": ("NN", "car"), "'s": ("VBZ", "be"), "red": ("JJ", "red"), "n't": ("RB", "not"), "do": ("VB", "do")})
    a, b, c = both(spark, lex, "The car's red.", "I DON'T, don't", "Alpha Corp. has 3.5 of 1.2.3, Corporal. O'Neil 's")
    assert a["tokens"] == ["The", "car", "'s", "red", "."] and a["lemmas"][2] == "be"
    assert b["tokens"] == ["I", "DO", "N'T", ",", "do", "n't"] and b["lemmas"][-1] == "not"
    assert c["tokens"] == ["Alpha", "Corp.", "has", "3.5", "of", "1.2.3", ",", "Corporal", ".", "O", "'", "Neil", "'s"]
    assert c["tags"][3] == c["tags"][5] == "CD"


def test_phrases_and_priority_of_gazetteers(spark):
    lex = Lexicon(words={}, gazetteers=(("PLACE", ("New York", "york minster")), ("ORGANIZATION", ("Alpha Corp.", "York", "new york times"))))
    a, b, c, d = both(spark, lex, "The NEW York Times of York", "Alpha Corp. and Alpha, new", "York", "")
    assert a["ents"] == ["O", "PLACE", "PLACE", "ORGANIZATION", "O", "ORGANIZATION"]
    assert b["ents"] == ["ORGANIZATION", "ORGANIZATION", "O", "O", "O", "O"]
    assert c["ents"] == ["ORGANIZATION"] and d["ents"] == []


def test_suffix_lemmas(spark):
    lex = Lexicon(words={"news": ("NN", "news"), "was": ("VBD", "be")}, suffix_rules=(("s", "NN"),), proper_tag="NNP",
                  lemma_suffixes=(("ies", "y"), ("s", "")))
    (a,) = both(spark, lex, "Cities cars ponies news was Was")
    assert a["lemmas"] == ["Cities", "car", "pony", "news", "be", "be"]


def test_a_large_lexicon_annotates(spark):
    from lexispark.operators.annotate import annotate_with_table
    words = {f"word{i}": ("JJ" if i % 2 else "NN", f"lemma{i % 1000}") for i in range(50_000)}
    lex = Lexicon(words=words, default_tag="FW", gazetteers=(("ORGANIZATION", ("word7 word8",)),))
    texts = ["word1 Word49998 other .", "word7 word8 " + "word1 " * 5000, None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")
    cols = ["id", "tokens", "tags", "lemmas", "ents"]
    a = sorted(annotate(df, "body", lex).select(cols).collect())
    assert a[0]["tags"] == ["JJ", "NN", "FW", "."] and a[0]["lemmas"][:2] == ["lemma1", "lemma998"]
    assert a[1]["ents"][:3] == ["ORGANIZATION", "ORGANIZATION", "O"]
    table = spark.createDataFrame([(w, t, m) for w, (t, m) in words.items()], "word string, tag string, lemma string")
    rules = Lexicon(words={}, default_tag="FW", gazetteers=lex.gazetteers)
    assert sorted(annotate_with_table(df, "body", table, rules).select(cols).collect()) == a


def test_lexicon_from_files_through_the_job(spark, tmpdir_path):
    import json
    import os

    from lexispark.plans import jobs
    words = "\n".join(f"{w}\t{t}\t{m}" for w, (t, m) in GOLDEN.words.items()) + "\n-xyz\tVB\n"
    for name, text in (("words.tsv", words), ("orgs.txt", "sports car\nduck\n"), ("in.json", json.dumps({"body": SENTENCE}))):
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    at = lambda n: os.path.join(tmpdir_path, n)
    jobs.main(["nlp", "--input", at("in.json"), "--output", at("out"), "--lexicon", at("words.tsv"),
               "--gazetteer", f"ORGANIZATION={at('orgs.txt')}"])
    out = json.loads(spark.read.text(at("out")).first()[0])
    assert out["tags"] == "DT JJ CC RB JJ NNS NN VBZ RB JJ CC RB RB JJ . DT JJ NN NN VBD JJ ."
    assert out["lemmas"].startswith("the large and very purple sport car be") and out["ents"].count("ORGANIZATION") == 3
    jobs.main(["nlp", "--input", at("in.json"), "--output", at("tagged"), "--tagger", "lexispark.plans.demo:make_tagger"])
    assert json.loads(spark.read.text(at("tagged")).first()[0])["tags"].split() == ["NN"] * 20


def test_a_gazetteer_table_covers_as_a_lexicon_does(spark):
    """Both ways (trie, joins) against the lexicon's own phrases, on random texts."""
    import random

    from lexispark.operators.gazetteer import annotate_with_gazetteer
    rng = random.Random(1)
    words = ["a", "B", "c", "Dd", "E", "."]
    phrases = [(label, " ".join(rng.choices(words[:5], k=rng.randint(1, 5)))) for label in ("P", "Q", "R") for _ in range(25)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(120)] + [None, "", "unknown words", "a"]
    lex = Lexicon(words={}, gazetteers=tuple((x, tuple(p for y, p in phrases if y == x)) for x in ("P", "Q", "R")))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string").repartition(3)
    want = {r["id"]: r["ents"] for r in annotate(df, "body", lex).collect()}
    table = spark.createDataFrame(phrases + [("other", "c"), ("P", "A b"), ("Q", ""), ("Q", None)], "label string, phrase string")
    want_ab = {r["id"]: r["ents"] for r in annotate(df, "body", Lexicon(words={}, gazetteers=(
        ("P", (*lex.gazetteers[0][1], "a b")), *lex.gazetteers[1:]))).collect()}
    for options in (dict(), dict(max_bytes=0), dict(max_bytes=0, few=0)):
        got = annotate_with_gazetteer(df, "body", table, ["P", "Q", "R"], Lexicon(words={}), **options)
        assert got.columns == ["id", "body", "tokens", "tags", "lemmas", "ents"]
        assert {r["id"]: r["ents"] for r in got.collect()} == want_ab
    none = annotate_with_gazetteer(df, "body", table.limit(0), ["P"], Lexicon(words={})).filter("size(array_distinct(ents)) > 1")
    assert none.count() == 0 and want != {}


def test_a_million_phrases_annotate(spark):
    from pyspark.sql import functions as F

    from lexispark.operators.gazetteer import annotate_with_gazetteer
    n = F.col("id")
    table = spark.range(1_000_000).select(F.lit("ORGANIZATION").alias("label"), F.concat_ws(
        " ", F.concat(F.lit("w"), n % 9973), F.concat(F.lit("x"), F.floor(n / 9973)), F.when(n % 2 == 0, F.lit("Inc"))).alias("phrase"))
    df = spark.createDataFrame([(0, "the W5 x7 of"), (1, "w6 x8 w4 X0 inc . w4 x0"), (2, "x7 w5 x101")], "id int, body string")
    got = {r["id"]: r["ents"] for r in annotate_with_gazetteer(df, "body", table, ["ORGANIZATION"], Lexicon(words={})).collect()}
    org = lambda i, a: (["ORGANIZATION"] * 2 if (i + 9973 * a) % 2 else ["O"] * 2)
    assert got[0] == ["O", *org(5, 7), "O"] and got[2] == ["O", "O", "O"]
    assert got[1] == [*org(6, 8), *["ORGANIZATION"] * 3, "O", "O", "O"]


def test_a_taggers_error_is_its_rows_own(spark, tmpdir_path):
    """A tagger that fails on one text of a thousand, and on one with ragged lists."""
    import json
    import os

    from lexispark.operators.annotate import annotate_with_tagger
    from lexispark.plans import jobs

    def make():
        def tag(text):
            if text == "bad":
                raise ValueError("cannot read this")
            words = text.split()
            return words, words, ["NN"] * len(words), ["O"] * (len(words) - (text == "ragged one"))
        return tag

    texts = [f"text number {i}" for i in range(1000)]
    texts[500], texts[501], texts[502] = "bad", "ragged one", None
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string").repartition(3)
    for max_bytes in (1, 100, 1 << 20):
        rows = {r["id"]: r for r in annotate_with_tagger(df, "body", make, max_bytes=max_bytes).collect()}
        assert len(rows) == 1000 and {i for i, r in rows.items() if r["tagger_error"]} == {500, 501}
        assert rows[500]["tagger_error"] == "tagger failed: ValueError: cannot read this" and rows[500]["tokens"] is None
        assert rows[7]["tokens"] == ["text", "number", "7"] and rows[502]["tokens"] == []
    lines = [json.dumps({"id": str(i), "body": t}) for i, t in enumerate(texts)]
    at = lambda n: os.path.join(tmpdir_path, n)
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(at("in"))
    jobs.nlp(spark, at("in"), at("out"), make_tagger=make)
    out = [json.loads(r[0]) for r in spark.read.text(at("out")).collect()]
    errors = [x for x in out if "error" in x]
    assert len(out) == 1000 and sorted(json.loads(x["raw"])["id"] for x in errors) == ["500", "501"]


def test_a_tagger_is_made_once_for_a_worker(spark):
    from lexispark.operators.annotate import annotate_with_tagger

    def make():
        import os
        import time
        made = f"{os.getpid()}:{time.time_ns()}"
        return lambda text: ([made], [made], ["NN"], ["O"])

    df = spark.range(400).selectExpr("id", "'x' AS body").repartition(16)
    made = {r["tokens"][0] for r in annotate_with_tagger(df, "body", make).select("tokens").collect()}
    assert len(made) == len({m.split(":")[0] for m in made})


def test_nlp_needs_a_lexicon_or_a_tagger(spark, tmpdir_path):
    import pytest

    from lexispark.plans import jobs
    with pytest.raises(ValueError):
        jobs.nlp(spark, "in", tmpdir_path)
    with pytest.raises(SystemExit):
        jobs.main(["nlp", "--input", "in", "--output", tmpdir_path])


def test_arrow_works_in_steps_of_bounded_text():
    import pyarrow as pa
    from lexispark.operators.annotate import STEP_BYTES, _arrow_annotator
    texts = [None, "", "The very large Thtion was <b>red</b>. " * 3, None, "Attion is able 4.2 " * 5000] * 40 + ["", None]
    b = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "body": pa.array(texts, pa.string())})
    assert b.column("body").nbytes > 3 * STEP_BYTES
    steps = list(_arrow_annotator(TEST_LEXICON, "body", True)(iter([b])))
    sizes = [sum(len(x or "") for x in s.column("body").to_pylist()) for s in steps]
    assert len(steps) > 3 and all(n <= STEP_BYTES or s.num_rows == 1 for n, s in zip(sizes, steps, strict=True))
    whole = list(_arrow_annotator(TEST_LEXICON, "body", True, max_bytes=1 << 40)(iter([b])))
    single = list(_arrow_annotator(TEST_LEXICON, "body", True, max_bytes=1)(iter([b])))
    assert len(whole) == 1 and max(s.num_rows for s in single[2:]) <= 5
    for some in (steps, single):
        assert pa.Table.from_batches(some).combine_chunks().equals(pa.Table.from_batches(whole).combine_chunks())


def test_first_of_words_that_differ_by_case():
    import pyarrow as pa
    from lexispark.operators.annotate import _arrow_annotator
    lex = Lexicon(words={"May": ("NNP", "May"), "may": ("MD", "might")}, default_tag="NN")
    b = pa.RecordBatch.from_pydict({"body": pa.array(["may MAY day"])})
    out = next(_arrow_annotator(lex, "body", False)(iter([b])))
    assert out.column("tags").to_pylist() == [["NNP", "NNP", "NN"]]
    assert out.column("lemmas").to_pylist() == [["May", "May", "day"]]


def test_runs_in_two_texts_are_shared(spark):
    from lexispark.plans.queries import _shared_runs
    rows = [(1, ["a", "b", "a", "b"]), (1, ["a", "b", "c"]), (2, ["b", "c"]), (None, ["x", "y"]), (None, ["x", "y"]),
            (None, ["b", "a"]), (3, ["c"]), (4, None)]
    got = _shared_runs(spark.createDataFrame(rows, "id long, tokens array<string>"), 2, "L")
    assert sorted(map(tuple, got.collect())) == [("L", "b a"), ("L", "b c")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_a_block_of_texts_meets_its_phrases_once(spark):
    """Repeated runs move once a block, and rows come back as they were."""
    from lexispark.operators import gazetteer as G
    import pyarrow as pa
    b = pa.RecordBatch.from_pydict({"body": pa.array(["a B a b", None, "b a b"]), "_block": pa.array([7, 7, 8])})
    rows = [tuple(r.values()) for x in G._runs("body", [1, 2])(iter([b])) for r in x.to_pylist()]
    assert sorted(rows) == [(7, "a"), (7, "a b"), (7, "b"), (7, "b a"), (8, "a"), (8, "a b"), (8, "b"), (8, "b a")]
    df = spark.createDataFrame([(1, "x a b"), (1, "x a b"), (None, None), (2, "")], "id int, body string")
    table = spark.createDataFrame([("P", "A b"), ("Q", "x"), ("Q", "a b")], "label string, phrase string")
    got = G.annotate_with_gazetteer(df, "body", table, ["P", "Q"], Lexicon(words={}), max_bytes=0, few=0).collect()
    assert sorted([str(r["id"]), r["ents"]] for r in got) == [["1", ["Q", "P", "P"]], ["1", ["Q", "P", "P"]], ["2", []], ["None", None]]


def test_packed_runs_are_those_of_the_definition(spark, monkeypatch):
    """F2 of round 4: shared runs of all lengths in one pass, packed by bucket; repeated and null
    ids, several buckets and several pieces of a task."""
    import random

    from pyspark.sql import functions as F

    from lexispark.operators import gazetteer as G
    from lexispark.operators.annotate import tokens_of
    from lexispark.plans.queries import _shared_runs
    rng = random.Random(4)
    words = ["a", "B", "don't", "Dd", "3.5", "Corp.", "é", "x" * 40]
    rows = [(rng.choice([None, *range(30)]), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for _ in range(60)]
    rows += [(1, None), (2, ""), (None, "only here twice"), (None, "only here twice"), (50, "one text twice"), (50, "one text twice")]
    df = spark.createDataFrame(rows, "id long, body string").repartition(3)
    tokens = df.select("id", F.transform(tokens_of("body"), F.lower).alias("tokens"))
    want = sorted(tuple(r) for n, label in ((3, "P"), (2, "Q")) for r in _shared_runs(tokens, n, label).collect())
    assert len(want) > 50
    for held, runs in ((4 << 20, 1_000_000), (200, 20)):
        monkeypatch.setattr(G, "HELD_BYTES", held)
        monkeypatch.setattr(G, "BUCKET_RUNS", runs)
        for texts, col in ((df, "body"), (tokens, "tokens")):
            assert sorted(map(tuple, G.shared_runs(texts, col, {3: "P", 2: "Q"}).collect())) == want
    assert G.shared_runs(df.limit(0), "body", {2: "Q"}).collect() == []
    plan = G.shared_runs(df, "body", {3: "P", 2: "Q"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("FlatMapGroupsInArrow") == 1
    # what is found of them, by a trie, by a broadcast and packed in several buckets, some without phrases
    table = spark.createDataFrame([*want, ("Q", "nowhere met"), ("P", "don't"), ("Q", "Corp. é 3.5 B")], "label string, phrase string")
    found = [sorted((str(r["id"]), str(r["body"]), r["ents"] or []) for r in G.annotate_with_gazetteer(df, "body", table, ["P", "Q"], Lexicon(words={}), **kw).collect())
             for kw in ({}, {"max_bytes": 0}, {"max_bytes": 0, "few": 0})]
    assert found[0] == found[1] == found[2] and any("P" in x[2] for x in found[0])
