from pyspark.sql import functions as F

from lexispark.operators import orgs as O



def tagged(spark, rows):
    """rows: (id, subreddit, [(tag, value, ent), ...])"""
    data = [(i, s, [t for t, _, _ in seq], [v for _, v, _ in seq], [e for _, _, e in seq]) for i, s, seq in rows]
    df = spark.createDataFrame(data, "id long, subreddit string, tags array<string>, values array<string>, "
                                     "ents array<string>")
    return O._encode(df)


def seq(spec):
    out = []
    for item in spec.split(" "):
        tag, value, ent = (item.split("/") + ["O"])[:3]
        out.append((tag, value, "ORGANIZATION" if ent == "G" else ent))
    return out


def test_profile_left_join_sort_and_casing(spark):
    rows = [
        (1, "cars", seq("JJ/big NN/Acme/G ./. JJ/big NN/acme/G ./. JJ/red NN/acme/G ./.")),
        (2, "cars", seq("JJ/big NN/acme/G ./. JJ/odd NN/acme/G ./.")),
        (3, "cars", seq("NN/Zeta/G ./.")),
        (4, "bikes", seq("NN/acme/G VBZ/be JJ/fast ./.")),
    ]
    prof = {(r["noun"], r["subreddit"]): r for r in O.profile_from_tagged(tagged(spark, rows)).collect()}
    acme = prof[("Acme", "cars")]                      # min display casing
    assert acme["numNoun"] == 5
    assert [(a["adj"], a["count"]) for a in acme["directAdj"]] == [("big", 3), ("odd", 1), ("red", 1)]
    assert acme["connectedAdj"] == []
    zeta = prof[("Zeta", "cars")]                      # kept without adjectives
    assert zeta["directAdj"] == [] and zeta["connectedAdj"] == []
    bikes = prof[("acme", "bikes")]
    assert [(a["adj"], a["count"]) for a in bikes["connectedAdj"]] == [("fast", 1)]
    order = [(r["numNoun"], r["noun"]) for r in O.profile_from_tagged(tagged(spark, rows)).collect()]
    assert order == sorted(order, reverse=True)


def test_sentences_and_thresholds(spark):
    rows = [(1, "a", seq("NN/x/G NN/y/G ./.")), (2, "a", seq("NN/x ./.")), (3, "b", seq("NN/x/G ./.")),
            (4, "a", seq("NN/z/G ./."))]
    s = O.org_sentences(tagged(spark, rows))
    assert sorted((r["id"], r["sentence"]) for r in s.collect()) == [(1, "x_y ."), (3, "x ."), (4, "z .")]
    over = O.groups_over_threshold(s, 1).collect()
    assert [r["subreddit"] for r in over] == ["a"]        # 2 > 1 kept, 1 > 1 dropped
    orgs = spark.createDataFrame([("a", "X", 3), ("a", "Y", 2), ("b", "X", 5)], "subreddit string, org string, count long")
    kept = O.orgs_over_threshold(orgs, O.groups_over_threshold(s, 1), 3).collect()
    assert [(r["subreddit"], r["org"]) for r in kept] == [("a", "X")]     # >= 3 kept
    tot = {r["org"]: r["count"] for r in O.org_totals(orgs, 5).collect()}
    assert tot == {"X": 8}


def test_annotated_lines_error_rows(spark):
    lines = spark.createDataFrame(
        [('{"subreddit":"s","tags":"NN VBZ","lemmas":"a b c","ents":"O O"}',),
         ('{bad',),
         ('{"subreddit":"s","tags":"NN VBZ JJ .","lemmas":"car be red .","ents":"O O O O"}',)], "value string")
    t = O.tagged_from_annotated(lines).orderBy("id").collect()
    assert t[0]["error"] is not None and t[0]["tags"] == []
    assert t[1]["error"] is not None
    assert t[2]["error"] is None and t[2]["tags"] == ["NN", "VBZ", "JJ", "."]
    pairs = O.adj_pairs(O.tagged_from_annotated(lines)).collect()
    assert [(p["noun"], p["adj"]) for p in pairs] == [("car", "red")]


def test_readback_goldens_and_large_counts(spark):
    lines = spark.createDataFrame([('{"noun":"Camero","subreddit":"cars","numNoun":2}',),
                                   ('{"noun":"Big","subreddit":"cars","numNoun":3000000000}',)], "value string")
    assert [tuple(r) for r in O.orgs_readback(lines).collect()] == [("cars", "Camero", 2), ("cars", "Big", 3_000_000_000)]
    lines = spark.createDataFrame([('{"sentence":"the sport car be red .","subreddit":"cars"}',)], "value string")
    (r,) = O.sentence_tokens(lines).collect()
    assert (r["subreddit"], r["text"]) == ("cars", ["the", "sport", "car", "be", "red", "."])


def test_compact_has_what_the_branches_read(spark):
    rows = [(1, "cars", seq("JJ/big NN/Acme/G ./. NN/acme/G VBZ/be JJ/fast ./.")), (2, "", seq("DT/the ./.")), (3, None, seq("NN/z/G ./."))]
    t = tagged(spark, rows)
    c = O.compact(t)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(O.mentions(c), O.mentions(t)) and same(O.adj_pairs(c), O.adj_pairs(t)) and same(O.org_sentences(c), O.org_sentences(t))
    assert same(O.profile_from_tagged(c), O.profile_from_tagged(t))


def test_top_adjectives_before_the_list(spark):
    rows = [(i, "c", seq(f"JJ/a{i % 15} NN/acme/G ./.")) for i in range(120)] + [(500, "c", seq("JJ/a3 NN/acme/G ./."))]
    (r,) = O.profile_from_tagged(tagged(spark, rows), top=10).collect()
    (full,) = O.profile_from_tagged(tagged(spark, rows)).collect()
    assert len(full["directAdj"]) == 15 and r["directAdj"] == full["directAdj"][:10] and r["directAdj"][0]["adj"] == "a3"


def test_semi_join_by_name_or_by_shuffle(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("b", 4)], "subreddit string, count long")
    groups = spark.createDataFrame([("a",), ("",), (None,)], "subreddit string")
    for few in (O.FEW_GROUPS, 0):
        monkeypatch.setattr(O, "FEW_GROUPS", few)
        assert sorted(r["count"] for r in O.group_sentences(rows, groups).collect()) == [1, 2, 3]


def test_raw_values_and_strict_lines(spark):
    import pytest
    good = '{"subreddit":"s","tokens":"Cars are","tags":"NNS VBP","lemmas":"car be","ents":"O O"}'
    lines = spark.createDataFrame([(good,)], "value string")
    assert O.tagged_from_annotated(lines).first()["raws"] == ["car", "be"]
    assert O.tagged_from_annotated(lines, raw_from="tokens").first()["raws"] == ["Cars", "are"]
    with pytest.raises(Exception, match="malformed annotated line"):
        O.tagged_from_annotated(spark.createDataFrame([("{bad",)], "value string"), strict=True).collect()


def _counted(spark, hot=400):
    import random
    rng = random.Random(6)
    orgs = [(f"o{i}", g, f"O{i}", rng.randint(1, 9)) for i in range(60) for g in ("a", "b", None, "")] + [("hot", "a", "Hot", 7)]
    adjs = {(f"o{rng.randint(0, 90)}", rng.choice(["a", "b", "c", None, ""]), f"x{rng.randint(0, 30)}", rng.random() < 0.5): rng.randint(1, 4)
            for _ in range(3000)} | {("hot", "a", f"y{i}", i % 3 == 0): i % 5 + 1 for i in range(hot)}
    return (spark.createDataFrame(orgs, "org_lower string, subreddit string, org string, count long").repartition(3),
            spark.createDataFrame([(*k, n) for k, n in adjs.items()],
                                  "org_lower string, subreddit string, adj string, is_direct boolean, adj_count long").repartition(5))


def test_streamed_profiles_are_the_joins_lists(spark):
    """E8/E9 as a secondary sort against join, group and collect_list."""
    orgs, adjs = _counted(spark)
    plain = lambda df: sorted(map(str, df.collect()))
    want = plain(O.short_profile(O.org_adj_join(orgs, adjs), sort=False))
    assert plain(O.org_profile(orgs, adjs, sort=False)) == want and len(want) == 241
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")              # groups over many batches
    try:
        assert plain(O.org_profile(orgs, adjs, sort=False)) == want
        pieces = O.org_profile(orgs, adjs, sort=False, piece_rows=50).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    whole = {}
    for r in sorted(pieces, key=lambda r: r["piece"]):
        row = whole.setdefault((r["noun"], r["subreddit"], r["numNoun"]), ([], []))
        row[0].extend(r["directAdj"])
        row[1].extend(r["connectedAdj"])
    got = sorted(str(O_row) for O_row in (__import__("pyspark").sql.Row(noun=k[0], subreddit=k[1], numNoun=k[2], directAdj=v[0], connectedAdj=v[1])
                                          for k, v in whole.items()))
    assert got == want and max(r["piece"] for r in pieces) == 7
    assert O.org_profile(orgs.limit(0), adjs, sort=False).count() == 0
    assert O.org_profile(orgs, adjs.limit(0), sort=False).filter("size(directAdj) + size(connectedAdj) > 0").count() == 0


def test_pieces_are_read_back_once(spark):
    lines = ['{"subreddit":"a","noun":"X","numNoun":9,"piece":%d}' % i for i in range(3)] + ['{"subreddit":"a","noun":"Y","numNoun":1}']
    got = O.orgs_readback(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted((r["org"], r["count"]) for r in got) == [("X", 9), ("Y", 1)]


def test_five_million_adjectives_of_one_key_stay_in_bounds():
    """The stream over one hot group, in batches as Spark gives them out: Arrow's
    peak of memory for 5,000,000 adjectives."""
    import pyarrow as pa
    n, size = 5_000_000, 10_000

    def batches():
        columns = [pa.array(x) for x in (["hot"], ["s"], [0], ["Hot"], [n])]
        yield pa.RecordBatch.from_arrays([*columns[:2], columns[2].cast(pa.int32()), *columns[3:]],
                                         names=["org_lower", "subreddit", "kind", "name", "count"])
        for lo in range(0, n, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(["hot"] * size), pa.array(["s"] * size), pa.array([1 if lo < n // 2 else 2] * size, pa.int32()),
                 pa.array([f"adjective{i}" for i in range(lo, lo + size)]), pa.array([n - i for i in range(lo, lo + size)])],
                names=["org_lower", "subreddit", "kind", "name", "count"])

    before = pa.total_allocated_bytes()
    (row,) = O._stream(None)(batches())
    assert row.num_rows == 1 and len(row.column("directAdj")[0]) == len(row.column("connectedAdj")[0]) == n // 2
    del row
    assert pa.default_memory_pool().max_memory() - before < 1 << 30
    made = [b.num_rows for b in O._stream(1_000_000)(batches())]
    assert made == [1] * 5
