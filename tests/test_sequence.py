import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import model
from lexispark.functions.tags import encode_ents, encode_tags
from lexispark.operators.sequence import (combine_orgs, connected_pairs, direct_pairs, merged_values,
                                          org_mentions)

# The golden sentences, tags and entities of the operators.
GOLD_TAGS = "DT JJ CC RB JJ NNS NN VBZ RB JJ CC RB RB JJ . DT JJ NN NN VBD JJ .".split(" ")
D1_TOKENS = "the large and very purple sports car be somewhat red and also not green . the plump singing duck was hungry .".split(" ")
D2_TOKENS = "the large and very purple sports car be somewhat red and also not green . the plump singing duck be hungry .".split(" ")
ORG_ENTS = ("O O ORGANIZATION ORGANIZATION O O O O ORGANIZATION ORGANIZATION O O O O O ORGANIZATION "
            "ORGANIZATION O").split(" ")
ORG_TOKENS = "I think Alpha Corp. be lacking substance , Alpha Corp. needs restructuring , as does Gama Corp. .".split(" ")


def frame(spark, seqs):
    rows = [([t for t, _, _ in s], [v for _, v, _ in s], [e for _, _, e in s]) for s in seqs]
    df = spark.createDataFrame(rows, "tags array<string>, vals array<string>, ents array<string>")
    return df.withColumn("enc", encode_tags("tags", "vals")).withColumn("enc_ents", encode_ents("ents", "vals"))


def pairs_of(row_pairs):
    return [(p["is_direct"], p["noun"], p["adj"]) for p in row_pairs]


def run_all(spark, seqs, skip_articles=False, flush_tail=False):
    df = frame(spark, seqs).select(
        direct_pairs("enc", flush_tail).alias("d"), connected_pairs("enc", skip_articles, flush_tail).alias("c"),
        org_mentions("enc_ents", flush_tail).alias("m"), merged_values("vals", "ents").alias("s"),
        combine_orgs("tags", "vals", "vals", "ents").alias("k"), F.monotonically_increasing_id().alias("i"))
    return [r for r in df.orderBy("i").collect()]


def test_direct_golden(spark):
    seq = [(t, v, "O") for t, v in zip(GOLD_TAGS, D1_TOKENS)]
    (r,) = run_all(spark, [seq])
    assert sorted(pairs_of(r["d"])) == sorted([(True, "sports car", "large"), (True, "sports car", "very purple"),
                                               (True, "singing duck", "plump")])


def test_connected_golden(spark):
    seq = [(t, v, "O") for t, v in zip(GOLD_TAGS, D2_TOKENS)]
    (r,) = run_all(spark, [seq])
    assert sorted(pairs_of(r["c"])) == sorted([(False, "sports car", "somewhat red"),
                                               (False, "sports car", "also not green"),
                                               (False, "singing duck", "hungry")])


def test_orgs_golden(spark):
    seq = [("X", v, e) for v, e in zip(ORG_TOKENS, ORG_ENTS)]
    (r,) = run_all(spark, [seq])
    assert sorted(r["m"]) == sorted(["Gama Corp.", "Alpha Corp.", "Alpha Corp."])
    merged = [(x["value"], x["rawValue"], x["ent"]) for x in r["k"]]
    assert ("Alpha_Corp.", "Alpha_Corp.", "ORGANIZATION") in merged


def seq_of(spec, ent="O"):
    out = []
    for item in spec.split(" "):
        tag, value = item.split("/")
        out.append((tag, value, ent))
    return out


@pytest.mark.parametrize("spec,expected", [
    ("JJ/big NN/dog JJ/small NN/cat ./.", [(True, "cat", "big"), (True, "cat", "small")]),
    ("DT/the JJ/red NN/car", []),
])
def test_direct_derived(spark, spec, expected):
    (r,) = run_all(spark, [seq_of(spec)])
    assert sorted(pairs_of(r["d"])) == sorted(expected)


@pytest.mark.parametrize("spec,expected,expected_skip", [
    ("NN/car VBZ/be JJ/red NN/truck VBZ/be JJ/blue ./.", [(False, "car", "red truck"), (False, "car", "truck")], None),
    ("NN/dog VBZ/be NN/mammal ./.", [(False, "dog", "mammal")], None),
    ("NN/car VBZ/be DT/a JJ/red NN/truck ./.", [], [(False, "car", "red truck"), (False, "car", "truck")]),
    ("NN/car VBZ/run JJ/red ./.", [], None),
])
def test_connected_derived(spark, spec, expected, expected_skip):
    (r,) = run_all(spark, [seq_of(spec)])
    assert sorted(pairs_of(r["c"])) == sorted(expected)
    if expected_skip is not None:
        (r,) = run_all(spark, [seq_of(spec)], skip_articles=True)
        assert sorted(pairs_of(r["c"])) == sorted(expected_skip)


def test_org_tail(spark):
    seq = [("NN", "a", "O"), ("NN", "Alpha", "ORGANIZATION"), ("NN", "Corp", "ORGANIZATION")]
    (r,) = run_all(spark, [seq])
    assert r["m"] == []                                   # open run dropped (Q1)
    assert r["s"] == "a Alpha_Corp"                        # merged anyway (right fold)


TAGS = ["RB", "RBR", "JJ", "JJS", "CC", "NN", "NNS", "NNP", "VBZ", "VB", "VBD", "IN", "DT", "WRB", ".", "PRP"]
VALUES = ["be", "red", "car", "x", "Alpha", "run", "the"]


def random_seqs(rng, n, max_len=14):
    return [[(rng.choice(TAGS), rng.choice(VALUES), rng.choice(["O", "ORGANIZATION", "PERSON"]))
             for _ in range(rng.randint(0, max_len))] for _ in range(n)]


def check(spark, seqs):
    for skip, flush in ((False, False), (True, False), (True, True)):
        rows = run_all(spark, seqs, skip_articles=skip, flush_tail=flush)
        for s, r in zip(seqs, rows):
            assert pairs_of(r["d"]) == model.direct_pairs(s, flush), s
            assert pairs_of(r["c"]) == model.connected_pairs(s, skip, flush), (s, skip)
            assert r["m"] == model.org_mentions(s, flush), s
            merged = model.combine_orgs(s)
            assert [(x["tag"], x["value"], x["ent"]) for x in r["k"]] == merged, s
            assert r["s"] == " ".join(v for _, v, _ in merged), s


def test_random_sequences_agree_with_state_machines(spark):
    check(spark, random_seqs(random.Random(7), 3000))


token = st.tuples(st.sampled_from(TAGS), st.sampled_from(VALUES), st.sampled_from(["O", "ORGANIZATION"]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(token, max_size=25), min_size=1, max_size=60))
def test_property_sequences(spark, seqs):
    check(spark, seqs)


def test_long_runs_are_linear(spark):
    """Thousands of run tokens without a terminator must not backtrack
    quadratically (each case would take minutes if it did)."""
    import time
    n = 20000
    seqs = [[("NN", "n", "ORGANIZATION")] * n,                      # tail noun / org run
            [("RB", "r", "O")] * n + [("NN", "x", "O"), (".", ".", "O")],   # adverbs, no adjective
            [("NN", "n", "O")] * n + [("VBZ", "be", "O")] + [("RB", "r", "O")] * n,
            [("JJ", "j", "O"), ("NN", "n", "O")] * (n // 2)]
    t = time.time()
    rows = run_all(spark, seqs)
    assert time.time() - t < 60
    for s, r in zip(seqs, rows):
        assert pairs_of(r["d"]) == model.direct_pairs(s)
        assert pairs_of(r["c"]) == model.connected_pairs(s)
        assert r["m"] == model.org_mentions(s)


def test_long_terminated_runs_match_too(spark):
    """A run that is followed by what its pattern ends with is matched, not
    filtered out; matching must not recurse over its tokens."""
    n, dot = 20000, (".", ".", "O")
    be, adj, noun, adv = ("VBZ", "be", "O"), ("JJ", "j", "O"), ("NN", "n", "ORGANIZATION"), ("RB", "r", "O")
    seqs = [[adj] + [noun] * n + [dot], [noun, be] + [adj] * n + [dot], [noun] * n + [be, adj, dot], [adv] * n + [adj, noun, dot],
            [noun, be] + [adv] * n + [adj, dot], [noun] * n + [dot], [adj, noun] * (n // 2) + [dot], [noun, be] * (n // 2) + [dot]]
    for flush in (False, True):
        for s, r in zip(seqs, run_all(spark, seqs, flush_tail=flush)):
            assert pairs_of(r["d"]) == model.direct_pairs(s, flush)
            assert pairs_of(r["c"]) == model.connected_pairs(s, flush_tail=flush)
            assert r["m"] == model.org_mentions(s, flush)


def test_empty_words_of_organizations(spark):
    for values, expected in ((["", "a"], ["a"]), (["", ""], []), (["a", "", "b"], ["a  b"])):
        seq = [("NN", v, "ORGANIZATION") for v in values] + [(".", ".", "O")]
        (r,) = run_all(spark, [seq])
        assert r["m"] == expected == model.org_mentions(seq)
