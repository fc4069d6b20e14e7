import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lexispark.llm import blocknames as B


def brute(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, i))
    out = []
    for bare, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(bare.encode()).hexdigest()
        for m in members:
            d = rows[m[3]][0]
            out.append((d, rows[best[3]][0], len(members), sha, m[:3] == best[:3]))
    return sorted(out, key=str)


def rows():
    rng = random.Random(5)
    made = ["".join(rng.choices("ab \n\té😀", k=rng.randint(0, 30))) for _ in range(60)]
    out = [(i, t) for i, t in enumerate(made + [t.replace(" ", " \t") for t in made[:30]])]
    out += [(200 + i, "one hot text") for i in range(60)] + [(300, None), (301, ""), (302, " \x0b\x0c\r\n"), (303, " "), (304, "\x1c")]
    out += [(400, "x" * 20_000), (401, "x" * 19_999), (402, "x" * 10_000 + " " + "x" * 10_000)]
    return out


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [B.BLOCK, 256, 3])
def test_against_brute_force(frame, block):
    data = [r for r in rows() if block > 3 or len(r[1] or "") < 100]
    assert result(B.exact_dedup(frame(data), block=block)) == brute(data)


def test_fingerprints_that_collide_change_nothing(frame, monkeypatch):
    monkeypatch.setattr(B, "fingerprint", lambda block: F.length(block).cast("long"))
    data = [r for r in rows() if len(r[1] or "") < 100]
    assert result(B.exact_dedup(frame(data), block=4)) == brute(data)


def test_repeated_and_null_ids_keep_one_row_for_a_text(frame):
    data = [(7, "same"), (7, "same"), (None, "same"), (None, "sa me"), (7, "other"), (None, "alone"), (None, None)]
    out = B.exact_dedup(frame(data)).collect()
    kept = [r for r in out if r.kept]
    assert len(out) == 7 and len(kept) == len({r.text_sha256 for r in out}) == 4
    same = [r for r in out if r.group_size == 4]
    assert {r.keep_id for r in same} == {None} and sum(r.kept for r in same) == 1      # "sa me" has the most code points


def test_empty_table(frame):
    assert B.exact_dedup(frame([])).collect() == []


def test_no_python_in_the_plan(frame):
    plan = B.exact_dedup(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
