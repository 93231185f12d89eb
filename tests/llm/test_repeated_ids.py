"""Near duplicates where doc_ids repeat or are missing, in any order of rows."""

import random

import pytest

from millrace.llm import jaccard

A = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
NEAR_A = A + " upsilon"
B = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
Z = "the last text has nothing at all in common with any of the others here or elsewhere"
ROWS = [(1, A), (1, B), (2, NEAR_A), (3, B), (None, Z), (None, Z), (None, Z + " too"), (4, None), (4, " "), (None, "")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, n int")


@pytest.mark.parametrize("seed", range(3))
def test_one_of_each_group_stays(spark, seed):
    rows = ROWS[:]
    random.Random(seed).shuffle(rows)
    stay = jaccard.one_per_group(frame(spark, rows))
    assert stay.columns == ["doc_id", "text", "node", "n"]
    found = sorted(((r["doc_id"], r["text"]) for r in stay.collect()), key=str)
    worded = [r for r in found if r[1] and r[1].strip()]
    assert worded[0] == (1, A) and worded[1] == (1, B) and len(worded) == 3
    assert worded[2][0] is None and worded[2][1] in (Z, Z + " too")
    assert [r for r in found if r not in worded] == sorted([(4, None), (4, " "), (None, "")], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_components_do_not_depend_on_order(spark, seed):
    rows = [(1, A), (1, Z), (2, Z + " too"), (5, A), (None, Z), (None, B)]
    random.Random(seed).shuffle(rows)
    out = jaccard.jaccard_components(frame(spark, rows)).collect()
    found = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["n_links"]) for r in out)
    n = {t: len(t.split()) - 4 for t in (A, B, Z)}
    assert found == sorted(
        [("1", n[A], 1, 1), ("5", n[A], 1, 1), ("1", n[Z], 1, 2), ("2", n[Z] + 1, 1, 2), ("None", n[Z], 1, 2), ("None", n[B], None, 0)]
    )
