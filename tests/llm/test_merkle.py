"""Merkle manifests against a plain tree, and on edge cases."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import merkle, sha256

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int"


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grown(nodes):
    """All levels of a tree, from its nodes to the one that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def climbed(levels, at, digest):
    """The siblings on the way up, and what the digest folds to."""
    siblings = ""
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
        siblings += "".join(d for i, d in enumerate(run) if i != at % 16)
        run[at % 16] = digest
        at, digest = at // 16, h("".join(run))
    return siblings, digest


def brute(rows, changed):
    """Counts of result rows, with `changed` a function of a row's values or None."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row[:5])
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grown([leaf(r) for r in sorted(groups[s], key=order)]) for s in names}
    forest = grown([trees[s][-1][0] for s in names])
    found = []
    for place, s in enumerate(names):
        for at, row in enumerate(sorted(groups[s], key=order)):
            new = changed(row) or leaf(row)
            low, digest = climbed(trees[s], at, new)
            high, digest = climbed(forest, place, digest)
            root = forest[-1][0]
            found.append((row[0], leaf(row), trees[s][-1][0], root, h(low + high), digest, digest == root))
    return sorted(found, key=str)


def proved(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, merkle.prove(docs, **options).collect()), key=str)


def test_blocks_against_the_standard_library():
    rng = np.random.default_rng(12)
    data = rng.integers(0, 256, (50, 4, 64)).astype(np.uint8)
    state = np.repeat(sha256.FRESH[:, None], 50, axis=1)
    for k in range(4):
        state = sha256.resumed(sha256.stored(state))
        state = sha256.compress(state, sha256.words(data[:, k]))
    state = sha256.compress(state, sha256.closing(np.full(50, 4)))
    found = [bytes(d).decode() for d in sha256.hexed(state)]
    assert found == [hashlib.sha256(d.tobytes()).hexdigest() for d in data]


@pytest.mark.parametrize("sizes", [(1,), (2,), (16,), (17,), (300, 1, 16), (5,) * 18, (1,) * 17])
def test_trees_of_many_shapes(spark, sizes):
    rows = [
        (100 * i + k, f"s{i}", "en", k, f"Text {i} {k}", "x", 1)
        for i, size in enumerate(sizes)
        for k in range(size)
    ]
    tampered = merkle.F.when(merkle.F.col("doc_id") % 3 == 0, merkle.F.sha2("text", 256))
    expected = brute(rows, lambda r: h(r[4]) if r[0] % 3 == 0 else None)
    found = proved(spark, rows, changed=tampered)
    assert found == expected
    assert [r[6] for r in found] == [r[0] % 3 != 0 for r in found]


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    rows = [
        (1, "a", None, None, None, "x", 1),
        (None, "a", "en", 1, "Ünï", None, None),
        (None, "a", "en", 1, "Ünï", None, None),
        (None, None, None, None, None, None, None),
        (2, None, "", 0, "", "x", 1),
        (2, "", "-", 0, "long " * 200_000, "x", 1),
        *[(7, "é", "en", 1, "same", "x", 1)] * 20,
        (9, "\U0001f600", "en", 1, "A", "x", 1),
        (8, "￿", "en", 1, "A", "x", 1),
    ]
    assert proved(spark, rows) == brute(rows, lambda r: None)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = merkle.prove(docs, keep=("doc_id", "leaf", "tree", "text"))
    assert kept.columns == ["doc_id", "tree", "text", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert kept.count() == len(rows) and merkle.prove(docs.limit(0)).count() == 0


def test_positions_are_gapless_over_tasks(spark):
    rows = spark.range(5000).selectExpr("id % 3 AS tree", "hash(id) AS k", "id")
    rows = rows.selectExpr("CASE WHEN tree = 0 THEN 'a' ELSE 'b' END AS tree", "k", "id")
    found = merkle.in_order(rows, "tree", ("k", "id")).collect()
    for tree in "ab":
        own = sorted((r for r in found if r["tree"] == tree), key=lambda r: r["pos"])
        assert [r["pos"] for r in own] == list(range(len(own)))
        assert [(r["k"], r["id"]) for r in own] == sorted((r["k"], r["id"]) for r in own)
        assert {r["n"] for r in own} == {len(own)}
