"""Which pairs of sets get a search: none that links is lost, and those that can't link cost no text."""

import random

import numpy as np
import pytest

from millrace.llm import jaccard


def near_sets(rng, n):
    """A set of shingle hashes and copies that differ from it, and from each other, here and there."""
    fresh = lambda k: rng.integers(1, 1 << 63, k, np.uint64)
    base = fresh(n)
    out = [np.unique(base)]
    for _ in range(12):
        part = base[rng.random(n) > rng.random() * 0.25]
        out.append(np.unique(np.concatenate([part, fresh(int(rng.integers(0, n // 6 + 2)))])))
    return [x for x in out if len(x)]


def overlap(a, b):
    return len(np.intersect1d(a, b))


@pytest.mark.parametrize("n", [1, 3, 9, 63, 64, 130, 1000])
def test_sketches_allow_every_link_and_few_others(n):
    rng = np.random.default_rng(n)
    sets = [s for _ in range(4) for s in near_sets(rng, n)]
    marks = [jaccard.sketch(s) for s in sets]
    kept = apart = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            may = jaccard.may_link(marks[i], len(a), marks[j], len(b))
            if jaccard._linked(overlap(a, b), len(a), len(b)):
                assert may
            elif not overlap(a, b):
                apart += 1
                kept += may
    assert n < 60 or kept * 100 < apart


@pytest.mark.parametrize("first", [0, 20])
def test_a_chain_holds_together_what_links(first):
    rng = np.random.default_rng(5)
    sets = [s for n in (40, 62, 66, 150) for s in near_sets(rng, n)]
    sets.sort(key=len)
    low, end = (first, first) if first else (1, len(sets))
    sizes = np.array([len(s) for s in sets])
    found = jaccard.chain(sizes, np.zeros(len(sets), int), [jaccard.sketch(s) for s in sets], low, end)
    label = list(range(len(sets)))
    for i, j in found:
        assert j < i and i >= low and j < end
        label = [label[j] if x == label[i] else x for x in label]
    assert len(found) == len(sets) - len(set(label))
    for i in range(low, len(sets)):
        for j in range(min(i, end)):
            if jaccard._linked(overlap(sets[i], sets[j]), sizes[i], sizes[j]):
                assert label[i] == label[j]


def test_parts_of_long_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 3)
    monkeypatch.setattr(jaccard, "LIST_PART", 7)
    monkeypatch.setattr(jaccard, "CELL", 5)
    rng = random.Random(6)
    base = [[f"{g}w{i}" for i in range(40)] for g in "ab"]
    texts = []
    for k in range(60):
        words = list(base[k % 2])
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(40)] = rng.choice("xyz")
        texts.append(" ".join(words[: rng.randint(30, 40)]))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    near = [[j for j in range(60) if j != i and linked(sets[i], sets[j])] for i in range(60)]
    label = list(range(60))
    for _ in range(60):
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in jaccard.jaccard_components(df).collect()}
    assert [found[i]["component_id"] for i in range(60)] == label
    assert [found[i]["n_links"] for i in range(60)] == [len(x) for x in near]


@pytest.mark.parametrize("many", [5, 40])
def test_texts_that_only_share_a_passage_are_not_moved(spark, monkeypatch, many):
    """Five texts make a list to pair, forty one to chain; 4 of 6 shingles are no link."""
    sought = []
    links = jaccard.links
    monkeypatch.setattr(jaccard, "links", lambda s, *rest: sought.append(s.count()) or links(s, *rest))
    rows = [(i, f"of all the words here most are alike {i}x") for i in range(many)]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["component_id"] for r in found.collect()) == list(range(many))
    assert sought == [0]
