"""Centroid clustering against plain integers, and on edge cases."""

import hashlib
import math

import numpy as np
import pytest

from millrace.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, cells int"


def brute(rows, k, rounds):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows]
    named = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    middle = [v for _, v in sorted(vectors, key=named)[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle] for _, v in vectors]
        return [min((d, c) for c, d in enumerate(row)) for row in far]

    for _ in range(rounds):
        near = assign()
        for c in range(len(middle)):
            own = [v for (_, v), (_, at) in zip(vectors, near, strict=True) if at == c]
            if own:
                middle[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near = assign()
    inertia = {c: sum(d for d, at in near if at == c) for _, c in near}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(
        (str(i), c, d, inertia[c], sum(inertia.values()), digest[c])
        for (i, _), (d, c) in zip(vectors, near, strict=True)
    )


def found(spark, rows, **options):
    vectors = spark.createDataFrame(rows, SCHEMA)
    out = centroids.cluster(vectors, **options).drop("n_checked").collect()
    return sorted((str(r[0]), *r[1:]) for r in out)


def blobs(n, groups, spread, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (groups, 64))
    return [
        (i, [float(np.float32(x)) for x in middles[i % groups] + rng.normal(0, spread, 64)], "c", 1)
        for i in range(n)
    ]


@pytest.mark.parametrize(("groups", "spread"), [(6, 0.05), (1, 1.0)])
def test_against_plain_integers(spark, groups, spread):
    rows = blobs(150, groups, spread, seed=13)
    assert found(spark, rows, k=9, rounds=3) == brute(rows, 9, 3)


def test_few_centroids_are_checked_where_vectors_form_groups(spark):
    rows = blobs(400, 12, 0.03, seed=14)
    out = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=24)
    checked = [r["n_checked"] for r in out.collect()]
    assert sum(checked) / len(checked) < 24 / 3


def test_bounds_are_never_above_the_distance():
    rng = np.random.default_rng(15)
    for scale in (1, 300, centroids.LARGEST):
        points = rng.integers(-scale, scale + 1, (60, 64))
        points = np.concatenate([points, points[:5], points[:5] + 1])
        pivots = centroids.Pivots(centroids.pivots_of(points, 8))
        assert all(apart > 0 for _, _, apart in pivots.pairs)
        least = pivots.least(pivots.distances(points), pivots.distances(points))
        exact = centroids.all_squared(points, points)
        for i in range(len(points)):
            for j in range(len(points)):
                assert least[i, j] <= math.sqrt(int(exact[i, j]))


def test_ties_repeats_and_vectors_left_out(spark):
    zero, one = [0.0] * 64, [1.0] + [0.0] * 63
    rows = [(i, v, None, None) for i, v in enumerate([zero, one] * 20)]
    rows += [(None, one, "c", 1), (None, zero, "c", 1), (3, zero, "c", 1)]
    odd = [(90, None, "c", 1), (91, [], "c", 1), (92, [1.0] * 63, "c", 1), (93, [None] + [1.0] * 63, "c", 1)]
    odd += [(94, [math.nan] * 64, "c", 1), (95, [math.inf] + [0.0] * 63, "c", 1), (96, [0.0] * 65, "c", 1)]
    assert found(spark, rows + odd, k=5, rounds=2) == brute(rows, 5, 2)
    assert found(spark, rows[:3] + odd) == brute(rows[:3], 40, 5)
    assert found(spark, odd) == [] and found(spark, rows[:0]) == []
    vectors = spark.createDataFrame(rows, SCHEMA)
    kept = centroids.cluster(vectors, keep=("vec_id", "cluster", "cells", "embedding"))
    assert kept.columns[:3] == ["vec_id", "cells", "embedding"] and kept.count() == len(rows)


def test_components_that_do_not_fit_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        found(spark, [(1, [1e9] * 64, "c", 1)])
