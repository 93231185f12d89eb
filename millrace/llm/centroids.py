"""Centroid clustering with exact assignments, pruned by Ptolemy's inequality over pivot pairs."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.store import cut, ship

#: Components stay within this, so that a squared distance fits a long: 64 * (2 * LARGEST)^2.
LARGEST = 1 << 27
#: Vectors that are compared at a time.
ROWS = 2048
#: Twice the number of pivots is the number of pairs that give bounds.
PIVOTS = 8
#: Relative error allowed for a bound worked out in doubles; it is a few units of 2^-53.
SLACK = 1e-14


def quantised(vectors: DataFrame, column: str, width: int, scale: int) -> DataFrame:
    """Rows with exactly `width` finite components, each turned into floor(scale * x)."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = (F.size(column) == width) & ~F.exists(column, odd)
    kept = vectors.where(F.coalesce(whole, F.lit(False)))
    cells = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return kept.withColumn(column, cells)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of a and b, one by one."""
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


def all_squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of a and all of a few rows b."""
    return np.stack([squared(a, row[None, :]) for row in b], axis=1)


def pivots_of(points: np.ndarray, count: int) -> np.ndarray:
    """Points far from each other: the first, then always the one farthest from those taken."""
    if not len(points):
        return points
    taken = [0]
    nearest = squared(points, points[:1])
    while len(taken) < count and nearest.max() > 0:
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(points, points[taken[-1:]]))
    return points[taken]


@dataclass(frozen=True)
class Pivots:
    """Fixed points and pairs of them; every pivot is in at most four pairs."""

    points: np.ndarray

    @cached_property
    def pairs(self) -> list[tuple[int, int, float]]:
        """(p, q, distance) of neighbours and next neighbours in a ring; all are distinct."""
        n = len(self.points)
        ring = {tuple(sorted((i, (i + k) % n))) for k in (1, 2) for i in range(n)}
        ring = sorted((p, q) for p, q in ring if p != q)
        return [(p, q, float(np.sqrt(squared(self.points[[p]], self.points[[q]])[0]))) for p, q in ring]

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(all_squared(vectors, self.points).astype(np.float64))

    def least(self, vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of distances (vectors, centroids) from distances to the pivots.

        For four points x, c, p, q of a Euclidean space Ptolemy's inequality gives
        d(x, c) d(p, q) >= |d(x, p) d(c, q) - d(x, q) d(c, p)|. What rounding may have added is
        taken off again, so a bound is never above the distance.
        """
        bound = np.zeros((len(vectors), len(centroids)))
        for p, q, apart in self.pairs:
            one = np.multiply.outer(vectors[:, p], centroids[:, q])
            two = np.multiply.outer(vectors[:, q], centroids[:, p])
            found = (np.abs(one - two) - SLACK * (one + two)) / apart
            np.maximum(bound, found, out=bound)
        return bound * (1 - SLACK)


def nearest(
    vectors: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each vector the nearest centroid, the exact squared distance, and how many were checked.

    The centroid of the least bound is checked first. Those whose bound isn't above its distance
    survive and are checked too; of equally near ones the smallest number is taken.
    """
    bound = pivots.least(cached, pivots.distances(centroids))
    rows = np.arange(len(vectors))
    first = bound.argmin(axis=1)
    best = squared(vectors, centroids[first])
    # The square of a bound, rounded down, against a distance rounded up.
    left = bound * bound * (1 - SLACK) <= (best.astype(np.float64) * (1 + SLACK))[:, None]
    left[rows, first] = True
    checked = left.sum(axis=1)
    cluster = np.full(len(vectors), len(centroids))
    for c in range(len(centroids)):
        on = np.flatnonzero(left[:, c])
        distance = squared(vectors[on], centroids[c : c + 1])
        nearer = (distance < best[on]) | ((distance == best[on]) & (c < cluster[on]))
        best[on[nearer]], cluster[on[nearer]] = distance[nearer], c
    return cluster, best, checked


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _assigned(batch: pa.RecordBatch, width: int, model):
    """Slices of a batch with vectors and what `nearest` says of them."""
    centroids, pivots = model.value
    vectors = _matrix(batch.column("cells"), width)
    cached = _matrix(batch.column("cached"), len(pivots.points))
    for lo in range(0, len(vectors), ROWS):
        part = slice(lo, lo + ROWS)
        yield lo, vectors[part], *nearest(vectors[part], cached[part], centroids, pivots)


def means(vectors: DataFrame, width: int, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The next centroids: floors of the exact means; a centroid without vectors stays.

    A task adds up its own vectors, so a row a centroid and task is shuffled.
    """
    model = vectors.sparkSession.sparkContext.broadcast((centroids, pivots))
    k = len(centroids)

    def add_up(batches):
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, part, cluster, _, _ in _assigned(batch, width, model):
                np.add.at(sums, cluster, part)
                counts += np.bincount(cluster, minlength=k)
        on = np.flatnonzero(counts)
        if len(on):
            yield pa.RecordBatch.from_arrays(
                [pa.array(on), pa.array(counts[on]), pa.array(list(sums[on]), pa.list_(pa.int64()))],
                ["cluster", "n", "sums"],
            )

    parts = vectors.select("cells", "cached").mapInArrow(
        add_up, "cluster long, n long, sums array<long>"
    )
    added = [
        F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)
    ]
    found = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect()
    moved = centroids.copy()
    for row in found:
        moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return moved


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    width: int = 64,
    scale: int = 256,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
    keep: Sequence[str] = ("vec_id",),
) -> DataFrame:
    """The kept columns of vectors, then cluster, distance, cluster_inertia, inertia,
    centroid_sha256 and n_checked.

    Vectors with exactly `width` finite components take part, as integers floor(scale * x).
    Centroids start as the k of them with the smallest SHA-256 of `seed:key`; each round moves
    every centroid to the floor of the mean of those it is nearest to. All distances that decide
    are exact integers. Most are never worked out: distances to a few pivots, farthest-first
    among the starting centroids, are stored with each vector once, and Ptolemy's inequality
    makes of them bounds that rule centroids out (see `Pivots.least`). n_checked is how many
    centroids were checked for a vector in the last assignment.

    What goes to tasks and to the driver is k centroids and their sums. Vectors are never
    shuffled, so equal ones do no harm.

    Other vectors, null ones included, are left out. With fewer than k vectors there are as many
    centroids; of equally near ones, the smaller number is taken. A null key counts as "" in the
    hash, and equal keys start in the order of their components. Repeated rows are vectors of
    their own. An empty table gives no rows. Components beyond 2^27 raise an error, as their
    distances wouldn't fit a long. Kept columns with the names of results are replaced.
    """
    spark = ship(vectors.sparkSession)
    own = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_checked")
    keep = [c for c in keep if c not in own]
    cells = quantised(
        vectors.select(F.struct(*keep).alias("row"), F.col(key).alias("key"), F.col(column).alias("cells")),
        "cells",
        width,
        scale,
    )
    cells = cells.withColumn(
        "cells",
        F.when(F.exists("cells", lambda x: F.abs(x) > LARGEST), F.raise_error(
            F.lit(f"a component is beyond {LARGEST} / {scale}"))).otherwise(F.col("cells")),
    )
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    start = cells.select("cells", F.sha2(named, 256).alias("hash")).orderBy("hash", "cells").limit(k)
    centroids = np.array([r["cells"] for r in start.collect()], np.int64).reshape(-1, width)
    pivots = Pivots(pivots_of(centroids, PIVOTS))
    shared = spark.sparkContext.broadcast(pivots)

    def measured(batches):
        for batch in batches:
            values = _matrix(batch.column("cells"), width)
            found = [shared.value.distances(values[lo : lo + ROWS]) for lo in range(0, len(values), ROWS)]
            lists = pa.array([row for part in found for row in part], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "cached"])

    cells = cells.select("row", "cells")
    schema = T.StructType([*cells.schema.fields]).add(
        "cached", T.ArrayType(T.DoubleType())
    )
    measured_cells = cut(cells.mapInArrow(measured, schema), "centroids-vectors")
    for _ in range(rounds if len(centroids) else 0):
        moved = means(measured_cells, width, centroids, pivots)
        if (moved == centroids).all():
            break
        centroids = moved
    model = spark.sparkContext.broadcast((centroids, pivots))

    def label(batches):
        for batch in batches:
            for lo, part, number, distance, checked in _assigned(batch, width, model):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(lo, len(part)),
                        pa.array(number, pa.int32()),
                        pa.array(distance),
                        pa.array(checked, pa.int64()),
                    ],
                    ["row", "cluster", "distance", "n_checked"],
                )

    schema = T.StructType([measured_cells.schema["row"]]).add("cluster", "integer")
    schema = schema.add("distance", "long").add("n_checked", "long")
    labelled = cut(measured_cells.mapInArrow(label, schema), "centroids-labels")
    sums = labelled.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(r["d"] for r in sums)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame(
        [(r["cluster"], r["d"], total, digests[r["cluster"]]) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return labelled.join(F.broadcast(about), "cluster").select("row.*", *own)
