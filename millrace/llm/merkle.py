"""Merkle manifest of a dataset: hash trees by group, with proofs folded from stored states."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import sha256
from millrace.llm.store import cut, ship

FANOUT = 16
#: Of each level above a run: the state before the node's slot, and its siblings' digests.
STEP = "struct<state:binary,left:string,right:string>"
#: The states and steps of so many messages are worked on at once.
LANES = 1 << 13


def record(columns: Sequence[str | Column]) -> Column:
    """The digest of a row: of each column `-` if null, else its byte count, `:` and value."""
    fields = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def in_order(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """rows with `pos`, gapless from 0 within their tree, and `n`, the tree's rows.

    Rows are dealt by range of (tree, order) and sorted in each task, so a tree of any size
    spreads over tasks. A tree's part in a task begins where its parts in earlier tasks end;
    what is added up for that is one count for each tree and task that meet.
    """
    sorted_rows = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = cut(
        sorted_rows.withColumns(
            {"pos": F.monotonically_increasing_id(), "part": F.spark_partition_id()}
        ),
        "merkle-order",
    )
    counts = placed.groupBy(tree, "part").agg(F.min("pos").alias("first"), F.count("*").alias("k"))
    within = W.partitionBy(tree)
    counts = counts.select(
        tree,
        "part",
        F.sum("k").over(within).alias("n"),
        (
            F.sum("k").over(within.orderBy("part").rowsBetween(W.unboundedPreceding, 0))
            - F.col("k")
            - F.col("first")
        ).alias("shift"),
    )
    found = placed.join(counts, [tree, "part"])
    return found.withColumn("pos", F.col("pos") + F.col("shift")).drop("part", "shift")


def _chained(batches):
    """Hashes runs of digests slot by slot and keeps the state before each slot."""
    for batch in batches:
        children = batch.column("nodes").to_pylist()
        sizes = np.array([len(c) for c in children])
        states: list[bytes] = []
        digests: list[str] = []
        for lo in range(0, len(children), LANES):
            part, many = children[lo : lo + LANES], sizes[lo : lo + LANES]
            state = np.repeat(sha256.FRESH[:, None], len(part), axis=1)
            kept = np.zeros((len(part), FANOUT, sha256.STATE), np.uint8)
            for slot in range(many.max()):
                kept[:, slot] = sha256.stored(state)
                on = np.flatnonzero(many > slot)
                block = np.frombuffer("".join(part[i][slot]["digest"] for i in on).encode(), np.uint8)
                state[:, on] = sha256.compress(
                    state[:, on], sha256.words(block.reshape(-1, sha256.BLOCK))
                )
            state = sha256.compress(state, sha256.closing(many))
            states += [kept[i, :n].tobytes() for i, n in enumerate(many)]
            digests += [bytes(d).decode() for d in sha256.hexed(state)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(states, pa.binary()), pa.array(digests, pa.string())],
            [*batch.schema.names, "states", "digest"],
        )


def run_level(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Runs (tree, run, n, nodes, states, digest) of nodes (tree, pos, n, digest).

    n is the number of runs of the tree from here on. Each run is at most FANOUT nodes, so
    no group grows with the data.
    """
    runs = nodes.groupBy("tree", F.floor(F.col("pos") / FANOUT).alias("run")).agg(
        F.max(F.ceil(F.col("n") / FANOUT)).alias("n"),
        F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("nodes"),
    )
    schema = T.StructType([*runs.schema.fields]).add("states", "binary").add("digest", "string")
    return cut(runs.mapInArrow(_chained, schema), "merkle-level")


def grow(nodes: DataFrame, carried: Sequence[str] = ()) -> list[DataFrame]:
    """The levels of all trees from their nodes up, as runs; trees of one node have none."""
    levels = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(run_level(nodes.where("n > 1"), carried))
        nodes, carried = levels[-1].select("tree", F.col("run").alias("pos"), "n", "digest"), ()
        most = -(-most // FANOUT)
    return levels


def subroots(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, digest): of each tree the digest that remains."""
    found = nodes.where("n = 1").select("tree", "digest")
    for runs in levels:
        found = found.union(runs.where("n = 1").select("tree", "digest"))
    return found


def steps_of(runs: DataFrame) -> DataFrame:
    """(tree, pos, run, n, digest, step): each node of a run with its step to the parent."""
    at = F.transform(
        "nodes",
        lambda x, i: F.struct(
            x["pos"].alias("pos"),
            x["digest"].alias("digest"),
            F.struct(
                F.substring(F.col("states"), i * sha256.STATE + 1, F.lit(sha256.STATE)).alias("state"),
                F.concat_ws("", F.slice(F.col("nodes.digest"), F.lit(1), i)).alias("left"),
                F.concat_ws("", F.slice(F.col("nodes.digest"), i + 2, F.lit(FANOUT))).alias("right"),
            )
            .cast(STEP)
            .alias("step"),
        ),
    )
    return runs.select("tree", "run", "n", F.explode(at).alias("at")).select(
        "tree", "run", "n", "at.*"
    )


def nothing() -> Column:
    return F.array().cast(f"array<{STEP}>")


def descend(levels: list[DataFrame], roots: DataFrame | None = None) -> DataFrame:
    """(tree, run, path, subroot) of the lowest runs, from roots (tree, path, subroot).

    Without roots, paths end at the trees' own and there is no subroot.

    The path of a run goes on above it, nearest level first. What a tree's root has is handed
    down from run to run, so nothing is joined on the tree alone, which may hold most rows.
    """
    paths = None
    for level in range(len(levels) - 1, -1, -1):
        runs = levels[level]
        ends = runs.where("n = 1").select("tree", "run")
        if roots is None:
            ends = ends.withColumns({"path": nothing(), "subroot": F.lit(None).cast("string")})
        else:
            ends = ends.join(roots, "tree")
        if paths is None:
            paths = ends
            continue
        above = steps_of(levels[level + 1]).withColumnRenamed("run", "parent").drop("n", "digest")
        up = paths.select("tree", F.col("run").alias("parent"), "path", "subroot")
        lower = above.join(up, ["tree", "parent"]).select(
            "tree",
            F.col("pos").alias("run"),
            F.concat(F.array("step"), "path").alias("path"),
            "subroot",
        )
        paths = lower.unionByName(ends)
    return paths


def _folded(current: np.ndarray, steps: list[list[tuple[bytes, bytes, bytes]]]) -> list[str]:
    """The roots that digests (n, 64) fold to: each step resumes a state before the slot."""
    depth = np.array([len(s) for s in steps])
    for level in range(depth.max(initial=0)):
        on = np.flatnonzero(depth > level)
        here = [steps[i][level] for i in on]
        state = sha256.resumed(
            np.frombuffer(b"".join(s[0] for s in here), np.uint8).reshape(-1, sha256.STATE)
        )
        left = np.array([len(s[1]) for s in here]) // sha256.BLOCK
        right = np.array([len(s[2]) for s in here]) // sha256.BLOCK
        state = sha256.compress(state, sha256.words(current[on]))
        # The longest first, so that those still to be hashed are always a beginning.
        order = np.argsort(-right, kind="stable")
        state = state[:, order]
        for k in range(right.max()):
            many = int((right > k).sum())
            block = b"".join(
                here[i][2][k * sha256.BLOCK : (k + 1) * sha256.BLOCK] for i in order[:many]
            )
            state[:, :many] = sha256.compress(
                state[:, :many],
                sha256.words(np.frombuffer(block, np.uint8).reshape(-1, sha256.BLOCK)),
            )
        state = sha256.compress(state, sha256.closing((left + right + 1)[order]))
        current[on[order]] = sha256.hexed(state)
    return [bytes(d).decode() for d in current]


def _proved(batches):
    """Rows of the leaves of runs (nodes, states, path, subroot, root); without states, alone."""
    for batch in batches:
        for lo in range(0, batch.num_rows, LANES // FANOUT):
            rows = batch.slice(lo, LANES // FANOUT).to_pylist()
            out: dict[str, list] = {name: [] for name in ("row", "leaf", "subroot", "root", "proof")}
            changed, steps = [], []
            for r in rows:
                digests = [x["digest"].encode() for x in r["nodes"]]
                above = [
                    (p["state"], p["left"].encode(), p["right"].encode()) for p in r["path"]
                ]
                siblings = b"".join(left + right for _, left, right in above)
                for i, x in enumerate(r["nodes"]):
                    own = []
                    if r["states"] is not None:
                        state = r["states"][i * sha256.STATE : (i + 1) * sha256.STATE]
                        own = [(state, b"".join(digests[:i]), b"".join(digests[i + 1 :]))]
                    proof = b"".join(a + b for _, a, b in own) + siblings
                    out["row"].append(x["row"])
                    out["leaf"].append(x["digest"])
                    out["subroot"].append(r["subroot"])
                    out["root"].append(r["root"])
                    out["proof"].append(hashlib.sha256(proof).hexdigest())
                    changed.append((x["changed"] or x["digest"]).encode())
                    steps.append(own + above)
            current = np.frombuffer(b"".join(changed), np.uint8).reshape(-1, sha256.BLOCK).copy()
            row_type = batch.schema.field("nodes").type.value_type.field("row").type
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["row"], row_type),
                    *[pa.array(out[c], pa.string()) for c in ("leaf", "subroot", "root", "proof")],
                    pa.array(_folded(current, steps), pa.string()),
                ],
                ["row", "leaf", "subroot", "root", "proof_sha256", "folded_root"],
            )


def prove(
    docs: DataFrame,
    group: str = "source",
    order: str = "doc_id",
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed: Column | None = None,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The kept columns of docs, then leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of a row's `columns` (see `record`). Leaves of one group ascend by
    `order`; every FANOUT digests in a row, concatenated as hex, give their parent's until one
    remains, the group's subroot. Subroots, by group with null first, give the root likewise.
    Parents keep the hash state before each of their slots: a hex digest is one block of
    SHA-256, so that state is 32 bytes, stored with the run. folded_root is worked out for each
    row from its path alone, resuming the state before the row's slot with its own digest
    (`changed` where not null, else leaf) and the siblings on the right. Siblings on the left
    only enter proof_sha256. verified tells whether the fold leads to the root.

    Only digests are shuffled, never texts. Trees are grown and descended level by level, with
    levels written in between; a run has FANOUT nodes at most, so a group of any size spreads.

    Null values are `-` in a record and null groups are a group of their own; null orders come
    first, equal ones by leaf. Repeated rows are leaves of their own. An empty table gives no
    rows. Kept columns with the names of results are replaced.
    """
    spark = ship(docs.sparkSession)
    own = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    keep = [c for c in keep if c not in own]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col(order).alias("place"),
        record(columns).alias("digest"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed"),
        F.struct(*keep).alias("row"),
    )
    leaves = cut(in_order(leaves, "tree", ("place", "digest", "changed")), "merkle-leaves")
    levels = grow(leaves, ("changed", "row"))
    tops = cut(subroots(leaves, levels), "merkle-subroots")
    forest = in_order(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "tree", ("name",))
    forest = cut(forest, "merkle-forest")
    upper = grow(forest, ("name",))
    root = subroots(forest, upper).first()
    if root is None:
        root = ("", "")
    if upper:
        paths = descend(upper).select(F.col("run").alias("parent"), "path")
        slots = steps_of(upper[0]).withColumnRenamed("run", "parent")
        slots = slots.join(paths, "parent").join(forest.select("pos", "name"), "pos")
        path, subroot = F.concat(F.array("step"), "path"), F.col("digest")
    else:
        slots, path, subroot = forest, nothing(), F.col("digest")
    roots = slots.select(F.col("name").alias("tree"), path.alias("path"), subroot.alias("subroot"))
    roots = cut(roots, "merkle-roots")
    lone = leaves.where("n = 1").select(
        "tree",
        F.array(F.struct("pos", "digest", "changed", "row")).alias("nodes"),
        F.lit(None).cast("binary").alias("states"),
    )
    wanted = ("nodes", "states", "path", "subroot")
    found = lone.join(roots, "tree").select(*wanted)
    if levels:
        found = found.union(levels[0].join(descend(levels, roots), ["tree", "run"]).select(*wanted))
    found = found.withColumn("root", F.lit(root[1]))
    schema = T.StructType([T.StructField("row", leaves.schema["row"].dataType)])
    for name in own[:-1]:
        schema = schema.add(name, "string")
    return found.mapInArrow(_proved, schema).select(
        "row.*", *own[:-1], (F.col("folded_root") == F.col("root")).alias("verified")
    )
