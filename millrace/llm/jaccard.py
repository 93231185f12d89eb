"""N-gram Jaccard join by T-occurrence search.

A document is the set of its shingles. Two sets link when 100 * |x & y| >= 80 * |x | y|, so
their overlap is at least T = ceil(0.8 * |x|): among the lists of documents of x's shingles,
a partner stands in T or more. DivideSkip leaves T - 1 long lists aside, so that a partner
stands in at least one of the other, short ones.

1. Count shingles in a table of fixed size, for an order with rare shingles first. Any order
   is right; a good one keeps the lists short.
2. Each text gives its set's fingerprint and its |x| - T + 1 rarest shingles. Equal sets are
   one class from here on.
3. The short lists are grouped by shingle. Two classes of a list may link only if their sizes,
   the shingles that follow this one in their orders and their sketches allow it. A list of few
   classes gives the pairs that may link. A list of many gives only as many of them as hold
   together what may link; classes so held make a block, which is cut into cells, and cells of
   near enough sizes meet two by two.
4. Each pair or meeting of cells is a search, for which texts are moved: an inverted index of its sets is built, the short
   lists of each query are merged on a heap, candidates are probed in the long ones by binary
   search, and those with the overlap asked for are links.
5. Links make components.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.store import cut, ship
from millrace.llm.words import find_words, mix, shingles, slices, table_of, texts, word_hashes

INSIDE, VALUE = table_of(bytes([0x20, *range(0x09, 0x0E)]))
WIDTH = 5
#: Cells of the counting table. It is broadcast as one byte each, whatever the input.
COUNT_BITS = 22
COUNT_PARTS = 64
#: A list of more classes than this is chained instead of paired.
SHORT_LIST = 16
#: Classes in a part of a longer list; parts meet two by two.
LIST_PART = 2048
#: A sketch has as many bits as its set has shingles, or up to twice as many, within these.
LEAST_BITS, MOST_BITS = 64, 1 << 16
#: Classes in a cell of a block.
CELL = 128


def least_overlap(n):
    """T: no partner of a set of n shingles shares fewer."""
    return (4 * n + 4) // 5


def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text."""
    data, at = texts(column)
    for lo, hi in slices(at):
        part = VALUE[data[at[lo] : at[hi]]]
        starts, ends, first = find_words(part, at[lo : hi + 1] - at[lo], INSIDE)
        yield from shingles(word_hashes(part, starts, ends), first, WIDTH)


def fingerprint(found: np.ndarray) -> int:
    """A signed 64-bit number for a set; equal sets have equal ones."""
    if not len(found):
        return 0
    both = np.array([np.bitwise_xor.reduce(mix(found)), found.sum()], np.uint64)
    return int(mix(both[:1] * np.uint64(3) + mix(both[1:])).astype(np.int64)[0])


def sketch(found: np.ndarray) -> bytes:
    """Bits that count shingles modulo two, each shingle in the bit that its hash tells.

    Sketches of two sets differ in at most as many bits as the sets differ in shingles. The
    two halves of a sketch, one xor the other, are the set's sketch of half the bits.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (len(found) - 1).bit_length()))
    counts = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(sketch1: bytes, n1: int, sketch2: bytes, n2: int) -> bool:
    """False only if the sets' sketches differ in too many bits for a link.

    Linked sets of n1 and n2 shingles share 4 / 9 of n1 + n2, so they differ in 1 / 9 of it.
    """
    long, short = sorted((sketch1, sketch2), key=len, reverse=True)
    bits, width = int.from_bytes(long, "little"), len(long)
    while width > len(short):
        width //= 2
        bits = (bits >> 8 * width) ^ (bits & ((1 << 8 * width) - 1))
    return 9 * (bits ^ int.from_bytes(short, "little")).bit_count() <= n1 + n2


def _cell(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def rarity(docs: DataFrame) -> np.ndarray:
    """For each cell of the counting table 8 * log2(1 + shingles of all documents in it).

    Tasks count in a table of their own and hand it over in parts, which are added up part by
    part: a few megabytes a task, whatever its rows.
    """
    part = (1 << COUNT_BITS) // COUNT_PARTS

    def count(batches):
        table = np.zeros(1 << COUNT_BITS, np.uint32)
        for batch in batches:
            for found in sets_of(batch.column("text")):
                np.add.at(table, _cell(found), np.uint32(1))
        if table.any():
            rows = table.reshape(COUNT_PARTS, part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(COUNT_PARTS), pa.int32()),
                    pa.array([_narrow(r) for r in rows], pa.binary()),
                ],
                ["part", "counts"],
            )

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            columns = batch.column("part").to_pylist(), batch.column("counts").to_pylist()
            for number, counts in zip(*columns, strict=True):
                total = totals.setdefault(number, np.zeros(part, np.uint64))
                total += _wide(counts)
        levels = [np.minimum(255, np.round(8 * np.log2(1.0 + t))) for t in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(totals), pa.int32()),
                pa.array([x.astype(np.uint8).tobytes() for x in levels], pa.binary()),
            ],
            ["part", "level"],
        )

    counted = docs.select("text").mapInArrow(count, "part int, counts binary")
    levels = counted.repartition("part").mapInArrow(add, "part int, level binary").collect()
    table = np.zeros((COUNT_PARTS, part), np.uint8)
    for row in levels:
        table[row["part"]] = np.frombuffer(row["level"], np.uint8)
    return table.reshape(-1)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in one byte where that is enough, packed, as most are small."""
    kind = np.uint8 if counts.max(initial=0) < 256 else np.uint32
    return bytes([kind().itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), np.uint8 if data[0] == 1 else np.uint32)


def described(docs: DataFrame, levels) -> DataFrame:
    """doc_id, content (hash of the text), n (set size), mark (fingerprint), the rarest
    shingles of each text, rarest first, and its sketch.

    Shingles and sketch stand only at the first text of a set in a task, which keeps large
    groups of copies from filling the lists.
    """

    def describe(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            n, marks, rare, sketches = [], [], [], []
            for found in sets_of(batch.column("text")):
                size, mark = len(found), fingerprint(found)
                n.append(size)
                marks.append(mark)
                if size and (mark, size) not in seen:
                    if len(seen) < 100_000:
                        seen.add((mark, size))
                    short = size - least_overlap(size) + 1
                    order = np.argsort(levels.value[_cell(found)], kind="stable")
                    rare.append(found[order[:short]].view(np.int64))
                    sketches.append(sketch(found))
                else:
                    rare.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("content"),
                    pa.array(n, pa.int64()),
                    pa.array(marks, pa.int64()),
                    pa.array(rare, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "content", "n", "mark", "rare", "sketch"],
            )

    return docs.select("doc_id", "content", "text").mapInArrow(
        describe,
        "doc_id long, content long, n long, mark long, rare array<long>, sketch binary",
    )


def _may_overlap(at1, at2):
    """Whether two classes of a list may link, by their sizes and places of its shingle.

    If it is the first shingle in order that both hold, they share no more than what follows
    it in either; linked classes pass in the list of that shingle, which is short in both.
    """
    n1, n2 = F.shiftright(at1, 32), F.shiftright(at2, 32)
    after1, after2 = n1 - at1.bitwiseAND(0xFFFFFFFF), n2 - at2.bitwiseAND(0xFFFFFFFF)
    return (F.least(after1, after2) * 9 >= (n1 + n2) * 4) & (
        F.least(n1, n2) * 5 >= F.greatest(n1, n2) * 4
    )


def listed(described: DataFrame) -> DataFrame:
    """What the lists of two classes or more tell: pairs, and the members of long lists.

    A pair that a list of up to SHORT_LIST classes holds is a row (node, other), node being
    the larger. A member of a longer one is a row (shingle, node, at, part, parts) without
    other; `at` holds the set's size in its high half and the shingle's place in the low one.
    """
    lists = described.where("rare IS NOT NULL").select(
        "n", F.xxhash64("n", "mark").alias("node"), F.posexplode("rare").alias("place", "shingle")
    )
    # Three numbers a row: this is the largest shuffle of the search.
    lists = lists.select("shingle", "node", F.expr("shiftleft(n, 32) + place").alias("at"))
    by_shingle = W.partitionBy("shingle").orderBy("at", "node")
    whole = by_shingle.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    lists = lists.withColumn("in_list", F.count("*").over(whole)).where("in_list > 1")
    lists = lists.withColumn("before", F.lag("node").over(by_shingle)).where(
        "before IS NULL OR before != node"
    )
    lists = lists.withColumn("in_list", F.count("*").over(whole)).where("in_list > 1")
    earlier = by_shingle.rowsBetween(-(SHORT_LIST - 1), -1)
    lists = lists.withColumns(
        {
            "earlier": F.collect_list(F.struct("at", "node")).over(earlier),
            "part": F.floor((F.row_number().over(by_shingle) - 1) / LIST_PART),
        }
    )
    short = F.col("in_list") <= SHORT_LIST
    near = F.filter("earlier", lambda y: _may_overlap(F.col("at"), y["at"]))
    rows = lists.select(
        "shingle",
        "node",
        "at",
        "part",
        F.ceil(F.col("in_list") / LIST_PART).alias("parts"),
        F.explode(
            F.when(short, near).otherwise(F.array(F.lit(None).cast("struct<at:long,node:long>")))
        ).alias("y"),
    )
    # Places differ from list to list, so that only sizes and nodes order a pair.
    x = F.struct(F.shiftright("at", 32).alias("n"), "node")
    y = F.struct(F.shiftright("y.at", 32).alias("n"), F.col("y.node").alias("node"))
    of_list = [F.when(F.col("y").isNull(), F.col(c)).alias(c) for c in ("shingle", "at", "part", "parts")]
    return rows.select(
        *of_list,
        F.when(F.col("y").isNull(), F.col("node")).otherwise(F.greatest(x, y)["node"]).alias("node"),
        F.when(F.col("y").isNotNull(), F.least(x, y)["node"]).alias("other"),
    ).distinct()


def close_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(query, other): the pairs (node, other) whose sketches allow a link, as classes."""
    held = classes.select("node", F.struct("node", "n", "copies").alias("c"), "sketch")
    pairs = pairs.join(
        held.select("node", F.col("c").alias("query"), F.col("sketch").alias("sketch1")), "node"
    ).join(
        held.select(F.col("node").alias("other"), F.col("c").alias("c2"), F.col("sketch").alias("sketch2")),
        "other",
    )
    pairs = pairs.select("query", F.col("c2").alias("other"), "sketch1", "sketch2")

    def close(batches):
        for batch in batches:
            query, other = batch.column("query"), batch.column("other")
            columns = (
                batch.column("sketch1"), query.field("n"), batch.column("sketch2"), other.field("n")
            )
            keep = [may_link(*x) for x in zip(*(c.to_pylist() for c in columns), strict=True)]
            yield pa.RecordBatch.from_arrays([query, other], ["query", "other"]).filter(
                pa.array(keep, pa.bool_())
            )

    return pairs.mapInArrow(close, pairs.select("query", "other").schema)


def chained(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): edges that hold together the classes of long lists that may link.

    Each part of a list meets each part before it and itself, so that a task holds two parts
    of a list at most, however long it is.
    """
    rows = (
        members.join(classes.select("node", "sketch"), "node")
        .withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(
            "shingle",
            F.greatest("part", "met").alias("high"),
            F.least("part", "met").alias("low"),
            "part",
            "at",
            "node",
            "sketch",
        )
    )
    keys = ("shingle", "high", "low")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "at", "node")

    def run(batches):
        held: list[tuple] = []
        current = None
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for *key, part, at, node, bits in zip(*columns, strict=True):
                if key != current:
                    out += _edges(current, held)
                    held, current = [], key
                held.append((part, at, node, bits))
            yield _edge_batch(out)
        yield _edge_batch(_edges(current, held))

    return rows.mapInArrow(run, "a long, b long")


def _edge_batch(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _edges(key: list[int] | None, held: list[tuple]) -> list[tuple[int, int]]:
    if len(held) < 2:
        return []
    parts, at, nodes, sketches = zip(*held, strict=True)
    _, high, low = key
    at = np.array(at, np.int64)
    first = 1 if high == low else parts.index(high)
    found = chain(at >> 32, at & 0xFFFFFFFF, sketches, first, len(at) if high == low else first)
    return [(nodes[i], nodes[j]) for i, j in found]


def chain(
    sizes: np.ndarray, places: np.ndarray, sketches: list[bytes], first: int, end: int
) -> list[tuple[int, int]]:
    """Edges (i, j), j before i, that connect all members of a list that may link.

    Members are in order of size, and so of the length of their sketches. Those from `first`
    on look for those below `end`.
    """
    widths = np.array([len(s) for s in sketches])
    tables = {
        w: (k, np.frombuffer(b"".join(sketches[k : k + m]), np.uint64).reshape(m, -1))
        for w, k, m in zip(*(x.tolist() for x in np.unique(widths, return_index=True, return_counts=True)), strict=True)
    }
    reach = np.searchsorted(sizes * 5, sizes * 4)
    after = 9 * (sizes - places)
    label = np.arange(len(sizes))
    edges = []
    for i in range(first, len(sizes)):
        lo, hi = int(reach[i]), min(i, end)
        if lo >= hi:
            continue
        needed = 4 * (sizes[lo:hi] + sizes[i])
        near = lo + np.flatnonzero((after[lo:hi] >= needed) & (after[i] >= needed))
        own = np.frombuffer(sketches[i], np.uint64)
        found = []
        while len(near):
            start, table = tables.get(8 * len(own), (len(sizes), None))
            split = int(np.searchsorted(near, start))
            if split < len(near):
                these = near[split:]
                differ = np.bitwise_count(table[these - start] ^ own).sum(axis=1, dtype=np.int64)
                found.append(these[9 * differ <= sizes[these] + sizes[i]])
            near = near[:split]
            own = own[: len(own) // 2] ^ own[len(own) // 2 :]
        if not found or not len(close := np.concatenate(found)):
            continue
        labels, one = np.unique(label[close], return_index=True)
        fresh = labels != label[i]
        edges += [(i, j) for j in close[one[fresh]].tolist()]
        if fresh.any():
            label[np.isin(label, labels)] = label[i]
    return edges


def searches(described: DataFrame, classes: DataFrame) -> DataFrame:
    """(search, side, node, n, copies): which classes meet in which search.

    Side 0 is a query and side 1 a candidate; in the meeting of a cell with itself all are 2,
    queries of those before them.
    """
    found = cut(listed(described), "jaccard-lists")
    pairs = close_pairs(found.where("other IS NOT NULL").select("node", "other"), classes)
    pairs = cut(pairs, "jaccard-pairs")
    blocks = cut(components(chained(found.where("other IS NULL"), classes)), "jaccard-blocks")
    # Pairs inside a block meet there; they need no search of their own.
    single = (
        pairs.join(blocks.select(F.col("node").alias("qn"), F.col("component").alias("qb")),
              F.col("query.node") == F.col("qn"), "left")
        .join(blocks.select(F.col("node").alias("on"), F.col("component").alias("ob")),
              F.col("other.node") == F.col("on"), "left")
        .where("qb IS NULL OR ob IS NULL OR qb != ob")
        .select("query", "other")
    )
    name = F.concat(F.lit("q"), F.col("query.node").cast("string")).alias("search")
    alone = single.select(name, F.lit(1).alias("side"), F.col("other.*")).union(
        single.select(name, F.lit(0).alias("side"), F.col("query.*")).distinct()
    )
    return alone.union(meetings(blocks, classes))


def meetings(blocks: DataFrame, classes: DataFrame) -> DataFrame:
    """The cells of blocks, in order of set size, and which cells meet."""
    members = blocks.join(classes, "node").select("component", "node", "n", "copies")
    # Rows of one block and size class are numbered apart, so that no task holds a whole block.
    level = F.floor(F.log(F.col("n").cast("double")) * 8).cast("int")
    spread = F.pmod(F.xxhash64("node"), F.lit(1024))
    key = ["component", "level", "spread"]
    members = members.withColumns({"level": level, "spread": spread})
    counts = members.groupBy(*key).agg(F.count("*").alias("m"))
    before = W.partitionBy("component", "level").orderBy("spread")
    counts = counts.select(
        *key,
        F.coalesce(
            F.sum("m").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("first"),
    )
    members = members.join(counts, key).withColumn(
        "cell",
        F.floor(
            (F.col("first") + F.row_number().over(W.partitionBy(*key).orderBy("node")) - 1) / CELL
        ),
    )
    members = cut(members.drop("spread", "first"), "jaccard-cells")
    cells = members.groupBy("component", "level", "cell").agg(
        F.min("n").alias("low"), F.max("n").alias("high")
    )
    # ln(5 / 4) * 8 is below 2, so links reach over two levels at most.
    reach = cells.select(
        "component",
        F.col("level").alias("level1"),
        F.col("cell").alias("cell1"),
        "low",
        "high",
        F.explode(F.sequence(F.col("level") - 2, F.col("level"))).alias("level"),
    )
    other = cells.select(
        "component",
        "level",
        F.col("cell").alias("cell2"),
        F.col("low").alias("low2"),
        F.col("high").alias("high2"),
    )
    met = (
        reach.join(other, ["component", "level"])
        .where("level < level1 OR cell2 <= cell1")
        .where("high2 * 5 >= low * 4 AND high * 5 >= low2 * 4")
        .withColumn("search", F.concat_ws(".", F.lit("b"), "component", "level1", "cell1", "level", "cell2"))
        .withColumn("itself", F.expr("level = level1 AND cell1 = cell2"))
    )
    sides = met.select(
        "search",
        "component",
        F.explode(
            F.when(F.col("itself"), F.array(F.struct(F.lit(2).alias("side"), F.col("level1").alias("level"), F.col("cell1").alias("cell"))))
            .otherwise(
                F.array(
                    F.struct(F.lit(0).alias("side"), F.col("level1").alias("level"), F.col("cell1").alias("cell")),
                    F.struct(F.lit(1).alias("side"), F.col("level").alias("level"), F.col("cell2").alias("cell")),
                )
            )
        ).alias("s"),
    ).select("search", "component", "s.*")
    return sides.join(members, ["component", "level", "cell"]).select(
        "search", "side", "node", "n", "copies"
    )


def divide_skip(lists: list[list[int]], needed: int) -> dict[int, int]:
    """How many of the sorted lists hold each number, for numbers in `needed` lists or more.

    The needed - 1 longest lists are put aside. The others are merged on a heap, and what they
    hold is looked up by binary search in those put aside.
    """
    lists = sorted(lists, key=len)
    aside = min(needed - 1, len(lists) - 1)
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    counts: dict[int, int] = {}
    for number in heapq.merge(*short):
        counts[number] = counts.get(number, 0) + 1
    candidates = np.fromiter(counts, np.int64, len(counts))
    totals = np.fromiter(counts.values(), np.int64, len(counts))
    for left, entries in zip(range(len(long) - 1, -1, -1), long, strict=True):
        if not len(candidates):
            break
        row = np.asarray(entries)
        place = np.searchsorted(row, candidates)
        totals = totals + (row[np.minimum(place, len(row) - 1)] == candidates)
        keep = totals + left >= needed
        candidates, totals = candidates[keep], totals[keep]
    return {c: t for c, t in zip(candidates.tolist(), totals.tolist(), strict=True) if t >= needed}


def search(sides: list[int], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links (i, j) between queries and candidates of one search, as places in the lists."""
    sizes = [len(s) for s in sets]
    if len(sets) == 2:
        if _linked(len(np.intersect1d(*sets, assume_unique=True)), *sizes):
            yield 0, 1
        return
    index: dict[int, list[int]] = {}
    for i, found in enumerate(sets):
        if sides[i]:
            for shingle in found.tolist():
                index.setdefault(shingle, []).append(i)
    for i, found in enumerate(sets):
        if sides[i] == 1:
            continue
        lists = [index[s] for s in found.tolist() if s in index]
        if len(lists) < least_overlap(sizes[i]):
            continue
        for j, overlap in divide_skip(lists, least_overlap(sizes[i])).items():
            if (sides[i] == 0 or j < i) and _linked(overlap, sizes[i], sizes[j]):
                yield i, j


def _linked(overlap: int, a: int, b: int) -> bool:
    return 100 * overlap >= 80 * (a + b - overlap)


def links(sought: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, linked) for each class a that has links in a search.

    b is the first class that a reaches by links of that search, and linked counts the
    documents that a links to there. No link is found in two searches. The text of a class is
    that of one document, told by doc_id and content, as a doc_id may repeat with other texts.
    """
    unnamed = docs.where("doc_id IS NULL").groupBy("content").agg(F.min("text").alias("text"))
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "content", "text").union(
        unnamed.select(F.lit(None).cast("long"), "content", "text")
    )
    sought = sought.join(classes.select("node", "lead", F.col("content").alias("held")), "node")
    rows = sought.join(
        texts, F.col("lead").eqNullSafe(F.col("doc_id")) & (F.col("held") == F.col("content"))
    ).select("search", "side", "node", "n", "copies", "text")
    rows = rows.repartition("search").sortWithinPartitions("search", "node")

    def run(batches):
        held: list[tuple] = []
        current = None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("search", "side", "node", "n", "copies")]
            for name, side, node, n, copies, found in zip(
                *columns, sets_of(batch.column("text")), strict=True
            ):
                if name != current:
                    out += _links_of(held)
                    held, current = [], name
                # A repeated row brings the same text again.
                if len(found) == n and not (held and held[-1][1] == node):
                    held.append((side, node, copies, found))
            yield _batch(out)
        yield _batch(_links_of(held))

    return rows.mapInArrow(run, "a long, b long, linked long")


def _links_of(held: list[tuple]) -> list[tuple[int, int, int]]:
    if len(held) < 2:
        return []
    sides, nodes, copies, sets = (list(x) for x in zip(*held, strict=True))
    root, linked = list(range(len(nodes))), [0] * len(nodes)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in search(sides, sets):
        linked[i] += copies[j]
        linked[j] += copies[i]
        low, high = sorted((top(i), top(j)))
        root[high] = low
    return [(nodes[i], nodes[top(i)], linked[i]) for i in range(len(nodes)) if linked[i]]


def _batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["a", "b", "linked"]
    )


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, content, n, mark) and the classes of equal sets that they are in.

    A class (n, mark) has a `node` of its own, made of both, whatever the doc_ids of its rows;
    `lead` is the smallest of them, and with `content` tells one of its texts. `group` is the
    class's component, `least` the smallest doc_id in it, and `linked` counts the rows of other
    classes that it links to.
    """
    spark = ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("content"))
    levels = spark.sparkContext.broadcast(rarity(docs))
    rows = cut(described(docs, levels), "jaccard-sets")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "content"))
    classes = (
        rows.where("n > 0")
        .groupBy("n", "mark")
        .agg(lead.alias("first"), F.count("*").alias("copies"), F.max("sketch").alias("sketch"))
    )
    classes = cut(
        classes.select(
            "n",
            "mark",
            F.xxhash64("n", "mark").alias("node"),
            F.col("first.doc_id").alias("lead"),
            F.col("first.content").alias("content"),
            "copies",
            "sketch",
        ),
        "jaccard-classes",
    )
    found = cut(links(searches(rows, classes), classes, docs), "jaccard-links")
    reached = components(found.select("a", "b")).withColumnRenamed("component", "group")
    linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("linked").alias("linked"))
    least = classes.join(reached, "node").groupBy("group").agg(F.min("lead").alias("least"))
    joined = (
        classes.join(reached.join(least, "group"), "node", "left")
        .join(linked, "node", "left")
        .withColumns(
            {
                "least": F.coalesce("least", "lead"),
                "group": F.coalesce("group", "node"),
                "linked": F.coalesce("linked", F.lit(0)),
            }
        )
    )
    return rows.drop("rare", "sketch"), joined


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for each row of docs (doc_id, text).

    Words are runs of other than ASCII white space, A-Z in lower case; a set holds the distinct
    runs of five words, or the whole text if it has fewer. A text without words, or null, has
    an empty set, and its component is its own doc_id. component_id is the smallest doc_id
    reachable by links; n_links counts the other rows a row links to. Rows without a doc_id
    link like others, and theirs is null if none they reach has an id. Repeated rows give
    repeated results, and a doc_id that repeats with another text is another document. doc_id
    must be a whole number. Other columns don't matter.

    Shingles and sets are compared by 64-bit hashes.
    """
    rows, classes = _grouped(docs)
    named = classes.select(
        "n",
        "mark",
        F.col("least").alias("component_id"),
        (F.col("linked") + F.col("copies") - 1).alias("n_links"),
    )
    return rows.select("doc_id", "n", "mark").join(named, ["n", "mark"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, any other columns) that stand for their group.

    Of each component one row stays: that with the smallest doc_id, then the smallest hash of
    its text, one of them if it is repeated. Rows without a doc_id come last and are told apart
    by their texts. Texts without words link with nothing and all stay.
    """
    _, classes = _grouped(docs.select("doc_id", "text"))
    first = F.min(F.struct(F.col("lead").isNull().alias("unnamed"), "lead", "content")).alias("first")
    stay = classes.groupBy("group").agg(first).select("first.unnamed", "first.lead", "first.content")
    # The same plain columns are keys of the join and of the window, so texts move once.
    keys = ("id", "unnamed", "hash")
    stay = stay.select(
        F.coalesce("lead", F.lit(0)).alias("id"), "unnamed", F.col("content").alias("hash")
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.xxhash64("text").alias("hash"),
        F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    order = W.partitionBy(*keys).orderBy(F.xxhash64("row"))
    named = (
        rows.where("worded")
        .join(stay, [*keys], "left_semi")
        .withColumn("place", F.row_number().over(order))
        .where("place = 1")
    )
    return named.select("row.*").union(rows.where("NOT worded").select("row.*"))
