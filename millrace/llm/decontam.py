"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.store import cut, ship
from millrace.llm.words import find_words, mix, slices, table_of, texts, word_hashes

#: Bytes outside 0-9, a-z and non-ASCII, after lower-casing, part words.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
INSIDE, VALUE = table_of(SEPARATORS)
_CANONICAL = bytes(VALUE[b] if INSIDE[b] else 32 for b in range(256))
TABLE_BITS = 20
#: Window ends that one cursor covers; longer texts get several cursors.
STRETCH = 256
#: Text of the benchmark that is searched in one pass; a larger one is cut into blocks.
BLOCK_BYTES = 8 << 20


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_CANONICAL).split()


class Search:
    """Wu-Manber tables for test strings of one length in words.

    Blocks are two words (one, for strings of one word). The shift table says how far the
    window can move when it ends with a block, by the last place of that block in any string;
    blocks in no string move it furthest. Shift 0 means that some strings end with the block:
    those in its bucket are compared word by word, first as hashes and then as text.
    """

    def __init__(self, strings: dict[tuple[bytes, ...], set[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.text = [b" ".join(s) for s in strings]
        self.items = [sorted(x) for x in strings.values()]
        joined = np.frombuffer(b" ".join(self.text), np.uint8)
        starts, ends, _ = find_words(joined, np.array([0, len(joined)]), INSIDE)
        self.words = word_hashes(joined, starts, ends).reshape(-1, length)
        furthest = length - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, furthest, np.int32)
        for last in range(self.block - 1, length):
            at = self._at(self.words, last)
            self.shift[at] = np.minimum(self.shift[at], length - 1 - last)
        suffix = self._at(self.words, length - 1)
        order = np.argsort(suffix, kind="stable")
        self.bucket, self.suffix = order, suffix[order]

    def _at(self, words: np.ndarray, last: int) -> np.ndarray:
        return self._slot(words[:, last], words[:, last - 1] if self.block == 2 else None)

    def _slot(self, last: np.ndarray, previous: np.ndarray | None) -> np.ndarray:
        both = last if previous is None else last * np.uint64(3) + previous
        return (mix(both) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words of windows that equal a string by their hashes, and the strings."""
        empty = np.zeros(0, np.int64)
        begin, end = first[:-1] + self.length - 1, first[1:]
        pieces = np.maximum(0, -(-(end - begin) // STRETCH))
        text = np.repeat(np.arange(len(begin)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = begin[text] + number * STRETCH
        stop = np.minimum(at + STRETCH, end[text])
        ends, strings = [empty], [empty]
        while len(at):
            slot = self._slot(hashes[at], hashes[at - 1] if self.block == 2 else None)
            shift = self.shift[slot]
            hit = np.flatnonzero(shift == 0)
            if len(hit):
                low = np.searchsorted(self.suffix, slot[hit], "left")
                many = np.searchsorted(self.suffix, slot[hit], "right") - low
                place = np.repeat(at[hit], many)
                number = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
                string = self.bucket[np.repeat(low, many) + number]
                for k in range(self.length):
                    same = self.words[string, k] == hashes[place - self.length + 1 + k]
                    place, string = place[same], string[same]
                ends.append(place)
                strings.append(string)
            at = at + np.maximum(shift, 1)
            left = at < stop
            at, stop = at[left], stop[left]
        return np.concatenate(ends), np.concatenate(strings)


class Matcher:
    """Searches for all test strings of a block of the benchmark."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for item, text in items:
            words = _words(text)
            length = min(window, len(words))
            for i in range(len(words) - length + 1 if words else 0):
                found = by_length.setdefault(length, {})
                found.setdefault(tuple(words[i : i + length]), set()).add(item)
        self.searches = [Search(strings, n) for n, strings in sorted(by_length.items())]

    def rows(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, set[str]]]:
        """For each text its number of words, places of hit words and items found."""
        data, at = texts(column)
        for lo, hi in slices(at):
            part = VALUE[data[at[lo] : at[hi]]]
            starts, ends, first = find_words(part, at[lo : hi + 1] - at[lo], INSIDE)
            hashes = word_hashes(part, starts, ends)
            marks = np.zeros(len(starts) + 1, np.int32)
            items: dict[int, set[str]] = {}
            for search in self.searches:
                places, strings = search.find(hashes, first)
                owners = np.searchsorted(first, places, "right") - 1
                for place, string, row in zip(
                    places.tolist(), strings.tolist(), owners.tolist(), strict=True
                ):
                    begin = place - search.length + 1
                    text = part[starts[begin] : ends[place]].tobytes().translate(_CANONICAL)
                    if b" ".join(text.split()) == search.text[string]:
                        marks[begin] += 1
                        marks[place + 1] -= 1
                        items.setdefault(row, set()).update(search.items[string])
            hit = np.cumsum(marks[:-1]) > 0
            for row in range(hi - lo):
                a, b = first[row], first[row + 1]
                yield int(b - a), np.flatnonzero(hit[a:b]), items.get(row, set())


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The kept columns of docs, then n_words, n_hit, n_items, items_sha256, contaminated.

    Test strings are all runs of `window` words of benchmark texts (a shorter text is one
    string). A document word within any occurrence of one is hit. items_sha256 is over the ids
    of the items found, sorted as strings and comma-joined.

    The strings of one pass are bounded by block_bytes of benchmark text and go to every task;
    a larger benchmark is dealt by item into blocks, and documents pass through one block after
    the other, with what was found so far written in between. Documents are not shuffled.

    Null or wordless texts have no words and are clean; null or wordless items are ignored;
    items without an id count as the id "". Repeated rows are judged one by one. An empty
    benchmark finds nothing. Kept columns with the names of results are replaced.
    """
    spark = ship(docs.sparkSession)
    own = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    keep = tuple(c for c in keep if c not in own)
    items = benchmark.where("text IS NOT NULL").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block_of = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))

    # A kept text is sent once; only kept columns are named by their place, as any name may clash.
    found = docs.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
        *(() if "text" in keep else (F.col("text").alias("text"),)),
        F.array().cast("array<int>").alias("hit"),
        F.array().cast("array<string>").alias("items"),
    )
    text = f"k{keep.index('text')}" if "text" in keep else "text"
    width = len(keep)
    for block in range(blocks):
        rows = items.where(block_of == block).collect()
        matcher = spark.sparkContext.broadcast(
            Matcher([(r["item"], r["text"]) for r in rows], window)
        )
        if block < blocks - 1:
            found = cut(_pass(found, matcher, text), "decontam-block")
    schema = T.StructType(found.schema.fields[:width])
    for name in own[:3]:
        schema = schema.add(name, "long")
    result = found.mapInArrow(_last_pass(matcher, text, width), schema.add("items_sha256", "string"))
    kept = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    return result.select(*kept, *own[:-1], (F.col("n_hit") > 0).alias("contaminated"))


def _merged(
    batch: pa.RecordBatch, matcher: Matcher, text: str
) -> Iterator[tuple[int, np.ndarray, set[str]]]:
    columns = batch.column("hit").to_pylist(), batch.column("items").to_pylist()
    earlier = zip(*columns, strict=True)
    for (n, places, items), (hit, known) in zip(
        matcher.rows(batch.column(text)), earlier, strict=True
    ):
        if hit:
            places = np.union1d(places, np.array(hit))
        yield n, places, items.union(known)


def _pass(found: DataFrame, matcher, text: str) -> DataFrame:
    def search(batches):
        for batch in batches:
            rows = list(_merged(batch, matcher.value, text))
            hits = pa.array([p.astype(np.int32) for _, p, _ in rows], pa.list_(pa.int32()))
            items = pa.array([sorted(x) for _, _, x in rows], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], hits, items], batch.schema.names
            )

    return found.mapInArrow(search, found.schema)


def _last_pass(matcher, text: str, width: int):
    def search(batches):
        for batch in batches:
            rows = list(_merged(batch, matcher.value, text))
            digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for *_, x in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:width],
                    pa.array([n for n, *_ in rows], pa.int64()),
                    pa.array([len(p) for _, p, _ in rows], pa.int64()),
                    pa.array([len(x) for *_, x in rows], pa.int64()),
                    pa.array(digest, pa.string()),
                ],
                [*batch.schema.names[:width], "n_words", "n_hit", "n_items", "items_sha256"],
            )

    return search
