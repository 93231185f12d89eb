"""Deletion of repeated runs of lines, by a suffix array over line ids."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.store import cut

NO_ID = -(1 << 63)
WORD = r"[^\x20\x09-\x0D]+"
#: What follows a suffix: the document's end, a line that stands nowhere else, or what is
#: beyond these.
END, ALONE, CLOSED = -2, -1, -3
KEY = ("d", "t")


def keyed(docs: DataFrame) -> DataFrame:
    """docs with d, the doc_id as a number, and t and u, two hashes of the text."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.withColumns(
        {"d": number, "t": F.xxhash64("text"), "u": F.xxhash64(F.lit(1), F.col("text"))}
    )


def text_table(docs: DataFrame, long_words: int) -> DataFrame:
    """(t, u, d, copied, lines): a row for each different text, with its smallest d.

    lines are the lines with a word: their number among all lines, two hashes of the line, and
    whether it is long. Copies are merged in each task before they are shuffled.
    """
    words = lambda line: F.regexp_count(line, F.lit(WORD))
    lines = F.filter(
        F.transform(
            F.split("text", "\n", -1),
            lambda line, no: F.struct(
                no.alias("no"),
                F.xxhash64(line).alias("h1"),
                F.xxhash64(F.lit(1), line).alias("h2"),
                words(line).alias("words"),
            ),
        ),
        lambda x: x["words"] > 0,
    )
    lines = F.transform(
        lines,
        lambda x: F.struct(x["no"], x["h1"], x["h2"], (x["words"] >= long_words).alias("long")),
    )
    rows = docs.where("text IS NOT NULL").select("t", "u", "d", lines.alias("lines"))
    return rows.groupBy("t", "u").agg(
        F.min("d").alias("d"),
        (F.max("d") > F.min("d")).alias("copied"),
        F.any_value("lines").alias("lines"),
    )


def line_table(texts: DataFrame) -> DataFrame:
    """(d, t, n_lines, i, no, h1, h2, long): lines with a word; i counts them, no counts all."""
    rows = texts.select(*KEY, F.size("lines").alias("n_lines"), F.posexplode("lines").alias("i", "x"))
    return rows.select(*KEY, "n_lines", "i", "x.no", "x.h1", "x.h2", "x.long")


def starts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Adds `first`, the sum of n over all rows with smaller keys.

    Rows are dealt by range of keys, summed up within each range, and the ranges' totals (one
    row each) are summed up apart, so that no task holds more than a range.
    """
    dealt = cut(
        counts.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranges"
    )
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = dealt.groupBy("part").agg(F.sum("n").alias("all"))
    totals = totals.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    before = W.partitionBy("part").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    return (
        dealt.withColumn("inner", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(totals, "part")
        .withColumn("first", F.col("base") + F.col("inner"))
        .drop("part", "inner", "base")
    )


def suffix_array(lines: DataFrame, run_lines: int) -> DataFrame:
    """(d, t, i, no, long, line, rank, run, shared) of suffixes that begin with a repeated line.

    rank is the suffix's place in the sorted order of all of them, equal for equal suffixes;
    line is its rank by the first line; run, by the first run_lines lines, null where no other
    suffix has the same; shared is how many lines it has in common with another at the least.

    Prefix doubling: ranks by the first h lines, of a suffix and of that h lines further on,
    give ranks by 2h lines; from run_lines lines on, two doublings share one sort, which then
    compares the ranks of h, 2h and 3h lines further on too. A line that stands once in all
    texts ends the comparison; its suffixes are no part of the table. Only groups that still
    tie go to the next round, with the documents that hold them, and only their distinct
    ranks, with counts, are sorted. The rounds are as many as the logarithm of the longest
    repeated run.
    """
    counts = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    first = starts(counts, ["h1", "h2"])
    ranked = lines.join(first, ["h1", "h2"]).select(
        *KEY, "i", "no", "long", "n_lines",
        F.col("first").alias("line"),
        F.col("first").alias("rank"),
        F.lit(None).cast("long").alias("run"),
        F.lit(1).cast("long").alias("shared"),
        F.lit(True).alias("active"),
        F.lit(True).alias("fresh"),
    )
    rounds = [cut(ranked, "suffixes")]
    h = 1
    while not rounds[-1].where("active").isEmpty():
        factor = 2 if h < run_lines else 4
        rounds.append(cut(doubled(rounds[-1], h, factor, run_lines), "suffixes"))
        h *= factor
    done = reduce(DataFrame.unionByName, [state.where("fresh AND NOT active") for state in rounds])
    if run_lines == 1:
        done = done.withColumn("run", F.col("line"))
    return done.drop("active", "fresh", "n_lines")


def doubled(state: DataFrame, h: int, factor: int, run_lines: int) -> DataFrame:
    """The suffixes of documents with a tie, ranked by factor * h lines; fresh ones were tied."""
    document = W.partitionBy(*KEY)
    steps = range(1, factor)
    state = state.withColumns(
        {f"at{k}": F.max("rank").over(document.orderBy("i").rangeBetween(k * h, k * h)) for k in steps}
        | {"alive": F.max("active").over(document)}
    ).where("alive")
    columns = [*KEY, "i", "no", "long", "n_lines", "line", "rank", "run", "shared"]
    # A step after the document's end or a line that stands alone compares nothing.
    active, open_ = state.where("active"), F.lit(True)
    for k in steps:
        found = (
            F.when(~open_, F.lit(CLOSED))
            .when(F.col("i") + k * h >= F.col("n_lines"), F.lit(END))
            .otherwise(F.coalesce(f"at{k}", F.lit(ALONE)))
        )
        active = active.withColumn(f"at{k}", found)
        open_ = F.col(f"at{k}") >= 0
    last = F.least(*[f"at{k}" for k in steps], F.lit(0))
    # A suffix that meets a line of its own is a group of its own.
    alone = reduce(or_, [F.col(f"at{k}") == ALONE for k in steps])
    active = active.withColumns(
        {f"own_{c}": F.when(alone, F.col(c).cast("long")).otherwise(0) for c in (*KEY, "i")}
    )
    pair = ["rank", *[f"at{k}" for k in steps], *[f"own_{c}" for c in (*KEY, "i")]]
    places = starts(active.groupBy(*pair).agg(F.count("*").alias("n")), pair)
    bases = places.groupBy("rank").agg(F.min("first").alias("base"))
    places = places.join(bases, "rank").select(
        *pair, "n", (F.col("rank") + F.col("first") - F.col("base")).alias("next")
    )
    tied = (F.col("n") > 1) & (last >= 0)
    whole = (F.col("n") > 1) & ~alone
    more = (
        F.when(tied, F.lit(factor * h))
        .when(whole, F.col("n_lines") - F.col("i"))
        .otherwise(F.col("shared"))
    )
    run = F.when(tied, F.col("next")) if factor * h == run_lines else F.col("run")
    moved = active.join(places, pair).select(
        *KEY, "i", "no", "long", "n_lines", "line",
        F.col("next").alias("rank"),
        run.alias("run"),
        more.cast("long").alias("shared"),
        tied.alias("active"),
        F.lit(True).alias("fresh"),
    )
    rest = state.where("NOT active").select(
        *columns, F.lit(False).alias("active"), F.lit(False).alias("fresh")
    )
    return rest.unionByName(moved)


def later_copies(suffixes: DataFrame, group: str) -> DataFrame:
    """Suffixes of a group other than its first, in the order of documents and lines."""
    place: Column = F.struct(*KEY, "i")
    first = cut(suffixes.groupBy(group).agg(F.min(place).alias("first")), "first-suffixes")
    return suffixes.join(first, group).where(place > F.col("first"))


def ranges_of(numbers: str) -> Column:
    """An array of ascending numbers as an array of (low, high) without gaps."""
    begins = F.filter(numbers, lambda no, k: ~F.get(numbers, k - 1).eqNullSafe(no - 1))
    ends = F.filter(numbers, lambda no, k: ~F.get(numbers, k + 1).eqNullSafe(no + 1))
    return F.zip_with(begins, ends, lambda low, high: F.struct(low.alias("low"), high.alias("high")))


def deleted_ranges(suffixes: DataFrame, lines: DataFrame, run_lines: int) -> DataFrame:
    """(d, t, ranges): the maximal runs of lines that later copies cover in each text."""
    runs = later_copies(suffixes.where("run IS NOT NULL"), "run").select(
        *KEY, F.explode(F.sequence(F.col("i"), F.col("i") + run_lines - 1)).alias("i")
    )
    singles = later_copies(suffixes.where("long"), "line").select(*KEY, "i")
    gone = runs.union(singles).distinct().join(lines.select(*KEY, "i", "no"), [*KEY, "i"])
    island = F.col("no") - F.row_number().over(W.partitionBy(*KEY).orderBy("no"))
    return (
        gone.withColumn("island", island)
        .groupBy(*KEY, "island")
        .agg(F.min("no").alias("low"), F.max("no").alias("high"))
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    )


def dedup_lines(docs: DataFrame, run_lines: int = 2, long_words: int = 50) -> DataFrame:
    """Deletes later copies of repeated runs of lines from docs (doc_id, text).

    Gives doc_id, n_lines, n_deleted, longest_run, longest_shared, kept_text for each row. A
    run counts from run_lines lines (a power of two), or as a single line from long_words
    words; suffixes that share so many lines are an interval of the suffix array whose longest
    common prefix is no shorter. The first occurrence in the order of doc_id and line stays,
    and all lines that a later one covers go, in maximal runs; longest_run is the longest run
    of deleted lines, longest_shared the most lines a suffix is known to share with another.

    Equal texts are one text of the array: the one with the smallest doc_id stands in it, and
    in the others every run is a later copy. Lines equal byte by byte are the same. Lines
    without a word (white space only) belong to no run and stay. Null text has no lines and a
    null kept_text. Rows without doc_id come first, in the order of a hash of the text. Rows
    alike in doc_id and text are one document, given as often as they come. A document all of
    whose lines go has what is left, which may be empty.
    """
    if run_lines & (run_lines - 1) or run_lines < 1:
        raise ValueError("run_lines must be a power of two")
    docs = keyed(docs.select("doc_id", "text"))
    texts = cut(text_table(docs, long_words), "texts")
    lines = line_table(texts)
    suffixes = suffix_array(lines, run_lines)
    shared = suffixes.groupBy(*KEY).agg(F.max("shared").alias("longest_shared"))
    # All that a copy of a text loses: each of its lines is in a run, or the long ones.
    enough = F.size("lines") >= run_lines
    lost = F.transform(F.filter("lines", lambda x: enough | x["long"]), lambda x: x["no"])
    facts = (
        texts.join(deleted_ranges(suffixes, lines, run_lines), list(KEY), "left")
        .join(shared, list(KEY), "left")
        .select(
            "t", "u",
            F.col("d").alias("first_d"),
            F.size("lines").cast("long").alias("n_lines"),
            F.when(F.col("copied"), F.size("lines").cast("long"))
            .otherwise(F.col("longest_shared"))
            .alias("longest_shared"),
            "ranges",
            F.when(F.col("copied"), lost).alias("lost"),
        )
    )
    facts = cut(facts, "facts")
    later = F.col("d") > F.col("first_d")
    found = docs.join(facts, ["t", "u"], "left").withColumn(
        "ranges", F.when(later, ranges_of("lost")).otherwise(F.col("ranges"))
    )
    width = F.transform("ranges", lambda r: (r["high"] - r["low"] + 1).cast("long"))
    zero = F.lit(0).cast("long")
    n_lines = F.coalesce("n_lines", zero)
    kept = F.filter(
        F.split("text", "\n", -1),
        lambda _, no: ~F.exists("ranges", lambda r: no.between(r["low"], r["high"])),
    )
    return found.select(
        "doc_id",
        n_lines.alias("n_lines"),
        F.coalesce(F.aggregate(width, zero, lambda a, x: a + x), zero).alias("n_deleted"),
        F.coalesce(F.array_max(width), zero).alias("longest_run"),
        F.coalesce("longest_shared", zero).alias("longest_shared"),
        F.when(F.coalesce(F.size("ranges"), F.lit(0)) <= 0, F.col("text"))
        .otherwise(F.array_join(kept, "\n"))
        .alias("kept_text"),
    )
