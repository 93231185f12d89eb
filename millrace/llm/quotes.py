"""Quotation linking: conversations from messages that quote each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.divergence import let
from millrace.llm.store import cut

#: Marks at the beginning of a line, one for each level of quotation.
MARKS = r"^(?:[ \t]*>)+"
NO_THREAD = -(1 << 63)
#: Positions 2**CHUNK_BITS apart are searched in different tasks.
CHUNK_BITS = 12
#: What a passage is told by: its number of lines and two hashes.
PASSAGE = ["th", "k", "h1", "h2"]


def normalised(line: Column) -> Column:
    """White space as one space, no white space at either end, lower case."""
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def parsed(messages: DataFrame) -> DataFrame:
    """Adds own_text, and `lines`: level and hash of each line with more than white space."""
    marks = lambda line: F.regexp_extract(line, MARKS, 0)
    level = lambda line: F.length(marks(line)) - F.length(F.replace(marks(line), F.lit(">")))
    split = F.split("text", "\r?\n", -1)
    own = F.array_join(F.filter(split, lambda line: level(line) == 0), "\n")

    def described(line: Column) -> Column:
        bare = normalised(F.regexp_replace(line, MARKS, ""))
        return F.struct(
            level(line).alias("level"),
            F.when(bare != "", F.xxhash64(bare)).alias("h1"),
            F.xxhash64(F.lit(1), bare).alias("h2"),
        )

    lines = F.filter(F.transform(split, described), lambda x: x["h1"].isNotNull())
    return messages.withColumns({"own_text": F.trim(own), "lines": lines})


def passage(lines: Column) -> list[Column]:
    """The number of lines and two hashes of an array of lines."""
    k = F.size(lines)
    whole = [
        F.xxhash64(F.transform(lines, lambda x: x["h1"])),
        F.xxhash64(F.transform(lines, lambda x: x["h2"])),
    ]
    first = [F.get(lines, F.lit(0))[h] for h in ("h1", "h2")]
    return [k.alias("k")] + [
        F.when(k == 1, a).otherwise(b).alias(h)
        for a, b, h in zip(first, whole, ("h1", "h2"), strict=True)
    ]


def quoted_passages(rows: DataFrame) -> DataFrame:
    """(th, position, id, level, k, h1, h2, a1, a2): runs of quoted lines of the same level.

    a1 and a2 are the first hashes of the first two lines.
    """
    n = F.size("lines")
    level = lambda i: F.get("lines", i)["level"]
    starts = F.filter(
        F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (level(i) != level(i - 1))
    )
    runs = let(
        starts,
        lambda s: F.transform(
            s, lambda at, j: F.slice("lines", at + 1, F.coalesce(F.get(s, j + 1), n) - at)
        ),
    )
    runs = rows.where(n > 0).select("th", "position", "id", F.explode(runs).alias("run"))
    line = lambda i: F.get("run", F.lit(i))
    return runs.select(
        "th",
        "position",
        "id",
        line(0)["level"].alias("level"),
        *passage(F.col("run")),
        line(0)["h1"].alias("a1"),
        line(1)["h1"].alias("a2"),
    ).where("level > 0")


def written_passages(rows: DataFrame, quoted: DataFrame) -> DataFrame:
    """(th, position, k, h1, h2): runs of own lines that may be quoted passages of the thread.

    These begin with the first two lines of a quoted passage and are as long.
    """
    own = F.filter("lines", lambda x: x["level"] == 0)
    rows = rows.where("position IS NOT NULL").select("th", "position", "id", own.alias("own"))
    rows = rows.where(F.size("own") > 1)
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("own") - 1),
        lambda i: F.struct(
            i.alias("at"), F.get("own", i - 1)["h1"].alias("a1"), F.get("own", i)["h1"].alias("a2")
        ),
    )
    pairs = rows.select("th", "position", "id", F.size("own").alias("n"), F.explode(pairs).alias("x"))
    wanted = quoted.where("k > 1").select("th", "a1", "a2", "k").distinct()
    places = (
        pairs.select("th", "position", "id", "n", "x.*")
        .join(wanted, ["th", "a1", "a2"])
        .where("at + k - 1 <= n")
        .groupBy("th", "position", "id")
        .agg(F.collect_set(F.struct("at", "k")).alias("places"))
    )
    runs = F.transform("places", lambda x: F.slice("own", x["at"], x["k"]))
    runs = rows.join(places, ["th", "position", "id"]).select(
        "th", "position", F.explode(runs).alias("run")
    )
    return runs.select("th", "position", *passage(F.col("run")))


def latest_earlier(written: DataFrame, asked: DataFrame) -> DataFrame:
    """(th, k, h1, h2, position, original) of asked passages that an earlier message holds.

    Positions are searched in chunks, and what the chunks before hold is carried on, so that a
    passage that stands in each message of a large thread isn't one task's work.
    """
    key = [*PASSAGE, "position"]
    both = written.select(*key, F.col("position").alias("own"), F.lit(False).alias("asks"))
    both = both.unionByName(
        asked.where("position IS NOT NULL").select(
            *key, F.lit(None).cast(written.schema["position"].dataType).alias("own"),
            F.lit(True).alias("asks"),
        )
    )
    chunk = F.shiftright(F.col("position").cast("long"), CHUNK_BITS)
    both = both.groupBy(*key).agg(F.max("own").alias("own"), F.max("asks").alias("asks"))
    both = cut(both.withColumn("chunk", chunk), "passages")
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    carried = (
        both.groupBy(*PASSAGE, "chunk")
        .agg(F.max("own").alias("last"))
        .withColumn("carry", F.max("last").over(before(W.partitionBy(*PASSAGE).orderBy("chunk"))))
        .drop("last")
    )
    near = F.max("own").over(before(W.partitionBy(*PASSAGE, "chunk").orderBy("position")))
    return (
        both.withColumn("near", near)
        .where("asks")
        .join(carried, [*PASSAGE, "chunk"])
        .select(*key, F.coalesce("near", "carry").alias("original"))
        .where("original IS NOT NULL")
    )


def link_quotes(messages: DataFrame) -> DataFrame:
    """Replies and own text of messages (thread, position, text).

    Gives for each row thread, position, reply_to, root, reply_depth, levels, n_quoted,
    n_linked, outside_thread, own_text. Sorted by (thread, root, reply_depth, position), rows
    are reply-ordered conversations without quotes.

    A line's level is the number of > marks before it. Lines are normalised and hashed. A
    passage is a run of quoted lines of the same level, and its original is the latest earlier
    message of the thread that has it among its lines of level 0, as a whole and in order. The
    original of a line is the latest earlier message of the thread with that line. Both are
    found in sorted order, so a line that everyone wrote gives no pairs. A message replies to
    the latest original of its passages at level 1, or, if none has one, of its lines there, or
    at the next level that has a link. root is the first message of the chain of replies, and
    reply_depth the length of the chain. outside_thread tells of quoted lines that only another
    thread has, or that this one has later.

    Null or empty text has no lines and replies to nothing. Null threads are one thread, named
    null; a null position can't be replied to. Rows of the same thread and position are one
    message to those who quote it. Lines that nobody wrote count as quoted only.
    """
    rows = messages.select("thread", "position", "text").withColumn(
        "th", F.coalesce(F.col("thread").cast("long"), F.lit(NO_THREAD))
    )
    rows = cut(parsed(rows).withColumn("id", F.xxhash64("text")).drop("text"), "messages")
    lines = rows.select("th", "position", "id", F.explode("lines").alias("x")).select(
        "th", "position", "id", "x.*"
    )
    written = lines.where("level = 0 AND position IS NOT NULL")
    anywhere = written.groupBy("h1", "h2").agg(F.min("th").alias("low"), F.max("th").alias("high"))
    passages = cut(quoted_passages(rows), "quoted-passages")
    quoted = (
        lines.where("level > 0")
        .groupBy("th", "position", "id", "level", "h1", "h2")
        .agg(F.count("*").alias("n"))
        .withColumns({"k": F.lit(1), "single": F.lit(1)})
    )
    quoted = quoted.unionByName(
        passages.drop("a1", "a2").withColumns({"n": F.lit(0).cast("long"), "single": F.lit(0)})
    )
    originals = written.select("th", "position", F.lit(1).alias("k"), "h1", "h2").unionByName(
        written_passages(rows, passages)
    )
    found = latest_earlier(originals, quoted)
    quoted = quoted.join(found, [*PASSAGE, "position"], "left").join(
        anywhere, ["h1", "h2"], "left"
    )
    near = F.col("original").isNotNull()
    far = ~near & ((F.col("low") != F.col("th")) | (F.col("high") != F.col("th")))
    facts = quoted.groupBy("th", "position", "id").agg(
        F.sum("n").alias("n_quoted"),
        F.sum(F.when(near | far, F.col("n"))).alias("n_linked"),
        F.sum(F.when(far, F.col("n"))).alias("outside_thread"),
        F.max("level").cast("long").alias("levels"),
        F.min(F.when(near, F.struct("level", "single", (-F.col("original")).alias("up")))).alias("parent"),
    )
    rows = rows.withColumn("place", F.coalesce(F.col("position"), F.lit(NO_THREAD)))
    facts = facts.withColumn("place", F.coalesce(F.col("position"), F.lit(NO_THREAD))).drop("position")
    linked = cut(
        rows.join(facts, ["th", "place", "id"], "left").select(
            "thread", "th", "position", "own_text",
            (-F.col("parent.up")).alias("reply_to"),
            F.coalesce("levels", F.lit(0)).alias("levels"),
            F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            F.coalesce("outside_thread", F.lit(0)).alias("outside_thread"),
        ),
        "linked-messages",
    )
    chains = reply_chains(
        linked.where("position IS NOT NULL")
        .groupBy("th", "position")
        .agg(F.max("reply_to").alias("up"))
    )
    return linked.join(chains, ["th", "position"], "left").select(
        "thread",
        "position",
        "reply_to",
        F.coalesce("root", "position").alias("root"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("reply_depth"),
        "levels",
        "n_quoted",
        "n_linked",
        "outside_thread",
        "own_text",
    )


def reply_chains(replies: DataFrame) -> DataFrame:
    """(th, position, root, depth) from (th, position, up), by doubling the step upwards."""
    state = cut(
        replies.select(
            "th",
            "position",
            F.coalesce("up", "position").alias("root"),
            F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        ),
        "chains",
    )
    while True:
        above = state.select("th", F.col("position").alias("root"), F.col("root").alias("top"), F.col("depth").alias("more"))
        moved = cut(
            state.join(above, ["th", "root"], "left").select(
                "th",
                "position",
                F.coalesce("top", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "chains",
        )
        before, after = (s.agg(F.sum("depth")).first()[0] for s in (state, moved))
        state = moved
        if before == after:
            return state
