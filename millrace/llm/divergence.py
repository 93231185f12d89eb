"""Quality rules: divergence of a document's distributions from its language's."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.store import cut

#: What is between words.
BETWEEN = r"[\x20\x09-\x0D]+"
#: Classes of characters; what is in none of them is the last class.
CLASSES = ("[a-z]+", "[A-Z]+", "[0-9]+", r"[\x20\x09-\x0D]+", r"[^\x00-\x7F]+")
#: The class that is between words.
SPACE = 3
#: References fewer than this are sent to all tasks; each is a few kilobytes.
BROADCAST_LANGS = 1024


@dataclass(frozen=True)
class Rules:
    """When a document's distributions are too far from its language's.

    Distances are Jensen-Shannon, 0 to 1. A histogram of few characters or words says little,
    so each rule has a least length; below it the rule passes. A language with fewer words
    than least_reference is held against the pool of all languages.
    """

    common_words: int = 24
    least_reference: int = 2000
    least_chars: int = 200
    farthest_chars: float = 0.30
    least_words: int = 100
    farthest_words: float = 0.45


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, n: Column) -> Column:
    """How many words lie in 3-word windows that the array holds twice or more.

    Windows are hashed, and sorted by the hash's high bits with the place in the low ones, so
    equal windows become neighbours; whether neighbours are equal is told by whole hashes. The
    places of repeated windows, in order, each cover up to three words more.
    """
    windows = F.when(
        n > 2,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    )

    def counted(hashes: Column) -> Column:
        def covered(order: Column, low: Column) -> Column:
            # The hash of each place in the order, and of its neighbours.
            sorted_hashes = F.transform(order, lambda k: F.get(hashes, k.bitwiseAND(low).cast("int")))

            def repeated(own: Column) -> Column:
                return F.filter(
                    F.transform(
                        order,
                        lambda k, j: F.when(
                            (F.get(own, j) == F.get(own, j - 1))
                            | (F.get(own, j) == F.get(own, j + 1)),
                            k.bitwiseAND(low),
                        ),
                    ),
                    lambda place: place.isNotNull(),
                )

            return let(
                F.sort_array(let(sorted_hashes, repeated)),
                lambda at: F.aggregate(
                    F.transform(
                        at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3)))
                    ),
                    F.lit(0).cast("long"),
                    lambda total, more: total + more,
                ),
            )

        def marked(low: Column) -> Column:
            high = F.bitwise_not(low)
            return F.transform(hashes, lambda h, i: h.bitwiseAND(high).bitwiseOR(i.cast("long")))

        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        low = F.pow(F.lit(2), F.length(F.bin(F.size(hashes)))).cast("long") - 1
        found = let(low, lambda bits: let(F.sort_array(marked(bits)), lambda o: covered(o, bits)))
        return F.when(some, found).otherwise(F.lit(0).cast("long"))

    return F.coalesce(let(windows, counted), F.lit(0).cast("long"))


def held_of(text: Column, kind: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, kind, ""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN), "")


def split_up(docs: DataFrame) -> DataFrame:
    """docs (with text), and its words, lines with a word, and counts of characters."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(
        F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))
    )
    chars = [held_of(text, c) for c in CLASSES]
    parts = F.struct(
        words_of(text).alias("words"),
        F.array(*chars).cast("array<long>").alias("chars"),
        F.length(text).cast("long").alias("n_chars_all"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    # One row in, one row out. Filters above don't pass a generator, so the optimizer never
    # copies the splitting of a text into an expression that is run for each word.
    return docs.select("*", F.explode_outer(F.array(parts)).alias("parts")).select(
        *docs.columns, "parts.*"
    )


def base_rules(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_dup_lines, n_repeat_words, base_failed to split rows."""
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.col("n_chars_all") - F.get("chars", F.lit(SPACE)),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("words"), F.size("words")),
        }
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return rows.withColumn("base_failed", failed).drop("lines")


def jensen_shannon(counts: Column, shares: Column) -> Column:
    """The distance of a histogram of counts from one of shares, in the same order."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    def distance(n: Column) -> Column:
        terms = F.zip_with(counts, shares, lambda c, q: part(c / n, q) + part(q, c / n))
        return F.sqrt(
            F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2)
        )

    return F.when(total > 0, let(total, distance))


def references(docs: DataFrame, rules: Rules) -> DataFrame:
    """(key, common, word_shares, char_shares): a row a language, and one named "" for all.

    Every document counts, whole, with words of any length, and counts are added up before they
    are sent. Characters are counted from the words' counts, as all but white space is in words.
    """
    counted = docs.select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    words = cut(counted.groupBy("lang", "word").agg(F.count("*").alias("n")), "common-words")
    held = [F.when(F.lit(i != SPACE), held_of(F.col("word"), c)) for i, c in enumerate(CLASSES)]
    inside = words.groupBy("lang").agg(
        F.sum("n").alias("all_words"),
        *[F.sum(F.col("n") * F.coalesce(h, F.lit(0))).alias(f"c{i}") for i, h in enumerate(held)],
        F.sum(F.col("n") * F.length("word")).alias("in_words"),
        F.lit(0).cast("long").alias("all_chars"),
    )
    lengths = docs.groupBy("lang").agg(F.sum(F.length("text").cast("long")).alias("all_chars"))
    both = inside.unionByName(lengths, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in inside.columns if c != "lang"]
    totals = both.groupBy("lang").agg(*sums)
    totals = totals.withColumn(f"c{SPACE}", F.col("all_chars") - F.col("in_words")).drop("in_words")
    totals = cut(totals, "language-totals")
    known = totals.where(F.col("lang").isNotNull() & (F.col("all_words") >= rules.least_reference))
    sums = [F.sum(c).alias(c) for c in totals.columns if c != "lang"]
    totals = known.withColumn("key", F.concat(F.lit("l"), "lang")).drop("lang").unionByName(
        totals.agg(*sums).withColumn("key", F.lit(""))
    )
    words = words.withColumn("key", F.concat(F.lit("l"), "lang")).where("key IS NOT NULL").select(
        "key", "word", "n"
    ).union(
        words.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(""), "word", "n")
    )
    place = F.row_number().over(W.partitionBy("key").orderBy(F.desc("n"), "word"))
    common = (
        words.withColumn("place", place)
        .where(F.col("place") <= rules.common_words)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("common"))
    )
    classes = [F.col(f"c{i}") for i in range(len(CLASSES))]
    rest = F.col("all_chars") - sum(classes[1:], classes[0])
    none = F.array().cast("array<struct<place:int,word:string,n:bigint>>")
    rows = totals.where("all_words > 0 AND all_chars > 0").join(common, "key", "left")
    rows = rows.withColumn("common", F.coalesce("common", none))
    shares = F.transform("common.n", lambda n: n / F.col("all_words"))
    spent = F.aggregate("common.n", F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select(
        "key",
        F.col("common.word").alias("common"),
        F.coalesce(F.array_max(F.transform("common.word", F.length)), F.lit(0)).alias("longest"),
        F.concat(shares, F.array(1 - spent / F.col("all_words"))).alias("word_shares"),
        F.transform(F.array(*classes, rest), lambda c: c / F.col("all_chars")).alias("char_shares"),
    )


def judge(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rules: Rules = Rules()
) -> DataFrame:
    """The kept columns of docs (doc_id, text, lang), then n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, char_distance, word_distance.

    A document that fails the base rules isn't kept. Another is kept unless its characters or
    its words are too far from its language's, given enough of them. A null lang, or one with
    too few words, is held against all languages together. Null and empty texts have no words
    and fail. Without any words there is no reference, and distances are null, which passes. Repeated rows are judged alike. Kept columns with names of results are replaced.
    """
    own = (
        "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept "
        "char_distance word_distance"
    ).split()
    keep = [c for c in keep if c not in own]
    split = split_up(docs.select(F.struct(*keep).alias("row"), "text", "lang"))
    found = cut(references(docs, rules), "references")
    rows = base_rules(split)
    small = found.count() <= BROADCAST_LANGS
    named = found.select(F.col("key").alias("named")).where("named != ''")
    langs = F.concat(F.lit("l"), "lang")
    rows = rows.withColumn("wanted", langs)
    rows = rows.join(F.broadcast(named) if small else named, F.col("wanted") == F.col("named"), "left")
    rows = rows.withColumn("key", F.coalesce("named", F.lit("")))
    rows = rows.join(F.broadcast(found) if small else found, "key", "left")
    # A word longer than all common ones needs no search among them.
    likely = F.filter("words", lambda w: F.length(w) <= F.col("longest"))
    places = F.filter(
        F.transform(likely, lambda w: F.array_position("common", w)), lambda at: at > 0
    )
    rows = rows.withColumn("places", places)
    held = F.concat(
        F.transform(
            F.sequence(F.lit(1), F.size("common")).cast("array<long>"),
            lambda k: (F.size("places") - F.size(F.array_remove("places", k))).cast("long"),
        ),
        F.array(F.col("n_words") - F.size("places")),
    )
    classes = F.concat(
        "chars",
        F.array(
            F.col("n_chars_all") - F.aggregate("chars", F.lit(0).cast("long"), lambda a, b: a + b)
        ),
    )
    rows = rows.withColumns({"held": held, "classes": classes})
    rows = rows.withColumns(
        {
            "char_distance": jensen_shannon(F.col("classes"), F.col("char_shares")),
            "word_distance": jensen_shannon(F.col("held"), F.col("word_shares")),
        }
    )
    far_chars = (F.col("n_chars_all") >= rules.least_chars) & (
        F.col("char_distance") > rules.farthest_chars
    )
    far_words = (F.col("n_words") >= rules.least_words) & (
        F.col("word_distance") > rules.farthest_words
    )
    kept = ~F.col("base_failed") & ~F.coalesce(far_chars | far_words, F.lit(False))
    return rows.withColumn("kept", kept).select("row.*", *own)
