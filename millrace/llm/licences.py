"""License scans by diagonal voting of word k-grams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Words of lower-cased texts are runs of a-z, 0-9 and what isn't ASCII; this is between them.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GRAM = 3
#: Words of a text that are worked on at once; a longer text is several stretches.
STRETCH = 256
#: Diagonals so far apart at most belong to one span: words put in or left out.
SLACK = 3
#: Share of a span's and its template's words that must agree.
LEAST_SCORE = 0.8
#: k-grams of templates that are sent to all tasks; more are joined by shuffling both sides.
BROADCAST_GRAMS = 200_000


@dataclass(frozen=True)
class Template:
    """A license's wording. An exact one must stand word by word; base ones are counted."""

    label: str
    text: str
    exact: bool = True
    base: bool = False


# Phrases whose places are counted, with their labels.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
# Names that tell a license apart from its relatives, and the usual notices.
NOTICES = (
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0 international"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software",
        exact=False,
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at http www apache org licenses license 2 0",
        exact=False,
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
        exact=False,
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        exact=False,
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        exact=False,
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        exact=False,
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        exact=False,
    ),
)
TEMPLATES = BASE + NOTICES


def words_of(text: Column) -> Column:
    """The words after lower-casing A-Z. Splitting is much faster here than extracting."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, BETWEEN), "")


def grams(words: Column) -> Column:
    """The hashes of all runs of GRAM words, in order."""
    hashed = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(GRAM)])
    return F.when(
        F.size(words) >= GRAM, F.transform(F.sequence(F.lit(0), F.size(words) - GRAM), hashed)
    ).otherwise(F.array().cast("array<bigint>"))


def template_rows(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(template, label, exact, base, words, n_grams) of templates of GRAM words at least."""
    rows = [(i, t.label, t.exact, t.base, t.text) for i, t in enumerate(templates)]
    found = spark.createDataFrame(
        rows, "template int, label string, exact boolean, base boolean, text string"
    )
    found = found.withColumn("template_words", words_of(F.col("text"))).drop("text")
    n_grams = F.size("template_words") - (GRAM - 1)
    return found.withColumn("n_grams", n_grams).where("n_grams > 0")


def votes(docs: DataFrame, templates: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row for each stretch of a text, and one for each k-gram that a template has.

    Rows of stretches have `n`, their words, and a text's first has `row`, the kept columns;
    rows of k-grams have the template, its place `at`, their own place `pos` and their words.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("text_id"),
        F.struct(*keep).alias("row"),
        # One row in, one row out: the optimizer never copies the splitting of a text past it.
        F.explode(F.array(words_of(F.col("text")))).alias("words"),
    )
    n = F.size("words")
    stretches = F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(STRETCH))).otherwise(F.array(F.lit(0))),
        lambda s: F.struct(
            s.alias("start"),
            F.least(F.lit(STRETCH), n - s).alias("n"),
            F.slice("words", s + 1, F.lit(STRETCH + GRAM - 1)).alias("part"),
        ),
    )
    parts = texts.select("text_id", "row", F.explode(stretches).alias("s")).select(
        "text_id", F.when(F.col("s.start") == 0, F.col("row")).alias("row"), "s.*"
    )
    # The first hash is null and stands for the stretch itself.
    hashes = F.concat(F.array(F.lit(None).cast("long")), grams(F.col("part")))
    run = parts.select("*", F.posexplode(hashes).alias("i", "hash"))
    at = templates.select("template", F.posexplode(grams(F.col("template_words"))).alias("at", "hash"))
    small = at.count() <= BROADCAST_GRAMS
    met = run.join(F.broadcast(at) if small else at, "hash", "left")
    is_mark = F.col("i") == 0
    met = met.where(is_mark | F.col("template").isNotNull())
    return met.select(
        "text_id",
        F.when(is_mark, F.col("row")).alias("row"),
        F.when(is_mark, F.col("n")).alias("n"),
        "template",
        "at",
        (F.col("start") + F.col("i") - 1).alias("pos"),
        F.when(~is_mark, F.slice("part", F.col("i"), F.lit(GRAM))).alias("words"),
    )


def diagonals(docs: DataFrame, templates: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Votes added up by text, template and offset diagonal (place in the text less place in
    the template), with the template's places whose words have been compared and agree.

    Rows without a template have a text's number of words and its kept columns. Votes are dealt
    by text, so a wording that most texts hold spreads over tasks.
    """
    cast = votes(docs, templates, keep).repartition("text_id")
    on = cast.groupBy("text_id", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.first("row", ignorenulls=True).alias("row"),
        F.sum("n").cast("long").alias("n_words"),
        F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "words"))).alias("cast"),
    )
    on = on.join(F.broadcast(templates), "template", "left")
    same = F.filter(
        "cast", lambda v: v["words"] == F.slice(F.col("template_words"), v["at"] + 1, F.lit(GRAM))
    )
    on = on.withColumn("agreed", F.array_sort(F.transform(same, lambda v: v["at"]))).drop("cast")
    return on.where("template IS NULL OR size(agreed) > 0")


def spans(found: DataFrame) -> DataFrame:
    """Neighbouring diagonals merged: (text_id, row, n_words, template, label, exact, base,
    first, last, score, places, ...), one row a span and one a text.

    `first` and `last` are the span's words, `score` the share of words that agree of the longer
    of span and template. `places` are the diagonals on which an exact template stands whole.
    """
    line = W.partitionBy("text_id", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(line) > SLACK
    chained = found.withColumn("chain", F.sum(F.coalesce(apart, F.lit(False)).cast("int")).over(line))
    whole = F.col("exact") & (F.size("agreed") == F.col("n_grams"))
    merged = chained.groupBy("text_id", "template", "chain").agg(
        F.first("row", ignorenulls=True).alias("row"),
        F.max("n_words").alias("n_words"),
        *[F.first(c).alias(c) for c in ("label", "exact", "base", "n_grams")],
        F.min(F.col("diagonal") + F.array_min("agreed")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("agreed") + (GRAM - 1)).alias("last"),
        F.collect_list(F.when(whole, F.col("diagonal"))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("agreed")))).alias("agreed"),
    )
    # Places in order, each covering GRAM words or as many as there are to the next one.
    covered = F.aggregate(
        F.transform(
            "agreed",
            lambda p, i: F.least(F.lit(GRAM), F.coalesce(F.get("agreed", i + 1) - p, F.lit(GRAM))),
        ),
        F.lit(0),
        lambda total, more: total + more,
    )
    longer = F.greatest(F.col("n_grams") + (GRAM - 1), F.col("last") - F.col("first") + 1)
    score = F.when(F.col("exact"), (F.size("places") > 0).cast("double")).otherwise(covered / longer)
    return merged.withColumn("score", score).drop("chain", "agreed", "n_grams")


def scan(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    templates: Sequence[Template] = TEMPLATES,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """The kept columns of docs, then n_words, n_base, first_word, last_word, base_labels,
    labels and score.

    All k-grams of all texts are joined to the templates' by hash; each match is a vote for an
    offset diagonal. Neighbouring diagonals are one span, whose words are compared with the
    template's. n_base counts places where a base template stands whole, first_word and
    last_word are the first and last of their beginnings. labels has those of all spans with
    least_score or more, which for an exact template means that it stands whole, and score is
    the best of any span.

    Null and empty texts have no words and no labels. Texts are told apart by row, so repeated
    rows have results each. An empty table gives no rows. Templates of less than GRAM words are
    ignored. Kept columns with the names of results are replaced.
    """
    own = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    keep = [c for c in keep if c not in own]
    known = template_rows(docs.sparkSession, templates)
    found = spans(diagonals(docs, known, keep))
    base, good = F.col("base") & (F.size("places") > 0), F.col("score") >= least_score

    def joined(which: Column) -> Column:
        labels = F.collect_set(F.when(which, F.col("label")))
        return F.array_join(F.array_sort(labels), ",")

    return (
        found.groupBy("text_id")
        .agg(
            F.first("row", ignorenulls=True).alias("row"),
            F.max("n_words").alias("n_words"),
            F.sum(F.when(base, F.size("places")).otherwise(0)).cast("long").alias("n_base"),
            F.min(F.when(base, F.array_min("places"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.array_max("places"))).cast("long").alias("last_word"),
            joined(base).alias("base_labels"),
            joined(good).alias("labels"),
            F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
        )
        .select("row.*", *own)
    )
