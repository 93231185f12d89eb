"""License scans against a brute-force search, and on edge cases."""

import random
import re

import pytest

from millrace.llm import licences

SCHEMA = "doc_id long, text string, row string, template int, score double"
MIT = next(t.text for t in licences.NOTICES if t.label == "mit")
FILLER = "the of software a to use copy free in is that under license and with lorem ipsum".split()


def words(text):
    lowered = (text or "").translate(str.maketrans(licences.UPPER, licences.UPPER.lower()))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    found, of = [], words(text)
    for template in licences.BASE:
        phrase = template.text.split()
        for i in range(len(of) - len(phrase) + 1):
            if of[i : i + len(phrase)] == phrase:
                found.append((i, template.label))
    return found


def scan(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "r", 1, 2.0) for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in licences.scan(docs, **options).collect()}


def test_base_places_against_brute_force(spark):
    rng = random.Random(11)
    phrases = ["Under the MIT License", "Apache License, version 2.0", "CC BY-NC", "cc by"]
    texts = []
    for _ in range(80):
        parts = [rng.choice(FILLER + phrases) for _ in range(rng.randint(0, 400))]
        texts.append(rng.choice([" ", "\n", ", "]).join(parts))
    found = scan(spark, texts)
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        places, r = base(text), found[i]
        assert r["n_words"] == len(words(text)) and r["n_base"] == len(places)
        starts = [p for p, _ in places]
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert {label for _, label in places} <= set(filter(None, r["labels"].split(",")))


def test_notices_with_words_left_out_or_changed(spark):
    of = MIT.split()
    texts = [
        "Copyright 2020.\n" + MIT.capitalize() + ".",
        " ".join(of[:20] + ["very"] + of[20:40] + of[41:]),  # one put in, one left out
        " ".join(of[: len(of) // 2]),  # half of it
        " ".join(random.Random(1).sample(of, len(of))),  # its words without their order
        "GNU General Public License, version 2",
        "Creative Commons Attribution-NonCommercial 4.0 International",
    ]
    found = scan(spark, texts)
    assert [found[i]["labels"] for i in range(6)] == ["mit", "mit", "", "", "gpl-2", "cc-by-nc"]
    assert found[0]["score"] == 1.0 and 0.9 < found[1]["score"] < 1.0
    assert found[2]["score"] == pytest.approx(0.5, abs=0.02)
    assert found[0]["n_base"] == 0 and found[0]["base_labels"] == ""


def test_spans_tell_where_a_notice_stands(spark):
    text = "one two three " + MIT + " four"
    known = licences.template_rows(spark, licences.TEMPLATES)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = licences.spans(licences.diagonals(docs, known, ["doc_id"])).where("score >= 0.8")
    (span,) = spans.collect()
    assert (span["label"], span["first"], span["last"]) == ("mit", 3, 2 + len(MIT.split()))


def test_long_texts_cross_stretches(spark):
    edge = licences.STRETCH
    texts = [" ".join(["x"] * n + ["under the mit license"] + ["y"] * 9) for n in range(edge - 5, edge + 3)]
    texts.append(" ".join(["word"] * 300_000 + ["cc by nc"] + ["word"] * 5))
    found = scan(spark, texts)
    for i, n in enumerate(range(edge - 5, edge + 3)):
        assert (found[i]["n_base"], found[i]["first_word"]) == (1, n)
        assert found[i]["n_words"] == n + 13
    assert (found[8]["n_base"], found[8]["first_word"], found[8]["n_words"]) == (1, 300_000, 300_008)


def test_nulls_empties_repeated_rows_and_clashing_names(spark):
    text = "released under the mit license"
    rows = [(1, text, None, 3, 0.5)] * 2 + [(None, text, "a", None, None)] * 2
    rows += [(2, None, "a", 1, 1.0), (3, "", "a", 1, 1.0), (4, " .\n", "a", 1, 1.0), (None, None, None, None, None)]
    rows += [(5, "under the İ mit license K", "a", 1, 1.0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = licences.scan(docs, keep=("doc_id", "row", "template", "score")).collect()
    assert len(found) == len(rows)
    assert sum(r["n_base"] for r in found) == 4
    assert sorted((r["n_words"], r["labels"]) for r in found if r["doc_id"] in (2, 3, 4)) == [(0, "")] * 3
    (five,) = [r for r in found if r["doc_id"] == 5]
    assert (five["n_words"], five["n_base"], five["score"]) == (6, 0, 0.0)
    assert {r["row"] for r in found if r["doc_id"] == 1} == {None}
    assert licences.scan(docs.limit(0)).count() == 0
    nothing = licences.scan(docs, templates=(licences.Template("short", "two words"),)).collect()
    assert len(nothing) == len(rows) and not any(r["labels"] for r in nothing)


def test_many_templates_are_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(licences, "BROADCAST_GRAMS", 0)
    assert scan(spark, ["released under the mit license"])[0]["labels"] == "mit"
