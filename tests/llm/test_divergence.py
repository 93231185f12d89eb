"""Distances of op4 against brute force, where frequent words are long."""

import math
import random
import re
from collections import Counter

import pytest

from millrace.llm import divergence

SHORT = "the of and to in is that it was for on are as with his they at be this from have or by".split()
LONG = "который человек говорить большой рабочий сегодня хороший история причина ведение".split()
RULES = divergence.Rules()


def chars(text):
    kinds = (r"[a-z]", r"[A-Z]", r"[0-9]", r"[\x20\x09-\x0D]", r"[^\x00-\x7F]")
    counts = [len(re.findall(k, text)) for k in kinds]
    return [*counts, len(text) - sum(counts)]


def jensen_shannon(counts, reference):
    p = [c / sum(counts) for c in counts]
    q = [c / sum(reference) for c in reference]
    terms = [a * math.log2(2 * a / (a + b)) for x, y in ((p, q), (q, p))
             for a, b in zip(x, y, strict=True) if a > 0]
    return math.sqrt(max(0.0, sum(terms) / 2))


def held(text, common):
    counts = Counter(text.split())
    return [*(counts[w] for w in common), sum(counts.values()) - sum(counts[w] for w in common)]


def test_distances_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        lang = ("en", "ru", "mixed")[i % 3]
        words = {"en": SHORT, "ru": LONG, "mixed": SHORT + ["registration", "everywhere"] * 6}[lang]
        rows.append((i, " ".join(rng.choices(words, k=rng.randint(120, 200))) + f". Item {i}", lang))
    rows.append((60, " ".join(rng.choices(LONG, k=150)), "en"))  # far from its language
    found = divergence.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {r["doc_id"]: r for r in found.collect()}
    for lang in ("en", "ru", "mixed"):
        texts = [text for _, text, own in rows if own == lang]
        counts = Counter(w for text in texts for w in text.split())
        assert sum(counts.values()) >= RULES.least_reference
        common = sorted(counts, key=lambda w: (-counts[w], w.encode()))[: RULES.common_words]
        words = [sum(c) for c in zip(*(held(text, common) for text in texts), strict=True)]
        classes = [sum(c) for c in zip(*(chars(text) for text in texts), strict=True)]
        for doc_id, text, own in rows:
            if own == lang:
                r, far_words = found[doc_id], jensen_shannon(held(text, common), words)
                far_chars = jensen_shannon(chars(text), classes)
                assert r["word_distance"] == pytest.approx(far_words, abs=1e-9)
                assert r["char_distance"] == pytest.approx(far_chars, abs=1e-9)
                far = far_words > RULES.farthest_words or far_chars > RULES.farthest_chars
                assert r["kept"] == (not r["base_failed"] and not far)
    # Long words only are no reason to be held against the pool of all languages.
    assert not found[60]["kept"]
    assert all(r["kept"] or r["base_failed"] for i, r in found.items() if i < 60)
    assert any(found[i]["kept"] for i in range(1, 60, 3))
