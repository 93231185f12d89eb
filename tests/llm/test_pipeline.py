"""Every stage of the pipeline against a plain Python version, on its own input."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from millrace.llm import langid, shards
from millrace.llm.store import cut
from tests.llm.test_rejection import WORDS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = 1 << 64


def sentence(lang, n, rng):
    return " ".join(f"{w}{rng.choice('aeiou')}" for w in rng.choices(WORDS[lang].split(), k=n))


def made_rows():
    rng = random.Random(11)
    passages = [sentence("en", 24, rng) for _ in range(4)]
    rows, sources = [], ["a", "a", "a", "b", "c", None]
    for i in range(240):
        lang = ("en", "de", "fi")[i % 3]
        text = sentence(lang, rng.randint(12, 90), rng)
        if i % 17 == 0:
            text = f"{text}\n{passages[i % 4].upper()}, {sentence(lang, 6, rng)}"
        rows.append((i, text, lang if i % 5 else None, rng.choice(sources), len(text)))
    for i in range(0, 240, 12):  # exact and near copies, in other sources, and without an id
        text = rows[i][1]
        near = f"{text} {rng.choice(WORDS['en'].split())}"
        rows += [(500 + i, text, None, "b", 1), (501 + i, near, None, "c", 1), (None, near, None, "a", 1)]
    rows += [rows[7], rows[7], (7, rows[8][1] + " zz", "en", "a", 1)]  # repeated rows and ids
    rows += [(900, None, "en", "a", 0), (901, "", "en", "b", 0), (902, " 12 \n 3", "de", None, 0)]
    rows += [(903, "qzx wvk jjq xxk " * 20, None, "a", 1), (None, None, None, None, None)]
    rng.shuffle(rows)
    items = [(f"i{k}", p) for k, p in enumerate(passages)] + [("short", "zq zq zq"), ("none", None)]
    return rows, items


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows, items = made_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


@pytest.fixture(scope="module")
def passed(spark, stored):
    """The rows before the first stage and after each."""
    folder, rows, _ = stored
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [[tuple(r) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, folder), f"test-{name}")
        found.append([tuple(r) for r in docs.collect()])
    assert Counter(found[0]) == Counter(rows)
    return found


# Hashes as Spark's xxhash64 makes them.


def signed(h):
    return h - LONG if h >= LONG >> 1 else h


def chained(*values):
    """xxhash64 over (kind, value) columns; nulls leave the hash as it was."""
    h = 42
    for kind, value in values:
        if value is not None:
            data = value.encode() if kind == "text" else struct.pack("<q" if kind == "long" else "<i", value)
            h = xxhash.xxh64_intdigest(data, seed=h % LONG)
    return signed(h)


def content(text):
    return chained(("text", text))


# Language ID, one text at a time.


def stirred(x):
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor % LONG
    return x ^ x >> 32


def buckets(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    letter = [b >= 0x80 or 97 <= b <= 122 for b in data]
    plain = [b if inside else 32 for b, inside in zip(data, letter, strict=True)]
    for size in (3, 4):
        for i in range(len(plain) - size + 1):
            gram = plain[i : i + size]
            if 32 not in gram[1:-1]:
                code = 0
                for b in gram:
                    code = (code * 257 + b) % (1 << 32)
                yield (code * 2654435761 + size) % (1 << 32) >> 17
    for word in re.findall(rb"[^ ]+", bytes(plain)):
        total = sum((b + 1) * pow(0x9E3779B97F4A7C15, k, LONG) for k, b in enumerate(word))
        yield stirred(total % LONG) >> 49


def judged(text, model):
    """Language, score and whether the model rejects the text."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, True
    found = list(buckets(text))
    logits = [
        sum(float(model.scores[b, k]) for b in found) / max(1, len(found)) + model.bias[k]
        for k in range(len(model.langs))
    ]
    raised = np.exp((np.array(logits) - max(logits)) / model.temperature)
    known = sum(float(model.familiar[b]) for b in found) / max(1, len(found))
    least = model.bounds[min(max(1, len(found)).bit_length() - 1, len(model.bounds) - 1)]
    return model.langs[int(raised.argmax())], float(raised.max() / raised.sum()), bool(known < least)


@pytest.fixture(scope="module")
def model(spark, stored):
    learned = [r for r in stored[1] if r[0] is None or zlib.crc32(str(r[0]).encode()) % 4 != 2]
    return langid.train(spark.createDataFrame(learned, SCHEMA).select("doc_id", "text", "lang"))


def test_predictions(spark, stored, model):
    docs = spark.createDataFrame(stored[1], SCHEMA)
    out = langid.identify(docs, model, keep=("doc_id", "text")).collect()
    assert len(out) == len(stored[1])
    for r in out:
        lang, score, rejected = judged(r["text"], model)
        assert (r["lang_pred"], r["rejected"]) == (lang, rejected)
        assert r["score"] == pytest.approx(score, abs=1e-3)


def test_language_stage(passed, model):
    verdicts = {r[1]: judged(r[1], model) for r in passed[0]}
    assert Counter(passed[1]) == Counter(r for r in passed[0] if not verdicts[r[1]][2])
    gone = {r[0] for r in passed[0]} - {r[0] for r in passed[1]}
    assert gone >= {900, 901, 902, 903} and not any(i is not None and i < 240 for i in gone)


# Near duplicates, all pairs.


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def test_near_duplicate_stage(passed):
    rows = [(r, shingle_set(r[1])) for r in passed[1]]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[top(i)] = top(j)
    groups = {}
    for i, (r, s) in enumerate(rows):
        groups.setdefault(top(i) if s else ("empty", i), []).append(r)
    first = lambda r: (r[0] is None, r[0] or 0, content(r[1]))
    stay = Counter(min(g, key=first)[:2] for g in groups.values())
    assert Counter(r[:2] for r in passed[2]) == stay
    assert len(passed[2]) < len(passed[1]) and set(passed[2]) <= set(passed[1])


# Benchmark passages, every window at every place.


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_decontamination_stage(stored, passed):
    windows = set()
    for _, text in stored[2]:
        words = plain_words(text)
        m = min(10, len(words))
        windows |= {tuple(words[i : i + m]) for i in range(len(words) - m + 1) if m}

    def clean(text):
        words = plain_words(text)
        return not any(
            tuple(words[i : i + m]) in windows
            for m in {len(w) for w in windows}
            for i in range(len(words) - m + 1)
        )

    assert Counter(passed[3]) == Counter(r for r in passed[2] if clean(r[1]))
    assert 0 < len(passed[3]) < len(passed[2])


# Mixing, source by source with a running sum.


def targets_of(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        free -= above
        if not free:
            return target


def test_mixing_stage(passed):
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes = Counter()
    for r in passed[3]:
        sizes[r[3]] += words(r)
    target = targets_of(sizes)
    taken, want = Counter(), Counter()
    for source in sizes:
        def place(r):
            name = r[1] if r[0] is None else r[0]
            digest = hashlib.md5(f"8|{'' if name is None else name}".encode()).hexdigest()
            return (len(str(words(r))), str(words(r))[:2], digest, words(r), content(r[1]))

        key = "" if source is None else f"s{source}"
        start = int(hashlib.md5(f"8|{key}".encode()).hexdigest()[:5], 16)
        rate = int(target[source] / sizes[source] * (1 << 20))
        at = start
        for r in sorted((r for r in passed[3] if r[3] == source), key=place):
            copies = (at + rate >> 20) - (at >> 20)
            at += rate
            want[r] += copies
            taken[source] += copies * words(r)
            assert copies <= 2
    assert Counter(passed[4]) == +want
    largest = max(map(words, passed[3]))
    assert all(abs(taken[s] - target[s]) <= 2 * largest for s in sizes)


# Sharding, bucket by bucket.


def shuffled(rows, count, bucket_rows):
    def h(r):
        kinds = ("long", "text", "text", "text", "long")
        return chained(*zip(kinds, r, strict=True))

    held = {}
    number = max(1, -(-len(rows) // bucket_rows))
    for r in rows:
        held.setdefault(chained(("int", 7), ("long", h(r)), ("long", 0)) % number, []).append(r)
    order = []
    none_first = lambda v: (v is not None, v if v is not None else 0)
    for bucket in sorted(held):
        mine = sorted(
            held[bucket],
            key=lambda r: (none_first(r[0]), content(r[1]), r[1] or "", r[2] or "", r[3] or "", r[4] or 0),
        )
        seed = chained(("int", 7), ("long", bucket))
        places = list(range(len(mine)))
        for i in range(len(mine) - 1, 0, -1):
            j = chained(("long", seed), ("int", i)) % (i + 1)
            places[i], places[j] = places[j], places[i]
        order += [mine[p] for p in places]
    return Counter((*r, p % count, p // count) for p, r in enumerate(order))


def test_sharding_stage(spark, stored, passed):
    assert Counter(passed[5]) == shuffled(passed[4], 40, 1024)
    assert Counter(map(tuple, corpus_pipeline.run(spark, stored[0]).collect())) == Counter(passed[5])


def test_sharding_of_many_buckets(spark, stored):
    docs = spark.createDataFrame(stored[1], SCHEMA)
    out = shards.shuffle(docs, shards=7, bucket_rows=16)
    assert Counter(map(tuple, out.collect())) == shuffled(stored[1], 7, 16)


@pytest.mark.parametrize("case", ["empty", "unlabelled"])
def test_stages_without_rows_or_labels(spark, stored, case):
    """No rows give no rows; without labels the first stage keeps every document."""
    docs = spark.createDataFrame(stored[1] if case == "unlabelled" else [], SCHEMA)
    docs = docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang", "source", "n_chars")
    before = docs.count()
    kept = cut(corpus_pipeline.known_language(spark, docs, stored[0]), "test-first")
    assert kept.count() == before
    if case == "empty":
        for name, stage in corpus_pipeline.STAGES[1:]:
            kept = cut(stage(spark, kept, stored[0]), f"test-{name}")
            assert kept.count() == 0
