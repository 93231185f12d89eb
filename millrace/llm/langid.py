"""Language identification by averaged hashed subword embeddings."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.store import ship
from millrace.llm.words import find_words, slices, table_of, texts, word_hashes

#: ASCII other than letters parts words; every other byte counts as part of a letter.
SEPARATORS = bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
INSIDE, VALUE = table_of(SEPARATORS)
_PLAIN = np.where(INSIDE, VALUE, 32).astype(np.uint8)
_LETTER = re.compile(r"[^\W\d_]")
#: Text that is worked on at once; its subwords take some sixty bytes for each of its own.
PART_BYTES = 1 << 18
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
GRAMS = (3, 4)
UNKNOWN = "und"
#: Openings of the sampled texts, in words, that tell how short texts behave.
OPENINGS = (2, 8, 32)
#: Added to each bucket's count, so that an unseen subword has a small share.
UNSEEN = 0.5
#: A length class, which is the power of two below the number of subwords, has its own bound
#: if it holds so many rows.
CLASS_ROWS = 100


def subwords(data: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of subword its bucket and place, over all texts.

    Subwords are words and runs of 3 and 4 bytes of a word with a space on either side.
    """
    plain = _PLAIN[data]
    found = []
    n = len(plain)
    space = plain == 32
    wide = plain.astype(np.uint32)
    for size in GRAMS:
        m = max(0, n - size + 1)
        code = np.zeros(m, np.uint32)
        inner = np.zeros(m, bool)
        for k in range(size):
            code = code * np.uint32(257) + wide[k : k + m]
            if 0 < k < size - 1:
                inner |= space[k : k + m]
        bucket = (code * np.uint32(2654435761) + np.uint32(size)) >> np.uint32(32 - BUCKET_BITS)
        for k in range(1, size):  # not across two texts
            edge = at[1:-1] - k
            inner[edge[(edge >= 0) & (edge < m)]] = True
        place = np.flatnonzero(~inner)
        found.append((bucket[place].astype(np.int64), place))
    starts, ends, _ = find_words(VALUE[data], at, INSIDE)
    words = word_hashes(VALUE[data], starts, ends) >> np.uint64(64 - BUCKET_BITS)
    found.append((words.astype(np.int64), starts))
    return found


@dataclass(frozen=True)
class Model:
    """Scores of each bucket for each language, and how familiar a text's subwords must be.

    `familiar` has of each bucket the logarithm of its share in the language that uses it most,
    and `bounds` the least mean of these by length class.
    """

    langs: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    familiar: np.ndarray
    bounds: np.ndarray

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The best language of each text, its score, and whether the text is rejected."""
        rows = len(column)
        langs, score = [UNKNOWN] * rows, np.zeros(rows)
        if not self.langs:
            return langs, score, np.zeros(rows, bool)
        rejected = np.ones(rows, bool)
        data, at = texts(column)
        for lo, hi in slices(at, PART_BYTES):
            part, offsets = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            total = np.zeros((hi - lo, len(self.langs)))
            count, known = np.zeros(hi - lo), np.zeros(hi - lo)
            for bucket, place in subwords(part, offsets):
                cuts = np.searchsorted(place, offsets)
                count += np.diff(cuts)
                full = np.flatnonzero(np.diff(cuts))
                if len(full):
                    total[full] += np.add.reduceat(self.scores[bucket], cuts[full], axis=0)
                    known[full] += np.add.reduceat(self.familiar[bucket], cuts[full])
            logits = total / np.maximum(count, 1)[:, None] + self.bias
            chance = softmax(logits / self.temperature)
            best = chance.argmax(axis=1)
            score[lo:hi] = chance[np.arange(hi - lo), best]
            least = self.bounds[np.minimum(length_class(count), len(self.bounds) - 1)]
            rejected[lo:hi] = known / np.maximum(count, 1) < least
            for row, lang in enumerate(best.tolist()):
                langs[lo + row] = self.langs[lang]
        for row, text in enumerate(column):
            if not (text.is_valid and _LETTER.search(text.as_py())):
                langs[row], score[row], rejected[row] = UNKNOWN, 0.0, True
        return langs, score, rejected


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def length_class(count: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(count, 1)).astype(np.int64)


def familiarity(
    langs: int, sample: list[tuple[int, list[tuple[np.ndarray, np.ndarray]]]], lost_share: float
) -> tuple[np.ndarray, np.ndarray]:
    """Model.familiar and Model.bounds, from texts of (language, histograms: whole, openings).

    Known rows are texts and openings, each against all texts but its own. Unknown ones are the
    same against the other languages only, as if theirs had never been learned. Where the two
    are apart, the bound of a length class lies in the middle; else it is the `lost_share`
    quantile of the known ones. A class of few rows takes in its neighbours.
    """
    counts = np.full((langs, BUCKETS), UNSEEN)
    for lang, ((at, n), *_) in sample:
        counts[lang, at] += n
    sums = counts.sum(axis=1)
    shares = np.log(counts / sums[:, None])
    best = shares.argmax(axis=0)
    familiar = shares.max(axis=0)
    shares[best, np.arange(BUCKETS)] = -np.inf
    second = shares.max(axis=0)
    size, known, unknown = [], [], []
    for lang, parts in sample:
        own_at, own = parts[0]
        for at, n in parts:
            left = counts[lang, at] - own[np.searchsorted(own_at, at)]
            others = np.where(best[at] == lang, second[at], familiar[at])
            mine = np.log(left / (sums[lang] - own.sum()))
            size.append(n.sum())
            known.append(n @ np.maximum(mine, others) / n.sum())
            unknown.append(n @ others / n.sum())
    kind, known, unknown = length_class(np.array(size)), np.array(known), np.array(unknown)
    bounds = np.zeros(kind.max() + 1)
    for k in range(len(bounds)):
        near = 0
        while (rows := abs(kind - k) <= near).sum() < min(CLASS_ROWS, len(kind)):
            near += 1
        bounds[k] = low = np.quantile(known[rows], lost_share)
        if langs > 1:
            bounds[k] = (low + min(low, np.quantile(unknown[rows], 1 - lost_share))) / 2
    return familiar.astype(np.float32), bounds


def training_sample(labelled: DataFrame, per_lang: int, rows: int) -> DataFrame:
    """At most per_lang rows of a language and `rows` rows in all, chosen by a hash of doc_id.

    Rows are ranked by keys alone, with a hash in place of the text; rows alike in all count
    once. The keys taken, `rows` at most, are sent to the texts, so that only theirs are moved.
    """
    named = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", "doc_id", F.xxhash64("text").alias("content")
    )
    order = [F.xxhash64(F.lit(5), "doc_id"), F.col("doc_id"), F.col("content")]
    taken = (
        named.withColumn("rank", F.dense_rank().over(W.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= per_lang)
        .select("rank", F.col("lang").alias("l"), F.col("doc_id").alias("d"), F.col("content").alias("c"))
        .distinct()
        .orderBy("rank", "l")
        .limit(rows)
    )
    same = (F.col("lang") == F.col("l")) & F.col("doc_id").eqNullSafe(F.col("d"))
    found = named.join(F.broadcast(taken), same & (F.col("content") == F.col("c")), "left_semi")
    return found.groupBy("lang", "doc_id", "content").agg(F.min("text").alias("text")).select("lang", "text")


def histogram(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text, in order, and how often it has each."""
    data, at = texts(pa.array([text], pa.large_string()))
    joined = np.concatenate([b for b, _ in subwords(data, at)])
    return np.unique(joined, return_counts=True)


def openings(text: str) -> list[str]:
    """The first few words of a text that has more."""
    words = text.split(maxsplit=max(OPENINGS))
    return [" ".join(words[:n]) for n in OPENINGS if n < len(words)]


def _histograms(batches):
    """Histograms as bytes, which the driver reads in place and need no object a bucket."""
    many = pa.list_(pa.binary())
    for batch in batches:
        buckets, counts = [], []
        for text in batch.column("text").to_pylist():
            parts = [histogram(part) for part in [text, *openings(text)]]
            buckets.append([at.astype(np.int32).tobytes() for at, _ in parts if len(at)])
            counts.append([n.astype(np.int32).tobytes() for _, n in parts if len(n)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(buckets, many), pa.array(counts, many)],
            ["lang", "buckets", "counts"],
        )


def train(
    labelled: DataFrame,
    per_lang: int = 400,
    rows: int = 2400,
    width: int = 16,
    updates: int = 16_000,
    rate: float = 0.5,
    lost_share: float = 0.001,
    seed: int = 5,
) -> Model:
    """Learns from a bounded sample of rows (doc_id, text, lang).

    Every subword bucket has an embedding; a text is the mean of its subwords' embeddings, and
    a linear softmax tells its language. Both are trained by stochastic gradient descent, one
    text at a time and as many times as make `updates`, on four fifths of the sample. The last fifth sets the temperature that
    makes scores honest. What is rejected isn't told by the score, which is high for some
    language even if the text is in none, but by how familiar a text's subwords are in any
    language, so that mixed texts stay (see `familiarity`). The sample has at most `rows` rows; of each the
    driver holds bucket counts, not the text. Without labelled rows the model knows no language.
    Below 50 rows there is no last fifth: the temperature is set on the rows learned from.
    """
    ship(labelled.sparkSession)
    sample = training_sample(labelled, per_lang, rows)
    taken = sample.mapInArrow(
        _histograms, "lang string, buckets array<binary>, counts array<binary>"
    ).collect()
    parts = [
        (
            r["lang"],
            [
                (np.frombuffer(at, np.int32), np.frombuffer(n, np.int32))
                for at, n in zip(r["buckets"], r["counts"], strict=True)
            ],
        )
        for r in taken
        if r["buckets"]
    ]
    taken = [(lang, *whole) for lang, (whole, *_) in parts]
    taken.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes(), x[2].tobytes()))
    langs = tuple(sorted({lang for lang, _, _ in taken}))
    if not langs:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, np.zeros(0), np.zeros(1))
    label = {lang: i for i, lang in enumerate(langs)}
    rng = np.random.default_rng(seed)
    rng.shuffle(taken)
    texts_of = [(label[lang], at, counts / counts.sum()) for lang, at, counts in taken]
    held = texts_of[::5] if len(texts_of) >= 50 else texts_of
    learned = [t for i, t in enumerate(texts_of) if i % 5] if len(texts_of) >= 50 else texts_of

    table = rng.uniform(-1 / width, 1 / width, (BUCKETS, width))
    output, bias = np.zeros((width, len(langs))), np.zeros(len(langs))
    epochs = -(-updates // len(learned))
    steps, done = epochs * len(learned), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learned)):
            lang, at, share = learned[i]
            mean = share @ table[at]
            error = softmax(mean @ output + bias)
            error[lang] -= 1
            step = rate * (1 - done / steps)
            back = output @ error
            output -= step * np.outer(mean, error)
            bias -= step * 0.1 * error
            # Divided by the square sum of shares, so that a step moves the mean as far for a
            # long text as for a short one.
            table[at] -= step * np.outer(share / (share @ share), back) * 0.1
            done += 1
    scores = table @ output
    logits = np.array([share @ scores[at] + bias for _, at, share in held])
    truth = np.array([lang for lang, _, _ in held])
    grid = np.geomspace(0.05, 5, 40)
    losses = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    familiar, bounds = familiarity(
        len(langs), [(label[lang], rows) for lang, rows in parts], lost_share
    )
    return Model(langs, scores.astype(np.float32), bias, temperature, familiar, bounds)


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs, then lang_pred, score (0 to 1) and rejected.

    Whole texts are read, with the text as the only input. Null texts and those without a
    letter are `und` with score 0 and rejected, as are texts whose subwords are strange to all
    languages of the model, which keep their best language and its score. A model that knows no
    language can't tell: all texts are `und` with score 0, and none is rejected. Repeated rows
    are judged alike, an empty table gives no rows, and kept columns with names of results are
    replaced.

    A text is sent to a task once, also if it is a kept column, and handed back as it came.
    """
    own = ("lang_pred", "score", "rejected")
    keep = [c for c in keep if c not in own]
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            langs, score, rejected = shared.value.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in keep],
                    pa.array(langs, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                [*keep, *own],
            )

    rows = docs.select(*keep, *(() if "text" in keep else ("text",)))
    schema = T.StructType([rows.schema[name] for name in keep])
    for name, kind in zip(own, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return rows.mapInArrow(predict, schema)
