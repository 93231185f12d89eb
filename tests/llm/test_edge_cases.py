"""Every operator on nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import (
    decontam,
    divergence,
    jaccard,
    langid,
    line_dedup,
    mixing,
    quotes,
    shards,
    token_files,
    warc,
)
from millrace.llm.store import cut, shared_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int"
SENTENCE = "the quick brown fox jumps over the lazy dog near the old river bank today"
LONG = " ".join(f"word{i}" for i in range(30_000))
ROWS = [
    (1, SENTENCE, "en", "a", 1, 9, 9),
    (1, SENTENCE, "en", "a", 1, 9, 9),
    (2, SENTENCE, None, None, None, None, None),
    (3, None, "en", "a", 0, 0, 0),
    (4, "", "en", "b", 0, 0, 0),
    (None, SENTENCE, "en", "b", 0, 0, 0),
    (None, None, None, None, None, None, None),
    (5, LONG, "de", "b", 0, 0, 0),
    (6, "  \n\t\n 12 ", "de", "\U0001f600", 0, 0, 0),
    (7, SENTENCE + " indeed", "en", "a", 0, 0, 0),
    (8, "one two three", "en", "a", 0, 0, 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_mixing(docs, none):
    taken = mixing.copies(docs, keep=("doc_id", "size")).collect()
    assert len(taken) == len(ROWS)
    assert all(0 <= r["copies"] <= 2 for r in taken)
    # Weights 5, 2, 1 in code point order; a, the largest need, takes what b and null leave.
    wanted = {r["source_size"]: r["target"] for r in taken}
    assert sum(wanted.values()) == pytest.approx(1.5 * sum(wanted))
    assert all(t <= 2 * s for s, t in wanted.items())
    assert rows(mixing.copies(docs)) == rows(mixing.copies(docs))
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.copies(none).count() == 0


def test_sharding(docs, none):
    out = shards.shuffle(docs, shards=4, bucket_rows=3)
    found = out.collect()
    assert len(found) == len(ROWS)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(r[:2] for r in ROWS)
    assert rows(out) == rows(shards.shuffle(docs, shards=4, bucket_rows=3))
    assert shards.shuffle(none).count() == 0


def test_sharding_spreads_rows_alike(spark, monkeypatch):
    alike = spark.range(20_000).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.lit("same").alias("text"),
        F.lit("a").alias("copy"),
        F.lit(None).cast("string").alias("h"),
    )
    # Same hash, as hashes pass over nulls, but other rows.
    swapped = alike.limit(300).withColumns({"copy": F.lit(None).cast("string"), "h": F.lit("a")})
    other = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("b").alias("copy"), F.lit("c").alias("h")
    )
    docs = alike.union(swapped).union(other)
    written = []
    monkeypatch.setattr(shards, "cut", lambda df, name: written.append(cut(df, name)) or written[-1])
    out = shards.shuffle(docs, shards=7).collect()
    sizes = [r["n"] for r in written[-1].collect()]
    assert len(sizes) == 21 and max(sizes) < 1300
    assert Counter(tuple(r)[:4] for r in out) == Counter(map(tuple, docs.collect()))
    places = sorted(r["slot"] * 7 + r["shard"] for r in out)
    assert places == list(range(20_800))
    again = shards.shuffle(docs.repartition(9), shards=7).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_sharding_writes_documents_one_by_one(spark, monkeypatch):
    """Memory to write and read buckets is that of a page of documents, whatever a bucket holds."""
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("text "), F.col("id").cast("int")).alias("text")
    )
    written = {}
    monkeypatch.setattr(
        shards, "cut", lambda df, name: written.setdefault(name, cut(df, name))
    )
    out = shards.shuffle(docs, shards=7, bucket_rows=100).collect()
    buckets = written["shuffle-buckets"]
    assert not any(kind.startswith(("array", "map")) for _, kind in buckets.dtypes)
    assert Counter(r["document"] for r in buckets.collect()) == Counter(docs.collect())
    assert buckets.select("bucket").distinct().count() == 4
    assert buckets.select("bucket", "place").distinct().count() == 400
    assert sorted(r["slot"] * 7 + r["shard"] for r in out) == list(range(400))


def test_shards_are_written_in_slot_order(spark, docs, tmp_path):
    shuffled = cut(shards.shuffle(docs, shards=3, bucket_rows=3), "shuffled")
    shards.write_shards(shuffled, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    columns = ["doc_id", "text", "shard", "slot"]
    assert rows(back.select(*columns)) == rows(shuffled.select(*columns))
    for file in (tmp_path / "shards").rglob("*.parquet"):
        slots = [r["slot"] for r in spark.read.parquet(str(file)).collect()]
        assert slots == sorted(slots)


def test_fisher_yates_gives_every_permutation(spark):
    df = spark.range(1200).select(shards.fisher_yates(F.lit(3), "id").alias("p"))
    counts = Counter(tuple(r["p"]) for r in df.collect())
    assert len(counts) == 6 and min(counts.values()) > 140


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame(
        [(1, SENTENCE.upper()), (2, "one two"), (3, None), (4, "..."), (None, "word7 word8")],
        "item_id long, text string",
    )
    found = decontam.contamination(docs, items, keep=("doc_id", "n_chars")).collect()
    again = decontam.contamination(docs, items, block_bytes=20).collect()
    key = lambda r: (r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"])
    assert Counter(map(key, found)) == Counter(map(key, again))
    by = {r["doc_id"]: r for r in found if r["doc_id"]}
    assert (by[1]["n_hit"], by[1]["n_items"]) == (15, 1)
    assert by[1]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert (by[8]["n_hit"], by[5]["n_hit"], by[3]["n_hit"], by[4]["n_words"]) == (2, 2, 0, 0)
    assert decontam.contamination(none, items).count() == 0
    clean = decontam.contamination(docs, items.limit(0)).where("contaminated").count()
    assert clean == 0


def test_jaccard(docs, none):
    found = {}
    for r in jaccard.jaccard_components(docs).collect():
        found.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert found[1] == [(11, 1), (11, 1)] and found[2] == [(11, 1)] and found[7] == [(12, 1)]
    assert found[3] == [(0, 3)] and found[4] == [(0, 4)] and found[8] == [(1, 8)]
    assert sorted(found[None], key=str) == [(0, None), (11, 1)]
    assert found[5] == [(29_996, 5)]
    assert jaccard.jaccard_components(none).count() == 0
    stay = [r["doc_id"] for r in jaccard.one_per_group(docs).collect()]
    # Of the rows without an id one has the text of document 1 and goes with it.
    assert sorted(map(str, stay)) == ["1", "3", "4", "5", "6", "8", "None"]


def test_language_id(docs, none):
    model = langid.train(docs)
    assert model.langs == ("de", "en")
    found = langid.identify(docs, model).collect()
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (3, 4, 6):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (1, 7)} == {"en"}
    assert langid.identify(none, model).count() == 0
    nothing = langid.train(none)
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_divergence(docs, none):
    found = {r["doc_id"]: r for r in divergence.judge(docs).collect()}
    assert found[3]["n_words"] == 0 and found[4]["base_failed"] and not found[1]["kept"]
    assert found[5]["n_words"] == 30_000 and found[5]["n_repeat_words"] == 0
    assert divergence.judge(none).count() == 0


def test_repeated_words(spark):
    texts = ["a b c a b c", "a a a a", "a b", "a b c d", "x a b c y a b c z"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    df = df.withColumn("w", F.split("text", " "))
    found = df.select("text", divergence.repeated_words(F.col("w"), F.size("w")).alias("n"))
    assert [r["n"] for r in found.collect()] == [6, 4, 0, 0, 6]


def test_line_dedup(spark, none):
    text = "one\n\ntwo\nthree\n"
    df = spark.createDataFrame(
        [(1, text), (2, "zero\none\n\ntwo\nthree"), (3, "two\none"), (4, None), (5, ""),
         (6, text), (6, text), (7, "x\nx\nx"), (None, "y")],
        "doc_id long, text string",
    )
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    kept = {k: r["kept_text"] for k, r in found.items()}
    # The blank line stands between deleted lines and is no part of the run.
    assert kept[1] == text and kept[2] == "zero\n" and kept[3] == "two\none"
    assert kept[4] is None and kept[5] == "" and kept[6] == "\n" and kept[None] == "y"
    assert kept[7] == "x" and found[7]["n_deleted"] == 2
    assert found[6]["longest_shared"] == 3
    assert line_dedup.dedup_lines(none).count() == 0


def test_quotes(spark):
    df = spark.createDataFrame(
        [
            (1, 0, "Hello there\nSecond line"),
            (1, 1, "> hello   THERE\nAn answer"),
            (1, 2, "> > Hello there\n> An answer\nThanks"),
            (2, 0, "> Second line\n> nobody wrote this"),
            (1, None, None),
            (None, 3, ""),
        ],
        "thread long, position long, text string",
    )
    found = {(r["thread"], r["position"]): r for r in quotes.link_quotes(df).collect()}
    assert found[1, 1]["reply_to"] == 0 and found[1, 1]["own_text"] == "An answer"
    assert found[1, 2]["reply_to"] == 1 and found[1, 2]["reply_depth"] == 2
    assert found[1, 2]["levels"] == 2 and found[1, 2]["root"] == 0
    assert found[2, 0]["outside_thread"] == 1 and found[2, 0]["n_quoted"] == 2
    assert found[1, None]["reply_to"] is None and found[None, 3]["n_quoted"] == 0
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_warc_round_trip(spark):
    page = "<p>é" + "x" * 200
    df = spark.createDataFrame(
        [(5, "http://a/", page), (3, "http://b/ b\n", page), (7, None, None), (8, "u", "small"),
         (9, "u", "small"), (None, "u", page)],
        "page_id long, url string, html string",
    )
    archives = warc.write_archives(warc.with_revisits(df), shared_folder(spark, "whole"))
    index = warc.normalise(archives, shared_folder(spark, "members"))
    found = {r["page_id"]: r for r in warc.read_records(index).collect()}
    digest = hashlib.sha256(page.encode()).hexdigest()
    assert (found[3]["record_type"], found[3]["payload_digest"]) == ("response", digest)
    assert (found[5]["record_type"], found[5]["refers_to"]) == ("revisit", 3)
    assert found[5]["payload_bytes"] == 205 and found[None]["refers_to"] == 3
    assert found[7]["payload_bytes"] == 0
    assert found[8]["record_type"] == found[9]["record_type"] == "response"


def test_inflated_members_and_cut_archives():
    record = warc._record(1, "u", b"body\r\n\r\nmore", "d", None)
    packed = b"".join(_gzip(record) for _ in range(3))
    import io

    assert list(warc.split_records(warc.inflated(io.BytesIO(packed)))) == [record] * 3
    with pytest.raises(ValueError):
        list(warc.split_records(iter([record[:-5]])))


def _gzip(data):
    packer = zlib.compressobj(wbits=31)
    return packer.compress(data) + packer.flush()


def test_token_files(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    content = open(path, encoding="utf-8").read()
    files = token_files.write_token_files(
        docs, content, shared_folder(spark, "ids"), file_text_bytes=100_000
    )
    found = token_files.read_token_files(files).orderBy("start").collect()
    plain = Tokenizer.from_file(path)
    want = Counter()
    for doc, text, *_ in ROWS:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        want[doc, len(ids), zlib.crc32(data)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    named = [r["doc_id"] for r in found if r["doc_id"]]
    assert named == sorted(named)
    ends = [r["start"] + r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == [0, *ends[:-1]]
    empty = token_files.write_token_files(none, content, shared_folder(spark, "ids"))
    assert token_files.read_token_files(empty).count() == 0


def test_pipeline_keeps_clean_documents(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = corpus_pipeline.known_language(spark, docs, folder)
    letters = re.compile(r"[^\W\d_]")
    expected = {r["doc_id"] for r in docs.collect() if r["text"] and letters.search(r["text"])}
    assert {r["doc_id"] for r in first.collect()} >= expected
    assert first.columns == list(corpus_pipeline.COLUMNS)
    last = corpus_pipeline.run(spark, folder)
    assert last.columns == [*corpus_pipeline.COLUMNS, "shard", "slot"]
    assert last.count() > 0
