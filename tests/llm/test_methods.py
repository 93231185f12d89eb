"""The methods against brute force on small inputs."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import decontam, jaccard, rans, token_files, words
from millrace.llm.queries import SQL
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, folder, name):
    assert compare(spark, folder, name) == ""


@pytest.mark.parametrize("n", [0, 1, 255, 257, 65_536, 65_537, 600_001])
def test_rans_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_257).astype(np.uint32)
    table = rans.Table.of(ids)
    counts = [min(rans.BLOCK_IDS, n - i) for i in range(0, n, rans.BLOCK_IDS)]
    assert (rans.decode(rans.encode(ids, table), counts, table) == ids).all()


def test_token_file_parts_and_checksums():
    ids = np.random.default_rng(1).integers(0, 300, 200_000).astype(np.uint32)
    data = b"".join(token_files.pack(ids, [None, 4], [150_000, 50_000]))
    file = token_files.TokenFile(pa.BufferReader(data))
    assert (file.ids(70_000, 140_001) == ids[70_000:140_001]).all()
    assert [d[:3] for d in file.documents()] == [(None, 0, 150_000), (4, 150_000, 50_000)]
    spoiled = bytearray(data)
    spoiled[5_000] ^= 1
    with pytest.raises(ValueError):
        token_files.TokenFile(pa.BufferReader(bytes(spoiled))).blocks(0, 4)


def test_encoder_cuts_like_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    random.seed(3)
    parts = [*"aBéß   \n\n'st.,!1\t日_-ª\x1c\x85€", " ", "　", "<|endoftext|>"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(5_000)]
    found = list(token_files.Encoder(open(path, encoding="utf-8").read()).ids(pa.array(texts)))
    flat = np.concatenate([ids for ids, _ in found]).tolist()
    plain = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert flat == [i for x in plain for i in x.ids]
    assert np.concatenate([n for _, n in found]).tolist() == [len(x.ids) for x in plain]


@pytest.mark.parametrize("remembered, ids", [(1_000_000, 16_000_000), (20, 16_000_000), (1_000_000, 50)])
def test_pieces_are_remembered_by_hash_and_forgotten(monkeypatch, remembered, ids):
    """Short pieces of earlier slices are found in arrays; a full memory starts anew."""
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "REMEMBERED", remembered)
    monkeypatch.setattr(token_files, "REMEMBERED_IDS", ids)
    monkeypatch.setattr(token_files, "slices", lambda at: words.slices(at, 64))
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_files.Encoder(open(path, encoding="utf-8").read())
    asked, piece = [], encoder._piece
    monkeypatch.setattr(encoder, "_piece", lambda x: asked.append(x) or piece(x))
    random.seed(4)
    parts = [f" w{i} été{i} Straße" for i in range(30)] + ["x" * 90, "\n\n", ""]
    texts = ["".join(random.choices(parts, k=9)) for _ in range(60)]
    found = list(encoder.ids(pa.array(texts))) + list(encoder.ids(pa.array(texts)))
    plain = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert len(found) > 50
    assert np.concatenate([x for x, _ in found]).tolist() == 2 * [i for x in plain for i in x.ids]
    short = [x for x in asked if len(x) <= token_files.LONGEST_REMEMBERED]
    assert (len(short) == len(set(short))) == (remembered > 20 and ids > 50)
    assert len(encoder.hashes) == len(set(short)) or len(short) > len(set(short))


@pytest.mark.parametrize("most", [300, rans.TABLED, 1 << 32])
def test_ids_are_numbered_by_a_table_or_by_sorting(monkeypatch, most):
    ids = np.random.default_rng(2).integers(0, most, 70_000).astype(np.uint32)
    ids[:9] = most - 1
    table = rans.Table.of(ids)
    blocks = rans.encode(ids, table)
    assert (rans.decode(blocks, [rans.BLOCK_IDS, 70_000 - rans.BLOCK_IDS], table) == ids).all()
    monkeypatch.setattr(rans, "TABLED", 0)
    sorted_table = rans.Table.of(ids)
    assert (sorted_table.symbols == table.symbols).all()
    assert (sorted_table.shares == table.shares).all()
    assert rans.encode(ids, sorted_table) == blocks


def test_divide_skip_against_counting():
    random.seed(1)
    for _ in range(200):
        lists = [sorted(random.sample(range(30), random.randint(1, 20))) for _ in range(8)]
        counts = Counter(x for row in lists for x in row)
        for needed in (1, 4, 8):
            want = {x: n for x, n in counts.items() if n >= needed}
            assert jaccard.divide_skip(lists, needed) == want


def test_long_lists_make_cells_and_lose_no_link(spark, monkeypatch):
    """A large group of near copies goes through chains, blocks and cells."""
    monkeypatch.setattr(jaccard, "SHORT_LIST", 3)
    monkeypatch.setattr(jaccard, "CELL", 5)
    random.seed(2)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(random.randint(0, 2)):
            words[random.randrange(60)] = random.choice("xyz")
        texts.append(" ".join(words[: random.randint(45, 60)]))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    near = [[j for j in range(60) if j != i and linked(sets[i], sets[j])] for i in range(60)]
    label = list(range(60))
    for _ in range(60):
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in jaccard.jaccard_components(df).collect()}
    assert [found[i]["component_id"] for i in range(60)] == label
    assert [found[i]["n_links"] for i in range(60)] == [len(x) for x in near]


def test_wu_manber_against_scanning():
    random.seed(4)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(str(k), " ".join(random.choices(vocabulary, k=k % 7 + 1))) for k in range(20)]
    matcher = decontam.Matcher(items, 4)
    texts = [" ".join(random.choices(vocabulary, k=random.randint(0, 900))) for _ in range(30)]
    strings = {}
    for item, text in items:
        words = text.split()
        m = min(4, len(words))
        for i in range(len(words) - m + 1):
            strings.setdefault(tuple(words[i : i + m]), set()).add(item)
    for text, (n, places, found) in zip(texts, matcher.rows(pa.array(texts)), strict=True):
        words, hit, want = text.split(), set(), set()
        for m in {len(s) for s in strings}:
            for i in range(len(words) - m + 1):
                if tuple(words[i : i + m]) in strings:
                    hit.update(range(i, i + m))
                    want |= strings[tuple(words[i : i + m])]
        assert (n, set(places.tolist()), found) == (len(words), hit, want)
