"""Token ids of documents in compressed files that can be decoded in parallel.

A file holds the ids of a range of documents, in ascending order of doc_id. Layout:

    magic | blocks | footer (compressed arrays) | length of the footer, 8 bytes | magic

The footer has the frequency table that the file's blocks share, a checkpoint for each block
(offset, bytes, ids before it, ids, crc32 of the ids), and for each document its id and number
of ids. A block is decoded from its checkpoint alone.
"""

from __future__ import annotations

import io
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm import rans
from millrace.llm.files import opened, written
from millrace.llm.store import cut, ship
from millrace.llm.words import slices, texts, word_hashes

MAGIC = b"IDSRANS1"
FILE_TEXT_BYTES = 24 << 20
#: Pieces of text whose ids a worker remembers, and their ids, before it starts anew.
REMEMBERED = 1_000_000
REMEMBERED_IDS = 16_000_000
LONGEST_REMEMBERED = 64
PARTS_BY_PATTERN = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"


def _bytes(those: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*those]] = True
    return table


_PRINTED = _bytes(range(0x21, 0x7F))
_LETTER = _bytes(b for b in range(128) if chr(b).isalpha())
_SIGN = _PRINTED & ~_LETTER & ~_bytes(b"0123456789'")
#: First bytes of characters that are surely no white space; some of Unicode's begin with these.
_SOLID = ~_bytes([*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3])
#: Byte-level BPE writes printable bytes as themselves and the others as characters from 256.
_OWN = [b for b in range(256) if chr(b).isprintable() and b != 32]
_OTHERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _OWN)}
_BYTE_CHARS = [chr(_OTHERS.get(b, b)) for b in range(256)]


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them.

    The library first parts a text by a pattern and then encodes the parts on their own. Texts
    are cut at some of those places that are plain to see: before a space that other than
    white space follows, before a sign after a letter, and around a single line break. The
    distinct pieces are encoded by the library, and the ids of short ones are remembered in
    arrays by the pieces' 64-bit hashes, so that only new pieces become Python objects. Texts
    with a special token's string stay in one piece.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in special]
        self._forget()
        # The pattern can't part letters, so such a piece goes to the model at once.
        self.plain = str(self.tokenizer.pre_tokenizer) == PARTS_BY_PATTERN
        self.plain = self.plain and self.tokenizer.normalizer is None

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.places = self.sizes = np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _piece(self, piece: bytes) -> list[int]:
        text = piece.decode()
        if self.plain and text[text[:1] == " " :].isalpha():
            if piece.isascii():
                chars = text.replace(" ", _BYTE_CHARS[32])
            else:
                chars = "".join([_BYTE_CHARS[b] for b in piece])
            return [t.id for t in self.tokenizer.model.tokenize(chars)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _found(
        self, raw: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Where in `flat` the ids of distinct pieces are, by ascending hash, and how many."""
        if len(self.hashes) > REMEMBERED or self.used > REMEMBERED_IDS:
            self._forget()
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        places, sizes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        places[known], sizes[known] = self.places[at[known]], self.sizes[at[known]]
        new = np.flatnonzero(~known)
        ids: list[int] = []
        upto = [0]
        for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True):
            ids += self._piece(raw[a:b])
            upto.append(len(ids))
        upto = np.array(upto, np.int64)
        places[new], sizes[new] = self.used + upto[:-1], np.diff(upto)
        if self.used + len(ids) > len(self.flat):
            more = np.zeros(self.used + 2 * len(ids), np.uint32)
            self.flat = np.concatenate([self.flat[: self.used], more])
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        kept = new[(ends - starts)[new] <= LONGEST_REMEMBERED]
        self.hashes = np.insert(self.hashes, at[kept], hashes[kept])
        self.places = np.insert(self.places, at[kept], places[kept])
        self.sizes = np.insert(self.sizes, at[kept], sizes[kept])
        return places, sizes

    def ids(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some texts at a time: their ids one after the other, and how many each has."""
        data, at = texts(column)
        for lo, hi in slices(at):
            part, offsets = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            raw = part.tobytes()
            begins = np.zeros(len(part) + 1, bool)
            if len(part) > 2:
                begins[:-2] = (part[:-1] == 32) & _SOLID[part[1:]]
                line = part == 10
                begins[1:-1] |= _LETTER[part[:-1]] & _SIGN[part[1:]]
                begins[1:-1] |= _PRINTED[part[:-1]] & line[1:]
                begins[2:-1] |= _PRINTED[part[:-2]] & line[1:-1] & _SOLID[part[2:]]
            for mark in self.special:
                if mark in raw:
                    for i in range(hi - lo):
                        if mark in raw[offsets[i] : offsets[i + 1]]:
                            begins[offsets[i] : offsets[i + 1]] = False
            # A space that ends a text has nothing after it.
            full = offsets[1:][np.diff(offsets) > 0]
            begins[full - 1] &= part[full - 1] != 32
            begins[offsets[:-1]] = True
            begins[len(part)] = False
            starts = np.flatnonzero(begins)
            ends = np.append(starts[1:], len(part)) if len(starts) else starts
            first = np.searchsorted(starts, offsets)
            hashes = word_hashes(part, starts, ends)
            distinct, one, which = np.unique(hashes, return_index=True, return_inverse=True)
            places, sizes = self._found(raw, distinct, starts[one], ends[one])
            counts = sizes[which]
            upto = np.concatenate([[0], np.cumsum(counts)])
            take = np.arange(upto[-1]) + np.repeat(places[which] - upto[:-1], counts)
            yield self.flat[take], np.diff(upto[first])


def pack(ids: np.ndarray, docs: list[int | None], counts: list[int]) -> Iterator[bytes]:
    """The parts of a file."""
    table = rans.Table.of(ids)
    yield MAGIC
    offset, before = len(MAGIC), 0
    checkpoints = []
    for block in rans.encode(ids, table):
        part = ids[before : before + rans.BLOCK_IDS]
        crc = zlib.crc32(part.astype("<u4").tobytes())
        checkpoints.append((offset, len(block), before, len(part), crc))
        offset, before = offset + len(block), before + len(part)
        yield block
    footer = io.BytesIO()
    np.savez_compressed(
        footer,
        symbols=table.symbols,
        shares=table.shares.astype(np.uint32),
        bits=np.array(table.bits),
        checkpoints=np.array(checkpoints, np.int64).reshape(-1, 5),
        doc=np.array([d or 0 for d in docs], np.int64),
        named=np.array([d is not None for d in docs], bool),
        count=np.array(counts, np.int64),
    )
    yield footer.getvalue()
    yield len(footer.getvalue()).to_bytes(8, "little") + MAGIC


class TokenFile:
    """A file opened for reading."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        tail = self._read(size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        length = int.from_bytes(tail[:8], "little")
        footer = np.load(io.BytesIO(self._read(size - 16 - length, length)), allow_pickle=False)
        self.table = rans.Table(
            footer["symbols"], footer["shares"].astype(np.uint64), int(footer["bits"])
        )
        self.checkpoints = footer["checkpoints"]
        self.doc, self.named, self.count = footer["doc"], footer["named"], footer["count"]

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last - 1, checked."""
        rows = self.checkpoints[first:last]
        data = [self._read(int(at), int(n)) for at, n, *_ in rows]
        ids = rans.decode(data, rows[:, 3].tolist(), self.table)
        for _, _, before, n, crc in rows.tolist():
            part = ids[before - rows[0, 2] :][:n]
            if zlib.crc32(part.astype("<u4").tobytes()) != crc:
                raise ValueError("ids of a block don't have its checksum")
        return ids

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids begin to end - 1; only the blocks that hold them are read."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        starts = self.checkpoints[:, 2]
        first = int(np.searchsorted(starts, begin, "right")) - 1
        last = int(np.searchsorted(starts, end, "left"))
        skip = int(starts[first])
        return self.blocks(first, last)[begin - skip : end - skip]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, place of the first id, number of ids and their crc32, in the file's order."""
        held, begin, block, place = np.zeros(0, np.uint32), 0, 0, 0
        for doc, named, n in zip(
            self.doc.tolist(), self.named.tolist(), self.count.tolist(), strict=True
        ):
            crc, left, at = 0, n, place
            while left:
                if at - begin >= len(held):
                    begin += len(held)
                    held = self.blocks(block, block + rans.TOGETHER)
                    block += rans.TOGETHER
                part = held[at - begin :][:left]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                left, at = left - len(part), at + len(part)
            yield doc if named else None, place, n, crc
            place += n


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 2,
    file_text_bytes: int = FILE_TEXT_BYTES,
) -> DataFrame:
    """Writes the ids of docs (doc_id, text) and gives (file, path, first_id, n_ids, n_docs).

    `tokenizer` is the content of a tokenizer file. Each document's ids end with end_id; a null
    text has that id only. Documents go to files by range of doc_id, null first, rows with the
    same doc_id by a hash of the text. A task holds one file's ids in memory and writes the
    file under its number, whole or not at all. first_id counts ids in earlier files.
    """
    spark = ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(tokenizer)

    def write(batches):
        ids, names, counts = [], [], []
        for batch in batches:
            names += batch.column("doc_id").to_pylist()
            for found, many in _encoder(shared.value).ids(batch.column("text")):
                ids.append(np.insert(found, np.cumsum(many), end_id))
                counts += (many + 1).tolist()
        if names:
            number = TaskContext.get().partitionId()
            path = f"{folder}/{number:08d}.ids"
            everything = np.concatenate(ids)
            with written(path) as stream:
                for part in pack(everything, names, counts):
                    stream.write(part)
            yield pa.RecordBatch.from_pydict(
                {"file": [number], "path": [path], "n_ids": [len(everything)], "n_docs": [len(names)]}
            )

    text = F.col("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(text).alias("tie"))
        .repartitionByRange(max(1, -(-size // file_text_bytes)), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    files = cut(
        ordered.mapInArrow(write, "file long, path string, n_ids long, n_docs long"), "token-files"
    )
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_encoders: dict[int, Encoder] = {}


def _encoder(tokenizer: str) -> Encoder:
    """One for each tokenizer and worker."""
    key = zlib.crc32(tokenizer.encode())
    if key not in _encoders:
        _encoders[key] = Encoder(tokenizer)
    return _encoders[key]


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents in files (path, first_id)."""
    ship(files.sparkSession)

    def read(batches):
        for batch in batches:
            for path, first in zip(
                batch.column("path").to_pylist(), batch.column("first_id").to_pylist(), strict=True
            ):
                with opened(path) as stream:
                    rows = list(TokenFile(stream).documents())
                doc, place, n, crc = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64()),
                        pa.array([first + p for p in place], pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # A file to a task; which task a file goes to follows from its number alone.
    count = max(1, files.count())
    spread = files.select("path", "first_id").repartitionByRange(count, "first_id")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
