"""WARC archives: writing, normalising whole-file gzip streams, and reading by offset.

A whole-file archive is one gzip stream; nothing in it can be reached without inflating all
before it. A normalised archive has each record as a gzip member of its own and an index beside
it, so that a record is one seek and one read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.files import opened, written
from millrace.llm.store import cut, ship

GZIP = 31
VERSION = b"WARC/1.1"
READ_BYTES = 1 << 18
#: Fields beyond the standard: the page's number, and the full payload's size.
PAGE_FIELD, SIZE_FIELD = "X-Page-Id", "X-Payload-Bytes"
ARCHIVE = "file long, path string, n_records long"
ENTRY = (
    "path string, offset long, length long, record_type string, page_id long, target_uri string"
)


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to of pages (page_id, url, html).

    Of pages with an equal payload of at least least_bytes, that with the smallest page_id has
    the payload and the others refer to it. Equal payloads are found by their digests, counted
    before they are joined; smaller payloads are each their own key, so that no page waits for
    all the empty ones. Null html is an empty payload. Rows that repeat the smallest page_id
    refer to nothing; a group without any page_id neither.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).select(
        "*",
        F.sha2("payload", 256).alias("payload_digest"),
        (F.octet_length("payload") >= least_bytes).alias("large"),
    )
    firsts = (
        rows.where("large")
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select(F.col("payload_digest").alias("key"), "first")
    )
    name: Column = F.concat(F.lit("page "), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    own = F.concat(name, F.lit(" "), F.coalesce("url", F.lit("")))
    rows = rows.withColumn("key", F.when(F.col("large"), F.col("payload_digest")).otherwise(own))
    other = F.col("page_id").isNull() | (F.col("first") != F.col("page_id"))
    return rows.join(firsts, "key", "left").select(
        "page_id", "url", "payload", "payload_digest", F.when(other, F.col("first")).alias("refers_to")
    )


def _record(page, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response with its payload, or a revisit without it."""
    body = payload if refers_to is None else b""
    key = f"{page}|{url}|{digest}"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:sha256:{hashlib.sha256(key.encode()).hexdigest()}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        (SIZE_FIELD, len(payload)),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", len(body)),
    ]
    if url is not None:
        clean = "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url)
        fields.append(("WARC-Target-URI", clean))
    if page is not None:
        fields.append((PAGE_FIELD, page))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Writes records as whole-file gzip archives, one a task: (file, path, n_records)."""
    ship(records.sparkSession)

    def write(batches):
        number = TaskContext.get().partitionId()
        path = f"{folder}/{number:08d}.warc.gz"
        batches = (b for b in batches if len(b))
        first = next(batches, None)
        if first is None:
            return
        n = 0
        with written(path) as stream:
            packer = zlib.compressobj(level, wbits=GZIP)
            for batch in itertools.chain([first], batches):
                for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    stream.write(packer.compress(_record(*row)))
                    n += 1
            stream.write(packer.flush())
        yield pa.RecordBatch.from_pydict({"file": [number], "path": [path], "n_records": [n]})

    columns = ("page_id", "url", "payload", "payload_digest", "refers_to")
    return cut(records.select(*columns).mapInArrow(write, ARCHIVE), "warc-archives")


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, read once from its beginning."""
    unpacker = zlib.decompressobj(GZIP)
    while data := stream.read(READ_BYTES):
        while data:
            yield unpacker.decompress(data)
            data = unpacker.unused_data
            if unpacker.eof:
                unpacker = zlib.decompressobj(GZIP)
                data = data.lstrip(b"\0")
            else:
                data = b""
    yield unpacker.flush()


def split_records(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records from inflated bytes; no more than a record and a part are held."""
    held = bytearray()
    more = True
    while True:
        end = held.find(b"\r\n\r\n")
        size = None
        if end >= 0:
            size = end + 8 + int(header(bytes(held[: end + 2])).get("content-length", 0))
        if size is not None and len(held) >= size:
            record = bytes(held[:size])
            if not record.startswith(b"WARC/") or not record.endswith(b"\r\n\r\n"):
                raise ValueError("not a WARC record")
            yield record
            del held[:size]
        elif more:
            part = next(parts, None)
            more = part is not None
            held += part or b""
        elif held:
            raise ValueError("the archive ends within a record")
        else:
            return


def header(record: bytes) -> dict[str, str]:
    """The named fields of a record, names in lower case."""
    lines = record.partition(b"\r\n\r\n")[0].decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites archives (file, path), one gzip member a record, with an index beside each.

    Each archive is inflated once, as a stream. The index has one JSON line a record, also
    returned: (path, offset, length, record_type, page_id, target_uri). An archive that
    doesn't end with a whole record is an error, not a shorter result.
    """
    ship(archives.sparkSession)

    def rewrite(batches):
        for batch in batches:
            for number, source in zip(
                batch.column("file").to_pylist(), batch.column("path").to_pylist(), strict=True
            ):
                path = f"{folder}/{number:08d}.warc.gz"
                entries = []
                with opened(source) as stream, written(path) as out:
                    at = 0
                    for record in split_records(inflated(stream)):
                        packer = zlib.compressobj(level, wbits=GZIP)
                        member = packer.compress(record) + packer.flush()
                        out.write(member)
                        fields = header(record)
                        page = fields.get(PAGE_FIELD.lower())
                        entries.append(
                            {
                                "path": path,
                                "offset": at,
                                "length": len(member),
                                "record_type": fields.get("warc-type"),
                                "page_id": None if page is None else int(page),
                                "target_uri": fields.get("warc-target-uri"),
                            }
                        )
                        at += len(member)
                with written(f"{path}.index") as out:
                    out.write("".join(json.dumps(e) + "\n" for e in entries).encode())
                yield pa.RecordBatch.from_pylist(entries, schema=schema)

    schema = pa.schema(
        [
            ("path", pa.string()),
            ("offset", pa.int64()),
            ("length", pa.int64()),
            ("record_type", pa.string()),
            ("page_id", pa.int64()),
            ("target_uri", pa.string()),
        ]
    )
    return cut(_one_a_task(archives.select("file", "path")).mapInArrow(rewrite, ENTRY), "warc-index")


def _one_a_task(files: DataFrame) -> DataFrame:
    return files.repartitionByRange(max(1, files.count()), "path")


def read_records(index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of indexed records.

    Each record is read at its offset and inflated alone. A response's size and digest are
    taken from its payload, and a digest other than its header's is an error; a revisit has
    those of its header.
    """
    ship(index.sparkSession)

    def read(batches):
        path, stream = None, None
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("path", "offset", "length"))
            for where, at, length in zip(*columns, strict=True):
                if where != path:
                    path, stream = where, opened(where)
                stream.seek(at)
                record = zlib.decompress(stream.read(length), GZIP)
                fields = header(record)
                payload = record.partition(b"\r\n\r\n")[2][:-4]
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                size, refers_to = int(fields[SIZE_FIELD.lower()]), None
                if fields["warc-type"] == "response":
                    if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                        raise ValueError(f"{path} at {at}: the payload isn't that of the header")
                else:
                    refers_to = int(fields["warc-refers-to"].strip("<>").rpartition(":")[2])
                page = fields.get(PAGE_FIELD.lower())
                rows.append(
                    (None if page is None else int(page), size, digest, fields["warc-type"], refers_to)
                )
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    # Neighbours in an archive stay together; large archives are read by several tasks.
    ordered = index.select("path", "offset", "length").repartitionByRange("path", "offset")
    ordered = ordered.sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long",
    )
