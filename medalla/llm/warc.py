"""WARC archives by way of a chunked record table.

A payload of any size is rows of (record, chunk number, at most ``CHUNK``
bytes); no task ever joins a record's chunks.  The table carries what a header
needs before the payload is seen (length, digest, role), so a writer streams
chunk after chunk into one gzip member for each record, and a reader streams
them out again, each chunk with the SHA-1 of the payload up to its end: the
last chunk's is the payload's digest.

Records with equal payloads of at least ``min_bytes`` bytes: the one with the
smallest id is a ``response``, the others are ``revisit`` records without a
payload that refer to it.

Files are written through pyarrow's file systems into a folder that all
executors share.  A task's file has a name of its own; readers take only the
files in the manifest table, so leftovers of lost attempts are never read.  A
reading task goes through one file at a time and holds a chunk of it.

Scale: payloads are shuffled once, to meet their roles.  Roles are settled over
digests; a payload that a third of all records share is a hot key of small
rows, reduced by partial aggregates and joined over salts.

Defined results: a null payload is an empty one; an empty payload is one empty
chunk; a record without a url has ``urn:page:<id>`` as its target; rows equal
in id and payload are records each, with one role, and an id may have several
payloads; a row without an id comes after all others.  Only ``page_id``,
``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import salted_join, shared_folder, stored, text_blocks

CHUNK = 1 << 18
DATE = "2025-01-01T00:00:00Z"  # of every record, so that archives are reproducible

MANIFEST = "name string, n_records long, n_bytes long"
CHUNKS = (
    "page_id long, record_id string, record_type string, refers_to long, url string, length long, declared_digest string, "
    "chunk int, last boolean, data binary, digest_so_far string"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four of base 32."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    hexa = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexa, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def chunk_table(pages: DataFrame, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """(page_id, url, length, digest, record_type, refers_to, n, data): the
    payload of a response in chunks n = 0, 1, ...; a revisit's one, empty."""
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    pages = pages.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("length", F.length("payload").cast("long"))
    keys = stored(pages.select("page_id", "digest", "length"), "payload-digests")
    least = keys.groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    copy = (F.col("length") >= min_bytes) & F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    revisits = (
        salted_join(keys, least.select("digest", "least"), ["digest"], "inner")
        .filter(copy)
        .select(F.col("page_id").alias("p"), F.col("digest").alias("d"), F.col("least").alias("refers_to"))
        .distinct()
    )
    met = pages.join(revisits, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left").drop("p", "d")
    typed = met.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
    starts = F.when(
        (F.col("record_type") == "response") & (F.col("length") > 0), F.sequence(F.lit(0), ((F.col("length") - 1) / chunk).cast("int"))
    ).otherwise(F.array(F.lit(0)))
    data = F.when(F.col("record_type") == "response", F.expr(f"substring(payload, n * {chunk} + 1, {chunk})")).otherwise(F.lit(b""))
    return typed.withColumn("n", F.explode(starts)).select(
        "page_id", "url", "length", "digest", "record_type", "refers_to", "n", data.alias("data")
    )


def _address(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _head(row: dict) -> bytes:
    """The WARC header, and the HTTP header that the block begins with."""
    page = "none" if row["page_id"] is None else str(row["page_id"])
    url = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"] or f"urn:page:{page}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['length']}\r\n\r\n".encode()
    body = row["length"] if row["record_type"] == "response" else 0
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", _address(page, row["digest"])),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("Page-ID", page),
    ]
    if row["record_type"] == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _address(row["refers_to"], row["digest"])),
            ("Refers-To-Page-ID", str(row["refers_to"])),
        ]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(http) + body))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


def _writer(folder: str):
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        name, out, packer, records, written = f"{uuid.uuid4().hex}.warc.gz", None, None, 0, 0

        def put(data: bytes):
            nonlocal written
            written += len(data)
            out.write(data)

        def close():
            put(packer.compress(b"\r\n\r\n") + packer.flush())

        for batch in text_blocks(batches, "data"):
            for row in batch.to_pylist():
                if out is None:
                    out = store.open_output_stream(f"{root}/{name}")
                if row["n"] == 0:
                    if packer:
                        close()
                    packer, records = zlib.compressobj(1, zlib.DEFLATED, 31), records + 1  # a gzip member
                    put(packer.compress(_head(row)))
                put(packer.compress(row["data"]))
        if out is not None:
            close()
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "n_records": [records], "n_bytes": [written]})

    return run


def write(chunks: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """(folder, manifest): one archive for each task that has records."""
    from pyarrow import fs

    folder = folder or shared_folder(chunks.sparkSession, "warc")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return folder, stored(chunks.mapInArrow(_writer(folder), MANIFEST), "warc-manifest")


class _Member:
    """The uncompressed bytes of one file of gzip members, read piece by piece."""

    def __init__(self, source, size: int):
        self.source, self.size, self.raw, self.ready, self.unpacker = source, size, b"", b"", None

    def more(self) -> bool:
        while not self.ready:
            if not self.raw:
                self.raw = self.source.read(self.size)
                if not self.raw:
                    return False
            self.unpacker = self.unpacker or zlib.decompressobj(31)
            self.ready = self.unpacker.decompress(self.raw, self.size)
            self.raw = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.raw, self.unpacker = self.unpacker.unused_data, None
        return True

    def take(self, n: int) -> bytes:
        """The next up to ``n`` bytes; fewer only at a piece's or the file's end."""
        if not self.more():
            return b""
        got, self.ready = self.ready[:n], self.ready[n:]
        return got

    def exactly(self, n: int):
        while n > 0:
            got = self.take(n)
            if not got:
                raise EOFError("the archive ends within a record")
            n -= len(got)
            yield got

    def header(self) -> list[str] | None:
        """The lines up to an empty one; None at the end of the file."""
        got = b""
        while not got.endswith(b"\r\n\r\n"):
            if not self.more():
                if got:
                    raise EOFError("the archive ends within a header")
                return None
            end = (got[-3:] + self.ready).find(b"\r\n\r\n")
            cut = len(self.ready) if end < 0 else end + 4 - len(got[-3:])
            got, self.ready = got + self.ready[:cut], self.ready[cut:]
        return got.decode()[:-4].split("\r\n")


def records(source, size: int = CHUNK):
    """The chunk rows of an open archive, as dicts."""
    file = _Member(source, size)
    while (lines := file.header()) is not None:
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        http = file.header()
        length = int(dict(line.split(": ", 1) for line in http[1:])["Content-Length"])
        body = int(head["Content-Length"]) - len("\r\n".join(http).encode()) - 4
        row = {
            "page_id": None if head["Page-ID"] == "none" else int(head["Page-ID"]),
            "record_id": head["WARC-Record-ID"],
            "record_type": head["WARC-Type"],
            "refers_to": int(head["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in head else None,
            "url": head["WARC-Target-URI"],
            "length": length if head["WARC-Type"] == "response" else None,
            "declared_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
        }
        sha, number, left = hashlib.sha1(), 0, body
        for part in file.exactly(body) if body else [b""]:
            sha.update(part)
            left -= len(part)
            yield row | {"chunk": number, "last": left == 0, "data": part, "digest_so_far": base64.b32encode(sha.digest()).decode()}
            number += 1
        if b"".join(file.exactly(4)) != b"\r\n\r\n":
            raise ValueError(f"record {head['WARC-Record-ID']} does not end where its header says")


def _reader(folder: str, size: int, with_data: bool):
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        kinds = [("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        kinds += [("url", pa.string()), ("length", pa.int64()), ("declared_digest", pa.string()), ("chunk", pa.int32())]
        kinds = pa.schema([*kinds, ("last", pa.bool_()), ("data", pa.binary()), ("digest_so_far", pa.string())])
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with store.open_input_stream(f"{root}/{name}") as source:
                    rows, held = [], 0
                    for row in records(source, size):
                        held += len(row["data"])
                        rows.append(row if with_data else row | {"data": None})
                        if held >= 4 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, kinds)

    return run


def read(spark: SparkSession, folder: str, manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk rows of all archives; a record's digest is its last chunk's
    ``digest_so_far``.  Without ``with_data`` chunks are read, but not handed on."""
    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(_reader(folder, chunk, with_data), CHUNKS)


def resolved(chunks: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes and payload_digest of the full
    payload, record_type and refers_to; a revisit's are those of the response
    it refers to, found by id and digest."""
    ends = stored(chunks.filter("last").select("page_id", "record_type", "refers_to", "length", "declared_digest", "digest_so_far"), "records")
    own = ends.filter("record_type = 'response'").select(
        "page_id", F.col("length").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to"
    )
    revisits = ends.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "declared_digest")
    full = own.filter("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("declared_digest"))
    full = full.agg(F.max("payload_bytes").alias("payload_bytes"))
    found = salted_join(revisits, full, ["refers_to", "declared_digest"], "left")
    return own.unionByName(found.withColumnRenamed("declared_digest", "payload_digest").select(own.columns))
