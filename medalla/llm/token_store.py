"""Token ids in binary shards with Elias-Fano document boundaries.

A shard is two files: ``.ids`` holds the ids of consecutive documents, end id
included, back to back as little-endian unsigned integers of 16 bits (32 if the
vocabulary needs them); ``.index`` holds where each document ends and what its
doc_id is, both ascending, both Elias-Fano coded: the low bits of each value
packed, the high bits in unary, about 2 + log2(universe / n) bits a value, and
the bit place of every 256th value, from which ``select`` walks to any other.
No 64-bit table is kept.

Texts are encoded where they are read, so the one shuffle moves ids, half the
size of the texts.  It deals the documents to shards by doc_id and, where ids
are missing or repeat, by row; the cuts come from a sample of at most
``SAMPLE`` rows and decide on nothing but how even the shards are.  A task
sorts a shard and writes it batch by batch: memory holds the shard's numbers
only, not its ids.  A task's files have a name of their own, and only those
that the manifest table names are read: what a lost or repeated attempt leaves
behind is ignored.  The manifest has a row for each shard; the driver sums
their ids.  Reading gives each shard to a task that goes through it block by
block.

Defined results: a null or empty text is the end id alone; documents without a
doc_id come first; those of one id stand in the order in which they are read; repeated rows are documents each; an empty table has no
shards.  Only ``doc_id`` and ``text`` are read, other columns may have any name.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, stored, text_blocks
from .tokens import default_tokenizer, id_width, shared_encoder

END_ID = 2
STEP = 256  # values from one stored place to the next
READ_IDS = 1 << 20  # ids a reading task holds at once
SHARD_BYTES = 48 << 20  # of text
SAMPLE = 100_000

MANIFEST = "shard int, name string, width int, n_docs long, n_ids long"


class EliasFano:
    """Ascending integers from 0, selected by rank."""

    HEAD = "<QQBI"

    def __init__(self, n: int, top: int, low_bits: int, low, high, places):
        self.n, self.top, self.low_bits, self.low, self.high, self.places = n, top, low_bits, low, high, places

    @classmethod
    def of(cls, values) -> "EliasFano":
        import numpy as np

        values = np.asarray(values, dtype=np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.packbits(((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(bool).ravel(), bitorder="little")
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        if n and places[-1] >= 1 << 32:
            raise ValueError("a shard holds too many documents: write more partitions")
        ones = np.zeros(int(places[-1]) + 1 if n else 0, dtype=bool)
        ones[places] = True
        return cls(n, top, bits, low, np.packbits(ones, bitorder="little"), places[::STEP].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = struct.pack(self.HEAD, self.n, self.top, self.low_bits, len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.places.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, at: int = 0) -> tuple["EliasFano", int]:
        """(the values, where they end in ``raw``)."""
        import numpy as np

        n, top, bits, n_high = struct.unpack_from(cls.HEAD, raw, at)
        at += struct.calcsize(cls.HEAD)
        n_low, n_places = -(-n * bits // 8), -(-n // STEP)
        low = np.frombuffer(raw, np.uint8, n_low, at)
        high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        places = np.frombuffer(raw, "<u4", n_places, at + n_low + n_high)
        return cls(n, top, bits, low, high, places), at + n_low + n_high + 4 * n_places

    def select(self, a: int, b: int | None = None):
        """Value number ``a``, or the values from ``a`` to before ``b``."""
        import numpy as np

        if b is None:
            return int(self.select(a, a + 1)[0])
        if not 0 <= a < b <= self.n:
            return np.empty(0, dtype=np.int64)
        first, last = a // STEP, (b - 1) // STEP + 1
        from_bit = int(self.places[first])
        to_bit = int(self.places[last]) if last < len(self.places) else 8 * len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[from_bit // 8 : -(-to_bit // 8)], bitorder="little"))
        ones = ones[ones >= from_bit % 8] + from_bit // 8 * 8
        high = ones[a - first * STEP : b - first * STEP] - np.arange(a, b)
        bits, from_bit = self.low_bits, a * self.low_bits
        raw = np.unpackbits(self.low[from_bit // 8 : -(-b * bits // 8)], bitorder="little")[from_bit % 8 :][: (b - a) * bits]
        low = (raw.reshape(b - a, bits).astype(np.int64) << np.arange(bits)).sum(axis=1) if bits else 0
        return (high << bits) + low


def _store(folder: str):
    """(file system, path) of a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def place(doc: int | None, row: int) -> tuple[bool, int, int]:
    """Order of the documents: null first, then by id, then as read."""
    return doc is not None, doc or 0, row


def cuts(docs: DataFrame, shards: int) -> list[tuple]:
    """``shards`` - 1 places that part the documents (doc_id, row) about evenly."""
    n = docs.count()
    share = min(1.0, min(SAMPLE, 50 * shards) / max(n, 1))
    some = sorted(place(*r) for r in docs.sample(share, seed=1).limit(2 * SAMPLE).collect())
    return [some[len(some) * i // shards] for i in range(1, shards)] if some else []


def _encoder(path: str, end_id: int, parts: list[tuple]):
    def run(batches):
        from bisect import bisect_right

        import numpy as np
        import pyarrow as pa

        encoder = shared_encoder(path)
        width = id_width(encoder, end_id)
        for batch in text_blocks(batches):
            ids, ends = encoder.encode_block(batch.column("text").to_pylist())
            ids = np.insert(ids, ends, end_id).astype(f"<u{width}")
            offsets = width * np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            docs, rows = batch.column("doc_id"), batch.column("row")
            shard = [bisect_right(parts, place(d, r)) for d, r in zip(docs.to_pylist(), rows.to_pylist())]
            names = ["shard", "doc_id", "row", "width", "ids"]
            arrays = [pa.array(shard, pa.int32()), docs, rows, pa.array([width] * len(ends), pa.int32()), column.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _writer(folder: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        store, root = _store(folder)
        out, name, shard, width, docs, ends, nulls = None, None, None, 2, [], [np.zeros(1, dtype=np.int64)], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                shard, width = batch.column("shard")[0].as_py(), batch.column("width")[0].as_py()
                name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(f"{root}/{name}.ids")
            column = batch.column("ids").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
            out.write(column.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])))
            ends.append((offsets[1:] - offsets[0]) // width + ends[-1][-1])
            nulls += batch.column("doc_id").null_count
            docs.append(batch.column("doc_id").drop_null().to_numpy())
        if out is None:
            return
        out.close()
        ends = np.concatenate(ends)[1:]
        docs = np.concatenate(docs).astype(np.int64)
        base = int(docs[0]) if len(docs) else 0
        known = docs.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)
        with store.open_output_stream(f"{root}/{name}.index") as index:
            index.write(struct.pack("<qQ", base, nulls) + EliasFano.of(ends).to_bytes() + EliasFano.of(known).to_bytes())
        row = {"shard": [shard], "name": [name], "width": [width], "n_docs": [len(ends)], "n_ids": [int(ends[-1])]}
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds)})

    return run


def write(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, folder: str | None = None, shard_bytes: int = SHARD_BYTES
) -> tuple[str, DataFrame]:
    """(folder, manifest): the shards in ascending doc_id order."""
    folder = folder or shared_folder(docs.sparkSession, "token-ids")
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    size = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    shards = int(-(-size // shard_bytes)) or 1
    coded = texts.mapInArrow(
        _encoder(tokenizer or default_tokenizer(), end_id, cuts(texts.select("doc_id", "row"), shards)),
        "shard int, doc_id long, row long, width int, ids binary",
    )
    dealt = coded.repartitionById(shards, F.col("shard")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row")
    return folder, stored(dealt.mapInArrow(_writer(folder), MANIFEST), "token-manifest")


def _reader(folder: str, with_ids: bool):
    def run(frames):
        import numpy as np
        import pandas as pd

        store, root = _store(folder)
        for frame in frames:
            for shard in frame.itertuples():
                with store.open_input_stream(f"{root}/{shard.name}.index") as index:
                    raw = index.read()
                base, nulls = struct.unpack_from("<qQ", raw)
                ends, at = EliasFano.from_bytes(raw, 16)
                known, _ = EliasFano.from_bytes(raw, at)
                with store.open_input_file(f"{root}/{shard.name}.ids") as ids:
                    a = done = 0
                    while a < ends.n:
                        block = ends.select(a, min(ends.n, a + 4096))
                        b = a + max(1, int(np.searchsorted(block, done + READ_IDS, side="right")))
                        block = block[: b - a]
                        ids.seek(done * shard.width)
                        got = np.frombuffer(ids.read((int(block[-1]) - done) * shard.width), f"<u{shard.width}").astype("<u4")
                        first = np.concatenate([[done], block[:-1]])
                        each = [got[i - done : j - done].tobytes() for i, j in zip(first, block)]
                        numbers = [None] * max(0, min(b, nulls) - a) + (known.select(max(a, nulls) - nulls, b - nulls) + base).tolist() if b > nulls else [None] * (b - a)
                        out = pd.DataFrame({"doc_id": pd.array(numbers, dtype="Int64"), "start": first + shard.base, "n_tokens": block - first, "ids_crc32": [zlib.crc32(x) for x in each]})
                        if with_ids:
                            out["ids"] = each
                        yield out
                        a, done = b, int(block[-1])

    return run


def read(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 and, if asked for, its ids."""
    rows = sorted(manifest.collect(), key=lambda r: r["shard"])  # one for each shard
    bases = accumulate((r["n_ids"] for r in rows), initial=0)
    shards = spark.createDataFrame([(r["name"], r["width"], b) for r, b in zip(rows, bases)], "name string, width int, base long")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return shards.repartition(max(1, len(rows))).mapInPandas(_reader(folder, with_ids), schema)
