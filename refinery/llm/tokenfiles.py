"""Token-ID files: ids at the minimum bits of the vocabulary, in blocks with stored offsets.

A file is, in little-endian order::

    magic          8 bytes  IDBLOCK1
    header         5 x u64  bits, ids a block, ids, documents, blocks
    block offsets  (blocks + 1) x u64, bytes from the start of the data
    doc ids        documents x i64, then documents x u8 (1: the id is null)
    doc starts     (documents + 1) x u64, ids before each document in this file
    data           each block: its ids at ``bits`` bits, lowest bit first, filled up to a byte

A block unpacks on its own with numpy, so any range of ids is read from the
blocks that hold it (:class:`TokenFile`).

Files are cut from ranges of doc_id and named by range and number: in name order
they hold the documents in ascending doc_id order. A task writes under a hidden
name and renames, and a repeated attempt writes the same bytes again.

Defined cases: null or empty text is the end id alone; null doc_id comes first;
rows of one doc_id keep their order in the input files; an empty table writes no file.
"""

from __future__ import annotations

import uuid
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, scratch, small, with_row
from .encode import END_ID, TOKENIZER, encoder

MAGIC = b"IDBLOCK1"
BLOCK = 4096
FILE_IDS = 1 << 23


def bits_for(vocab: int) -> int:
    """The fewest bits that hold every id below ``vocab``."""
    return max(1, (vocab - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` at ``bits`` bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(spread[:, :bits], bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    full = np.zeros((n, 32), np.uint8)
    full[:, :bits] = spread
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(n)


def file_bytes(doc_ids: list[int | None], texts: list[bytes], bits: int, block: int = BLOCK) -> bytes:
    """One file of the documents' ids (each: little-endian u32)."""
    ids = np.frombuffer(b"".join(texts), "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit into {bits} bits")
    blocks = [pack_bits(ids[i:i + block], bits) for i in range(0, len(ids), block)]
    u64 = lambda xs: np.cumsum([0, *xs], dtype="<u8").tobytes()
    return b"".join([
        MAGIC, np.array([bits, block, len(ids), len(texts), len(blocks)], "<u8").tobytes(),
        u64(map(len, blocks)), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        bytes(d is None for d in doc_ids), u64(len(t) // 4 for t in texts), *blocks])


class TokenFile:
    """Random access into one file's bytes (or a memory map of it)."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        if bytes(self.data[:8]) != MAGIC:
            raise ValueError("not a token-id file")
        self.bits, self.block, self.n_ids, self.n_docs, blocks = (
            int(x) for x in np.frombuffer(self.data, "<u8", 5, 8))
        at = 48
        self.offsets = np.frombuffer(self.data, "<u8", blocks + 1, at).astype(np.int64)
        at += 8 * (blocks + 1)
        ids = np.frombuffer(self.data, "<i8", self.n_docs, at).tolist()
        at += 8 * self.n_docs
        nulls = self.data[at:at + self.n_docs]
        self.doc_ids = [None if null else i for i, null in zip(ids, nulls)]
        at += self.n_docs
        self.starts = np.frombuffer(self.data, "<u8", self.n_docs + 1, at).astype(np.int64)
        self.at = at + 8 * (self.n_docs + 1)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the file, from the blocks that hold them."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        parts = [unpack_bits(self.data[self.at + self.offsets[b]:self.at + self.offsets[b + 1]],
                             min(self.block, self.n_ids - b * self.block), self.bits)
                 for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block:stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every (doc_id, start, ids), a stretch of blocks at a time."""
        lo = 0
        while lo < self.n_docs:
            hi = max(lo + 1, int(np.searchsorted(self.starts, self.starts[lo] + 64 * self.block)) - 1)
            ids, base = self.read(int(self.starts[lo]), int(self.starts[hi])), int(self.starts[lo])
            for k in range(lo, hi):
                yield self.doc_ids[k], int(self.starts[k]), ids[self.starts[k] - base:self.starts[k + 1] - base]
            lo = hi


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under a hidden name, then rename: a reader sees whole files only."""
    uri = folder if "://" in folder or folder.startswith("/") else folder.replace(":", "://", 1)
    where, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    where.create_dir(path, recursive=True)
    hidden = f"{path}/.{name}-{uuid.uuid4().hex}"
    with where.open_output_stream(hidden) as out:
        out.write(data)
    where.move(hidden, f"{path}/{name}")


def write_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode and write; the written manifest has a row a file: name, start, n_docs, n_ids.

    ``start`` counts the ids of all earlier files. Runs the job when called.
    """
    spark = docs.sparkSession

    def run(batches):
        enc, part, number = encoder(tokenizer, end_id), TaskContext.get().partitionId(), 0
        bits, held, size = bits_for(enc.vocab), [], 0

        def flush():
            nonlocal number, held, size
            name = f"part-{part:06d}-{number:06d}.ids"
            _put(folder, name, file_bytes([d for d, _ in held], [t for _, t in held], bits, block))
            row = pa.RecordBatch.from_pylist([{"name": name, "n_docs": len(held), "n_ids": size}])
            number, held, size = number + 1, [], 0
            return row

        for doc_id, ids in enc.documents(batches):
            held.append((doc_id, ids))
            size += len(ids) // 4
            if size >= file_ids:
                yield flush()
        if held:
            yield flush()

    ordered = (with_row(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
               .repartitionByRange("doc_id", ROW).sortWithinPartitions("doc_id", ROW))
    files = ordered.select("doc_id", "text").mapInArrow(run, "name string, n_docs long, n_ids long")
    files.write.mode("overwrite").parquet(f"{folder}/_manifest")
    earlier = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema("name string, n_docs long, n_ids long").parquet(f"{folder}/_manifest")
            .withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))))


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    schema = pa.schema([("name", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in small(batches, 1):
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(name, d, s, len(ids), zlib.crc32(ids.tobytes()))
                        for d, s, ids in TokenFile(data.as_buffer()).documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    rows = (files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
            .mapInArrow(run, "name string, doc_id long, at long, n_tokens long, ids_crc32 long"))
    return (rows.join(manifest.select("name", "start"), "name")
            .select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def encode_to_files(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` (doc_id, text) as files and read every document back from them."""
    folder = folder or scratch(docs.sparkSession, "token-files")
    return read_documents(docs.sparkSession, folder, write_files(docs, folder, **options))
