"""Operator 1: token ids as length-delimited binary records with an offset index.

A data file holds one record for each document, in ascending order of doc_id (null first)::

    length   unsigned 64-bit   bytes of the body
    check    unsigned 32-bit   masked CRC-32 of the eight bytes before it
    body     doc_id signed 64-bit, has_id one byte, width one byte (2 or 4), ids unsigned little-endian of that width
    check    unsigned 32-bit   masked CRC-32 of the body

all little-endian; masked(c) = rotate_right(c, 15) + 0xA282EAD8.  Beside it an index file holds (offset, ids before it in
the file) of each record as two unsigned 64-bit integers, and a last pair for the file's end, so that a reader seeks to
any record.  Files are cut by ranges of doc_id and at FILE_BYTES; the manifest (one row a file) gives their order.  Every
attempt of a task writes files of its own names, and the manifest names those of the attempts that ended well, so that a
task that runs again harms nothing.

Readers take CHUNK records at a time: ``read_records`` in order, ``read_shuffled`` in a seeded random order, in which each
record is sought by its offset.  Both verify the checks, and that records and index agree.

Words between spaces or line ends are encoded by the library's model once for each worker's cache: the tokenizer's
pre-tokenizer drops white space and never joins what it separates.

Defined results: a null text is empty (the end id alone); rows that repeat an id give one record each, ordered by a hash
of the text and then by the text; an empty table gives no file and an empty result; other columns are dropped.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, new_path, resident, slices, trimmed
from .pretokens import PreTokens

END_ID = 1
#: Bytes at which a task starts its next file, and records that a reader takes at a time.
FILE_BYTES, CHUNK = 256 << 20, 4096
ENTRIES = 500_000
MANIFEST = "part int, seq int, file string, n_docs long, n_tokens long, n_bytes long"
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    body = struct.pack("<qBB", doc_id or 0, doc_id is not None, width) + ids
    head = struct.pack("<Q", len(body))
    return b"".join((head, struct.pack("<I", masked(head)), body, struct.pack("<I", masked(body))))


def read_record(stream, at: int | None = None) -> tuple[int | None, np.ndarray]:
    """The record at the stream's place, or at a byte offset of the index; raises ValueError if a check fails."""
    if at is not None:
        stream.seek(at)
    head = stream.read(12)
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError("damaged record length")
    body = stream.read(struct.unpack("<Q", head[:8])[0])
    if stream.read(4) != struct.pack("<I", masked(body)):
        raise ValueError("damaged record body")
    doc_id, has, width = struct.unpack("<qBB", body[:10])
    return doc_id if has else None, np.frombuffer(body, f"<u{width}", offset=10)


#: The pre-tokenizer's pattern of the vocabulary with word ends (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Texts to the bytes of their ids; one for each worker."""

    def __init__(self, path: str, entries: int = ENTRIES):
        self.tokens, self.entries = PreTokens(path, PATTERN, True, entries, "I"), entries
        self.width = 2 if self.tokens.whole.get_vocab_size() <= 1 << 16 else 4
        self.tokens.code = "H" if self.width == 2 else "I"
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        known, ids = self.known, self.tokens.all
        split = [t.replace("\n", " ").split(" ") for t in texts]
        for w in (new := [w for w in set().union(*split) if w not in known]):
            known[w] = b"".join(ids(w))
        end = END_ID.to_bytes(self.width, "little")
        out = [b"".join([*map(known.__getitem__, p), end]) for p in split]
        self.known = trimmed(known, new, self.entries)
        return out


class Writer:
    """The files of one attempt of a task."""

    def __init__(self, path: str, part: int):
        self.store, self.root = fs.FileSystem.from_uri(path)
        self.store.create_dir(self.root)
        self.part, self.own, self.seq, self.name = part, uuid.uuid4().hex, 0, ""

    def add(self, doc_ids: list, ids: list[bytes], width: int) -> dict | None:
        """Appends records; the manifest's row of the file if that makes it full."""
        if not self.name:
            self.name = f"part-{self.part:06d}-{self.seq:04d}-{self.own}"
            self.data, self.index = (self.store.open_output_stream(f"{self.root}/{self.name}.{kind}") for kind in ("records", "index"))
            self.n_docs = self.n_tokens = self.n_bytes = 0
        entries = []
        for doc_id, x in zip(doc_ids, ids, strict=True):
            record = frame(doc_id, x, width)
            self.data.write(record)
            entries += (self.n_bytes, self.n_tokens)
            self.n_bytes, self.n_tokens = self.n_bytes + len(record), self.n_tokens + len(x) // width
        self.index.write(np.array(entries, "<u8").tobytes())
        self.n_docs += len(doc_ids)
        return self.close() if self.n_bytes >= FILE_BYTES else None

    def close(self) -> dict | None:
        if not self.name:
            return None
        self.index.write(np.array([self.n_bytes, self.n_tokens], "<u8").tobytes())
        self.data.close()
        self.index.close()
        row = {"part": self.part, "seq": self.seq, "file": self.name, "n_docs": self.n_docs, "n_tokens": self.n_tokens, "n_bytes": self.n_bytes}
        self.name, self.seq = "", self.seq + 1
        return row


def write_records(docs: DataFrame, tokenizer_path: str, path: str) -> list:
    """Writes docs(doc_id, text) below path; the manifest's rows in order: (file, ids before it, records)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = resident(("binary_records", tokenizer_path), lambda: Encoder(tokenizer_path))
        writer, rows = Writer(path, TaskContext.get().partitionId()), []
        for batch in slices(batches, "text"):
            rows.append(writer.add(batch.column("doc_id").to_pylist(), encoder.encode([t or "" for t in batch.column("text").to_pylist()]), encoder.width))
        if rows := [r for r in [*rows, writer.close()] if r]:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(c, t) for c, t in zip(rows[0], (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)]))

    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    ordered = docs.selectExpr("cast(doc_id as long) doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    manifest, start = [], 0
    for r in sorted(ordered.mapInArrow(run, MANIFEST).collect()):  # one row a file
        manifest.append((r.file, start, r.n_docs))
        start += r.n_tokens
    return manifest


def chunks(spark: SparkSession, manifest: list) -> DataFrame:
    """(file, start, a, b): records a to b of each file, CHUNK at most."""
    files = spark.createDataFrame(manifest, "file string, start long, n_docs long")
    rows = files.select("file", "start", "n_docs", F.explode(F.sequence(F.lit(0), F.col("n_docs") - 1, F.lit(CHUNK))).alias("a"))
    return rows.select("file", "start", "a", F.least(F.col("a") + CHUNK, "n_docs").alias("b"))


def read_chunk(path: str, file: str, a: int, b: int, order: np.ndarray | None = None) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(record's number, doc_id, ids before it in the file, ids) of records a to b, by the index; order: which after which."""
    store, root = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{root}/{file}.index") as f:
        f.seek(16 * a)
        index = np.frombuffer(f.read(16 * (b - a + 1)), "<u8").reshape(-1, 2).astype(np.int64).tolist()
    if len(index) != b - a + 1:
        raise ValueError(f"{file}: the index ends before record {b}")
    with store.open_input_file(f"{root}/{file}.records") as f:
        if order is None:  # neighbours come in one read
            f.seek(index[0][0])
            data, base = pa.BufferReader(f.read(index[-1][0] - index[0][0])), index[0][0]
        else:
            data, base = f, 0
        for k in range(b - a) if order is None else order.tolist():
            (at, start), (end, upto) = index[k], index[k + 1]
            doc_id, ids = read_record(data, at - base)
            if data.tell() != end - base or len(ids) != upto - start:
                raise ValueError(f"{file}: record {a + k} and index differ")
            yield a + k, doc_id, start, ids


def read_records(spark: SparkSession, path: str, manifest: list) -> DataFrame:
    """A row for each record of the files, every check verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = [(doc_id, r["start"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for _, doc_id, start, ids in read_chunk(path, r["file"], r["a"], r["b"])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = sum(-(-n_docs // CHUNK) for _, _, n_docs in manifest)
    return chunks(spark, manifest).repartition(min(max(1, n), 8192)).mapInArrow(run, SCHEMA)


def read_shuffled(spark: SparkSession, path: str, manifest: list, seed: int) -> DataFrame:
    """(doc_id, ids) of every record once; chunks are dealt out, and their records sought, in an order that seed decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                order = np.random.default_rng([seed, zlib.crc32(r["file"].encode()), r["a"]]).permutation(r["b"] - r["a"])
                rows = [(doc_id, ids.astype("<u4").tolist()) for _, doc_id, _, ids in read_chunk(path, r["file"], r["a"], r["b"], order)]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    n = sum(-(-n_docs // CHUNK) for _, _, n_docs in manifest)
    mixed = F.xxhash64("file", "a", F.lit(seed))
    return chunks(spark, manifest).repartition(min(max(1, n), 8192), mixed).sortWithinPartitions(mixed).mapInArrow(run, "doc_id long, ids array<long>")


def op1_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "records")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_records(spark, path, write_records(docs, public_tokenizers.path("word_bpe_49k.json"), path))
