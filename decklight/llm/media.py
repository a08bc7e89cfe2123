"""Media columns (operator 5): payloads in content-addressed tar shards.

Each task writes its payloads as 8-bit grey PNG files, 192 samples a row, into tar
shards in the shared folder. A member is named by the payload's SHA-256, so a shard
holds each content once, and a content that many rows share is stored once a task at
most. Rows carry digest, shard, offset and length. Metadata columns come from range
reads of the two headers; only ``read_payloads`` reads the samples.

Reading back is dealt out by spans of ``SPAN_BYTES`` of a shard, so that a task's work is
bounded by bytes, and goes along each span; what rows share is read once.

A task that is run again writes new shards and new rows; what the lost attempt wrote
is not referred to by any row.

Defined results: a null or empty text is one row of 192 spaces; a text of any length is
one payload; equal texts give equal values, and repeated rows equal rows; rows with a null doc_id are stored as well; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import read_table, shared_folder, text_or_empty

ROW_SAMPLES = 192
SHARD_BYTES = 256 << 20
#: Bytes of a shard that one task reads back.
SPAN_BYTES = 16 << 20
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Tar header, then the PNG signature and its IHDR chunk.
_HEADER_BYTES = 512 + len(_SIGNATURE) + 25


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    """Lossless: one grey sample a byte, ``ROW_SAMPLES`` a row, each row unfiltered."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW_SAMPLES)
    raw = np.zeros((len(rows), ROW_SAMPLES + 1), np.uint8)
    raw[:, 1:] = rows
    header = struct.pack(">IIBBBBB", ROW_SAMPLES, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), 4)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, packed, shape = 8, [], None
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        data = media[at + 8 : at + 8 + size]
        if struct.unpack(">I", media[at + 8 + size : at + 12 + size])[0] != zlib.crc32(kind + data):
            raise ValueError("damaged PNG chunk")
        if kind == b"IHDR":
            shape = struct.unpack(">II", data[:8])
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + size
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(shape[1], shape[0] + 1)
    return raw[:, 1:].tobytes()


def padded(text: str) -> tuple[bytes, int]:
    raw = text.encode()
    size = max(1, -(-len(raw) // ROW_SAMPLES)) * ROW_SAMPLES
    return raw.ljust(size, b" "), len(raw)


class ShardWriter:
    """Tar shards of one task, opened as needed."""

    def __init__(self, folder: str):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.root, self.stream, self.at = root, None, 0
        self.held: dict[str, tuple[int, int]] = {}

    def put(self, digest: str, payload: bytes) -> tuple[str, int, int]:
        """(shard, offset of the media file, its length)"""
        if self.stream is None or self.at >= SHARD_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}.tar"
            self.stream, self.at, self.held = self.files.open_output_stream(f"{self.root}/{self.name}"), 0, {}
        if digest not in self.held:
            media = to_png(payload)
            member = tarfile.TarInfo(f"{digest}.png")
            member.size = len(media)
            self.stream.write(member.tobuf(tarfile.USTAR_FORMAT) + media + bytes(-len(media) % 512))
            self.held[digest] = self.at + 512, len(media)
            self.at += 512 + len(media) + -len(media) % 512
        return self.name, *self.held[digest]

    def close(self) -> None:
        if self.stream is not None:
            self.stream.write(bytes(1024))  # the archive's end
            self.stream.close()
            self.stream = None


class ShardReader:
    """Range reads; keeps the last shard open, and what ``use`` made of the last range."""

    def __init__(self, folder: str, use: Callable[[bytes], tuple]):
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.use = use
        self.name, self.file, self.range, self.made = None, None, None, ()

    def read(self, shard: str, offset: int, size: int) -> tuple:
        if (shard, offset, size) != self.range:
            if shard != self.name:
                self.name, self.file = shard, self.files.open_input_file(f"{self.root}/{shard}")
            self.range, self.made = (shard, offset, size), self.use(self.file.read_at(size, offset))
        return self.made


def by_span(rows: DataFrame) -> DataFrame:
    """Pointer rows dealt out by the span of the shard that they point into, along the span."""
    total = rows.agg(F.sum("length")).first()[0] or 0
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // SPAN_BYTES + 1)
    return rows.repartition(parts, "shard", F.floor(F.col("offset") / SPAN_BYTES)).sortWithinPartitions("shard", "offset")


def store_payloads(docs: DataFrame, folder: str) -> DataFrame:
    """Writes the shards and the rows (doc_id, n_bytes, digest, shard, offset, length) that point into them."""
    shards = f"{folder}/shards"

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ShardWriter(shards)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                rows = []
                for text in part["text"].to_pylist():
                    payload, size = padded(text)
                    digest = hashlib.sha256(payload).hexdigest()
                    rows.append((size, digest, *writer.put(digest, payload)))
                sizes, digests, names, offsets, lengths = zip(*rows)
                columns = [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests), pa.array(names), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        writer.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    made = rows.mapInArrow(store, "doc_id long, n_bytes long, digest string, shard string, offset long, length long")
    made.write.option("compression", "zstd").parquet(f"{folder}/rows")
    return docs.sparkSession.read.schema(made.schema).parquet(f"{folder}/rows")


def with_metadata(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` with name, width, height and media_bytes, from header-only range reads."""
    shards = f"{folder}/shards"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def header(head: bytes) -> tuple:
            member = tarfile.TarInfo.frombuf(head[:512], "utf-8", "strict")
            return member.name, *struct.unpack(">II", head[512 + 16 : 512 + 24]), member.size

        reader = ShardReader(shards, header)
        for batch in batches:
            found = [reader.read(shard, offset - 512, _HEADER_BYTES) for shard, offset in zip(batch["shard"].to_pylist(), batch["offset"].to_pylist())]
            name, width, height, size = zip(*found) if found else ((),) * 4
            columns = [*batch.columns, pa.array(name, pa.string()), *(pa.array(c, pa.int64()) for c in (width, height, size))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "name", "width", "height", "media_bytes"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(read, f"{kinds}, name string, width long, height long, media_bytes long")


def sample_features(payload: bytes) -> str:
    """Mean, deviation and a 64-bit average hash of the samples."""
    samples = np.frombuffer(payload, np.uint8).astype(np.int64)
    n, total = len(samples), int(samples.sum())
    deviation = (int((samples * samples).sum()) / n - (total / n) ** 2) ** 0.5
    edges = np.arange(64) * n // 64
    sums = np.add.reduceat(samples, edges)
    above = sums * n > total * np.diff(np.append(edges, n))
    return f"mean={total / n:.3f};std={deviation:.3f};ahash={np.packbits(above).tobytes().hex()}"


def with_samples(rows: DataFrame, folder: str) -> DataFrame:
    """Digests and features of the payloads, read back from the shards."""
    shards = f"{folder}/shards"
    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width long, height long"
    names = [k.split()[0] for k in kinds.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests(media: bytes) -> tuple:
            payload = from_png(media)
            return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), hashlib.sha256(media).hexdigest(), sample_features(payload)

        reader = ShardReader(shards, digests)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = [reader.read(*row) for row in zip(*(part[c].to_pylist() for c in ("shard", "offset", "length")))]
                size, digest, tail, stored, feature = zip(*found)
                columns = [
                    part["doc_id"], part["n_bytes"], pa.array(size, pa.int64()), pa.array(digest), pa.array(tail, pa.int64()),
                    part["media_bytes"], pa.array(stored), pa.array(feature), part["width"], part["height"],
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(read, kinds)


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    rows = store_payloads(read_table(spark, sf_dir, "documents", "doc_id", "text"), folder)
    return with_samples(with_metadata(by_span(rows), folder), folder)
