"""Token ids on disk as bit or byte planes.

A part of the corpus is a run of segments. A segment holds whole documents in
order: their ids and lengths, one id stream cut into blocks of a fixed number
of ids. Each block is transposed into planes (bit planes or byte planes of its
ids) and each plane is compressed on its own with zstandard. An index gives the
place of every block, so any block can be read alone.

    magic "PLN1" | uint32 header length | header (JSON) | index | documents | planes

index      one uint64 per plane of each block: the end of its bytes among the planes
documents  zstandard of int64 doc ids, then bytes telling nulls, then uint32 lengths
planes     the compressed planes, block after block
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.llm.frames import texts
from firstseen.llm.tokens import default_vocabulary, document_ids
from firstseen.storage import shared_folder

MAGIC = b"PLN1"
BLOCK_IDS = 65_536
# Ids after which a segment is closed; bounds a row of the file and a worker's memory.
SEGMENT_IDS = 2_000_000
LEVEL = 3

SEGMENT_SCHEMA = "part bigint, segment bigint, start_in_part bigint, n_ids bigint, content binary"
DOCUMENT_SCHEMA = "part bigint, start_in_part bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """Transpose a block: plane k holds bit k, or byte k, of every id."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(parts: list[bytes], n_ids: int, planes: str) -> np.ndarray:
    if planes == "byte":
        raw = np.stack([np.frombuffer(part, np.uint8, n_ids) for part in parts], axis=1)
    else:
        bits = np.stack(
            [np.unpackbits(np.frombuffer(part, np.uint8), count=n_ids, bitorder="little") for part in parts], axis=1
        )
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def encode_segment(doc_ids: list[int | None], ids: list[np.ndarray], planes: str, block_ids: int) -> bytes:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    stream = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    compressed = [
        squeeze(plane)
        for first in range(0, len(stream), block_ids)
        for plane in to_planes(stream[first : first + block_ids], planes)
    ]
    ends = np.cumsum([len(part) for part in compressed], dtype="<u8").astype("<u8")
    documents = squeeze(
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
        + np.array([d is None for d in doc_ids], np.uint8).tobytes()
        + np.array([len(one) for one in ids], "<u4").tobytes()
    )
    header = json.dumps(
        {"planes": planes, "block_ids": block_ids, "n_ids": len(stream), "n_docs": len(doc_ids), "documents": len(documents)}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, ends.tobytes(), documents, *compressed])


class Segment:
    """Reads a segment; blocks are decompressed when asked for."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC:
            raise ValueError("not a segment of token planes")
        (size,) = struct.unpack_from("<I", content, 4)
        self.header = json.loads(content[8 : 8 + size])
        self._planes = 4 if self.header["planes"] == "byte" else 32
        self.n_blocks = -(-self.header["n_ids"] // self.header["block_ids"])
        count = self.n_blocks * self._planes
        self._ends = np.frombuffer(content, "<u8", count, 8 + size)
        documents = 8 + size + 8 * count
        self._first = documents + self.header["documents"]
        self._content = content
        self._documents = content[documents : self._first]

    def block(self, number: int) -> np.ndarray:
        import zstandard

        open_plane = zstandard.ZstdDecompressor().decompress
        n_ids = min(self.header["block_ids"], self.header["n_ids"] - number * self.header["block_ids"])
        parts = []
        for plane in range(number * self._planes, (number + 1) * self._planes):
            first = int(self._ends[plane - 1]) if plane else 0
            parts.append(open_plane(self._content[self._first + first : self._first + int(self._ends[plane])]))
        return from_planes(parts, n_ids, self.header["planes"])

    def ids(self) -> np.ndarray:
        blocks = [self.block(k) for k in range(self.n_blocks)]
        return np.concatenate(blocks) if blocks else np.zeros(0, "<u4")

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        import zstandard

        raw, n = zstandard.ZstdDecompressor().decompress(self._documents), self.header["n_docs"]
        doc_ids, absent = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n)
        lengths = np.frombuffer(raw, "<u4", n, 9 * n)
        return [None if gone else int(d) for d, gone in zip(doc_ids, absent, strict=True)], lengths


def write_token_files(
    documents: DataFrame,
    path: str,
    vocabulary: str | None = None,
    planes: str = "byte",
    block_ids: int = BLOCK_IDS,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode every whole text and write the ids in ascending doc_id order.

    Texts are ranged by doc_id, so no id of part k of the output is above one of
    part k + 1. A null text is empty; a null doc_id comes first; rows of one doc_id
    follow each other in the order of the table, and many of them spread over parts.
    A text is one task's, however long; a segment is closed after the text that
    fills it. An empty table gives no segment.
    """
    if planes not in ("bit", "byte"):
        raise ValueError(f"unknown planes {planes!r}")
    vocabulary = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, done, held = TaskContext.get().partitionId(), 0, 0, 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            content = encode_segment(doc_ids, ids, planes, block_ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([segment]), pa.array([done]), pa.array([held]), pa.array([content], pa.binary())],
                names=["part", "segment", "start_in_part", "n_ids", "content"],
            )

        for batch in batches:
            found = document_ids(vocabulary, batch.column("text").to_pylist())
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                doc_ids.append(doc_id)
                ids.append(one)
                held += len(one)
                if held >= segment_ids:
                    yield closed()
                    segment, done, held, doc_ids, ids = segment + 1, done + held, 0, [], []
        if ids:
            yield closed()

    # Ranges are cut by the place in the table too, or rows without id would be one task.
    # It is the same whenever a task reads its part of the files again.
    placed = texts(documents).withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").drop("place")
    ordered.mapInArrow(encode, SEGMENT_SCHEMA).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, start, content in zip(
            batch.column("part").to_pylist(),
            batch.column("start_in_part").to_pylist(),
            batch.column("content"),
            strict=True,
        ):
            segment = Segment(content.as_py())
            raw = memoryview(segment.ids().tobytes())
            doc_ids, lengths = segment.documents()
            ends = np.cumsum(lengths, dtype=np.int64)
            starts = ends - lengths
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(sums), pa.int64()),
                    pa.array(starts + start, pa.int64()),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ],
                names=["part", "start_in_part", "doc_id", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    The driver holds one number per part to find where each part starts.
    """
    segments = spark.read.parquet(path)
    sizes = sorted((row.part, row.n) for row in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, total = [], 0
    for part, size in sizes:
        before.append((part, total))
        total += size
    offsets = spark.createDataFrame(before, "part bigint, before bigint")
    return (
        segments.select("part", "start_in_part", "content")
        .mapInArrow(_read, DOCUMENT_SCHEMA)
        .join(offsets, "part")
        .select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")
    )


def round_trip(documents: DataFrame, vocabulary: str | None = None, planes: str = "byte") -> DataFrame:
    """Write the ids of all documents and read them back."""
    spark = documents.sparkSession
    path = shared_folder(spark, "token-planes")
    write_token_files(documents, path, vocabulary, planes)
    return read_token_files(spark, path)
