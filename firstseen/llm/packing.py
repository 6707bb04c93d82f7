"""Packing documents into sequences by minimum bin slack.

A document's ids are cut at every full window; what remains is shorter than a
window. Remainders are dealt over shards of even size. In a shard the multiset
of remaining lengths is packed window by window: the longest remainder is set,
and a subset-sum over bitsets finds which others fill the window closest to its
capacity. The counts of each length taken come from walking the bitsets back,
and a filling found is used as often as the counts allow.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.llm.frames import staged, texts
from firstseen.llm.tokens import default_vocabulary, document_ids

WINDOW = 2048
# Pieces packed together. More leave less padding and take longer.
SHARD_PIECES = 16_384

PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
# Where a piece was cut: the task, and the number of the piece there.
PLACE_SCHEMA = "task bigint, piece bigint"


def fill(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """How many of each length come closest to the capacity from below.

    ``counts[n]`` pieces of length n are there. Bit s of ``reach`` tells that the
    lengths looked at so far can sum to s. Longer lengths are looked at first and
    the search ends when the capacity itself is reached.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in np.flatnonzero(counts[: capacity + 1])[::-1].tolist():
        left, batch = min(int(counts[length]), capacity // length), 1
        while left:
            take = min(batch, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, batch = left - take, batch * 2
        if reach >> capacity:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + take
            total -= length * take
    return taken


def fillings(lengths: np.ndarray, window: int) -> Iterator[tuple[dict[int, int], int]]:
    """Fillings of a window and how often each is used, until no piece is left."""
    counts = np.bincount(lengths, minlength=window + 1)
    longest = window
    while True:
        while longest and not counts[longest]:
            longest -= 1
        if not longest:
            return
        counts[longest] -= 1
        taken = fill(counts, window - longest)
        counts[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(int(counts[length]) // n for length, n in taken.items())
        for length, n in taken.items():
            counts[length] -= n * times
        yield taken, times


def pack_shard(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece of a shard."""
    order = np.argsort(lengths, kind="stable")
    ends = np.cumsum(np.bincount(lengths, minlength=window + 1))
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    for taken, times in fillings(lengths, window):
        at = 0
        for length, n in sorted(taken.items(), reverse=True):
            ends[length] -= n * times
            rows = order[ends[length] : ends[length] + n * times]
            sequence[rows] = number + np.repeat(np.arange(times), n)
            offset[rows] = at + np.tile(np.arange(n) * length, times)
            at += n * length
        number += times
    return sequence, offset


def pieces(documents: DataFrame, vocabulary: str | None = None, window: int = WINDOW) -> DataFrame:
    """The pieces of every document, full windows and a remainder, and where they were cut."""
    vocabulary = vocabulary or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            found: list[list] = [[], [], [], [], []]
            ids = document_ids(vocabulary, batch.column("text").to_pylist())
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                raw, total = memoryview(one.tobytes()), len(one)
                for start in range(0, total, window):
                    end = min(total, start + window)
                    row = (doc_id, start, end - start, zlib.crc32(raw[4 * start : 4 * end]), total)
                    for column, value in zip(found, row, strict=True):
                        column.append(value)
            count = len(found[0])
            place = [np.full(count, task, np.int64), np.arange(done, done + count, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in (*found, *place)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "piece"],
            )
            done += count

    return texts(documents).mapInArrow(cut, f"{PIECE_SCHEMA}, {PLACE_SCHEMA}")


def pack(
    documents: DataFrame, vocabulary: str | None = None, window: int = WINDOW, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """One row per piece with its sequence and its offset there.

    A null text is empty and still has its end id; a long one is cut into as many
    pieces as it fills. Rows that repeat are packed each: pieces are dealt over
    shards by where they were cut, so rows that are wholly equal spread as any
    others do, and which pieces share a sequence depends on how the table is split
    into tasks. ``sequence_tokens`` counts a sequence's ids; ``padded_to`` is the
    window, or that count where it is a power of two. An empty table gives none.
    """
    cut = staged(pieces(documents, vocabulary, window), "pieces")
    shards = max(1, -(-cut.count() // shard_pieces))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "length", "ids_crc32"], kind="stable", ignore_index=True)
        sequence, offset = pack_shard(rows["length"].to_numpy(), window)
        filled = np.bincount(sequence, weights=rows["length"].to_numpy()).astype(np.int64)[sequence]
        whole = np.where(filled & (filled - 1) == 0, filled, window)
        return rows.assign(
            sequence_id=sequence * shards + rows["shard"], offset=offset, sequence_tokens=filled, padded_to=whole
        ).drop(columns="shard")

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("task", "piece"), F.lit(shards))).drop("task", "piece")
    return dealt.groupBy("shard").applyInPandas(
        packed, PIECE_SCHEMA + ", sequence_id bigint, offset bigint, sequence_tokens bigint, padded_to bigint"
    )
