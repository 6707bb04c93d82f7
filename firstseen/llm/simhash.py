"""SimHash near-duplicates: fingerprints, links by bit-sliced comparison, classes.

Every distinct fingerprint is compared, complete for the radius: of ``BLOCKS``
blocks of bits, two fingerprints at most ``radius`` bits apart agree on
``BLOCKS - radius`` at least. So fingerprints meet in a bucket for each choice of
that many blocks. A bucket returns, for each fingerprint, the first of its class
there, never pairs. Buckets above ``CHUNK`` are cut into chunks and each two
chunks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstseen.llm.bitslice import classes
from firstseen.llm.components import components
from firstseen.llm.frames import fresh_names, staged, texts

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
BLOCKS = 6
# Fingerprints compared with each other in one task's group.
CHUNK = 4096
# Rows a worker gathers before it compares them.
ROWS_TOGETHER = 50_000


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(parts) > words:
        cuts = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    else:
        cuts = [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in cuts], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(text) for text in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp): one row per document; a text without words has fp 0."""
    return texts(documents).mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def _buckets(reps: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint once for every choice of blocks it may agree on."""
    cuts = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        key = F.lit(number).cast("bigint")
        for block in chosen:
            width = cuts[block + 1] - cuts[block]
            part = F.shiftrightunsigned("fp", cuts[block]).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return reps.select("fp", "rep", F.explode(F.array(*keys)).alias("bucket"))


def _spread(rows: DataFrame, chunk: int) -> DataFrame:
    """Give rows of large buckets to every pair of chunks they belong to."""
    large = rows.groupBy("bucket").count().filter(F.col("count") > chunk)
    large = staged(large.select("bucket", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")), "large-buckets")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")),
    )
    return (
        rows.join(large, "bucket", "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("own", own)
        .select("fp", "rep", "bucket", F.explode(pairs).alias("pair"))
        .select("fp", "rep", "bucket", "pair.i", "pair.j")
    )


def _linker(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def compared(columns: list[np.ndarray]) -> pa.RecordBatch:
            fp, rep = columns[3].view(np.uint64), columns[4]
            groups = np.ascontiguousarray(np.stack(columns[:3], axis=1)).view([("", np.int64)] * 3).reshape(-1)
            first = classes(groups, fp, radius)
            linked = np.flatnonzero(first != np.arange(len(first)))
            return pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(rep[first[linked]])], names=["a", "b"])

        rows = 0
        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)]))
            rows += batch.num_rows
            if rows >= ROWS_TOGETHER:
                together = np.concatenate(held, axis=1)
                # The last group may go on in the next batch.
                changes = np.flatnonzero((together[:3, 1:] != together[:3, :-1]).any(axis=0))
                if len(changes):
                    cut = changes[-1] + 1
                    yield compared(list(together[:, :cut]))
                    together = together[:, cut:]
                held, rows = [together], together.shape[1]
        if rows:
            yield compared(list(np.concatenate(held, axis=1)))

    return link


def links(reps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(a, b) links that join the same classes as all pairs within the radius.

    ``reps`` has distinct ``fp`` with a ``rep`` standing for each.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius {radius} is not below {BLOCKS}")
    rows = _spread(_buckets(reps, radius), chunk)
    key = ["bucket", "i", "j"]
    dealt = rows.select(*key, "fp", "rep").repartition(*key).sortWithinPartitions(*key, "fp")
    return dealt.mapInArrow(_linker(radius), "a bigint, b bigint")


def near_duplicates(documents: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: one row per document.

    Equal fingerprints are one node, so copies cost nothing. A null text is empty.
    Rows with equal doc_id are one document each. Rows without doc_id link like any
    other but name no class; one of such rows alone has none. Texts are whole; a
    task's memory grows with its longest text. An empty table gives no row.
    """
    prints = staged(fingerprints(documents), "fingerprints")
    reps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    # Fingerprints link, whoever has them; the class is named by the least id in it.
    linked = components(links(reps.select("fp", F.col("fp").alias("rep")), radius, chunk), "simhash-components")
    members = linked.join(reps, linked.node == reps.fp).select("fp", "component", "rep")
    names = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = members.select("fp", "component").join(names, "component").select("fp", "component_id", F.lit(True).alias("linked"))
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("rep")).alias("component_id")
    classed = reps.join(named, "fp", "left").select("fp", component)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(classed, "fp").select("doc_id", hexed, "component_id")


def keep_first(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``documents``, all columns, that are the first of their class.

    The smallest doc_id of a class stays. Rows that repeat a doc_id with its text
    count once; rows without doc_id stay.
    """
    first, copy, number = fresh_names(documents, "first", "copy", "number")
    classed = near_duplicates(documents, radius).filter("doc_id = component_id")
    classed = classed.select(F.col("doc_id").alias(first)).distinct()
    once = Window.partitionBy("doc_id", copy).orderBy(copy)
    joined = documents.join(classed, F.col("doc_id") == F.col(first), "left")
    return (
        joined.filter(F.col(first).isNotNull() | F.col("doc_id").isNull())
        .withColumn(copy, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("text")))
        .withColumn(number, F.row_number().over(once))
        .filter(F.col(number) == 1)
        .select(*documents.columns)
    )
