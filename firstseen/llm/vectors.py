"""Near-duplicate vectors by a pivot-permutation index.

Reference points are drawn from the vectors by hash, about ``PIVOTS_PER_ROOT``
times the root of their number and never more than ``MAX_PIVOTS``; every vector
is indexed. A vector is described by its ``NEAREST`` nearest pivots in order.
Inverted lists hold the vectors by pivot; two vectors are a candidate if they
share ``SHARED`` pivots. Such a pair shares one of the first
``NEAREST - SHARED + 1`` pivots of either, rarest first, so a vector is only
posted there. Candidates are verified by cosine in double precision in the list of
the rarest pivot they share, and each list returns counts per vector and a root
per class, never pairs. Vectors of each number of components have pivots and
lists of their own, all in the same jobs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.llm.bitslice import join_labels
from firstseen.llm.components import components
from firstseen.llm.frames import staged

PIVOTS_PER_ROOT = 4
MIN_PIVOTS, MAX_PIVOTS = 32, 4096
# Pivots closer than this to another are left out: among the pivots of a dense
# group, near copies would order them at random.
PIVOTS_APART = 0.8
NEAREST = 8
SHARED = 3
COSINE = 0.95
# Vectors of a list that meet in one task; longer lists meet chunk by chunk.
CHUNK = 2048
# Rows compared in one block of a list.
BLOCK = 512


@dataclass(frozen=True)
class Pivots:
    """Unit reference points of one number of components; they are numbered from ``first``."""

    first: int
    points: np.ndarray

    def __len__(self) -> int:
        return len(self.points)


def _usable(embedding, dimension: int | None):
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = whole & F.exists(embedding, lambda x: x != 0)
    return usable if dimension is None else (F.size(embedding) == dimension) & usable


def _unit(rows: np.ndarray) -> np.ndarray:
    """Unit rows in double precision; scaled first, so tiny and huge ones survive."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return _unit(np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dimension))


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch apart by their number of components."""
    sizes = np.asarray(batch.column("embedding").value_lengths())
    for dimension in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dimension)
        yield dimension, batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))


def _apart(rows: np.ndarray) -> np.ndarray:
    """The rows in turn, without those close to one taken before."""
    closest, kept = np.full(len(rows), -1.0), []
    for k, row in enumerate(rows):
        if closest[k] < PIVOTS_APART:
            kept.append(k)
            closest = np.maximum(closest, rows @ row)
    return rows[kept]


def _pivots(reps: DataFrame) -> dict[int, Pivots]:
    """Pivots by number of components.

    Of each number those with the least hashes are taken. The rows that can be
    among them pass a bound on the hash, twice as wide as the share wanted, so one
    job without a sort serves all. The driver holds one count and at most
    ``MAX_PIVOTS`` points for each number of components that occurs.
    """
    sizes = reps.groupBy(F.size("embedding").alias("size")).count().collect()
    wanted = {row.size: min(MAX_PIVOTS, max(MIN_PIVOTS, int(PIVOTS_PER_ROOT * row["count"] ** 0.5))) for row in sizes}
    # Hashes are even over 2**64 values; below the bound lie about twice the wanted ones.
    bounds = [(row.size, min(2**63 - 1, int(-(2**63) + 2**65 * wanted[row.size] / row["count"]))) for row in sizes]
    bounded = reps.sparkSession.createDataFrame(bounds, "size int, bound bigint")
    hashed = reps.select("rep", "embedding", F.size("embedding").alias("size"), F.xxhash64("rep").alias("hash"))
    chosen = hashed.join(F.broadcast(bounded), "size").filter("hash <= bound").select("size", "hash", "rep", "embedding")
    rows: dict[int, list] = {}
    for row in sorted(chosen.collect(), key=lambda row: (row.size, row.hash, row.rep)):
        rows.setdefault(row.size, []).append(row.embedding)
    found, first = {}, 0
    for dimension, points in rows.items():
        found[dimension] = Pivots(first, _apart(_unit(np.array(points[: wanted[dimension]], np.float64))))
        first += len(found[dimension])
    return found


def describe(reps: DataFrame, pivots: dict[int, Pivots]) -> DataFrame:
    """Add ``nearest``: the numbers of the nearest pivots, nearest first."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, rows in _by_dimension(batch):
                own = pivots[dimension]
                order = np.argsort(-(_matrix(rows.column("embedding"), dimension) @ own.points.T), axis=1, kind="stable")
                numbers = (own.first + order[:, :NEAREST]).astype(np.int32)
                yield rows.append_column("nearest", pa.array(list(numbers), pa.list_(pa.int32())))

    schema = f"rep bigint, copies bigint, embedding array<{reps.schema['embedding'].dataType.elementType.simpleString()}>"
    return reps.select("rep", "copies", "embedding").mapInArrow(nearest, schema + ", nearest array<int>")


def _list_sizes(described: DataFrame, count: int) -> np.ndarray:
    sizes = np.zeros(count, np.int64)
    for row in described.select(F.explode("nearest").alias("pivot")).groupBy("pivot").count().collect():
        sizes[row.pivot] = row["count"]
    return sizes


def _post(described: DataFrame, pivots: dict[int, Pivots], sizes: np.ndarray, chunk: int) -> DataFrame:
    """One row per list and pair of its chunks that a vector belongs to.

    ``ranks`` are the pivots of the vector by rarity among those of its number of
    components; a list is named by its rank after the lists of other numbers.
    """
    order = np.concatenate([p.first + np.argsort(sizes[p.first : p.first + len(p)], kind="stable") for p in pivots.values()])
    rank = np.empty(len(sizes), np.int64)
    rank[order] = np.arange(len(sizes))
    chunks = np.maximum(1, -(-sizes // chunk))[order]
    first = {dimension: p.first for dimension, p in pivots.items()}
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in described.drop("nearest").schema.fields)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dimension, batch in (part for batch in batches for part in _by_dimension(batch)):
            nearest = np.asarray(batch.column("nearest").flatten()).reshape(batch.num_rows, -1)
            ranks = np.sort(rank[nearest], axis=1)
            posted = max(1, ranks.shape[1] - SHARED + 1)
            row, lists = np.repeat(np.arange(batch.num_rows), posted), ranks[:, :posted].reshape(-1)
            own = batch.column("rep").to_numpy(zero_copy_only=False)[row] % chunks[lists]
            times = chunks[lists]
            row, lists, own = (np.repeat(x, times) for x in (row, lists, own))
            other = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            plain = batch.select(["rep", "copies", "embedding"]).take(pa.array(row))
            columns = [pa.array(list((ranks[row] - first[dimension]).astype(np.int32)), pa.list_(pa.int32())), *map(pa.array, (lists, np.minimum(own, other), np.maximum(own, other), own))]
            yield pa.RecordBatch.from_arrays(
                [*plain.columns, *columns], names=["rep", "copies", "embedding", "ranks", "list", "i", "j", "own"]
            )

    return described.mapInArrow(post, fields + ", ranks array<int>, list bigint, i bigint, j bigint, own bigint")


def _bitmaps(ranks: np.ndarray, count: int) -> np.ndarray:
    maps = np.zeros((len(ranks), -(-count // 64)), np.uint64)
    rows = np.arange(len(ranks))
    for column in ranks.T:
        maps[rows, column // 64] |= np.uint64(1) << (column % 64).astype(np.uint64)
    return maps


def _verify(pivots: dict[int, Pivots], cosine: float):
    """Compare the vectors of one list, or of two chunks of it."""
    places = {dimension: (p.first, len(p)) for dimension, p in pivots.items()}

    def verify(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dimension = len(group.column("embedding")[0])
        first, count = places[dimension]
        unit = _matrix(group.column("embedding").combine_chunks(), dimension)
        rep, copies, own = (group.column(c).to_numpy() for c in ("rep", "copies", "own"))
        ranks = np.asarray(group.column("ranks").combine_chunks().flatten()).reshape(len(rep), -1)
        number, i, j = (group.column(c)[0].as_py() for c in ("list", "i", "j"))
        number -= first
        maps = _bitmaps(ranks, count)
        # Pivots rarer than this list: a pair that shares one is met there.
        rarer = np.zeros(maps.shape[1], np.uint64)
        rarer[: number // 64] = np.uint64(0xFFFFFFFFFFFFFFFF)
        rarer[number // 64] = (np.uint64(1) << np.uint64(number % 64)) - np.uint64(1)
        links, labels = np.zeros(len(rep), np.int64), np.arange(len(rep))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        for a in range(0, len(left), BLOCK):
            rows = left[a : a + BLOCK]
            for b in range(a if i == j else 0, len(right), BLOCK):
                columns = right[b : b + BLOCK]
                shared = np.zeros((len(rows), len(columns)), np.uint8)
                here = np.ones(shared.shape, bool)
                for word in range(maps.shape[1]):
                    both = maps[rows, word][:, None] & maps[columns, word][None, :]
                    shared += np.bitwise_count(both)
                    if rarer[word]:
                        here &= (both & rarer[word]) == 0
                near = here & (shared >= min(SHARED, ranks.shape[1]))
                if i == j and a == b:
                    near &= rows[:, None] < columns[None, :]
                if not near.any():
                    continue
                near &= unit[rows] @ unit[columns].T >= cosine
                at, to = np.nonzero(near)
                np.add.at(links, rows[at], copies[columns[to]])
                np.add.at(links, columns[to], copies[rows[at]])
                labels = join_labels(labels, rows[at], columns[to])
        linked = np.flatnonzero(links)
        return pa.table({"rep": rep[linked], "links": links[linked], "root": rep[labels[linked]]})

    return verify


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, dimension: int | None = None, chunk: int = CHUNK
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector.

    A vector that is null, zero or has null or non-finite components, or not
    ``dimension`` of them where that is given, links with nothing; others link with
    vectors of as many components. Equal vectors are one node and count as links of
    each other, as rows of one vec_id do. A null vec_id has no component. An empty
    table gives none.
    """
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    usable = rows.filter(_usable(F.col("embedding"), dimension) & F.col("vec_id").isNotNull())
    reps = usable.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = staged(reps, "vectors")
    pivots = _pivots(reps)
    if pivots:
        described = staged(describe(reps, pivots), "permutations")
        sizes = _list_sizes(described, sum(map(len, pivots.values())))
        posted = _post(described, pivots, sizes, chunk)
        found = posted.groupBy("list", "i", "j").applyInArrow(_verify(pivots, cosine), "rep bigint, links bigint, root bigint")
        found = staged(found, "vector-links")
        joined = components(found.select("rep", "root"), "vector-components")
        counted = found.groupBy("rep").agg(F.sum("links").alias("links")).join(
            joined.withColumnRenamed("node", "rep"), "rep", "left"
        )
        classed = reps.join(counted, "rep", "left")
    else:
        classed = reps.select("*", F.lit(None).cast("bigint").alias("links"), F.lit(None).cast("bigint").alias("component"))
    classed = classed.select(
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    linked = usable.join(classed, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.coalesce(_usable(F.col("embedding"), dimension), F.lit(False)) | F.col("vec_id").isNull())
    alone = alone.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
