"""A Bloom filter over record keys, to keep new keys out of joins.

The filter is rows of ``(file_date, blocks, block, bitmap)``. A key belongs to one
block of its date, by one hash, and sets ``PROBES`` bits there, by another. Bitmaps
of several parts of the keys are combined by OR, so filters grow with what is
published. A key that the filter does not hold is surely new; one that it holds
has to be looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstseen.columns import GROUP
from firstseen.config import DedupConfig
from firstseen.operators.first_seen import baseline_anti_join
from firstseen.operators.prepare import records

# Bits of a bitmap of Spark's bitmap functions, and its bytes.
BLOCK_BITS = 32_768
BLOCK_BYTES = BLOCK_BITS // 8
PROBES = 4
# A new filter has so many bits for each key; one with fewer than the second
# number lets too many keys through and is made anew.
BITS_PER_KEY = 16
LEAST_BITS_PER_KEY = 8
# Filters are broadcast up to this size. Beyond it keys go to the join unfiltered.
BROADCAST_BYTES = 64 << 20

FILTER_SCHEMA = "file_date DATE, blocks BIGINT, block BIGINT, bitmap BINARY"


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys."""
    return max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*GROUP), blocks)


def _bits() -> list[Column]:
    """The places of a key's bits in its block: 15 bits of a second hash each."""
    second = F.xxhash64(F.lit("bits"), *GROUP)
    return [F.shiftrightunsigned(second, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(PROBES)]


def build(keys: DataFrame, blocks: Column) -> DataFrame:
    """The filter of rows with GROUP. ``blocks`` is their date's number of blocks.

    One aggregation; map tasks send a bitmap per block.
    """
    bits = keys.select("file_date", blocks.cast("bigint").alias("blocks"), _block(blocks).alias("block"), F.explode(F.array(*_bits())).alias("bit"))
    return bits.groupBy("file_date", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def combined(parts: DataFrame) -> DataFrame:
    """One bitmap for each block of a filter written in parts."""
    return parts.groupBy("file_date", "blocks", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, bit.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def with_presence(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``rows`` with ``maybe_known``: false where the filter shows the key to be new.

    ``bitmaps`` has one row per block of a date, and all blocks of a date have the
    same ``blocks``. It is broadcast: callers keep it below ``BROADCAST_BYTES``.
    """
    sizes = F.broadcast(bitmaps.groupBy(F.col("file_date").alias("_date")).agg(F.max("blocks").alias("_blocks")))
    sized = rows.join(sizes, F.col("file_date") == F.col("_date"), "left").drop("_date")
    sized = sized.withColumn("_block", _block(F.col("_blocks")))
    held = bitmaps.select(F.col("file_date").alias("_day"), F.col("block").alias("_held"), "bitmap")
    met = sized.join(F.broadcast(held), (F.col("file_date") == F.col("_day")) & (F.col("_block") == F.col("_held")), "left")
    every = F.col("bitmap").isNotNull()
    for bit in _bits():
        every = every & _is_set(F.col("bitmap"), bit)
    return met.withColumn("maybe_known", every).select(*rows.columns, "maybe_known")


def fits(blocks: int) -> bool:
    return blocks * (BLOCK_BYTES + 64) <= BROADCAST_BYTES


def prefiltered_anti_join(prepared: DataFrame, config: DedupConfig) -> DataFrame:
    """Today's records whose key is not published, as ``baseline_anti_join`` gives them.

    A filter of the published keys is made first. Records it shows to be new go
    straight out; only the others meet the published keys in the join.
    """
    prior = records(prepared).filter(F.col("role_rank") == 0).select(*GROUP).distinct()
    # One row per date.
    found = prior.groupBy("file_date").agg(F.count("*").alias("n")).collect()
    sizes = {row.file_date: blocks_for(row.n) for row in found}
    if not sizes or not fits(sum(sizes.values())):
        return baseline_anti_join(prepared, config)
    known = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    bitmaps = build(prior, known[F.col("file_date")])
    today = records(prepared).filter(F.col("role_rank") == 1)
    tested = with_presence(today, bitmaps)
    new = tested.filter(~F.col("maybe_known")).drop("maybe_known")
    doubtful = tested.filter("maybe_known").drop("maybe_known")
    published = records(prepared).filter(F.col("role_rank") == 0)
    return new.unionByName(baseline_anti_join(published.unionByName(doubtful), config))
