"""Output ranges of even size: cut by bytes of text, in order.

Ranges cut from sampled rows are even in rows. Where a few lines are long, or
lie together, one of those ranges holds most of the text and one task writes it.
Here a line belongs to the range that its first byte falls in, counted over all
lines in order, so no range is longer than the others by more than a line.

The running count has two levels: over the splits of an output, one row each,
and over the lines of a split, without their text. What leaves the second level
is one bound per range and split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firstseen.sources.ndjson import byte_count

PART = "part"

# What a table and date are called in the order of output lines: its first columns.
SCOPE = 2


def part_count(spark: SparkSession, size: int) -> int:
    """As many parts as adaptive execution would leave of ``spark.sql.shuffle.partitions``."""
    conf = spark.conf
    most = int(conf.get("spark.sql.shuffle.partitions"))
    adaptive = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    if any(conf.get(name) == "false" for name in adaptive):
        return most
    wanted = byte_count(spark, conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    if conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst") == "true":
        least = byte_count(spark, conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize"))
        wanted = min(wanted, max(least, size // spark.sparkContext.defaultParallelism))
    return max(1, min(most, -(-size // wanted)))


def line_sizes(lines: DataFrame, order: Sequence[str]) -> DataFrame:
    """The place of each line and its bytes as written, with the line end."""
    return lines.select(*order, (F.octet_length("raw_line") + F.lit(1)).cast("bigint").alias("bytes"))


def part_bounds(sizes: DataFrame, order: Sequence[str], step: int) -> DataFrame:
    """For each split the first row of every part in it: ``bounds``, by row.

    ``order`` is table and date, then what names a split, then the row in it.
    One window runs over the tables and dates, which the allow-list bounds, one
    over the splits of each, one over the rows of a split.
    """
    *split, row = order
    scope, within = split[:SCOPE], split[SCOPE:]
    ahead = lambda column, window: F.coalesce(
        F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    per_split = sizes.groupBy(*split).agg(F.sum("bytes").alias("split_bytes"))
    per_scope = per_split.groupBy(*scope).agg(F.sum("split_bytes").alias("scope_bytes"))
    per_scope = per_scope.select(*scope, ahead("scope_bytes", Window.orderBy(*scope)).alias("scope_start"))
    starts = per_split.withColumn("split_start_in_scope", ahead("split_bytes", Window.partitionBy(*scope).orderBy(*within)))
    starts = starts.join(F.broadcast(per_scope), scope).select(
        *split, (F.col("scope_start") + F.col("split_start_in_scope")).alias("before")
    )
    running = ahead("bytes", Window.partitionBy(*split).orderBy(row))
    # Whole-number division: sums of bytes may be beyond what a double holds.
    part = F.expr(f"CAST((before + in_split) DIV {step} AS INT)")
    placed = sizes.withColumn("in_split", running).join(starts, split).withColumn(PART, part)
    firsts = placed.groupBy(*split, PART).agg(F.min(row).alias("first_row"))
    return firsts.groupBy(*split).agg(F.sort_array(F.collect_list(F.struct("first_row", PART))).alias("bounds"))


def with_part(lines: DataFrame, bounds: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``part``: that of the last bound at or before the row.

    A split has few bounds, its bytes over those of a part. They meet the lines by
    broadcast while they are small; beyond that the lines are shuffled by split.
    """
    *split, row = order
    passed = F.filter("bounds", lambda bound: bound["first_row"] <= F.col(row))
    return lines.join(bounds, list(split)).withColumn(PART, F.element_at(passed, -1)[PART]).drop("bounds")


def in_even_parts(lines: DataFrame, order: Sequence[str], scratch: str, parts: int | None = None) -> DataFrame:
    """``lines`` with ``part``, in that many partitions of even size, each in order.

    ``lines`` are read twice, so they have to be staged. Sizes and bounds are
    written below ``scratch``, which the caller removes when the result is
    written. No lines: one empty partition. A line longer than a part has one to
    itself, and the parts it covers stay empty.
    """
    spark = lines.sparkSession
    line_sizes(lines, order).write.parquet(f"{scratch}/sizes")
    sizes = spark.read.schema(line_sizes(lines, order).schema).parquet(f"{scratch}/sizes")
    size = sizes.agg(F.sum("bytes")).first()[0] or 0
    count = part_count(spark, size) if parts is None else parts
    if count == 1:
        whole = lines.withColumn(PART, F.lit(0))
    else:
        bounds = part_bounds(sizes, order, max(1, -(-size // count)))
        bounds.write.parquet(f"{scratch}/bounds")
        whole = with_part(lines, spark.read.schema(bounds.schema).parquet(f"{scratch}/bounds"), order)
    return whole.repartitionById(count, F.col(PART)).sortWithinPartitions(*order)
