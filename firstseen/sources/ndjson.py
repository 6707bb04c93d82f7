"""Text lines with their place: file, split, row, and physical line number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A broadcast of split offsets may take this much; beyond it the lines are joined
# by a shuffle on (file, split), which no split can skew. A row holds a path, and
# the longest path a file system takes is counted.
OFFSET_BROADCAST_BYTES = 256 << 20
OFFSET_ROW_BYTES = 4096 + 256


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    name_glob: str = "*.json",
    keep_file: Column | None = None,
) -> DataFrame:
    """One row per physical line: raw_line, file_path, file_name, split_start, row_id.

    Files may be split. ``row_id`` grows along the lines of a split without gaps,
    because it is taken on the scan itself; filter lines only afterwards.
    ``keep_file`` may use ``_metadata`` columns and drops whole files.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    scan = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .text(paths)
    )
    if keep_file is not None:
        scan = scan.filter(keep_file)
    return scan.select(
        F.col("value").alias("raw_line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def split_offsets(lines: DataFrame) -> DataFrame:
    """Per split: its first and last row id and the lines of its file before it.

    One row per split of the input. The running sum is over the splits of a file.
    """
    per_split = lines.groupBy("file_path", "split_start").agg(
        F.count("*").alias("split_lines"),
        F.min("row_id").alias("first_row"),
        F.max("row_id").alias("last_row"),
    )
    before = (
        Window.partitionBy("file_path")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return per_split.withColumn(
        "lines_before", F.coalesce(F.sum("split_lines").over(before), F.lit(0))
    ).drop("split_lines")


def number_lines(lines: DataFrame, offsets: DataFrame) -> DataFrame:
    """Replace split_start and row_id by ``line_no``, counted from 1 per file.

    If offsets and lines came from reads that cut the files differently, some row
    falls outside its split's range and the job fails rather than misnumber.
    """
    in_range = F.col("row_id").between(F.col("first_row"), F.col("last_row"))
    line_no = F.when(
        in_range, F.col("lines_before") + F.col("row_id") - F.col("first_row") + 1
    ).otherwise(F.raise_error(F.lit("the input was split differently by two reads")).cast("bigint"))
    return (
        lines.join(offsets, ["file_path", "split_start"], "left")
        .withColumn("line_no", line_no)
        .drop("split_start", "row_id", "first_row", "last_row", "lines_before")
    )


def byte_count(spark: SparkSession, text: str) -> int:
    """A Spark size setting in bytes, e.g. ``128MB`` or ``134217728b``."""
    utils = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    return int(utils.byteStringAsBytes(text))


def selected_files(
    spark: SparkSession, paths: Sequence[str], name_glob: str, keep_file: Column | None = None
) -> DataFrame:
    """The files a scan would read, with ``length`` and ``_metadata``; no content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load(list(paths))
    )
    return files if keep_file is None else files.filter(keep_file)


def split_bound(
    spark: SparkSession, paths: Sequence[str], name_glob: str = "*.json", keep_file: Column | None = None
) -> int:
    """No more splits than this of the files to be read: each adds at most one short one."""
    row = selected_files(spark, paths, name_glob, keep_file).agg(F.count("*").alias("n"), F.sum("length").alias("size")).first()
    largest = byte_count(spark, spark.conf.get("spark.sql.files.maxPartitionBytes", "128MB"))
    opening = byte_count(spark, spark.conf.get("spark.sql.files.openCostInBytes", "4MB"))
    return row.n + (row.size or 0) // max(1, min(largest, opening))


def scan_numbered(
    spark: SparkSession,
    paths: str | Sequence[str],
    name_glob: str = "*.json",
    keep_file: Column | None = None,
) -> DataFrame:
    """``read_lines`` with ``line_no``, at the price of a second, counting read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = read_lines(spark, paths, name_glob, keep_file)
    offsets = split_offsets(lines)
    if split_bound(spark, paths, name_glob, keep_file) * OFFSET_ROW_BYTES <= OFFSET_BROADCAST_BYTES:
        offsets = F.broadcast(offsets)
    return number_lines(lines, offsets)
