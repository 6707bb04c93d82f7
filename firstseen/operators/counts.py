"""Counts per file, table and job.

Everything derives from ``file_counts``: one row per file, whatever the number of
records. It reads and parses every line once and joins nothing: lines are counted
per key and file, and a key's first file is the one its survivor is in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstseen.columns import GROUP, POSITION
from firstseen.functions.names import merged_file_name
from firstseen.operators.first_seen import DUPLICATE, PUBLISHED, SURVIVOR
from firstseen.operators.prepare import BLANK, RECORD, REJECT

FILE = ["table_name", "file_date", "sequence", "file_path"]


def file_counts(prepared: DataFrame) -> DataFrame:
    """Read, written, filtered, skipped and blank lines of every file.

    For a published file nothing is filtered: all its records count as written.
    """
    # One row per key and file; lines without key are one per file and kind.
    keyed = F.col("line_kind") == RECORD
    per_key = prepared.groupBy("role", "role_rank", *FILE, "line_kind", *GROUP[:2]).agg(
        F.count("*").alias("lines"), F.min("line_no").alias("line_no")
    )
    # A key's rows are as many as its files. Lines without key spread by file.
    together = Window.partitionBy(*GROUP, F.when(~keyed, F.col("file_path"))).orderBy(*POSITION)
    first = keyed & (F.col("role_rank") == 1) & (F.row_number().over(together) == 1)
    lines = lambda kind: F.coalesce(F.sum(F.when(F.col("line_kind") == kind, F.col("lines"))), F.lit(0))
    today = F.col("role") == "TODAY"
    return (
        per_key.withColumn("first", first)
        .groupBy("role", *FILE)
        .agg(
            lines(RECORD).alias("read_count"),
            lines(REJECT).alias("skipped_count"),
            lines(BLANK).alias("blank_count"),
            F.count_if("first").alias("kept"),
        )
        .withColumn("written_count", F.when(today, F.col("kept")).otherwise(F.col("read_count")))
        .withColumn("filtered_count", F.col("read_count") - F.col("written_count"))
        .drop("kept")
    )


def file_counts_of(classified: DataFrame) -> DataFrame:
    """``file_counts`` when every line already has its status: one aggregation."""
    status = F.col("status")
    return (
        classified.groupBy("role", "table_name", "file_date", "sequence", "file_path")
        .agg(
            F.count_if(status.isin(SURVIVOR, DUPLICATE, PUBLISHED)).alias("read_count"),
            F.count_if(status == REJECT).alias("skipped_count"),
            F.count_if(status == BLANK).alias("blank_count"),
            F.count_if(status.isin(SURVIVOR, PUBLISHED)).alias("written_count"),
        )
        .withColumn("filtered_count", F.col("read_count") - F.col("written_count"))
    )


def skipped_counts(prepared: DataFrame) -> DataFrame:
    """Malformed lines of every file, from lines that have no status yet."""
    malformed = F.count_if(F.col("line_kind") == REJECT)
    return prepared.groupBy("role", *FILE).agg(malformed.alias("skipped_count"))


def file_summary(counts: DataFrame) -> DataFrame:
    """Today's files: read (malformed lines excluded), written, filtered, skipped."""
    return counts.filter(F.col("role") == "TODAY").select(
        "table_name",
        "file_date",
        "sequence",
        "file_path",
        "read_count",
        "written_count",
        "filtered_count",
        "skipped_count",
    )


def table_summary(counts: DataFrame) -> DataFrame:
    """Today's files summed per table and date.

    Files whose table names differ only in case form one table, which takes the
    name of the file with the lowest sequence.
    """
    today = counts.filter(F.col("role") == "TODAY")
    return (
        today.groupBy(F.lower("table_name").alias("scope_table"), "file_date")
        .agg(
            F.min(F.struct("sequence", "file_path", "table_name")).alias("lead"),
            F.sum("read_count").alias("total_processed"),
            F.sum("filtered_count").alias("total_duplicates"),
            F.sum("skipped_count").alias("total_rejected"),
        )
        .select(
            F.col("lead.table_name").alias("table_name"),
            "file_date",
            "total_processed",
            "total_duplicates",
            "total_rejected",
        )
    )


def with_output(summary: DataFrame, published: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Add the published count, 0 if nothing is published, and the output name.

    ``files`` gives the name where it is not that of one merged file.
    """
    named = summary.withColumn("scope_table", F.lower("table_name"))
    joined = named.join(published, ["scope_table", "file_date"], "left")
    name = merged_file_name(F.col("table_name"), F.col("file_date"))
    if files is not None:
        joined = joined.join(files, ["scope_table", "file_date"], "left")
        name = F.coalesce(F.col("output_file"), name)
    return (
        joined.withColumn("output_count", F.coalesce("output_count", F.lit(0)))
        .withColumn("output_file", name)
        .drop("scope_table")
    )


def published_counts(published: DataFrame) -> DataFrame:
    """Published lines per table and date."""
    return published.groupBy(F.lower("table_name").alias("scope_table"), "file_date").agg(
        F.count("*").alias("output_count")
    )


def published_from_counts(counts: DataFrame, mode: str) -> DataFrame:
    """What a run leaves published per table and date, without reading it back.

    ``merge``: the old lines and the survivors. ``replace``: the survivors, or
    the old lines where nothing survived.
    """
    today = F.col("role") == "TODAY"
    sums = counts.groupBy(F.lower("table_name").alias("scope_table"), "file_date").agg(
        F.coalesce(F.sum(F.when(today, F.col("written_count"))), F.lit(0)).alias("new"),
        F.coalesce(
            F.sum(F.when(~today, F.col("read_count") + F.col("skipped_count") + F.col("blank_count"))),
            F.lit(0),
        ).alias("old"),
    )
    if mode == "merge":
        total = F.col("old") + F.col("new")
    else:
        total = F.when(F.col("new") > 0, F.col("new")).otherwise(F.col("old"))
    return sums.select("scope_table", "file_date", total.alias("output_count"))


def job_totals(summary: DataFrame) -> DataFrame:
    """One row of sums over all tables."""
    return summary.agg(
        F.count("*").alias("table_count"),
        F.coalesce(F.sum("total_processed"), F.lit(0)).alias("total_processed"),
        F.coalesce(F.sum("total_duplicates"), F.lit(0)).alias("total_duplicates"),
        F.coalesce(F.sum("total_rejected"), F.lit(0)).alias("total_rejected"),
        F.coalesce(F.sum("output_count"), F.lit(0)).alias("output_count"),
    )


def input_volume(lines: DataFrame) -> DataFrame:
    """Physical lines per date and table, per date (table NULL) and in total."""
    return (
        lines.rollup("file_date", "table_name")
        .agg(F.count("*").alias("line_count"))
        .select("file_date", "table_name", "line_count")
    )


def reject_threshold(counts: DataFrame, limit: int) -> DataFrame:
    """Published files with more malformed lines than a run tolerates."""
    return counts.filter((F.col("role") == "PRIOR") & (F.col("skipped_count") > limit)).select(
        "table_name", "file_date", "file_path", "skipped_count"
    )
