"""File names in and out, run ids, durations, throughput."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The input file name, and what a run id may contain.
FILE_NAME_PATTERN = r"^([A-Za-z0-9_]+)-(\d{4}-\d{2}-\d{2})-(\d+)\.json$"
RUN_ID_UNSAFE = r"[^A-Za-z0-9._-]"
DEFAULT_RUN_ID = "default"


def is_input_name(name: Column) -> Column:
    """The name fits, its date is in the calendar, its sequence is an INT >= 1."""
    fits = name.rlike(FILE_NAME_PATTERN)
    return fits & date_of(name).isNotNull() & F.coalesce(sequence_of(name) >= 1, F.lit(False))


# Parts of a name that fits. A table has no dash in it, so these need no regular
# expression: they are taken for every line of a file.


def table_of(name: Column) -> Column:
    return F.substring_index(name, "-", 1)


def date_of(name: Column) -> Column:
    return F.substring_index(F.substring_index(name, "-", 4), "-", -3).try_cast("date")


def sequence_of(name: Column) -> Column:
    return F.substring_index(F.substring_index(name, "-", -1), ".", 1).try_cast("int")


def parse_file_name(name: Column) -> Column:
    """STRUCT<table_name, file_date, sequence>, or NULL if it is not an input name."""
    parts = F.struct(
        table_of(name).alias("table_name"),
        date_of(name).alias("file_date"),
        sequence_of(name).alias("sequence"),
    )
    return F.when(is_input_name(name), parts)


def merged_file_name(table: Column, date: Column) -> Column:
    return F.concat(F.lit("MERGED="), table, F.lit("-"), F.date_format(date, "yyyy-MM-dd"), F.lit(".json"))


def partition_name(role: Column, table: Column, sequence: Column) -> Column:
    return F.concat_ws("-", F.lower(role), table, sequence.cast("string"))


def part_file_name(sequence: Column, file_name: Column) -> Column:
    return F.format_string("%02d-%s.part", sequence, file_name)


def clean_run_id(run_id: Column) -> Column:
    """Safe for a file name; blank or missing becomes the default."""
    blank = run_id.isNull() | run_id.rlike(r"^\p{javaWhitespace}*\z")
    return F.when(blank, DEFAULT_RUN_ID).otherwise(F.regexp_replace(run_id, RUN_ID_UNSAFE, "_"))


def duration_text(millis: Column) -> Column:
    """``1h 2m 3.004s``; leading zero units are left out."""
    hours = F.floor(millis / 3_600_000)
    minutes = F.floor(F.pmod(millis, F.lit(3_600_000)) / 60_000)
    seconds = F.floor(F.pmod(millis, F.lit(60_000)) / 1000)
    rest = F.pmod(millis, F.lit(1000))
    return (
        F.when(hours > 0, F.format_string("%dh %dm %d.%03ds", hours, minutes, seconds, rest))
        .when(minutes > 0, F.format_string("%dm %d.%03ds", minutes, seconds, rest))
        .otherwise(F.format_string("%d.%03ds", seconds, rest))
    )


def throughput(read_count: Column, elapsed_seconds: Column) -> Column:
    """Records per second; a run shorter than a second counts as one."""
    return read_count / F.greatest(F.lit(1), elapsed_seconds)
