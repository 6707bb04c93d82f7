"""Which files belong to a run, and their lines as envelope rows.

Raw feed:   any folder depth below the input root, ``<table>-<date>-<n>.json``
Published:  ``<output root>/<table>/<date>/...``, any ``*.json``
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.columns import ENVELOPE, PRIOR, TODAY
from firstseen.config import normalise_tables
from firstseen.functions.names import (
    FILE_NAME_PATTERN,
    date_of,
    is_input_name,
    sequence_of,
    table_of,
)
from firstseen.sources.ndjson import read_lines, scan_numbered, selected_files
from firstseen.storage import Storage

DAY_GLOB = "[0-9]*-[0-9]*-[0-9]*"

UNNUMBERED = [c for c in ENVELOPE if c != "line_no"] + ["split_start", "row_id"]


def allowed_tables(lines: DataFrame) -> DataFrame:
    """The allow-list from its text lines (line_no, value): position, table_name.

    Trimmed, lower-cased, without blank and ``#`` lines; a repeated name keeps
    its first position.
    """
    name = F.lower(F.regexp_replace("value", r"^[\x00-\x20]+|[\x00-\x20]+$", ""))
    return (
        lines.select("line_no", name.alias("table_name"))
        .filter((F.col("table_name") != "") & ~F.col("table_name").startswith("#"))
        .groupBy("table_name")
        .agg(F.min("line_no").alias("position"))
    )


def resolve_tables(spark: SparkSession, tables: Sequence[str], tables_file: str | None) -> list[str]:
    """The allow-list of a run; a file overrides the list. Empty is an error."""
    if tables_file is None:
        return normalise_tables(tables)
    # A list of table names: as many rows as the feed has tables.
    rows = allowed_tables(scan_numbered(spark, tables_file, "*").withColumnRenamed("raw_line", "value"))
    names = [row.table_name for row in rows.orderBy("position").collect()]
    return normalise_tables(names)


def only_allowed(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows whose table is on the list, whatever its case."""
    listed = allowed.select(F.col("table_name").alias("_allowed"))
    return rows.join(listed, F.lower("table_name") == F.col("_allowed"), "left_semi")


def _selected(table: Column, date: Column, tables: Sequence[str], dates: Sequence[dt.date]) -> Column:
    keep = F.lower(table).isin(*tables)
    return keep & date.isin(*dates) if dates else keep


def _name_glob(dates: Sequence[dt.date]) -> str:
    """Lets the file listing skip other dates before any file is opened."""
    if not dates:
        return "*.json"
    return "*-{" + ",".join(d.isoformat() for d in dates) + "}-*.json"


def _hidden(storage: Storage, tops: Sequence[str]) -> Iterator[str]:
    """Files ending in ``.json`` below the given patterns that Spark's readers skip.

    They ignore every file and folder whose name starts with ``_`` or ``.``. Each
    level of folders is one call on names alone, down to the last level there is.
    """
    for top in tops:
        level = top.rstrip("/")
        while True:
            yield from storage.glob(f"{level}/[._]*.json")
            below = f"{level}/[._]*"
            while storage.any(f"{below}/*"):
                yield from storage.glob(f"{below}/*.json")
                below += "/*"
            level += "/*"
            if not storage.any(level):
                break


def refuse_hidden(spark: SparkSession, input_dir: str, tables: Sequence[str], dates: Sequence[dt.date]) -> None:
    """Fail if Spark would silently skip a raw file of this run."""
    wanted = re.compile(FILE_NAME_PATTERN)
    chosen = {d.isoformat() for d in dates}
    for path in _hidden(Storage(spark, input_dir), [input_dir]):
        match = wanted.match(path.rsplit("/", 1)[-1])
        if match and match[1].lower() in tables and (not chosen or match[2] in chosen):
            raise ValueError(f"Spark does not read below names that start with _ or a dot: {path}")


def refuse_hidden_published(
    spark: SparkSession, output_dir: str, tables: Sequence[str], dates: Sequence[dt.date]
) -> None:
    """Fail if Spark would silently skip a published file that a run must know."""
    storage, root = Storage(spark, output_dir), output_dir.rstrip("/")
    day = "{" + ",".join(d.isoformat() for d in dates) + "}" if dates else DAY_GLOB
    for path in _hidden(storage, [f"{root}/*/{day}"] if storage.any(f"{root}/*/{day}") else []):
        if path.split(storage.qualified_path(output_dir).rstrip("/") + "/", 1)[-1].split("/")[0].lower() in tables:
            raise ValueError(f"Spark does not read below names that start with _ or a dot: {path}")
    for path in storage.glob(f"{root}/[._]*/{day}"):
        if path.split("/")[-2].lower() in tables:
            raise ValueError(f"Spark does not read below names that start with _ or a dot: {path}")


def _today(lines: DataFrame) -> DataFrame:
    """Add the columns a file's name gives; names were checked when files were kept."""
    name = F.col("file_name")
    return (
        lines.withColumn("role", F.lit(TODAY))
        .withColumn("role_rank", F.lit(1))
        .withColumn("table_name", table_of(name))
        .withColumn("file_date", date_of(name))
        .withColumn("sequence", sequence_of(name))
    )


def _keep_today(tables: Sequence[str], dates: Sequence[dt.date]) -> Column:
    name = F.col("_metadata.file_name")
    return _selected(table_of(name), date_of(name), tables, dates) & is_input_name(name)


def _check_input(spark: SparkSession, input_dir: str) -> None:
    if not Storage(spark, input_dir).is_directory(input_dir):
        raise FileNotFoundError(f"input directory does not exist: {input_dir}")


def today_lines(
    spark: SparkSession,
    input_dir: str,
    tables: Sequence[str],
    dates: Sequence[dt.date] = (),
    numbered: bool = True,
) -> DataFrame:
    """Lines of the raw files of the given dates, all dates if none are given.

    The date in the file name counts, not the folder.
    """
    _check_input(spark, input_dir)
    refuse_hidden(spark, input_dir, tables, dates)
    read = scan_numbered if numbered else read_lines
    lines = read(spark, input_dir, _name_glob(dates), _keep_today(tables, dates))
    return _today(lines).select(*(ENVELOPE if numbered else UNNUMBERED))


def _layout(root: str, path: Column) -> tuple[Column, Column]:
    """(table, date) of a published file; date NULL if the layout is another.

    Taken for every line, so by position and not by regular expression.
    """
    below = F.substring(path, F.locate(root + "/", path) + len(root) + 1, F.length(path))
    two = F.substring_index(below, "/", 2)
    day = F.substring_index(two, "/", -1)
    nested = (two != below) & (F.length(day) == 10)
    return F.substring_index(below, "/", 1), F.when(nested, day.try_cast("date"))


def _published_paths(spark: SparkSession, output_dir: str, dates: Sequence[dt.date]) -> list[str]:
    """Folders to read: ``<root>/<table>/<date>`` of the wanted dates that exist."""
    storage = Storage(spark, output_dir)
    root = output_dir.rstrip("/")
    if not storage.exists(output_dir):
        return []
    if not storage.is_directory(output_dir):
        raise NotADirectoryError(f"not a directory: {output_dir}")
    day = "{" + ",".join(d.isoformat() for d in dates) + "}" if dates else DAY_GLOB
    pattern = f"{root}/*/{day}"
    return [pattern] if storage.glob(pattern) else []


def _empty(spark: SparkSession, numbered: bool) -> DataFrame:
    place = "line_no BIGINT, raw_line STRING" if numbered else "raw_line STRING, split_start BIGINT, row_id BIGINT"
    return spark.createDataFrame(
        [],
        "role STRING, role_rank INT, table_name STRING, file_date DATE, sequence INT, "
        f"file_path STRING, file_name STRING, {place}",
    )


def baseline_lines(
    spark: SparkSession,
    output_dir: str,
    tables: Sequence[str],
    dates: Sequence[dt.date] = (),
    numbered: bool = True,
) -> DataFrame:
    """Lines already published for the given dates; empty if nothing is there."""
    paths = _published_paths(spark, output_dir, dates)
    if not paths:
        return _empty(spark, numbered)
    refuse_hidden_published(spark, output_dir, tables, dates)
    root = Storage(spark, output_dir).qualified_path(output_dir)
    table, date = _layout(root, F.col("_metadata.file_path"))
    keep = date.isNotNull() & _selected(table, date, tables, dates)
    if numbered:
        lines = scan_numbered(spark, paths, "*.json", keep)
    else:
        lines = read_lines(spark, paths, "*.json", keep)
    return _prior(lines, root, numbered)


def _prior(lines: DataFrame, root: str, numbered: bool) -> DataFrame:
    """Add the columns a published file's place gives."""
    table, date = _layout(root, F.col("file_path"))
    return (
        lines.withColumn("role", F.lit(PRIOR))
        .withColumn("role_rank", F.lit(0))
        .withColumn("table_name", table)
        .withColumn("file_date", date)
        .withColumn("sequence", F.lit(1))
        .select(*(ENVELOPE if numbered else UNNUMBERED))
    )


def lines_of_published(spark: SparkSession, output_dir: str, paths: Sequence[str]) -> DataFrame:
    """Numbered lines of some published files, by the paths that listings give."""
    lines = scan_numbered(spark, [unquote(path) for path in paths], "*.json")
    return _prior(lines, Storage(spark, output_dir).qualified_path(output_dir), numbered=True)


def _files(spark: SparkSession, paths: Sequence[str], name_glob: str, keep: Column) -> DataFrame:
    """File names and sizes from the listing; no content is read."""
    return selected_files(spark, paths, name_glob, keep).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("length").alias("file_bytes"),
        F.col("modificationTime").alias("modified"),
    )


FILE_COLUMNS = ["role", "table_name", "file_date", "sequence", "file_path", "file_name", "file_bytes"]


def has_today_files(
    spark: SparkSession, input_dir: str, tables: Sequence[str], dates: Sequence[dt.date] = ()
) -> bool:
    """Whether a run has any raw file; stops at the first."""
    _check_input(spark, input_dir)
    return not _files(spark, [input_dir], _name_glob(dates), _keep_today(tables, dates)).isEmpty()


def today_files(
    spark: SparkSession, input_dir: str, tables: Sequence[str], dates: Sequence[dt.date] = ()
) -> DataFrame:
    """The raw files of a run, by table (any case), date, sequence."""
    _check_input(spark, input_dir)
    refuse_hidden(spark, input_dir, tables, dates)
    files = _files(spark, [input_dir], _name_glob(dates), _keep_today(tables, dates))
    return (
        _today(files)
        .select(*FILE_COLUMNS)
        .orderBy(F.lower("table_name"), "file_date", "sequence", "file_path")
    )


def published_files(
    spark: SparkSession, output_dir: str, tables: Sequence[str], dates: Sequence[dt.date] = ()
) -> DataFrame:
    """The published files of a run with size and time, in no order."""
    columns = [*FILE_COLUMNS, "modified"]
    paths = _published_paths(spark, output_dir, dates)
    if not paths:
        return spark.createDataFrame(
            [],
            "role STRING, table_name STRING, file_date DATE, sequence INT, file_path STRING, "
            "file_name STRING, file_bytes BIGINT, modified TIMESTAMP",
        )
    root = Storage(spark, output_dir).qualified_path(output_dir)
    table, date = _layout(root, F.col("_metadata.file_path"))
    keep = date.isNotNull() & _selected(table, date, tables, dates)
    files = _files(spark, paths, "*.json", keep)
    table, date = _layout(root, F.col("file_path"))
    return (
        files.withColumn("role", F.lit(PRIOR))
        .withColumn("table_name", table)
        .withColumn("file_date", date)
        .withColumn("sequence", F.lit(1))
        .select(*columns)
    )


def baseline_files(
    spark: SparkSession, output_dir: str, tables: Sequence[str], dates: Sequence[dt.date] = ()
) -> DataFrame:
    """The published files of a run, by table (any case) and path."""
    files = published_files(spark, output_dir, tables, dates).select(*FILE_COLUMNS)
    return files.orderBy(F.lower("table_name"), "file_path")
