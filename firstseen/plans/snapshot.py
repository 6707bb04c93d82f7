"""Published lines as they were before a run or are after it, never in between.

Files move in one by one, so a reader of the folders may meet half a run. The
intent of a run is written whole before the first move, and that is the moment a
snapshot changes: with an open intent it holds the files the run will leave,
each wherever it lies just then, also where the run died.

A file that moves, goes or is replaced while it is read cannot be locked. So
``read_whole`` looks at listing and intents again when the reader is done, and
reads anew where they are no longer the same.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any
from urllib.parse import unquote

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.plans.publish import WORK
from firstseen.sources.feeds import published_files
from firstseen.storage import Storage

ATTEMPTS = 10

SCHEMA = "_path STRING, table_name STRING, file_date DATE, file_name STRING"


class Unsettled(RuntimeError):
    """What is published changed in every attempt to read it."""


@dataclass(frozen=True)
class Listed:
    """A published file as a listing gives it."""

    table_name: str
    file_date: date
    file_name: str
    file_path: str
    file_bytes: int
    modified: datetime

    @property
    def name(self) -> tuple[str, str, str]:
        return self.table_name, self.file_date.isoformat(), self.file_name


@dataclass(frozen=True)
class State:
    """Open intents by name, and the files that are in place, sorted."""

    intents: tuple[tuple[str, str], ...]
    files: tuple[Listed, ...]


def _intents(storage: Storage, output_dir: str) -> tuple[tuple[str, str], ...] | None:
    """Names and texts; None where one went while it was read."""
    work = f"{output_dir.rstrip('/')}/{WORK}"
    names = [name for name in storage.names(work) if name.endswith(".json")]
    try:
        return tuple((name, storage.read_text(f"{work}/{name}")) for name in names)
    except Py4JError as error:
        if "FileNotFoundException" in str(error):
            return None
        raise


def _look(spark: SparkSession, output_dir: str, tables: Sequence[str], dates: Sequence[date]) -> State | None:
    """Intents, then files. The driver holds the names of the files."""
    intents = _intents(Storage(spark, output_dir), output_dir)
    if intents is None:
        return None
    columns = list(Listed.__dataclass_fields__)
    rows = published_files(spark, output_dir, tables, dates).select(*columns).collect()
    return State(intents, tuple(sorted((Listed(*row) for row in rows), key=lambda listed: listed.file_path)))


def settled(spark: SparkSession, output_dir: str, tables: Sequence[str], dates: Sequence[date] = ()) -> State:
    """A state that two looks in a row agree on.

    New parts and intents have names of their own, so what a publisher did
    between the two looks shows in one of them.
    """
    before = _look(spark, output_dir, tables, dates)
    for _ in range(ATTEMPTS):
        after = _look(spark, output_dir, tables, dates)
        if after is not None and after == before:
            return after
        before = after
    raise Unsettled(f"{output_dir} changed in each of {ATTEMPTS} looks")


def _name(path: str) -> tuple[str, ...]:
    """Table, date and file name of an output path, however its root is spelled."""
    return tuple(path.split("/")[-3:])


def _places(
    spark: SparkSession, output_dir: str, state: State, tables: Sequence[str], dates: Sequence[date]
) -> list[tuple[str, str, date, str]]:
    """Where the files lie that the open intents leave: path as Spark gives it, table, date, name."""
    storage, chosen = Storage(spark, output_dir), {day.isoformat() for day in dates}
    held = {listed.name: listed.file_path for listed in state.files}
    for _, text in state.intents:
        intent = json.loads(text)
        for source, target in intent["moves"]:
            table, day, _ = name = _name(target)
            # A stream's number is moved in as well, and is no output.
            wanted = target.endswith(".json") and table.lower() in tables and (not chosen or day in chosen)
            if wanted and storage.exists(source):
                held[name] = storage.uri(source)
        for path in intent["removals"]:
            held.pop(_name(path), None)
    return [(path, table, date.fromisoformat(day), name) for (table, day, name), path in sorted(held.items())]


def snapshot_lines(
    spark: SparkSession, output_dir: str, state: State, tables: Sequence[str], dates: Sequence[date] = ()
) -> DataFrame:
    """table_name, file_date, file_name, raw_line of a state; in no order.

    The file names sort in merge order. ``file_name`` is the name a file has once
    it is in place. The list of files is broadcast: the driver holds it already.
    """
    places = _places(spark, output_dir, state, tables, dates)
    if not places:
        return spark.createDataFrame([], "table_name STRING, file_date DATE, file_name STRING, raw_line STRING")
    lines = spark.read.option("recursiveFileLookup", "true").text([unquote(path) for path, *_ in places])
    lines = lines.select(F.col("_metadata.file_path").alias("_path"), F.col("value").alias("raw_line"))
    return lines.join(F.broadcast(spark.createDataFrame(places, SCHEMA)), "_path").drop("_path").select(
        "table_name", "file_date", "file_name", "raw_line"
    )


def read_whole(
    spark: SparkSession,
    output_dir: str,
    tables: Sequence[str],
    action: Callable[[DataFrame], Any],
    dates: Sequence[date] = (),
) -> Any:
    """The result of ``action`` on the lines of one snapshot.

    ``action`` has to do its work before it returns (count, collect, an
    overwriting write) and may be called again. Tables are named in lower case.
    """
    for _ in range(ATTEMPTS):
        state = settled(spark, output_dir, tables, dates)
        try:
            result = action(snapshot_lines(spark, output_dir, state, tables, dates))
        except (PySparkException, Py4JError):
            # A file that went while it was read; any other failure comes again.
            if _look(spark, output_dir, tables, dates) == state:
                raise
            continue
        if _look(spark, output_dir, tables, dates) == state:
            return result
    raise Unsettled(f"{output_dir} changed during each of {ATTEMPTS} reads")
