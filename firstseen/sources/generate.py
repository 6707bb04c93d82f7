"""Test feeds of any size with a known number of duplicates, made by Spark."""

from __future__ import annotations

import filecmp
import os
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.storage import Storage, shared_folder

# Records per file, and how often a record repeats another.
RECORDS_PER_FILE = 20_000
DUPLICATE_EVERY = 20


def generate_records(
    specs: DataFrame,
    records_per_file: int = RECORDS_PER_FILE,
    duplicate_every: int = DUPLICATE_EVERY,
    across_files: bool = False,
) -> DataFrame:
    """Records 1..total of every (table_name, file_date, total) row of ``specs``.

    Every ``duplicate_every``-th record repeats the one before it, or with
    ``across_files`` the record at its place in the first file. Specs fan out to
    files first and files to records after a shuffle, so one huge spec is made by
    many tasks.
    """
    files = specs.filter(F.col("total") > 0).select(
        "table_name",
        "file_date",
        F.col("total").cast("bigint").alias("total"),
        F.explode(
            F.sequence(F.lit(1), F.ceil(F.col("total") / records_per_file).cast("int"))
        ).alias("sequence"),
    )
    start = (F.col("sequence").cast("bigint") - 1) * records_per_file
    records = files.repartition("table_name", "file_date", "sequence").select(
        "table_name",
        "file_date",
        "sequence",
        F.posexplode(
            F.sequence(start + 1, F.least(start + records_per_file, F.col("total")))
        ).alias("at", "i"),
    )
    place_in_file = (F.col("i") - 1) % records_per_file + 1
    earlier = place_in_file if across_files else F.col("i") - 1
    src = F.when(F.col("i") % duplicate_every == 0, earlier).otherwise(F.col("i"))
    return (
        records.withColumn("src", src)
        .withColumn("time", _time(F.col("src")))
        .withColumn("raw_line", _json_line())
        .select(
            "table_name",
            "file_date",
            "sequence",
            (F.col("at") + 1).cast("bigint").alias("line_no"),
            "raw_line",
        )
    )


def _time(n):
    return F.format_string(
        "%sT%02d:%02d:%02d.00Z",
        F.date_format("file_date", "yyyy-MM-dd"),
        n % 24,
        F.floor(n / 24) % 60,
        F.floor(n / 1440) % 60,
    )


def _json_line():
    source = F.struct(F.col("table_name").alias("Table"), F.lit("CORE").alias("System"))
    change = F.struct(
        F.lpad(F.col("src").cast("string"), 12, "0").alias("id"),
        F.col("time").alias("ChangeDateTime"),
        F.lit("UPSERT").alias("Operation"),
    )
    data = F.struct(
        F.col("time").alias("_creationdate"),
        F.concat(F.lit("A"), (F.col("src") % 900 + 100).cast("string")).alias("accountId"),
        F.lit("OPEN").alias("status"),
        F.lit("HIGH").alias("balanceBand"),
    )
    return F.to_json(F.struct(source.alias("Source"), change.alias("ChangeData"), data.alias("Data")))


def feed_path(table: str, date: str, sequence: str) -> str:
    return f"{date}/{table}/{table}-{date}-{sequence}.json"


def published_path(table: str, date: str, sequence: str) -> str:
    return f"{table}/{date}/MERGED={table}-{date}.part{int(sequence):06d}.json"


# What Spark writes for a missing value in the name of a folder, and escapes there.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r'[\x01-\x1f"#%\'*/:=?\\\x7f{\[\]^]')


def _step(value: str | None) -> str:
    """A value as a step of a path, as Spark names folders."""
    return _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", value) if value else NO_VALUE


def _put(scratch: str, target: str) -> None:
    """Give a written file its name, whole or not at all.

    A task that runs again finds its own file there; any other file is an error.
    """
    try:
        os.link(scratch, target)
    except FileExistsError:
        if not filecmp.cmp(scratch, target, shallow=False):
            raise
    finally:
        os.remove(scratch)


def _file_writer(folder: str, path: Callable[[str, str, str], str]) -> Callable:
    """Writes sorted rows to files of a mounted folder, line by line; gives the number of files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, place, stream, scratch, target = 0, None, None, "", ""
        try:
            for batch in batches:
                *steps, texts = (column.to_pylist() for column in batch.columns)
                for key, rows in groupby(zip(*steps, texts, strict=True), itemgetter(0, 1, 2)):
                    if key != place:
                        if stream is not None:
                            stream.close()
                            _put(scratch, target)
                        target = f"{folder}/{path(*map(_step, key))}"
                        os.makedirs(os.path.dirname(target), exist_ok=True)
                        # Readers skip names that start with a dot.
                        scratch = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}.writing"
                        place, stream, made = key, open(scratch, "wb"), made + 1
                    stream.writelines((row[3] or b"") + b"\n" for row in rows)
            if stream is not None:
                stream.close()
                _put(scratch, target)
                stream = None
        finally:
            if stream is not None:
                stream.close()
                if os.path.exists(scratch):
                    os.remove(scratch)
        yield pa.RecordBatch.from_pydict({"files": pa.array([made], pa.int64())})

    return write


def _moved_in(records: DataFrame, root: str, path: Callable[[str, str, str], str]) -> int:
    """Files written by Spark and renamed: for every store Spark can write to."""
    spark, place = records.sparkSession, PLACE
    staging = shared_folder(spark, "feed")
    records.write.partitionBy(*place).text(staging)
    moves = []
    storage = Storage(spark, staging)
    for part in storage.glob(f"{staging}/table_name=*/file_date=*/sequence=*/part-*"):
        table, date, sequence = (step.split("=", 1)[1] for step in part.split("/")[-4:-1])
        moves.append((part, f"{root.rstrip('/')}/{path(table, date, sequence)}"))
    storage.move_all(moves)
    return len(moves)


PLACE = ["table_name", "file_date", "sequence"]


def write_feed(records: DataFrame, root: str, path: Callable[[str, str, str], str] = feed_path) -> int:
    """Write one text file per (table_name, file_date, sequence); returns how many.

    Lines go in order of ``line_no``. A file is written by one task, so keep
    ``sequence`` rolling over. ``path`` places a file below the root.

    In a mounted folder tasks give files their names: Hadoop's local file system
    starts a process for every file and folder it makes, and the driver would have
    to list and rename all files.
    """
    spark: SparkSession = records.sparkSession
    lines = records.repartition(*PLACE).sortWithinPartitions(*PLACE, "line_no").select(*PLACE, "raw_line")
    folder = Storage(spark, root).mounted(root)
    if folder is None:
        return _moved_in(lines, root, path)
    texts = lines.select(*[F.col(c).cast("string") for c in PLACE], F.col("raw_line").cast("binary"))
    made = texts.mapInArrow(_file_writer(folder, path), "files BIGINT")
    return made.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
