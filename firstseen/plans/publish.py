"""Survivors to ``<output>/<table>/<date>/``, in merge order.

Spark cannot overwrite a folder it is reading, and the published files are also
the baseline. So survivors are written to a staging folder below the output root,
on the same file system, and moved in by renames.

Before the first rename an intent is written: every move and every removal of
the run. A run that dies before has changed nothing. One that dies later is
completed by the next, which first carries out any open intent: moves whose
source is still there, then removals. So *replace* never ends with old and new
side by side, and a single file never gives way before its successor is whole.
One run at a time may publish below an output root.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.config import DedupConfig
from firstseen.plans.even_parts import in_even_parts
from firstseen.sources.feeds import baseline_lines
from firstseen.storage import Storage

# Lines of an output by place; within a split, rows count up.
ORDER = ["sequence", "file_path", "split_start", "row_id"]

# Below the output root. The name hides it from every reader of published files.
WORK = "_firstseen"

@dataclass(frozen=True)
class Published:
    """Files of one table and date after a run, in merge order."""

    table_name: str
    file_date: str
    files: tuple[str, ...]


def spellings(storage: Storage, output_dir: str) -> dict[str, str]:
    """Lower-cased name to folder name of what is published; a few per table."""
    return {name.lower(): name for name in reversed(storage.names(output_dir))}


def with_output_table(survivors: DataFrame, published: dict[str, str]) -> DataFrame:
    """Add ``output_table``: one spelling per table and date.

    Names that differ only in case share an output: the folder that is there
    already, else one called like the file with the lowest sequence. The names
    are one row per allowed table and run date, and that bounds their broadcast.
    """
    names = survivors.groupBy("scope_table", "file_date").agg(
        F.min(F.struct("sequence", "file_path", "table_name")).alias("lead")
    )
    name = F.col("lead.table_name")
    if published:
        there = F.create_map(*[F.lit(text) for pair in published.items() for text in pair])
        name = F.coalesce(there[F.col("scope_table")], name)
    names = names.select("scope_table", "file_date", name.alias("output_table"))
    return survivors.join(F.broadcast(names), ["scope_table", "file_date"])


def in_merge_order(survivors: DataFrame, scratch: str) -> DataFrame:
    """In ranges of even size, each sorted: table, date, sequence, path, place in the file.

    Ranges are cut by the whole position, so one big table spreads over many
    tasks and the part numbers run in merge order.
    """
    return in_even_parts(survivors, ["output_table", "file_date", *ORDER], scratch)


def _write_text(lines: DataFrame, staging: str) -> None:
    """One part per task and output, whatever limit the cluster sets on records."""
    (
        lines.select("output_table", "file_date", "raw_line")
        .write.option("maxRecordsPerFile", 0)
        .partitionBy("output_table", "file_date")
        .text(staging)
    )


def single_file_lines(survivors: DataFrame, output_dir: str, config: DedupConfig) -> DataFrame:
    """Lines of the outputs that have survivors, each output in one partition and in order.

    In merge mode what is published comes first, as it stands. One file means one
    writer: its task sorts the whole output, on disk where it is large.
    """
    lines = survivors.select(
        "scope_table",
        "output_table",
        "file_date",
        F.lit(1).alias("role_rank"),
        *ORDER,
        "raw_line",
    )
    if config.publish_mode == "merge":
        # One row per table and date: bounded by the allow-list and the dates.
        spelled = survivors.select("scope_table", "file_date", "output_table").distinct()
        rows = spelled.collect()
        tables, dates = sorted({r.scope_table for r in rows}), sorted({r.file_date for r in rows})
        old = (
            baseline_lines(survivors.sparkSession, output_dir, tables, dates, numbered=False)
            .withColumn("scope_table", F.lower("table_name"))
            .join(F.broadcast(spelled), ["scope_table", "file_date"])
            .filter(F.col("table_name") == F.col("output_table"))
        )
        lines = lines.unionByName(old.select(*lines.columns))
    place = ["output_table", "file_date"]
    return lines.repartition(*place).sortWithinPartitions(*place, "role_rank", *ORDER)


def part_number(path: str) -> tuple[int, str]:
    """Parts sort by number: names have five digits only up to 99 999 tasks."""
    name = path.rsplit("/", 1)[-1]
    number = re.match(r"part-(\d+)", name)
    return int(number[1]) if number else -1, name


def _parts(storage: Storage, staging: str) -> dict[tuple[str, str], list[str]]:
    """Written part files by table and date, in part order."""
    found: dict[tuple[str, str], list[str]] = defaultdict(list)
    for part in sorted(storage.glob(f"{staging}/output_table=*/file_date=*/part-*"), key=part_number):
        table, date = (step.split("=", 1)[1] for step in part.split("/")[-3:-1])
        found[table, date].append(part)
    return found


def _carry_out(storage: Storage, path: str) -> None:
    """Do what an intent says and is not done yet, then drop it."""
    intent = json.loads(storage.read_text(path))

    def place(move: list[str]) -> None:
        source, target = move
        if storage.exists(source):
            storage.replace(source, target)
        elif not storage.exists(target):
            raise OSError(f"neither {source} nor {target} is there")

    storage.each(place, intent["moves"])
    storage.each(storage.remove_file, intent["removals"])
    storage.remove_file(path)
    storage.remove_folder(intent["staging"])


def finish_open(storage: Storage, output_dir: str) -> int:
    """Complete what a run that died was about to publish; how many there were.

    Staging folders without an intent belong to runs that changed nothing.
    """
    work = f"{output_dir.rstrip('/')}/{WORK}"
    names = storage.names(work)
    intents = [name for name in names if name.endswith(".json")]
    for name in intents:
        _carry_out(storage, f"{work}/{name}")
    for name in names:
        if not name.endswith(".json"):
            storage.remove_folder(f"{work}/{name}")
    return len(intents)


def propose(
    survivors: DataFrame, output_dir: str, config: DedupConfig, run_id: str, note: tuple[str, str] | None = None
) -> tuple[str, list[tuple[str, str]]]:
    """Write survivors and the intent to move them in; its path, and the tables and dates.

    From then on the run is published for readers of snapshots, and the next run
    carries out what this one did not.
    """
    storage = Storage(survivors.sparkSession, output_dir)
    root = output_dir.rstrip("/")
    survivors = with_output_table(survivors, spellings(storage, output_dir))
    name = uuid.uuid4().hex
    staging = f"{root}/{WORK}/{name}"
    if config.single_file:
        _write_text(single_file_lines(survivors, output_dir, config), staging)
    else:
        # Dropped with the work folder by the next run if this one dies.
        _write_text(in_merge_order(survivors, f"{staging}-parts"), staging)
        storage.remove_folder(f"{staging}-parts")

    outputs = sorted(_parts(storage, staging).items())
    folders = [f"{root}/{table}/{date}" for (table, date), _ in outputs]
    moves, removals = [], []
    for ((table, date), new), folder, names in zip(outputs, folders, storage.each(storage.names, folders), strict=True):
        old = [f"{folder}/{n}" for n in names if n.endswith(".json")]
        if config.single_file:
            if len(new) != 1:
                raise RuntimeError(f"{len(new)} files were written for the one file of {table} {date}")
            targets = [f"{folder}/MERGED={table}-{date}.json"]
        else:
            targets = [f"{folder}/{part_name(table, date, k, run_id)}" for k in range(len(old), len(old) + len(new))]
        moves += zip(new, targets, strict=True)
        if config.publish_mode == "replace" or config.single_file:
            removals += sorted(set(old) - set(targets))
    if note is not None:
        storage.write_text(f"{staging}/_note", note[1])
        moves.append((f"{staging}/_note", note[0]))
    intent = f"{root}/{WORK}/{name}.json"
    storage.write_text(f"{intent}.new", json.dumps({"staging": staging, "moves": moves, "removals": removals}))
    # The intent is there whole or not at all.
    storage.move(f"{intent}.new", intent)
    return intent, [output for output, _ in outputs]


def publish(
    survivors: DataFrame, output_dir: str, config: DedupConfig, run_id: str, note: tuple[str, str] | None = None
) -> list[Published]:
    """Write, then move in. Tables without survivors are left as they are.

    ``note`` is the path and text of a small file that is put in place by the same
    intent: once no intent is open, it is there if and only if the lines are.
    """
    intent, outputs = propose(survivors, output_dir, config, run_id, note)
    storage = Storage(survivors.sparkSession, output_dir)
    _carry_out(storage, intent)
    listed = storage.each(storage.names, [f"{output_dir.rstrip('/')}/{table}/{date}" for table, date in outputs])
    return [
        Published(table, date, tuple(n for n in names if n.endswith(".json")))
        for (table, date), names in zip(outputs, listed, strict=True)
    ]


def part_name(table: str, date: str, number: int, run_id: str) -> str:
    """Sorts after the single file and after the parts of earlier runs."""
    return f"MERGED={table}-{date}.part{number:06d}-{run_id}.json"


def output_file(table: str, date: str, names: list[str]) -> str:
    """The single file if that is all there is, else a glob over the parts."""
    single = f"MERGED={table}-{date}.json"
    return single if names in ([], [single]) else f"MERGED={table}-{date}.*json"


def output_files(summary: DataFrame, output_dir: str) -> DataFrame:
    """scope_table, file_date, output_file: what to read for each table and date."""
    spark, root = summary.sparkSession, output_dir.rstrip("/")
    storage = Storage(spark, output_dir)
    published = spellings(storage, output_dir)
    # One row per table and date.
    rows = summary.select("table_name", "file_date").collect()
    tables = [published.get(row.table_name.lower(), row.table_name) for row in rows]
    listed = storage.each(storage.names, [f"{root}/{t}/{row.file_date}" for t, row in zip(tables, rows, strict=True)])
    found = [
        (row.table_name.lower(), row.file_date, output_file(table, str(row.file_date), [n for n in names if n.endswith(".json")]))
        for row, table, names in zip(rows, tables, listed, strict=True)
    ]
    return spark.createDataFrame(found, "scope_table STRING, file_date DATE, output_file STRING")


def write_manifest(manifest: DataFrame, output_dir: str, folder: str = "triggerFile", extension: str = ".trg") -> list[str]:
    """One ``<date>.trg`` per date with ``table,file,count`` lines.

    One line per table and date, so the driver may hold them.
    """
    storage = Storage(manifest.sparkSession, output_dir)
    by_date: dict[str, list[str]] = defaultdict(list)
    for row in manifest.orderBy("file_date", F.lower("table_name")).collect():
        by_date[row.file_date.isoformat()].append(row.line)
    written = []
    for date, lines in by_date.items():
        path = f"{output_dir.rstrip('/')}/{folder}/{date}{extension}"
        storage.write_text(path, "\n".join(lines) + "\n")
        written.append(path)
    return written
