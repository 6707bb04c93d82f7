"""Restartable incremental de-duplication with Structured Streaming.

Each micro-batch takes the files that arrived since the last one, drops records
whose key an earlier batch or the published baseline holds, and appends the rest.
A record that arrived earlier wins, even against a lower sequence that arrives
later; within a batch the order is the usual (sequence, path, line).

State folder::

    checkpoint/              Spark's own progress
    survivors/batch=<n>/     records kept by batch n
    keys/                    their keys and places: the index, see ``key_index``
    duplicates/batch=<n>/    what it dropped, and why
    rejects/batch=<n>/       malformed lines
    work/                    staged lines, a new folder for every attempt
    stream.id                the name this state publishes by

A batch that died is replayed by Spark with the same number and the same files,
and overwrites its own folders only: nothing is lost or kept twice.

With ``publish=True`` each batch also publishes what it kept, as a daily run does.
The number of the last batch published lies below the output root and is put in
place by the intent that moves the batch's files, so it tells the truth whatever
died: a replayed batch that is published already is not published again, and one
that is not takes along what batches before it have left unpublished.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firstseen.columns import GROUP, POSITION
from firstseen.config import DedupConfig
from firstseen.operators.first_seen import SURVIVOR, classify, duplicates, survivors
from firstseen.operators.prepare import RECORD, REJECT, records
from firstseen.operators import counts
from firstseen.plans.daily import PLACE, check_rejects, numbered_keys, stage_lines, staged
from firstseen.plans.publish import finish_open, publish
from firstseen.sources.feeds import (
    UNNUMBERED,
    _keep_today,
    _name_glob,
    _today,
    baseline_lines,
    refuse_hidden,
    resolve_tables,
)
from firstseen.sources.ndjson import number_lines
from firstseen.storage import Storage
from firstseen.streaming.key_index import BASELINE_BATCH, KeyIndex

# Keys of a batch are broadcast up to this size. A row is a hash, a date and a
# table name, which the file system bounds to 255 bytes.
KEY_BROADCAST_BYTES = 128 << 20
KEY_ROW_BYTES = 512

# So many batches of the index, and so many folders of each level, become one.
COMPACT_BATCHES = 8

# Files are never too old: one that arrives late with an old time is read too.
# Spark then remembers the names of all files it has read.
MAX_FILE_AGE = "36500d"

# Below the output root: a file per stream with the number of the batch published last.
PUBLISHED = "_firstseen_batches"

KEY_COLUMNS = ["dedup_key", "scope_table", *POSITION, "table_name", "file_date"]
KEY_SCHEMA = (
    "dedup_key BINARY, scope_table STRING, role_rank INT, sequence INT, file_path STRING, line_no BIGINT, "
    "table_name STRING, file_date DATE"
)

SURVIVOR_COLUMNS = [*GROUP, *POSITION, "table_name", "file_name", "effective_table", "raw_line"]
SURVIVOR_SCHEMA = (
    "dedup_key BINARY, scope_table STRING, file_date DATE, role_rank INT, sequence INT, "
    "file_path STRING, line_no BIGINT, table_name STRING, file_name STRING, "
    "effective_table STRING, raw_line STRING, batch BIGINT"
)


class IncrementalDedup:
    """A feed folder, a state folder, and the micro-batch logic between them."""

    def __init__(
        self,
        spark: SparkSession,
        input_dir: str,
        state_dir: str,
        config: DedupConfig,
        output_dir: str | None = None,
        publish: bool = False,
    ):
        if publish and output_dir is None:
            raise ValueError("publish needs an output folder")
        if publish and config.publish_mode != "merge":
            raise ValueError("a stream can only merge: a batch would replace the one before it")
        self.spark = spark
        self.input_dir = input_dir
        self.state = state_dir.rstrip("/")
        self.config = config
        self.output_dir = output_dir
        self.publishes = publish
        self.tables = resolve_tables(spark, config.tables, config.tables_file)
        self.keys = KeyIndex(spark, f"{self.state}/keys", KEY_SCHEMA, COMPACT_BATCHES)

    def read(self, max_files: int | None = None) -> DataFrame:
        """The feed as a stream of lines; whole files are dropped by name."""
        reader = (
            self.spark.readStream.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", _name_glob(self.config.run_dates))
            .option("maxFileAge", MAX_FILE_AGE)
        )
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        lines = reader.text(self.input_dir).filter(_keep_today(self.tables, self.config.run_dates))
        return lines.select(
            F.col("value").alias("raw_line"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("split_start"),
        )

    def start(self, max_files: int | None = None) -> StreamingQuery:
        """Process everything that is there, then stop; call again for more."""
        refuse_hidden(self.spark, self.input_dir, self.tables, self.config.run_dates)
        if self.publishes:
            # What a run that died was about to publish is baseline, or a batch of this stream.
            finish_open(Storage(self.spark, self.output_dir), self.output_dir)
        self._load_baseline()
        return (
            self.read(max_files)
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.state}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    def process(self, batch: DataFrame, number: int) -> None:
        """One micro-batch: stage, classify against the index, append."""
        work = f"{self.state}/work/{number}-{uuid.uuid4().hex[:8]}"
        # Row ids are taken here: a streaming frame cannot have them.
        lines = _today(batch.withColumn("row_id", F.monotonically_increasing_id()))
        written, offsets = stage_lines(lines.select(*UNNUMBERED), self.config, work)
        prepared = numbered_keys(written, offsets)
        index = self._index(number, prepared)
        both = prepared.unionByName(index, allowMissingColumns=True)
        today = classify(both, self.config).filter(F.col("role_rank") == 1)
        classified = staged(today, f"{work}/classified", "status")
        # Nothing of a batch that breaks the limits is kept; it is replayed as it is.
        check_rejects(counts.file_counts_of(classified), self.config)
        # Keys of earlier batches win by their role, wherever they stand.
        earlier = index.withColumns({"split_start": F.lit(0).cast("bigint"), "row_id": F.col("line_no")})
        kept = survivors(written.unionByName(earlier.drop("line_no"), allowMissingColumns=True), place=PLACE)
        kept = number_lines(staged(kept, f"{work}/survivors"), offsets).withColumn("role_rank", F.lit(1))
        self._append("survivors", kept.select(*SURVIVOR_COLUMNS), number)
        new_keys = classified.filter(F.col("status") == SURVIVOR).select(*KEY_COLUMNS)
        self._append("duplicates", duplicates(classified), number)
        rejects = number_lines(written.filter(F.col("line_kind") == REJECT), offsets)
        self._append("rejects", rejects.select("table_name", "file_date", "file_path", "line_no", "raw_line", "reason"), number)
        self.keys.add(new_keys, number)
        if self.publishes:
            self._publish(number)

    def survivors(self) -> DataFrame:
        """Everything kept so far."""
        return self._survivor_table()

    def duplicates(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.state}/duplicates")

    def rejects(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.state}/rejects")

    def _stream_id(self) -> str:
        """The name of this state: a new state folder at an old path is another stream."""
        storage, path = Storage(self.spark, self.state), f"{self.state}/stream.id"
        if not storage.exists(path):
            new = f"{path}.{uuid.uuid4().hex}"
            storage.write_text(new, uuid.uuid4().hex)
            storage.move(new, path)
        return storage.read_text(path)

    def published_through(self) -> int:
        """The last batch whose lines are published; -1 if none is."""
        storage, path = Storage(self.spark, self.output_dir), self._note_path()
        return json.loads(storage.read_text(path))["batch"] if storage.exists(path) else -1

    def _note_path(self) -> str:
        return f"{self.output_dir.rstrip('/')}/{PUBLISHED}/{self._stream_id()}.json"

    def _publish(self, number: int) -> None:
        """Publish the batches that are not yet, up to this one."""
        finish_open(Storage(self.spark, self.output_dir), self.output_dir)
        done = self.published_through()
        if done >= number:
            return
        # Line numbers stand for places: both run up within a file.
        kept = self._survivor_table().filter(F.col("batch").between(done + 1, number))
        kept = kept.withColumns({"split_start": F.lit(0).cast("bigint"), "row_id": F.col("line_no")})
        run_id = f"{self._stream_id()[:8]}-batch{number:08d}"
        publish(kept, self.output_dir, self.config, run_id, (self._note_path(), json.dumps({"batch": number})))

    def _append(self, name: str, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.state}/{name}/batch={number}")

    def _survivor_table(self) -> DataFrame:
        folder = f"{self.state}/survivors"
        if not Storage(self.spark, folder).exists(folder):
            return self.spark.createDataFrame([], SURVIVOR_SCHEMA)
        return self.spark.read.schema(SURVIVOR_SCHEMA).parquet(folder)

    def _index(self, number: int, prepared: DataFrame) -> DataFrame:
        """Keys and places kept before this batch, as published rows.

        The index has keys and positions only, and folders of other dates are not
        opened, as each batch covers few dates. For a small
        batch its keys are broadcast, so the index is filtered where it is read
        and hardly any of it is shuffled. A large batch meets the whole index in
        the shuffle by key.
        """
        dates = [row.file_date for row in prepared.select("file_date").distinct().collect()]
        index = self.keys.before(number).filter(F.col("file_date").isin(*dates))
        keys = records(prepared).select(*GROUP)
        if keys.count() * KEY_ROW_BYTES <= KEY_BROADCAST_BYTES:
            index = index.join(F.broadcast(keys), GROUP, "left_semi")
        return (
            index.withColumn("role_rank", F.lit(0))
            .withColumn("role", F.lit("PRIOR"))
            .withColumn("line_kind", F.lit(RECORD))
        )

    def index_folders(self, number: int) -> list[str]:
        """Folders with the keys kept before a batch."""
        return self.keys.folders(number)

    def _load_baseline(self) -> None:
        """Bring the published keys into the index, once."""
        if self.output_dir is None or self.keys.has_baseline():
            return
        work = f"{self.state}/work/baseline-{uuid.uuid4().hex[:8]}"
        lines = baseline_lines(self.spark, self.output_dir, self.tables, self.config.run_dates, numbered=False)
        prepared = numbered_keys(*stage_lines(lines, self.config, work))
        check_rejects(counts.file_counts(prepared), self.config)
        self.keys.add(records(prepared).select(*KEY_COLUMNS), BASELINE_BATCH)
