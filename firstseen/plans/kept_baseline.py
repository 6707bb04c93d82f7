"""Keys of what is published, kept beside it.

A run needs of the published files which keys they hold and where. Here that is
written once per file, so a run neither parses the baseline nor shuffles it::

    <output>/_firstseen_keys/<settings>/
        keys/      first place of each key: a table foldered by date, in buckets by
                   key and sorted, which joins meet bucket by bucket
        filter/    Bloom filter of the keys, by date (``operators.prefilter``)
        files/     what was read: path, size, time, lines of each kind
        rejects/   malformed lines

``refresh`` compares the listing of published files with ``files/``. Files that came
since are read and added; where one has changed or is gone its date is read again.
``files/`` is written last: what died before counts as not read, and keys that are
in twice do no harm, as the first place counts.

Settings that change keys, such as the key fields, have a folder of their own.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.columns import GROUP, PRIOR
from firstseen.config import DedupConfig
from firstseen.operators import first_seen, prefilter
from firstseen.operators.prepare import BLANK, RECORD, REJECT, prepare, records
from firstseen.sources import feeds
from firstseen.storage import Storage, shared_folder

KEPT = "_firstseen_keys"
# Of the layout; another one is another folder.
LAYOUT = 1

# The same as GROUP; a folder's column cannot be one of the bucket's.
BUCKET_KEY = ["dedup_key", "scope_table", "day"]
KEY_COLUMNS = (
    "dedup_key BINARY, scope_table STRING, day DATE, sequence INT, file_path STRING, line_no BIGINT, "
    "table_name STRING, file_date DATE"
)
FILES_SCHEMA = (
    "table_name STRING, file_path STRING, file_bytes BIGINT, modified TIMESTAMP, read_count BIGINT, "
    "skipped_count BIGINT, blank_count BIGINT, key_count BIGINT, blocks BIGINT, file_date DATE"
)
REJECTS_SCHEMA = "role STRING, table_name STRING, file_path STRING, line_no BIGINT, raw_line STRING, reason STRING, file_date DATE"


class KeptBaseline:
    """The kept keys of one output root, for the tables and key settings of a run."""

    def __init__(self, spark: SparkSession, output_dir: str, config: DedupConfig, tables: Sequence[str]):
        self.spark, self.output_dir, self.config, self.tables = spark, output_dir, config, tables
        self.buckets = config.baseline_buckets
        settings = [LAYOUT, self.buckets, list(config.key_fields), config.case_insensitive_overrides]
        settings += [sorted((name, list(fields)) for name, fields in config.table_key_fields.items())]
        digest = hashlib.sha256(json.dumps(settings).encode()).hexdigest()[:16]
        self._storage = Storage(spark, output_dir)
        self.folder = f"{output_dir.rstrip('/')}/{KEPT}/{digest}"

    # --- what is kept ------------------------------------------------------

    def keys(self, dates: Sequence[dt.date]) -> DataFrame:
        """Kept places of the keys of some dates, in their buckets; a key may be there twice."""
        return self.spark.table(self._table()).filter(F.col("file_date").isin(*dates))

    def matching(self, wanted: DataFrame) -> DataFrame:
        """The first kept place of each key of ``wanted``, rows with GROUP, as published rows.

        Only wanted keys that pass the filter are shuffled, to the kept buckets.
        """
        # One row per date.
        dates = [row.file_date for row in wanted.select("file_date").distinct().collect()]
        doubtful = self.doubtful(wanted, dates).withColumn("day", F.col("file_date")).select(*BUCKET_KEY)
        met = self.keys(dates).join(doubtful.repartition(self.buckets, *BUCKET_KEY), BUCKET_KEY, "left_semi")
        first = F.min(F.struct("sequence", "file_path", "line_no", "table_name")).alias("first")
        return met.groupBy(*BUCKET_KEY).agg(first).select(
            "dedup_key",
            "scope_table",
            F.col("day").alias("file_date"),
            "first.*",
            F.lit(PRIOR).alias("role"),
            F.lit(0).alias("role_rank"),
            F.lit(RECORD).alias("line_kind"),
        )

    def anti_join(self, today: DataFrame) -> DataFrame:
        """Prepared records whose key is not kept. A key with many records is looked up once.

        They are read several times, so they are staged: a feed is parsed once.
        """
        today = self._staged(today, shared_folder(self.spark, "wanted"))
        known = self.matching(today.select(*GROUP).distinct())
        both = today.unionByName(known, allowMissingColumns=True)
        return first_seen.baseline_anti_join(both, self.config).select(*today.columns)

    def doubtful(self, wanted: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
        """The rows of ``wanted`` whose key may be kept."""
        # One row per date.
        known = self._files(dates).groupBy("file_date").agg(F.max("blocks").alias("blocks")).collect()
        blocks = {row.file_date: row.blocks for row in known}
        if not blocks or not prefilter.fits(sum(blocks.values())):
            return wanted
        current = self.spark.createDataFrame(list(blocks.items()), "file_date DATE, blocks BIGINT")
        parts = self._read("filter", prefilter.FILTER_SCHEMA, dates).join(F.broadcast(current), ["file_date", "blocks"], "left_semi")
        return prefilter.with_presence(wanted, prefilter.combined(parts)).filter("maybe_known").drop("maybe_known")

    def file_counts(self, dates: Sequence[dt.date]) -> DataFrame:
        """Lines of every published file, as a run counts them."""
        return self._files(dates).select(
            F.lit(PRIOR).alias("role"),
            "table_name",
            "file_date",
            F.lit(1).alias("sequence"),
            "file_path",
            "read_count",
            "skipped_count",
            "blank_count",
            F.col("read_count").alias("written_count"),
            F.lit(0).cast("bigint").alias("filtered_count"),
        )

    def published_counts(self, dates: Sequence[dt.date]) -> DataFrame:
        """Published lines per table and date."""
        lines = F.col("read_count") + F.col("skipped_count") + F.col("blank_count")
        return self._files(dates).groupBy(F.lower("table_name").alias("scope_table"), "file_date").agg(
            F.sum(lines).alias("output_count")
        )

    def rejects(self, dates: Sequence[dt.date]) -> DataFrame:
        """Malformed lines of the published files; added twice, they count once."""
        rows = self._read("rejects", REJECTS_SCHEMA, dates).filter(F.lower("table_name").isin(*self.tables))
        return rows.dropDuplicates(["file_path", "line_no"])

    def _files(self, dates: Sequence[dt.date]) -> DataFrame:
        """The files that were read, of this run's tables."""
        rows = self._read("files", FILES_SCHEMA, dates).filter(F.lower("table_name").isin(*self.tables))
        return rows.dropDuplicates(["file_date", "file_path"])

    def _read(self, name: str, schema: str, dates: Sequence[dt.date]) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not self._storage.any(f"{path}/file_date=*"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(path)
        columns = self.spark.createDataFrame([], schema).columns
        return (rows.filter(F.col("file_date").isin(*dates)) if dates else rows).select(*columns)

    def _table(self) -> str:
        """The kept keys as a table of this session, which knows their buckets."""
        path = f"{self.folder}/keys"
        name = "firstseen_keys_" + hashlib.sha256(self._storage.qualified_path(path).encode()).hexdigest()[:16]
        if not self._storage.exists(path):
            self._storage.write_text(f"{path}/_buckets", str(self.buckets))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({KEY_COLUMNS}) USING parquet PARTITIONED BY (file_date) "
            f"CLUSTERED BY ({', '.join(BUCKET_KEY)}) SORTED BY ({', '.join(BUCKET_KEY)}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}'"
        )
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        self.spark.sql(f"REFRESH TABLE {name}")
        return name

    # --- bringing it up to date --------------------------------------------

    def refresh(self, dates: Sequence[dt.date] = ()) -> dict[dt.date, str]:
        """Read what is published and not kept; 'grown' or 'stale' by date, fresh ones left out."""
        listed = feeds.published_files(self.spark, self.output_dir, self.tables, dates)
        known = self._files(dates).select(
            "file_date", "file_path", F.col("file_bytes").alias("known_bytes"), F.col("modified").alias("known_time")
        )
        both = listed.join(known, ["file_date", "file_path"], "full")
        added = F.col("known_bytes").isNull()
        changed = F.col("file_bytes").isNull() | (F.col("file_bytes") != F.col("known_bytes")) | (F.col("modified") != F.col("known_time"))
        per_date = both.groupBy("file_date").agg(F.count_if(added).alias("added"), F.count_if(~added & changed).alias("changed"), F.count("known_bytes").alias("known"))
        # One row per date.
        rows = per_date.filter("added > 0 OR changed > 0").collect()
        stale = [row.file_date for row in rows if row.changed]
        fresh = [row.file_date for row in rows if not row.known]
        grown = [row.file_date for row in rows if row.known and not row.changed]
        for date in stale:
            self._forget(date)
        if stale or fresh:
            # All files of a date: by its folders, as a path for each file costs a task each.
            whole = [*stale, *fresh]
            there = listed.filter(F.col("file_date").isin(*whole))
            self._add(feeds.baseline_lines(self.spark, self.output_dir, self.tables, whole), there)
        if grown:
            new = both.filter(added & F.col("file_date").isin(*grown)).select(*listed.columns)
            paths = [row.file_path for row in new.select("file_path").collect()]
            self._add(feeds.lines_of_published(self.spark, self.output_dir, paths), new)
        return dict.fromkeys(stale, "stale") | dict.fromkeys([*fresh, *grown], "grown")

    def _forget(self, date: dt.date) -> None:
        """Drop what is kept of a date; the list of files first."""
        for name in ("files", "filter", "rejects"):
            self._storage.remove_folder(f"{self.folder}/{name}/file_date={date}")
        self.spark.sql(f"ALTER TABLE {self._table()} DROP IF EXISTS PARTITION (file_date = DATE'{date}')")
        self._storage.remove_folder(f"{self.folder}/keys/file_date={date}")

    def _add(self, lines: DataFrame, files: DataFrame) -> None:
        """Read lines of published files and write what is kept of them."""
        work = shared_folder(self.spark, "kept")
        malformed = F.col("line_kind") == REJECT
        prepared = prepare(lines, self.config).withColumn("raw_line", F.when(malformed, F.col("raw_line")))
        prepared = self._staged(prepared, f"{work}/lines")
        first = F.min(F.struct("sequence", "file_path", "line_no", "table_name")).alias("first")
        keys = records(prepared).groupBy(*GROUP).agg(first).select(*GROUP, "first.*")
        keys = self._staged(keys, f"{work}/keys")
        listed = self._staged(files, f"{work}/files")
        blocks, regrown = self._blocks(keys, [row.file_date for row in listed.select("file_date").distinct().collect()])
        placed = keys.withColumn("day", F.col("file_date")).repartition(self.buckets, *BUCKET_KEY)
        table = self._table()
        placed.select(*BUCKET_KEY, "sequence", "file_path", "line_no", "table_name", "file_date").write.insertInto(table)
        # Dates that outgrew their filter get one of all their keys.
        source = keys.select(*GROUP).filter(~F.col("file_date").isin(*regrown))
        if regrown:
            whole = self.keys(regrown).select("dedup_key", "scope_table", F.col("day").alias("file_date"))
            source = source.unionByName(whole)
        known = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
        self._append(prefilter.build(source, known[F.col("file_date")]), "filter")
        rejected = prepared.filter(malformed)
        self._append(rejected.select("role", "table_name", "file_path", "line_no", "raw_line", "reason", "file_date"), "rejects")
        kind = F.col("line_kind")
        counted = prepared.groupBy("file_date", "file_path").agg(
            F.count_if(kind == RECORD).alias("read_count"),
            F.count_if(kind == REJECT).alias("skipped_count"),
            F.count_if(kind == BLANK).alias("blank_count"),
        )
        held = keys.groupBy("file_date", "file_path").agg(F.count("*").alias("key_count"))
        place = ["file_date", "file_path"]
        rows = listed.join(counted, place, "left").join(held, place, "left")
        rows = rows.na.fill(0, ["read_count", "skipped_count", "blank_count", "key_count"])
        rows = rows.withColumn("blocks", known[F.col("file_date")].cast("bigint"))
        columns = self.spark.createDataFrame([], FILES_SCHEMA).columns
        self._append(rows.select(*columns), "files")
        self._storage.remove_folder(work)

    def _blocks(self, keys: DataFrame, dates: list[dt.date]) -> tuple[dict[dt.date, int], list[dt.date]]:
        """Blocks of each date's filter, and the dates whose filter is too small now."""
        # One row per date each.
        new = {row.file_date: row.n for row in keys.groupBy("file_date").agg(F.count("*").alias("n")).collect()}
        sums = self._files(dates).groupBy("file_date").agg(F.sum("key_count").alias("n"), F.max("blocks").alias("blocks"))
        old = {row.file_date: (row.n, row.blocks) for row in sums.collect()}
        blocks, regrown = {}, []
        for date in dates:
            n, there = old.get(date, (0, None))
            total = n + new.get(date, 0)
            if there is not None and total * prefilter.LEAST_BITS_PER_KEY <= there * prefilter.BLOCK_BITS:
                blocks[date] = there
            else:
                # Twice the keys have room before it is made anew.
                blocks[date] = prefilter.blocks_for(total)
                if there is not None:
                    regrown.append(date)
        return blocks, regrown

    def _staged(self, frame: DataFrame, path: str) -> DataFrame:
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").partitionBy("file_date").parquet(f"{self.folder}/{name}")
