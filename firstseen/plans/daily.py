"""The daily run: raw feed and published files in, new records and reports out.

What is published is read first, so a file there that breaks the limits ends the
run before the feed is touched. The raw text is read once. Parsed, keyed lines are staged as Parquet in the
shared folder; later stages read only the columns they need from there, and a
lost executor costs a re-read of staged files, not of the feed. The text itself
goes through one shuffle by key, with the survivors, and one by output order.
Line numbers and provenance work on keys and places alone.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.columns import GROUP
from firstseen.config import DedupConfig
from firstseen.functions.names import DEFAULT_RUN_ID, RUN_ID_UNSAFE
from firstseen.operators import counts
from firstseen.operators.first_seen import classify, duplicates, survivors
from firstseen.operators.prepare import REJECT, prepare, records
from firstseen.plans import reports
from firstseen.plans.kept_baseline import KeptBaseline
from firstseen.plans.publish import Published, finish_open, output_files, publish, write_manifest
from firstseen.sources.feeds import baseline_lines, has_today_files, resolve_tables, today_lines
from firstseen.sources.ndjson import number_lines, split_offsets
from firstseen.storage import Storage, shared_folder


class TooManyRejects(RuntimeError):
    """A file has more malformed lines than the settings allow."""


class WrongCount(RuntimeError):
    """What is published is not what the run counted."""


@dataclass
class DailyResult:
    """Frames over the staged files of a finished run, and what it wrote.

    As a context manager it removes the staged files at the end; the frames are
    then gone, what was published stays.
    """

    survivors: DataFrame
    duplicates: DataFrame
    rejects: DataFrame
    file_counts: DataFrame
    summary: DataFrame
    staging: str
    published: list[Published] = field(default_factory=list)
    manifests: list[str] = field(default_factory=list)
    reports: list[str] = field(default_factory=list)

    def remove_staging(self) -> None:
        Storage(self.summary.sparkSession, self.staging).remove_folder(self.staging)

    def __enter__(self) -> DailyResult:
        return self

    def __exit__(self, *error) -> None:
        self.remove_staging()


# Where a line stands before it has a number. Rows count up within a split.
PLACE = ["role_rank", "sequence", "file_path", "split_start", "row_id"]


# What a malformed line says where none is allowed; the path follows.
MALFORMED = "malformed line in "


def staged(frame: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write a frame and read it back. The schema is given: there may be no rows."""
    frame.write.partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def write_lines(lines: DataFrame, config: DedupConfig, path: str, strict: bool = False) -> DataFrame:
    """Prepare unnumbered lines and write them.

    Published lines only compete by key, so their text stays behind unless it is
    malformed. ``strict`` lets the first malformed line end the job that writes.
    """
    text_needed = (F.col("role_rank") == 1) | (F.col("line_kind") == REJECT)
    prepared = prepare(lines, config).withColumn("raw_line", F.when(text_needed, F.col("raw_line")))
    if not strict:
        return staged(prepared, path)
    wrong = F.raise_error(F.concat(F.lit(MALFORMED), F.col("file_path"))).cast("string")
    kind = F.when(F.col("line_kind") == REJECT, wrong).otherwise(F.col("line_kind"))
    try:
        return staged(prepared.withColumn("line_kind", kind), path)
    except (PySparkException, Py4JError) as error:
        named = re.search(rf"{MALFORMED}\S+", str(error))
        if named is None:
            raise
        raise TooManyRejects(named[0]) from error


def with_offsets(written: DataFrame, staging: str) -> tuple[DataFrame, DataFrame]:
    """Written lines, and the offsets of their splits.

    Split offsets come from three columns of the staged files, and are staged as
    well: their size is then known, and Spark broadcasts them only while they are
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return written, staged(split_offsets(written), f"{staging}/offsets")


def stage_lines(lines: DataFrame, config: DedupConfig, staging: str) -> tuple[DataFrame, DataFrame]:
    """Prepare unnumbered lines and write them; the lines and their splits' offsets."""
    return with_offsets(write_lines(lines, config, f"{staging}/lines"), staging)


def numbered_keys(written: DataFrame, offsets: DataFrame) -> DataFrame:
    """Staged lines with their numbers, without their text."""
    return number_lines(written.drop("raw_line"), offsets)


def check_counts(counted: DataFrame, expected: DataFrame, summary: DataFrame) -> None:
    """Raise where the published lines are not as many as old and new ones make."""
    scope = ["scope_table", "file_date"]
    of_run = summary.select(F.lower("table_name").alias("scope_table"), "file_date")
    both = of_run.join(expected.withColumnRenamed("output_count", "expected"), scope, "left").join(counted, scope, "left")
    found, due = (F.coalesce(c, F.lit(0)) for c in ("output_count", "expected"))
    wrong = both.filter(found != due).orderBy(*scope).first()
    if wrong is not None:
        raise WrongCount(
            f"{wrong.scope_table} of {wrong.file_date}: {wrong.output_count} lines are published, {wrong.expected} are due"
        )


def check_rejects(file_counts: DataFrame, config: DedupConfig) -> None:
    """Raise for a published file above the limit, or for any reject if strict."""
    worst = counts.reject_threshold(file_counts, config.prior_reject_limit)
    if not config.skip_malformed:
        worst = worst.unionByName(
            file_counts.filter("role = 'TODAY' AND skipped_count > 0").select(*worst.columns)
        )
    example = worst.orderBy(F.desc("skipped_count"), "file_path").first()
    if example is not None:
        raise TooManyRejects(f"{example.skipped_count} malformed lines in {example.file_path}")


def _against_kept(
    baseline: KeptBaseline, written: DataFrame, offsets: DataFrame, config: DedupConfig, staging: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Today's lines classified, lines per file, and the rows that compete to survive.

    Only the kept places of keys that today has as well take part.
    """
    prepared = numbered_keys(written, offsets)
    wanted = records(prepared).select(*GROUP).distinct()
    known = staged(baseline.matching(wanted), f"{staging}/known")
    today = classify(prepared.unionByName(known, allowMissingColumns=True), config).filter(F.col("role_rank") == 1)
    classified = staged(today, f"{staging}/classified", "status")
    per_file = counts.file_counts_of(classified)
    per_file = per_file.unionByName(baseline.file_counts(config.run_dates).select(*per_file.columns))
    # Published keys win by their role, wherever they stand.
    earlier = known.withColumns({"split_start": F.lit(0).cast("bigint"), "row_id": F.col("line_no")})
    return classified, per_file, written.unionByName(earlier.drop("line_no"), allowMissingColumns=True)


def run_daily(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    config: DedupConfig,
    log_dir: str | None = None,
) -> DailyResult:
    """De-duplicate the feed of ``config.run_dates`` (all dates if empty) and publish."""
    started = time.monotonic()
    run_id = re.sub(RUN_ID_UNSAFE, "_", config.run_id) if config.run_id.strip() else DEFAULT_RUN_ID
    tables = resolve_tables(spark, config.tables, config.tables_file)
    if not has_today_files(spark, input_dir, tables, config.run_dates):
        raise FileNotFoundError(f"no input files for the run in {input_dir}")

    # A run that died while it published is completed first: its files are baseline.
    finish_open(Storage(spark, output_dir), output_dir)
    staging = shared_folder(spark, "run")
    baseline = KeptBaseline(spark, output_dir, config, tables) if config.keep_baseline else None
    folders = [f"{staging}/lines/today"]
    if baseline is None:
        prior = baseline_lines(spark, output_dir, tables, config.run_dates, numbered=False)
        folders.append(f"{staging}/lines/published")
        check_rejects(counts.skipped_counts(write_lines(prior, config, folders[-1])), config)
    else:
        baseline.refresh(config.run_dates)
        check_rejects(baseline.file_counts(config.run_dates), config)
    lines = today_lines(spark, input_dir, tables, config.run_dates, numbered=False)
    written = write_lines(lines, config, folders[0], strict=not config.skip_malformed)
    written, offsets = with_offsets(spark.read.schema(written.schema).parquet(*folders), staging)
    if baseline is None:
        # Foldered by status: every sink reads just its part.
        classified = staged(classify(numbered_keys(written, offsets), config), f"{staging}/classified", "status")
        per_file, competing = counts.file_counts_of(classified), written
    else:
        classified, per_file, competing = _against_kept(baseline, written, offsets, config, staging)
    # One row per file, written so that the reports below do not count again.
    file_counts = staged(per_file, f"{staging}/file_counts")
    check_rejects(file_counts, config)

    kept = staged(survivors(competing, place=PLACE), f"{staging}/survivors")
    malformed = number_lines(written.filter(F.col("line_kind") == REJECT), offsets)
    rejected = malformed.select("role", "table_name", "file_date", "file_path", "line_no", "raw_line", "reason")
    if baseline is not None:
        # Before publishing changes what is there.
        of_run = baseline.rejects(config.run_dates).select(*rejected.columns)
        rejected = rejected.unionByName(staged(of_run, f"{staging}/baseline_rejects"))
    published = publish(kept, output_dir, config, f"{run_id}-{uuid.uuid4().hex[:8]}")

    per_table = counts.table_summary(file_counts)
    if baseline is None:
        there = baseline_lines(spark, output_dir, tables, config.run_dates, numbered=False)
        counted = counts.published_counts(there)
    else:
        # Reads what was just published, for its count and for the next run.
        baseline.refresh(config.run_dates)
        counted = baseline.published_counts(config.run_dates)
    counted = staged(counted, f"{staging}/published_counts")
    check_counts(counted, counts.published_from_counts(file_counts, config.publish_mode), per_table)
    summary = counts.with_output(per_table, counted, output_files(per_table, output_dir))
    result = DailyResult(
        survivors=number_lines(kept, offsets),
        duplicates=duplicates(classified),
        rejects=rejected,
        file_counts=file_counts,
        summary=summary,
        staging=staging,
        published=published,
    )
    result.manifests = write_manifest(reports.completion_manifest(summary), output_dir)
    if log_dir:
        result.reports = write_reports(result, output_dir, log_dir, run_id, time.monotonic() - started)
    return result


def write_reports(result: DailyResult, output_dir: str, log_dir: str, run_id: str, seconds: float) -> list[str]:
    """``stats-<run>.log`` per date, and a folder of detail lines per date."""
    storage, written = Storage(result.summary.sparkSession, log_dir), []
    dates = [row.file_date for row in result.summary.select("file_date").distinct().collect()]
    details = reports.detail_report(result.duplicates, result.rejects)
    for date in sorted(dates):
        folder = f"{log_dir.rstrip('/')}/{date}"
        text = reports.summary_report(result.summary, date.isoformat(), run_id, output_dir, duration(seconds))
        storage.write_text(f"{folder}/stats-{run_id}.log", text)
        reports.write_details(details.filter(F.col("file_date") == date), f"{folder}/stats-detailed-{run_id}.log")
        written += [f"{folder}/stats-{run_id}.log", f"{folder}/stats-detailed-{run_id}.log"]
    return written


def duration(seconds: float) -> str:
    """Text of a run time, as ``functions.names.duration_text`` writes it."""
    millis = int(seconds * 1000)
    hours, rest = divmod(millis, 3_600_000)
    minutes, rest = divmod(rest, 60_000)
    text = f"{rest // 1000}.{rest % 1000:03d}s"
    if hours:
        return f"{hours}h {minutes}m {text}"
    return f"{minutes}m {text}" if minutes else text
