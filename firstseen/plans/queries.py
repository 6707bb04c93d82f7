"""One query per operator, bound to the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firstseen.config import normalise_tables
from firstseen.functions import keys, lines, names
from firstseen.operators import counts, first_seen, prefilter
from firstseen.operators.prepare import prepare, records, rejects
from firstseen.plans import bindings as b
from firstseen.plans import reports
from firstseen.plans.daily import PLACE as RUN_PLACE
from firstseen.plans.daily import run_daily, staged
from firstseen.plans.even_parts import in_even_parts
from firstseen.plans.kept_baseline import KeptBaseline
from firstseen.plans.publish import propose
from firstseen.plans.snapshot import settled, snapshot_lines
from firstseen.sources import feeds
from firstseen.sources.generate import feed_path, generate_records, write_feed
from firstseen.sources.ndjson import scan_numbered
from firstseen.storage import shared_folder
from firstseen.streaming.incremental import IncrementalDedup

Query = Callable[[SparkSession, str], DataFrame]

TABLES = list(b.CHANGE_CONFIG.tables)
KEPT_CONFIG = replace(b.CHANGE_CONFIG, keep_baseline=True, baseline_buckets=8)
# A user's list: spaces, mixed case, a repeat, a blank. It leaves two tables out.
MESSY_TABLES = [" Click ", "PURCHASE", "", "click", "view"]


def hexed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("dedup_key", keys.key_hex(F.col("dedup_key")))


# --- sources ---------------------------------------------------------------


def ndjson_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical lines of written files, numbered."""
    scanned = feeds.today_lines(spark, b.change_feed(spark, sf_dir), TABLES)
    return scanned.select(
        "table_name",
        "file_date",
        "sequence",
        b.short_path(F.col("file_path")).alias("file_path"),
        "line_no",
        "raw_line",
    )


def file_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made of orders, good and bad by priority."""
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    sequence = F.col("o_orderkey").cast("string")
    name = (
        F.when(priority == "1-URGENT", F.concat_ws("-", status, date, F.concat(sequence, F.lit(".csv"))))
        .when(priority == "2-HIGH", F.concat_ws("-", status, F.regexp_replace(date, "-[0-9]+-", "-13-"), F.concat(sequence, F.lit(".json"))))
        .when(priority == "3-MEDIUM", F.concat_ws("-", F.concat(F.lit("Sub_"), status), date, F.concat(sequence, F.lit(".json"))))
        .when(priority == "5-LOW", F.concat_ws("-", status, date, F.concat(sequence, F.lit("000000.json"))))
        .otherwise(F.concat_ws("-", status, F.concat(date, F.lit(".json"))))
    )
    parsed = b.table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file_name"))
    parsed = parsed.withColumn("name", names.parse_file_name(F.col("file_name")))
    return parsed.select(
        "o_orderkey",
        "file_name",
        F.col("name.table_name").alias("table_name"),
        F.col("name.file_date").alias("file_date"),
        F.col("name.sequence").cast("bigint").alias("sequence"),
        F.col("name").isNotNull().alias("is_input"),
    )


def today_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written files of the listed tables, from the listing alone."""
    files = feeds.today_files(spark, b.change_feed(spark, sf_dir), normalise_tables(MESSY_TABLES))
    return files.select(
        "role",
        "table_name",
        "file_date",
        "sequence",
        b.short_path(F.col("file_path")).alias("file_path"),
        "file_name",
        "file_bytes",
    )


def baseline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered lines of what is published."""
    published = feeds.baseline_lines(spark, b.change_published(spark, sf_dir), TABLES)
    return published.select(
        "role",
        "table_name",
        "file_date",
        "sequence",
        b.short_path(F.col("file_path")).alias("file_path"),
        "line_no",
        "raw_line",
    )


def _early_weeks(spark: SparkSession, sf_dir: str) -> list[dt.date]:
    """Dates of the change feed in the first half of a month: a handful per year."""
    day = F.col("file_date")
    rows = b.change_lines(spark, sf_dir).select(day).distinct().filter(F.dayofmonth(day) <= 15)
    return sorted(row.file_date for row in rows.collect())


def run_date_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and published files of given dates, numbered in the order of a run."""
    dates = _early_weeks(spark, sf_dir)
    today = feeds.today_files(spark, b.change_feed(spark, sf_dir), TABLES, dates)
    published = feeds.baseline_files(spark, b.change_published(spark, sf_dir), TABLES, dates)
    place = F.row_number().over(Window.partitionBy("role", "file_date").orderBy(F.lower("table_name"), "sequence", "file_path"))
    return today.unionByName(published).select(
        "role", "file_date", place.alias("place"), b.short_path(F.col("file_path")).alias("file_path")
    )


def run_date_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of given dates, of both roles."""
    dates = _early_weeks(spark, sf_dir)
    today = feeds.today_lines(spark, b.change_feed(spark, sf_dir), TABLES, dates)
    published = feeds.baseline_lines(spark, b.change_published(spark, sf_dir), TABLES, dates)
    return today.unionByName(published).select(
        "role", "table_name", "file_date", b.short_path(F.col("file_path")).alias("file_path"), "line_no", "raw_line"
    )


def allowed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list with repeats, cases, comments and blanks, one line per customer."""
    segment = F.col("c_mktsegment")
    value = (
        F.when(F.col("c_nationkey") < 3, " \t ")
        .when(F.col("c_nationkey") < 8, F.concat(F.lit("\t# "), segment))
        .when(F.col("c_acctbal") < 0, F.concat(F.lit("\t "), F.lower(segment), F.lit(" \t")))
        .otherwise(F.concat_ws("_", segment, "c_nationkey"))
    )
    listed = b.table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("line_no"), value.alias("value")
    )
    return feeds.allowed_tables(listed)


def allowed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the listed tables, by semi-join."""
    listed = spark.createDataFrame(
        list(enumerate(MESSY_TABLES, start=1)), "line_no INT, value STRING"
    )
    kept = feeds.only_allowed(b.event_lines(spark, sf_dir), feeds.allowed_tables(listed))
    return kept.groupBy("table_name", "file_date").agg(F.count("*").alias("line_count"))


def _generated(spark: SparkSession, sf_dir: str, across_files: bool) -> DataFrame:
    specs = (
        b.table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("table_name"), F.trunc(F.to_date("ts"), "month").alias("file_date"))
        .agg(F.count("*").alias("total"))
    )
    return generate_records(specs, records_per_file=500, across_files=across_files)


def generate_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many records per event type and month as there are events."""
    return _generated(spark, sf_dir, across_files=False)


def generate_feed_across_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir, across_files=True)


# --- projections and filters -----------------------------------------------


def blank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-blank lines of every document, under their physical numbers."""
    pieces = F.posexplode(F.split("text", "\r\n|\r|\n"))
    numbered = b.table(spark, sf_dir, "documents").select("doc_id", pieces.alias("at", "raw_line"))
    return numbered.select("doc_id", (F.col("at") + 1).cast("bigint").alias("line_no"), "raw_line").filter(
        ~lines.is_blank(F.col("raw_line"))
    )


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rejects(b.events(spark, sf_dir))
    return found.select("role", "table_name", "file_path", "line_no", "raw_line", "reason")


def json_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("raw_line")
    return b.customer_lines(spark, sf_dir).select(
        "custkey",
        lines.path_text(line, "Source.Table").alias("source_table"),
        lines.path_text(line, "Data.name").alias("name"),
        lines.path_text(line, "Data.nation.key").alias("nation_key"),
        lines.path_text(line, "Data.nation").alias("nation"),
        lines.path_text(line, "Data.absent.key").alias("absent"),
    )


def key_part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("raw_line")
    return b.customer_lines(spark, sf_dir).select(
        "custkey",
        lines.key_part(line, "Source.Table").alias("source_table"),
        lines.key_part(line, "Data.balance").alias("balance"),
        lines.key_part(line, "Data.nation").alias("nation"),
        lines.key_part(line, "Data.nation.key").alias("nation_key"),
    )


def repeated_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that repeat: numbers, fractions and objects; the last one counts."""
    line = F.format_string(
        '{"Data":{"n":0,"balance":1.25,"nation":{"key":-1},"n":%d,"balance":%d.5,"nation":{"key":%d}}}',
        "c_custkey",
        F.floor(F.abs("c_acctbal")).cast("bigint"),
        "c_nationkey",
    )
    rows = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), line.alias("raw_line"))
    line = F.col("raw_line")
    return rows.select(
        "custkey",
        lines.is_json(line).alias("is_json"),
        lines.key_part(line, "Data.n").alias("n"),
        lines.key_part(line, "Data.balance").alias("balance"),
        lines.key_part(line, "Data.nation").alias("nation"),
        lines.key_part(line, "Data.nation.key").alias("nation_key"),
    )


def effective_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    effective = lines.effective_table(F.col("raw_line"), F.col("table_name"))
    return b.customer_lines(spark, sf_dir).select("custkey", effective.alias("effective_table"))


def key_fields_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides by exact case, and by any case when asked."""
    effective = effective_table(spark, sf_dir)
    loose = replace(b.OVERRIDE_CONFIG, case_insensitive_overrides=True)
    return effective.select(
        "custkey",
        "effective_table",
        keys.key_fields(F.col("effective_table"), b.OVERRIDE_CONFIG).alias("fields"),
        keys.key_fields(F.col("effective_table"), loose).alias("fields_any_case"),
    )


def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("raw_line")
    rows = b.customer_lines(spark, sf_dir).withColumn(
        "effective_table", lines.effective_table(line, F.col("table_name"))
    )
    key = keys.dedup_key(line, F.col("effective_table"), b.OVERRIDE_CONFIG)
    return rows.select("custkey", "effective_table", keys.key_hex(key).alias("dedup_key"))


def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived names of every event file, and a cleaned run id."""
    files = b.event_lines(spark, sf_dir).select("role", "table_name", "file_date", "sequence", "file_name").distinct()
    table, sequence = F.col("table_name"), F.col("sequence")
    return files.select(
        "file_name",
        "role",
        names.merged_file_name(table, F.col("file_date")).alias("merged_name"),
        names.partition_name(F.col("role"), table, sequence).alias("partition_name"),
        names.part_file_name(sequence, F.col("file_name")).alias("part_name"),
        names.clean_run_id(F.concat_ws(" / ", "role", "file_name")).alias("run_id"),
    )


def duration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices read as milliseconds: from seconds to hours."""
    millis = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey", millis.alias("millis"), names.duration_text(millis).alias("duration")
    )


def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read per second, of every file of the feed."""
    per_file = counts.file_summary(_event_counts(spark, sf_dir))
    # A file of hour h arrives in h seconds.
    rate = names.throughput(F.col("read_count"), F.col("sequence").cast("bigint"))
    return per_file.select("file_path", F.round(rate, 6).alias("per_second"))


# --- first occurrences -----------------------------------------------------


def baseline_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = hexed(first_seen.baseline_index(b.events(spark, sf_dir)))
    return index.select("scope_table", "file_date", "dedup_key", "first_path", "first_line_no")


PLACE = ["table_name", "file_date", "file_path", "line_no"]


def baseline_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = first_seen.baseline_anti_join(b.events(spark, sf_dir), b.EVENT_CONFIG)
    return kept.select(*PLACE, "raw_line")


def prefiltered_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same behind a Bloom filter of the published keys."""
    kept = prefilter.prefiltered_anti_join(b.events(spark, sf_dir), b.EVENT_CONFIG)
    return kept.select(*PLACE, "raw_line")


def kept_baseline_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the written feed that are in no published file, by the kept keys."""
    baseline = KeptBaseline(spark, b.change_published(spark, sf_dir), KEPT_CONFIG, TABLES)
    baseline.refresh()
    lines_of = feeds.today_lines(spark, b.change_feed(spark, sf_dir), TABLES)
    new = baseline.anti_join(records(prepare(lines_of, b.CHANGE_CONFIG)))
    return new.select("table_name", "file_date", b.short_path(F.col("file_path")).alias("file_path"), "line_no", "raw_line")


def key_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = first_seen.key_membership(b.events(spark, sf_dir), b.EVENT_CONFIG)
    return found.select(*PLACE, "is_known", "first_path", "first_line_no")


def within_batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First occurrences when nothing is published yet."""
    today = b.prepare(b.event_lines(spark, sf_dir).filter(F.col("role") == "TODAY"), b.EVENT_CONFIG)
    return first_seen.survivors(today, ["table_name", "raw_line"]).select(*PLACE, "raw_line")


def full_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's new records: neither published nor seen earlier today."""
    kept = first_seen.survivors(b.events(spark, sf_dir), ["table_name", "raw_line"])
    return kept.select(*PLACE, "sequence", "raw_line")


def full_dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = first_seen.survivors(b.lineitems(spark, sf_dir), ["table_name", "raw_line"])
    return kept.select(*PLACE, "sequence", "raw_line")


def duplicate_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = first_seen.classify(b.events(spark, sf_dir), b.EVENT_CONFIG)
    return hexed(first_seen.duplicates(classified)).drop("dup_kind")


def duplicate_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = first_seen.classify(b.events(spark, sf_dir), b.EVENT_CONFIG)
    return (
        first_seen.duplicates(classified)
        .groupBy("table_name", "file_date", "dup_kind")
        .agg(F.count("*").alias("duplicate_count"))
    )


def hot_key_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that hold all records of a table and date; some go the hot way."""
    prepared = b.prepare(b.event_lines(spark, sf_dir), b.HOT_CONFIG)
    classified = first_seen.classify(prepared, b.HOT_CONFIG)
    return first_seen.duplicates(classified).drop("dedup_key")


# --- counts ----------------------------------------------------------------


def _event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.file_counts(b.events(spark, sf_dir))


def file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.file_summary(_event_counts(spark, sf_dir))


def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.table_summary(_event_counts(spark, sf_dir))


def job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_file = _event_counts(spark, sf_dir)
    left = counts.published_from_counts(per_file, "merge")
    return counts.job_totals(counts.with_output(counts.table_summary(per_file), left))


def output_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published after the run, in both modes."""
    per_file = _event_counts(spark, sf_dir)
    merged = counts.published_from_counts(per_file, "merge")
    replaced = counts.published_from_counts(per_file, "replace")
    return merged.withColumnRenamed("output_count", "merge_count").join(
        replaced.withColumnRenamed("output_count", "replace_count"), ["scope_table", "file_date"]
    )


def input_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical lines of the written feed, per date and table and in total."""
    written = feeds.today_lines(spark, b.change_feed(spark, sf_dir), TABLES, numbered=False)
    return counts.input_volume(written)


def reject_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published files with any malformed line."""
    return counts.reject_threshold(_event_counts(spark, sf_dir), 0)


# --- whole runs over written files -----------------------------------------


def _run(spark: SparkSession, sf_dir: str, **settings) -> str:
    """A daily run over the change feed; returns the output root."""
    published = b.change_published(spark, sf_dir)
    with run_daily(spark, b.change_feed(spark, sf_dir), published, replace(b.CHANGE_CONFIG, **settings)):
        return published


def merged_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published lines and their place in the merge order over all part files."""
    root = _run(spark, sf_dir, publish_mode="replace")
    placed = feeds.baseline_lines(spark, root, TABLES)
    before = Window.partitionBy("table_name", "file_date").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("table_name", "file_date", "file_path").agg(F.count("*").alias("n"))
    files = files.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return placed.join(files.select("file_path", "ahead"), "file_path").select(
        "table_name", "file_date", (F.col("ahead") + F.col("line_no")).alias("merge_position"), "raw_line"
    )


def _published_lines(spark: SparkSession, root: str) -> DataFrame:
    return feeds.baseline_lines(spark, root, TABLES, numbered=False).select("table_name", "file_date", "raw_line")


def publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published_lines(spark, _run(spark, sf_dir, publish_mode="replace", single_file=True))


def publish_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published_lines(spark, _run(spark, sf_dir, publish_mode="merge"))


def kept_baseline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published lines after two runs over the same feed with kept keys; the second adds none."""
    published = b.change_published(spark, sf_dir)
    for _ in range(2):
        with run_daily(spark, b.change_feed(spark, sf_dir), published, KEPT_CONFIG):
            pass
    return _published_lines(spark, published)


def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published lines as readers see them while a run has not moved in a single file."""
    root, config = b.change_published(spark, sf_dir), b.CHANGE_CONFIG
    today = feeds.today_lines(spark, b.change_feed(spark, sf_dir), TABLES, numbered=False)
    lines = today.unionByName(feeds.baseline_lines(spark, root, TABLES, numbered=False))
    kept = staged(first_seen.survivors(prepare(lines, config), place=RUN_PLACE), shared_folder(spark, "survivors"))
    propose(kept, root, config, "waiting")
    lines = snapshot_lines(spark, root, settled(spark, root, TABLES), TABLES)
    return lines.select("table_name", "file_date", "raw_line")


def even_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event lines in 16 output ranges: lines, bytes and first line of each."""
    order = ["table_name", "file_date", "role", "file_path", "line_no"]
    placed = in_even_parts(b.event_lines(spark, sf_dir), order, shared_folder(spark, "parts"), 16)
    first = F.min(F.struct(*order))
    size = F.sum(F.octet_length("raw_line") + F.lit(1))
    parts = placed.groupBy("part").agg(F.count("*").alias("line_count"), size.alias("byte_count"), first.alias("first"))
    return parts.select("part", "line_count", "byte_count", "first.file_path", "first.line_no")


def publish_single_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per table and date, old lines first; their place in it."""
    root = _run(spark, sf_dir, publish_mode="merge", single_file=True)
    placed = feeds.baseline_lines(spark, root, TABLES)
    name = F.element_at(F.split("file_path", "/"), -1).alias("file_name")
    return placed.select("table_name", "file_date", name, F.col("line_no").alias("merge_position"), "raw_line")


def mixed_case_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose files spell the tables of odd sequences in capitals."""
    root = f"{shared_folder(spark, 'mixed')}/feed"
    odd = F.col("sequence") % 2 == 1
    spelled = b.change_lines(spark, sf_dir).withColumn("table_name", F.when(odd, F.upper("table_name")).otherwise(F.col("table_name")))
    write_feed(spelled.filter("role = 'TODAY'"), root, feed_path)
    published = b.change_published(spark, sf_dir)
    with run_daily(spark, root, published, replace(b.CHANGE_CONFIG, tables=MESSY_TABLES)):
        lines_of = feeds.baseline_lines(spark, published, normalise_tables(MESSY_TABLES), numbered=False)
        return lines_of.select(F.lower("table_name").alias("scope_table"), "file_date", "raw_line")


def completion_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the written manifests, with their place."""
    root = _run(spark, sf_dir, publish_mode="merge", single_file=True)
    found = scan_numbered(spark, f"{root}/triggerFile", "*.trg")
    return found.select("file_name", "line_no", F.col("raw_line").alias("line"))


def detail_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = b.events(spark, sf_dir)
    classified = first_seen.classify(prepared, b.EVENT_CONFIG)
    return reports.detail_report(first_seen.duplicates(classified), rejects(prepared)).select("section", "line")


def summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of the summary report, per table and date."""
    per_file = _event_counts(spark, sf_dir)
    left = counts.published_from_counts(per_file, "merge")
    summary = counts.with_output(counts.table_summary(per_file), left)
    return reports.summary_lines(summary, "output").withColumn("line_no", F.col("line_no").cast("bigint"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written feed as a stream, against what is published."""
    job = IncrementalDedup(
        spark,
        b.change_feed(spark, sf_dir),
        shared_folder(spark, "stream"),
        b.CHANGE_CONFIG,
        output_dir=b.change_published(spark, sf_dir),
    )
    job.start().awaitTermination()
    return job.survivors().select(
        "table_name",
        "file_date",
        "sequence",
        b.short_path(F.col("file_path")).alias("file_path"),
        "line_no",
        "raw_line",
    )


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published after the written feed went through a stream that publishes."""
    published = b.change_published(spark, sf_dir)
    state = shared_folder(spark, "stream")
    for _ in range(2):
        # The second start finds nothing new and adds nothing.
        job = IncrementalDedup(spark, b.change_feed(spark, sf_dir), state, b.CHANGE_CONFIG, published, publish=True)
        job.start().awaitTermination()
    return _published_lines(spark, published)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        ndjson_scan,
        file_name_parse,
        today_files,
        baseline_scan,
        run_date_files,
        run_date_lines,
        allowed_tables,
        allowed_rows,
        generate_feed,
        generate_feed_across_files,
        blank_filter,
        json_rejects,
        json_path_extract,
        key_part_text,
        repeated_fields,
        effective_table,
        key_fields_by_table,
        dedup_key,
        output_names,
        duration_text,
        throughput,
        baseline_index,
        baseline_anti_join,
        prefiltered_anti_join,
        kept_baseline_anti_join,
        key_membership,
        within_batch_dedup,
        full_dedup,
        full_dedup_lineitem,
        duplicate_provenance,
        duplicate_kinds,
        hot_key_provenance,
        file_summary,
        table_summary,
        job_totals,
        output_counts,
        input_volume,
        reject_threshold,
        merged_output,
        publish_replace,
        publish_merge,
        kept_baseline_run,
        even_parts,
        snapshot_read,
        publish_single_merge,
        mixed_case_run,
        completion_manifest,
        detail_report,
        summary_report,
        stream_dedup,
        stream_publish,
    )
}
