"""Feeds derived from the driver's tables, whole, for the registered queries.

Four feeds:

``event_lines``     an envelope over ``events``: the JSON of ``props``, keyed by ``k``
``change_lines``    nested change records made of ``events``, keyed by the default
                    fields; also written out as files by ``change_files``
``customer_lines``  nested JSON with null, missing, number and object values
``lineitem_lines``  the widest table, keyed by two numbers

Some lines arrive damaged or blank, decided by the ``value`` of the event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.columns import ENVELOPE, role_rank
from firstseen.config import DedupConfig
from firstseen.operators.prepare import prepare
from firstseen.sources.generate import feed_path, published_path, write_feed
from firstseen.storage import shared_folder

EVENT_CONFIG = DedupConfig(key_fields=("k",), tables=("view", "error", "signup", "click", "purchase"))
CHANGE_CONFIG = DedupConfig(tables=EVENT_CONFIG.tables)
LINEITEM_CONFIG = DedupConfig(key_fields=("Data.p", "Data.s"))
# Every record of a table and date has this key: none has the field.
HOT_CONFIG = DedupConfig(key_fields=("absent",), hot_min_copies=50, hot_keys=60)
OVERRIDE_CONFIG = DedupConfig(
    key_fields=("Source.Table", "Data.name"),
    table_key_fields={"BUILDING": ("Data.balance",), "MACHINERY": ("Data.balance",), "furniture": ("Data.nation",)},
)

RECORDS_PER_SEQUENCE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def _role() -> Column:
    return F.when(F.hour("ts") < 6, "PRIOR").otherwise("TODAY")


def _with_place(lines: DataFrame) -> DataFrame:
    """Complete an envelope that has role, table, date, sequence, line and text."""
    name = F.concat_ws("-", "table_name", _day(F.col("file_date")), F.concat(F.col("sequence").cast("string"), F.lit(".json")))
    return (
        lines.withColumn("role_rank", role_rank(F.col("role")))
        .withColumn("file_name", name)
        .withColumn("file_path", F.concat_ws("/", F.lower("role"), "table_name", "file_name"))
        .select(*ENVELOPE)
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event; an hour of an event type and day is a file."""
    damaged = F.translate("props", "}", "")
    line = F.when(F.col("value") < 1, damaged).when(F.col("value") < 2, "  ").otherwise(F.col("props"))
    columns = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", "props")
    return _with_place(
        columns.select(
            _role().alias("role"),
            F.col("event_type").alias("table_name"),
            F.to_date("ts").alias("file_date"),
            (F.hour("ts") + 1).alias("sequence"),
            (F.col("event_id") + 1).alias("line_no"),
            line.alias("raw_line"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(event_lines(spark, sf_dir), EVENT_CONFIG)


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """role, table_name, file_date, sequence, line_no, raw_line.

    Dates are weeks. A sequence holds a thousand consecutive events, so files
    stay small however many events there are. ``line_no`` orders a file's lines;
    it becomes the physical number only when written.
    """
    time = F.concat(_day(F.to_date("ts")), F.lit("T00:00:00.00Z"))
    body = F.format_string(
        '{"Source":{"Table":"%s","System":"CORE"},'
        '"ChangeData":{"id":"%s","ChangeDateTime":"%s","Operation":"UPSERT"},'
        '"Data":{"_creationdate":"%s","detail":%s}',
        "event_type",
        F.lpad(F.col("user_id").cast("string"), 12, "0"),
        time,
        time,
        "props",
    )
    line = F.when(F.col("value") < 1, body).when(F.col("value") < 2, "  ").otherwise(F.concat(body, F.lit("}")))
    return table(spark, sf_dir, "events").select(
        _role().alias("role"),
        F.col("event_type").alias("table_name"),
        F.trunc(F.to_date("ts"), "week").alias("file_date"),
        (F.floor(F.col("event_id") / RECORDS_PER_SEQUENCE) + 1).cast("int").alias("sequence"),
        F.col("event_id").alias("line_no"),
        line.alias("raw_line"),
    )


_WRITTEN: dict[tuple[str, str], str] = {}


def change_feed(spark: SparkSession, sf_dir: str) -> str:
    """Write today's change lines as raw files once per session; the input root."""
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _WRITTEN:
        root = shared_folder(spark, "changes")
        write_feed(change_lines(spark, sf_dir).filter("role = 'TODAY'"), f"{root}/feed", feed_path)
        _WRITTEN[slot] = f"{root}/feed"
    return _WRITTEN[slot]


def change_published(spark: SparkSession, sf_dir: str) -> str:
    """A new output root that already holds the earlier change lines."""
    root = f"{shared_folder(spark, 'changes')}/published"
    write_feed(change_lines(spark, sf_dir).filter("role = 'PRIOR'"), root, published_path)
    return root


def short_path(path: Column) -> Column:
    """``feed/...`` or ``published/...`` of a written file."""
    return F.regexp_replace(path, r"^.*/(feed|published)/", "$1/")


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey, table_name, raw_line. What is missing or null depends on the row."""
    cents = F.round(F.abs("c_acctbal") * 100).cast("bigint")
    balance = F.concat(
        F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")
    )
    source = (
        F.when(F.col("c_acctbal") < 0, '"Source":{"Table":null},')
        .when(F.col("c_nationkey") < 5, "")
        .otherwise(F.concat(F.lit('"Source":{"Table":"'), "c_mktsegment", F.lit('"},')))
    )
    nation = F.when(F.col("c_nationkey") > 20, F.lit("null")).otherwise(
        F.format_string('{"key": %d, "tags":["n", %d]}', "c_nationkey", "c_nationkey")
    )
    line = F.concat(
        F.lit("{"),
        source,
        F.format_string('"Data":{"name":"%s","balance":%s,"nation":%s}}', "c_name", balance, nation),
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.lit("customer").alias("table_name"), line.alias("raw_line")
    )


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per line item; a return flag is a table, a line number a file."""
    columns = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"
    )
    return _with_place(
        columns.select(
            F.when(F.col("l_linenumber") <= 2, "PRIOR").otherwise("TODAY").alias("role"),
            F.col("l_returnflag").alias("table_name"),
            F.lit("2024-01-01").cast("date").alias("file_date"),
            F.col("l_linenumber").cast("int").alias("sequence"),
            F.col("l_orderkey").alias("line_no"),
            F.format_string('{"Data":{"p":%d,"s":%d}}', "l_partkey", "l_suppkey").alias("raw_line"),
        )
    )


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(lineitem_lines(spark, sf_dir), LINEITEM_CONFIG)
