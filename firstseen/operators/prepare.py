"""Envelope rows to prepared rows: line kind, reject reason, scope and key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.columns import GROUP
from firstseen.config import DedupConfig
from firstseen.functions.keys import all_fields, dedup_key
from firstseen.functions.lines import (
    INVALID_ENCODING,
    INVALID_FORMAT,
    INVALID_TABLE,
    SOURCE_TABLE,
    is_blank,
    is_container,
    is_whole,
    parse,
    value_at,
    value_text,
)

BLANK, REJECT, RECORD = "blank", "reject", "record"


def prepare(lines: DataFrame, config: DedupConfig) -> DataFrame:
    """Add ``line_kind``, ``reason``, ``effective_table``, ``scope_table``, ``dedup_key``.

    A narrow projection that parses each line once. Every line stays, blank ones
    too: they hold their place in the line numbers. Copies are looked for among
    the files of one table, whatever the case of its name, and one date.
    """
    line, parsed = F.col("raw_line"), F.col("_parsed")
    paths = list(dict.fromkeys([SOURCE_TABLE, *all_fields(config)]))
    values = {path: f"_value{n}" for n, path in enumerate(paths)}
    texts = {path: f"_text{n}" for n, path in enumerate(paths)}
    source_value, source_text = F.col(values[SOURCE_TABLE]), F.col(texts[SOURCE_TABLE])
    record = F.col("line_kind") == RECORD

    read = (
        lines.withColumn("_blank", is_blank(line))
        .withColumn("_parsed", F.when(~F.col("_blank"), parse(line)))
        .withColumns({name: value_at(parsed, path) for path, name in values.items()})
    )
    reason = (
        F.when(F.col("_blank"), None)
        .when(~F.is_valid_utf8(line), INVALID_ENCODING)
        .when(~is_whole(parsed, line), INVALID_FORMAT)
        .when(is_container(source_value), INVALID_TABLE)
    )
    kind = F.when(F.col("_blank"), BLANK).when(F.col("reason").isNotNull(), REJECT).otherwise(RECORD)
    judged = (
        read.withColumn("reason", reason)
        .withColumn("line_kind", kind)
        .withColumns({texts[p]: F.when(record, value_text(F.col(values[p]), line, p)) for p in paths})
        .withColumn("scope_table", F.lower("table_name"))
        .withColumn("effective_table", F.when(record, F.coalesce(source_text, F.col("table_name"))))
    )
    known = {path: F.col(name) for path, name in texts.items()}
    key = dedup_key(line, F.col("effective_table"), config, known)
    # Always true, but not known to be so: filters on the columns above stay
    # above this projection. Pushed below it, each would parse the line again.
    here = F.spark_partition_id() >= 0
    return judged.withColumn("dedup_key", F.when(record & here, key)).drop(
        "_blank", "_parsed", *values.values(), *texts.values()
    )


def records(prepared: DataFrame) -> DataFrame:
    """The valid lines. They all have a key; saying so lets grouped plans be shared."""
    keyed = F.col("line_kind") == RECORD
    for column in GROUP:
        keyed = keyed & F.col(column).isNotNull()
    return prepared.filter(keyed)


def rejects(prepared: DataFrame) -> DataFrame:
    """The malformed lines of both roles, with where and why."""
    return prepared.filter(F.col("line_kind") == REJECT).select(
        "role", "table_name", "file_date", "file_path", "line_no", "raw_line", "reason"
    )
