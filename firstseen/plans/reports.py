"""Report lines: manifest, summary, details of duplicates and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstseen.functions.names import DEFAULT_RUN_ID

# The wording and layout of the report lines below.
RULE = "-" * 72


def completion_manifest(summary: DataFrame) -> DataFrame:
    """table_name, file_date and the ``table,file,count`` line."""
    return summary.select(
        "table_name",
        "file_date",
        F.concat_ws(",", "table_name", "output_file", F.col("output_count").cast("string")).alias("line"),
    )


def _location(line_no: Column, path: Column) -> Column:
    return F.concat(F.lit("Line "), line_no.cast("string"), F.lit(" in "), path)


def duplicate_lines(duplicates: DataFrame) -> DataFrame:
    text = F.concat(
        _location(F.col("line_no"), F.col("file_path")),
        F.lit(" is a duplicate of line "),
        F.col("first_line_no").cast("string"),
        F.lit(" in "),
        F.col("first_path"),
    )
    return duplicates.select(
        F.lit("duplicate").alias("section"), "table_name", "file_date", "file_path", "line_no", text.alias("line")
    )


def reject_lines(rejects: DataFrame) -> DataFrame:
    """Rejects of both roles; a published file can hold malformed lines too."""
    text = F.concat(
        _location(F.col("line_no"), F.col("file_path")),
        F.lit(" has been rejected due to "),
        F.col("reason"),
    )
    return rejects.select(
        F.lit("reject").alias("section"), "table_name", "file_date", "file_path", "line_no", text.alias("line")
    )


def detail_report(duplicates: DataFrame, rejects: DataFrame) -> DataFrame:
    """One line per duplicate and per reject, in two sections."""
    return duplicate_lines(duplicates).unionByName(reject_lines(rejects))


def write_details(details: DataFrame, folder: str) -> None:
    """Ordered part files, duplicates before rejects, written by all tasks."""
    order = ["section", "table_name", "file_date", "file_path", "line_no"]
    details.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(folder)


def summary_block() -> Column:
    """The lines of one table in the summary report, as an array.

    One Spark job does all tables, so a table has no duration of its own.
    """
    number = lambda name: F.col(name).cast("string")
    path = F.concat_ws("/", "output_dir", "table_name", F.date_format("file_date", "yyyy-MM-dd"), "output_file")
    return F.array(
        F.concat("table_name", F.lit(":")),
        F.concat(F.lit("\tTotal Records processed: "), number("total_processed")),
        F.concat(F.lit("\tTotal Rejected: "), number("total_rejected")),
        F.concat(F.lit("\tTotal Duplicates: "), number("total_duplicates")),
        F.concat(F.lit("\tFiles: "), path),
    )


def summary_lines(summary: DataFrame, output_dir: str) -> DataFrame:
    """table_name, file_date, line_no, line: the body of the summary report."""
    return summary.withColumn("output_dir", F.lit(output_dir)).select(
        "table_name", "file_date", F.posexplode(summary_block()).alias("line_no", "line")
    )


def summary_report(summary: DataFrame, date: str, run_id: str, output_dir: str, run_duration: str) -> str:
    """The summary text of one date. A few lines per table; the driver holds them."""
    day = summary.filter(F.col("file_date") == F.lit(date).cast("date"))
    body = summary_lines(day, output_dir).orderBy(F.lower("table_name"), "line_no").collect()
    total = day.agg(F.coalesce(F.sum("total_processed"), F.lit(0)).alias("n")).first().n
    lines = [f"Run ID: {run_id or DEFAULT_RUN_ID}", f"Run Date: {date}", "", "Data Processed Summary:"]
    lines += [row.line for row in body]
    lines += [RULE, f"Grand Total: {total}", f"Duration: {run_duration}"]
    return "\n".join(lines) + "\n"
