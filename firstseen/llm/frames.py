"""Reading tables and cutting lineage, shared by the corpus operators."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.storage import shared_folder

# Rows of whole texts handed to a Python worker at once. Texts may be long.
TEXT_ROWS_PER_BATCH = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker holds of a column of long texts.

    Workers of a local session also learn where this package lies; a cluster gets
    it with the job (``--py-files``).
    """
    context, root = spark.sparkContext, str(Path(__file__).resolve().parents[2])
    if context.master.startswith("local["):
        known = context.environment.get("PYTHONPATH", "")
        if root not in known.split(":"):
            context.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))
    return spark


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it again.

    The plan above it is then computed once, and a lost executor costs a re-read.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def texts(documents: DataFrame) -> DataFrame:
    """doc_id and the text, null taken as empty; other columns are left behind."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def fresh_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the frame is called so."""
    taken = {column.lower() for column in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found
