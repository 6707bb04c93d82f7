import datetime as dt

import pytest
from pyspark.sql import functions as F

from firstseen.functions import names
from firstseen.plans.daily import duration

CASES = [
    ("account-2026-03-11-2.json", ("account", dt.date(2026, 3, 11), 2)),
    ("account-2026-03-11-0.json", None),
    ("account-2026-03-11-25.json", ("account", dt.date(2026, 3, 11), 25)),
    ("account-2026-03-11-1.txt", None),
    ("account-2026-13-11-1.json", None),
    ("account-2026-02-30-1.json", None),
    ("account-2026-03-11-1.csv", None),
    ("account-2026-03-11.json", None),
    ("core_PlasticHistory-2026-03-11-1.json", ("core_PlasticHistory", dt.date(2026, 3, 11), 1)),
    ("account-2026-03-11-99999999999.json", None),
    ("my-account-2026-03-11-1.json", None),
]


def test_file_names(spark):
    rows = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(CASES)], "i INT, name STRING")
    found = rows.select("i", names.parse_file_name(F.col("name")).alias("p")).orderBy("i").collect()
    assert [tuple(r.p) if r.p else None for r in found] == [expected for _, expected in CASES]


@pytest.mark.parametrize(
    "millis, text", [(3_723_004, "1h 2m 3.004s"), (135_123, "2m 15.123s"), (999, "0.999s"), (3_600_000, "1h 0m 0.000s")]
)
def test_durations(spark, millis, text):
    assert spark.range(1).select(names.duration_text(F.lit(millis))).first()[0] == text
    assert duration(millis / 1000) == text


def test_derived_names(spark):
    row = spark.range(1).select(
        names.merged_file_name(F.lit("account"), F.lit("2026-03-11").cast("date")),
        names.partition_name(F.lit("TODAY"), F.lit("account"), F.lit(3)),
        names.part_file_name(F.lit(3), F.lit("account-2026-03-11-3.json")),
        names.clean_run_id(F.lit("a b/c:1")),
        names.clean_run_id(F.lit("  ")),
        names.throughput(F.lit(10), F.lit(0.5)),
    )
    assert tuple(row.first()) == (
        "MERGED=account-2026-03-11.json",
        "today-account-3",
        "03-account-2026-03-11-3.json.part",
        "a_b_c_1",
        "default",
        10.0,
    )
