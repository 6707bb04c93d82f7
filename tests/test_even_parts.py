"""Output ranges cut by bytes, against a running sum by hand."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from firstseen.config import DedupConfig
from firstseen.plans.even_parts import in_even_parts, part_count
from firstseen.plans.publish import publish
from tests.conftest import DAY

ORDER = ["output_table", "file_date", "sequence", "file_path", "split_start", "row_id"]
SCHEMA = (
    "output_table STRING, file_date DATE, sequence INT, file_path STRING, split_start BIGINT, row_id BIGINT, raw_line STRING"
)


def random_lines(seed, n):
    """Splits of several files and tables; some lines are empty, some long, some not ASCII."""
    rng, rows = random.Random(seed), []
    for row in range(n):
        table, number, split = rng.choice("ab"), rng.randint(1, 3), rng.choice([0, 100, 1000])
        text = rng.choice(["", "x" * rng.randint(0, 30), "ä€" * rng.randint(0, 9), "y" * rng.randint(0, 400)])
        rows.append((table, DAY, number, f"{table}{number}", split, split * 1000 + row, text))
    return rows


@pytest.mark.parametrize("parts", [2, 5, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_parts_by_hand(spark, tmp_path, seed, parts):
    rows = random_lines(seed, 400)
    size = sum(len(r[-1].encode()) + 1 for r in rows)
    step, ahead, expected = -(-size // parts), 0, defaultdict(list)
    for row in sorted(rows, key=lambda r: r[:-1]):
        expected[ahead // step].append(row[-1])
        ahead += len(row[-1].encode()) + 1
    frame = in_even_parts(spark.createDataFrame(rows, SCHEMA), ORDER, str(tmp_path / "scratch"), parts)
    found = defaultdict(list)
    for row in frame.withColumn("here", F.spark_partition_id()).collect():
        assert row.here == row.part
        found[row.part].append(row.raw_line)
    assert found == expected


def test_no_lines_and_one_part(spark, tmp_path):
    assert in_even_parts(spark.createDataFrame([], SCHEMA), ORDER, str(tmp_path / "none"), 3).collect() == []
    assert in_even_parts(spark.createDataFrame([], SCHEMA), ORDER, str(tmp_path / "empty")).collect() == []
    rows = random_lines(3, 50)
    frame = in_even_parts(spark.createDataFrame(rows, SCHEMA), ORDER, str(tmp_path / "one"), 1)
    assert [tuple(r)[:-1] for r in frame.collect()] == sorted(rows, key=lambda r: r[:-1])


def test_a_line_longer_than_a_part(spark, tmp_path):
    rows = [("a", DAY, 1, "f", 0, n, "z" * (5000 if n == 1 else 5)) for n in range(6)]
    frame = in_even_parts(spark.createDataFrame(rows, SCHEMA), ORDER, str(tmp_path / "scratch"), 10)
    kept = sorted((r.part, r.row_id) for r in frame.collect())
    assert [row for _, row in kept] == list(range(6))
    assert len({part for part, row in kept if row >= 2}) == 1


def published_sizes(spark, root, rows, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).select(
        F.col("output_table").alias("scope_table"), F.col("output_table").alias("table_name"), *ORDER[1:], "raw_line"
    )
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        publish(frame, str(root), DedupConfig(tables=["account"]), "run")
    finally:
        for name in settings:
            spark.conf.unset(name)
    files = sorted((root / "account" / str(DAY)).glob("*.json"))
    return [f.stat().st_size for f in files], "".join(f.read_text() for f in files)


@pytest.mark.parametrize("together", [True, False])
def test_long_lines_do_not_make_a_long_part(spark, tmp_path, together):
    """A hundredth of the lines has 1 MB; the longest part is within twice the median."""
    rng = random.Random(7)
    long = set(range(2970, 3000)) if together else set(rng.sample(range(3000), 30))
    rows = [
        ("account", DAY, 1, "f", 0, n, f"{n}:" + "v" * (1 << 20 if n in long else 100)) for n in range(3000)
    ]
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4MB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    sizes, text = published_sizes(spark, tmp_path / "out", rows, **settings)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) >= 6
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    assert [int(line.split(":")[0]) for line in text.splitlines()] == list(range(3000))
    assert not list((tmp_path / "out" / "_firstseen").iterdir())


def test_number_of_parts(spark):
    names = {
        "spark.sql.shuffle.partitions": "10",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100b",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        assert [part_count(spark, size) for size in (0, 1, 100, 101, 950, 10**15)] == [1, 1, 1, 2, 10, 10]
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert part_count(spark, 1) == 10
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for name in list(names)[1:]:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
