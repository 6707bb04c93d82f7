import datetime as dt

import random

import pytest
from pyspark.sql import functions as F

from firstseen.config import normalise_tables
from firstseen.sources import feeds
from firstseen.sources.ndjson import number_lines, read_lines, scan_numbered, split_offsets
from tests.conftest import DAY


@pytest.fixture
def small_splits(spark):
    """Cut files every four kilobytes."""
    saved = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    yield
    for name, value in saved.items():
        spark.conf.set(name, value)


def mixed_file(seed):
    """Random lines with all three line ends, blank lines, none at the end."""
    rng = random.Random(seed)
    lines = ["".join(rng.choices("abcé ", k=rng.choice([0, 3, 40, 400]))) for _ in range(400)] + ["last"]
    ends = [rng.choice(["\n", "\r\n", "\r"]) for _ in lines[:-1]] + [""]
    # A lone \r before an empty line ended by \n would read as one \r\n.
    ends = [
        "\r\n" if end == "\r" and i + 1 < len(lines) and lines[i + 1] == "" and ends[i + 1] != "\r" else end
        for i, end in enumerate(ends)
    ]
    return lines, "".join(line + end for line, end in zip(lines, ends))


def test_line_numbers_across_splits(spark, write, small_splits):
    expected = set()
    for n in (1, 2, 3):
        lines, text = mixed_file(n)
        write(f"in/t-2026-03-11-{n}.json", text)
        expected |= {(f"t-2026-03-11-{n}.json", i, line) for i, line in enumerate(lines, start=1)}
    root = str(write.root / "in")
    assert read_lines(spark, root).select("split_start").distinct().count() > 3
    found = scan_numbered(spark, root)
    assert {(r.file_name, r.line_no, r.raw_line) for r in found.collect()} == expected
    assert found.count() == len(expected)


def test_numbers_without_broadcast(spark, write, small_splits):
    lines, text = mixed_file(5)
    write("in/t-2026-03-11-1.json", text)
    rows = read_lines(spark, str(write.root / "in"))
    numbered = number_lines(rows, split_offsets(rows)).hint("merge")
    assert {(r.line_no, r.raw_line) for r in numbered.collect()} == set(enumerate(lines, start=1))


def test_different_splits_are_noticed(spark, write):
    _, text = mixed_file(6)
    write("in/t-2026-03-11-1.json", text)
    rows = read_lines(spark, str(write.root / "in"))
    offsets = split_offsets(rows).withColumn("first_row", F.col("first_row") + 5)
    with pytest.raises(Exception, match="split differently"):
        number_lines(rows, offsets).collect()


def names_of(files):
    return [(r.table_name, str(r.file_date), r.sequence) for r in files.collect()]


def test_today_files(spark, write):
    for name in ("account-2026-03-11-2", "account-2026-03-11-1", "account-2026-03-10-1", "ignored-2026-03-11-1"):
        write(f"in/x/{name}.json", "{}\n")
    write("in/deep/er/Award-2026-03-11-1.json", "{}\n{}\n")
    write("in/award-2026-03-11-1.txt", "{}\n")
    root = str(write.root / "in")
    found = feeds.today_files(spark, root, ["account", "award"], [DAY])
    day = "2026-03-11"
    assert names_of(found) == [("account", day, 1), ("account", day, 2), ("Award", day, 1)]
    assert [r.file_bytes for r in found.collect()] == [3, 3, 6]
    assert names_of(feeds.today_files(spark, root, ["award"], [DAY])) == [("Award", day, 1)]
    assert len(names_of(feeds.today_files(spark, root, ["account"]))) == 3
    lines = feeds.today_lines(spark, root, ["account", "award"], [DAY])
    assert sorted((r.table_name, r.sequence, r.line_no) for r in lines.collect()) == [
        ("Award", 1, 1), ("Award", 1, 2), ("account", 1, 1), ("account", 2, 1),
    ]


def test_missing_input(spark, write):
    with pytest.raises(FileNotFoundError):
        feeds.today_files(spark, str(write.root / "none"), ["account"], [DAY])


@pytest.mark.parametrize(
    "path", ["in/_t-2026-03-11-1.json", "in/a/b/c/d/e/f/_t-2026-03-11-1.json", "in/_batch/t-2026-03-11-1.json", "in/x/.y/z/t-2026-03-11-1.json"]
)
def test_hidden_files_are_refused(spark, write, path):
    """Spark skips every name that starts with _ or a dot; a run must not."""
    write("in/t-2026-03-11-2.json", "{}\n")
    write(path, "{}\n")
    root = str(write.root / "in")
    with pytest.raises(ValueError, match="does not read"):
        feeds.today_files(spark, root, ["_t", "t"], [DAY])
    with pytest.raises(ValueError, match="does not read"):
        feeds.today_lines(spark, root, ["_t", "t"])
    # Files of other tables and dates are none of this run's.
    assert feeds.today_files(spark, root, ["other"], [DAY]).count() == 0
    assert feeds.today_files(spark, root, ["_t", "t"], [dt.date(2026, 3, 12)]).count() == 0


def test_files_deep_down_are_read(spark, write):
    write("in/1/2/3/4/5/6/7/8/t-2026-03-11-1.json", "{}\n")
    assert feeds.today_lines(spark, str(write.root / "in"), ["t"], [DAY]).count() == 1


@pytest.mark.parametrize("path", ["out/account/2026-03-11/_old.json", "out/account/2026-03-11/_x/old.json", "out/_t/2026-03-11/old.json"])
def test_hidden_published_files_are_refused(spark, write, path):
    write("out/account/2026-03-11/seen.json", "{}\n")
    write("out/account/2026-03-11/.seen.json.crc", "")
    write("out/_firstseen/1/output_table=account/file_date=2026-03-11/part-0.txt", "{}\n")
    root = str(write.root / "out")
    assert feeds.baseline_lines(spark, root, ["account", "_t"], [DAY]).count() == 1
    write(path, "{}\n")
    for dates in ([DAY], []):
        with pytest.raises(ValueError, match="does not read"):
            feeds.baseline_lines(spark, root, ["account", "_t"], dates)
    assert feeds.baseline_lines(spark, root, ["account", "_t"], [dt.date(2026, 3, 12)]).count() == 0


def test_baseline(spark, write):
    for path in (
        "out/account/2026-03-11/MERGED=account-2026-03-11.json",
        "out/account/2026-03-11/deep/any name.json",
        "out/award/2026-03-11/a.json",
        "out/account/2026-03-10/a.json",
        "out/2026-03-11/x.json",
        "out/account/2026-03-11/a.txt",
        "out/other/2026-03-11/a.json",
        "out/account/2026-99-11/a.json",
        "out/triggerFile/2026-03-11.trg",
    ):
        write(path, '{"a":1}\n')
    root = str(write.root / "out")
    files = feeds.baseline_files(spark, root, ["account", "award"], [DAY])
    assert [(r.table_name, r.sequence, r.role) for r in files.collect()] == [
        ("account", 1, "PRIOR"), ("account", 1, "PRIOR"), ("award", 1, "PRIOR"),
    ]
    assert feeds.baseline_lines(spark, root, ["account", "award"], [DAY]).count() == 3
    assert feeds.baseline_lines(spark, root, ["account", "award"]).count() == 4


def test_missing_baseline(spark, write):
    root = str(write.root / "none")
    assert feeds.baseline_files(spark, root, ["account"], [DAY]).count() == 0
    assert feeds.baseline_lines(spark, root, ["account"], [DAY]).count() == 0
    empty = write("plain", "").parent
    assert feeds.baseline_lines(spark, str(empty), ["account"], [DAY]).count() == 0
    with pytest.raises(NotADirectoryError):
        feeds.baseline_lines(spark, str(empty / "plain"), ["account"], [DAY])


def test_allowed_tables(spark, write):
    path = write("tables.txt", "account\n# comment\n award \ncore_PlasticHistory\naccount\n\n")
    assert feeds.resolve_tables(spark, ["other"], str(path)) == ["account", "award", "core_plastichistory"]
    assert feeds.resolve_tables(spark, [" account ", "Award", "", "award"], None) == ["account", "award"]
    tabs = write("tabs.txt", "\taccount\r\n\t# note\n\x0b award\t\n")
    assert feeds.resolve_tables(spark, [], str(tabs)) == ["account", "award"]
    assert normalise_tables(["", "\taccount \x01"]) == ["account"]
    with pytest.raises(ValueError):
        feeds.resolve_tables(spark, [" "], None)
    with pytest.raises(ValueError):
        feeds.resolve_tables(spark, ["account"], str(write("blank.txt", "\n  \n# only\n")))
    with pytest.raises(Exception):
        feeds.resolve_tables(spark, ["account"], str(write.root / "none.txt"))
