import random
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from firstseen.columns import GROUP, POSITION
from firstseen.config import DedupConfig
from firstseen.operators import counts, first_seen
from firstseen.operators.prepare import prepare, records, rejects
from tests import brute
from tests.conftest import DAY

FIELDS = ("k", "n.m")
CONFIG = DedupConfig(key_fields=FIELDS)
LINES = [
    '{"k":1}', '{"k":"1"}', '{"k":2,"n":{"m":true}}', '{"k":2,"n":{"m":"true"}}', "{}", "123", "[1]", "null",
    '{"k":{"b":1,"a":2}}', '{"k":{"a":2,"b":1}}', '{"Source":{"Table":"b"},"k":1}', '{"k":3} x', '{"k":', "  ", "",
    '{"k":1}]', '{"n":{"m":null}}', '{"k":"<null>"}',
]


def random_files(seed):
    rng = random.Random(seed)
    files = []
    for role in ("PRIOR", "TODAY"):
        for table in ("a", "A", "b"):
            for sequence in range(1, rng.randint(1, 4)):
                number = 1 if role == "PRIOR" else sequence
                lines = [
                    f'{{"k":{rng.randint(1, 40)}}}' if rng.random() < 0.5 else rng.choice(LINES)
                    for _ in range(rng.randint(0, 25))
                ]
                files.append((role, table, number, f"{role}/{table}/{sequence}", lines))
    return files


def frame(spark, files):
    rows = [
        (role, int(role == "TODAY"), table, DAY, sequence, path, path, n, line)
        for role, table, sequence, path, lines in files
        for n, line in enumerate(lines, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "role STRING, role_rank INT, table_name STRING, file_date DATE, sequence INT, file_path STRING, "
        "file_name STRING, line_no BIGINT, raw_line STRING",
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot", [1, 5, 1_000_000])
def test_against_brute_force(spark, seed, hot):
    """Whatever share of the keys goes the hot way."""
    files = random_files(seed)
    survivors, duplicates, rejected = brute.run(files, FIELDS)
    config = replace(CONFIG, hot_min_copies=hot, hot_keys=3)
    prepared = prepare(frame(spark, files), config)
    assert sorted((r.file_path, r.line_no) for r in first_seen.survivors(prepared).collect()) == sorted(survivors)
    classified = first_seen.classify(prepared, config)
    found = first_seen.duplicates(classified).collect()
    assert sorted((r.file_path, r.line_no, r.first_path, r.first_line_no, r.dup_kind) for r in found) == sorted(
        duplicates
    )
    kept = classified.filter("status = 'survivor'").collect()
    assert sorted((r.file_path, r.line_no) for r in kept) == sorted(survivors)
    assert sorted((r.file_path, r.line_no) for r in rejects(prepared).collect()) == sorted(rejected)
    assert classified.count() == sum(len(f[4]) for f in files)


@pytest.mark.parametrize("hot", [2, 1_000_000])
def test_membership(spark, hot):
    files = random_files(11)
    config = replace(CONFIG, hot_min_copies=hot, hot_keys=2)
    prepared = prepare(frame(spark, files), config)
    index = {(r.dedup_key, r.scope_table): (r.first_path, r.first_line_no) for r in first_seen.baseline_index(prepared).collect()}
    today = records(prepared).filter("role = 'TODAY'").collect()
    found = first_seen.key_membership(prepared, config).collect()
    assert len(found) == len(today)
    for r in found:
        assert (r.first_path, r.first_line_no) == index.get((r.dedup_key, r.scope_table), (None, None))
        assert r.is_known == ((r.dedup_key, r.scope_table) in index)
    unknown = {(r.file_path, r.line_no) for r in found if not r.is_known}
    left = first_seen.baseline_anti_join(prepared, config).collect()
    assert {(r.file_path, r.line_no) for r in left} == unknown and len(left) == len(unknown)


def test_window_agrees(spark):
    """The plain window form, right for keys of few copies, keeps the same rows."""
    prepared = prepare(frame(spark, random_files(5)), CONFIG)
    w = Window.partitionBy(*GROUP).orderBy(*POSITION)
    plain = records(prepared).withColumn("n", F.row_number().over(w)).filter("n = 1 AND role_rank = 1")
    place = ["file_path", "line_no", "raw_line"]
    assert sorted(plain.select(*place).collect()) == sorted(first_seen.survivors(prepared).select(*place).collect())


def test_partition_count_does_not_matter(spark):
    prepared = prepare(frame(spark, random_files(6)), CONFIG)
    results = []
    for partitions in (1, 3, 16):
        moved = prepared.repartition(partitions)
        results.append(sorted(first_seen.duplicates(first_seen.classify(moved, CONFIG)).collect()))
    assert results[0] == results[1] == results[2]


def test_counts(spark):
    files = random_files(7)
    survivors, duplicates, rejected = brute.run(files, FIELDS)
    prepared = prepare(frame(spark, files), CONFIG)
    per_file = counts.file_counts(prepared)
    same = counts.file_counts_of(first_seen.classify(prepared, CONFIG)).select(*per_file.columns)
    assert sorted(per_file.collect()) == sorted(same.collect())
    lengths = {f[3]: len(f[4]) for f in files}
    for r in per_file.collect():
        assert r.read_count == r.written_count + r.filtered_count
        assert r.read_count + r.skipped_count + r.blank_count == lengths[r.file_path]
    today = counts.table_summary(per_file).collect()
    assert sum(r.total_processed for r in today) == len(survivors) + len(duplicates)
    assert sum(r.total_duplicates for r in today) == len(duplicates)
    assert sum(r.total_rejected for r in today) == len([p for p, _ in rejected if p.startswith("TODAY")])
    # Files of A and a form one table.
    assert len(today) == len({f[1].lower() for f in files if f[0] == "TODAY" and f[4]})
    worst = counts.reject_threshold(per_file, 0).collect()
    assert {r.file_path for r in worst} == {p for p, _ in rejected if p.startswith("PRIOR")}


# Parsing of values again is for the few that are fractions or containers.
WHOLE_LINE = "parseJson(concat("


def test_one_parse_per_scan(spark):
    """Filters on line kind and key stay above the parsing projection."""
    prepared = prepare(frame(spark, random_files(8)), CONFIG)
    plan = first_seen.survivors(prepared)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(WHOLE_LINE) == 1
    per_file = counts.file_counts(prepared)
    for frame_of in (per_file, counts.table_summary(per_file)):
        plan = frame_of._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(WHOLE_LINE) == 1 and "Join" not in plan and "Union" not in plan
