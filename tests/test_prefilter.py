"""The Bloom filter of published keys."""


import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from firstseen.operators import first_seen, prefilter
from firstseen.operators.prepare import prepare
from tests.conftest import DAY
from tests.test_first_seen import CONFIG, frame, random_files

SCHEMA = "dedup_key BINARY, scope_table STRING, file_date DATE"


def keys_of(spark, numbers):
    return spark.createDataFrame([(k.to_bytes(32, "big"), "t", DAY) for k in numbers], SCHEMA)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(known=st.sets(st.integers(0, 10**6), min_size=1, max_size=300), blocks=st.sampled_from([1, 2, 7]))
def test_no_known_key_is_taken_for_new(spark, known, blocks):
    parts = [list(known)[::2], list(known)[1::2]]
    built = [prefilter.build(keys_of(spark, part), F.lit(blocks)) for part in parts]
    found = prefilter.with_presence(keys_of(spark, known), prefilter.combined(built[0].unionByName(built[1])))
    assert found.filter("maybe_known").count() == len(known)


def test_few_new_keys_get_through(spark):
    keys = spark.range(200_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("dedup_key"), F.lit("t").alias("scope_table"), F.lit(DAY).alias("file_date"))
    known, today = keys.limit(100_000), keys
    bitmaps = prefilter.build(known, F.lit(prefilter.blocks_for(100_000)))
    assert bitmaps.count() <= prefilter.blocks_for(100_000)
    let_through = prefilter.with_presence(today.exceptAll(known), bitmaps).filter("maybe_known").count()
    # A feed of new keys: the join gets less than a twentieth of it.
    assert let_through < 100_000 / 100


def test_other_dates_and_tables_are_new(spark):
    bitmaps = prefilter.build(keys_of(spark, range(50)), F.lit(1))
    other = keys_of(spark, range(50)).withColumn("file_date", F.date_add("file_date", 1))
    assert prefilter.with_presence(other, bitmaps).filter("maybe_known").count() == 0
    none = keys_of(spark, range(50)).withColumn("scope_table", F.lit("u"))
    assert prefilter.with_presence(none, bitmaps).filter("maybe_known").count() < 10


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_anti_join_with_and_without(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(prefilter, "BROADCAST_BYTES", limit)
    prepared = prepare(frame(spark, random_files(seed)), CONFIG)
    place = ["file_path", "line_no", "raw_line"]
    found = prefilter.prefiltered_anti_join(prepared, CONFIG).select(*place)
    expected = first_seen.baseline_anti_join(prepared, CONFIG).select(*place)
    assert sorted(found.collect()) == sorted(expected.collect())


def test_nothing_published(spark):
    files = [f for f in random_files(9) if f[0] == "TODAY"]
    prepared = prepare(frame(spark, files), CONFIG)
    assert prefilter.prefiltered_anti_join(prepared, CONFIG).count() == first_seen.baseline_anti_join(prepared, CONFIG).count()
