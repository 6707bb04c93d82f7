"""The levels of a stream's key index."""

import pytest
from pyspark.sql import functions as F

from firstseen.streaming.key_index import BASELINE_BATCH, KeyIndex, LostKeys

SCHEMA = "k BIGINT, file_date DATE"
ROWS = 20


def keys_of(spark, number):
    rows = spark.range(ROWS * number, ROWS * (number + 1), numPartitions=1)
    return rows.select(F.col("id").alias("k"), F.date_add(F.lit("2026-03-01").cast("date"), (F.col("id") % 2).cast("int")).alias("file_date"))


def found(index, number):
    return sorted(row.k for row in index.before(number).collect())


class Counting(KeyIndex):
    """Remembers how many rows were written again."""

    rewritten = 0

    def _write(self, rows, folder):
        super()._write(rows, folder)
        if "/through=" in folder:
            self.rewritten += self.spark.read.parquet(folder).count()


def test_a_key_is_rewritten_once_per_level(spark, tmp_path):
    index, at = Counting(spark, str(tmp_path / "keys"), SCHEMA, 4), {}
    for number in range(64):
        index.add(keys_of(spark, number), number)
        assert len(index.folders(number + 1)) <= 3 * 3 + 1
        at[number + 1] = index.rewritten
    assert len(index.folders(64)) == 1 and found(index, 64) == list(range(64 * ROWS))
    # Three levels of four: every key at most three times, and n log n in between.
    assert at[64] <= 3 * 64 * ROWS and at[16] <= 2 * 16 * ROWS and at[4] == 4 * ROWS
    # What writing the whole index every four batches would cost.
    assert at[64] < sum(4 * k * ROWS for k in range(1, 17)) / 3
    assert {p.name for p in (tmp_path / "keys").iterdir() if "=" in p.name} == {"through=63"}


@pytest.mark.parametrize("number", [0, 1, 5, 8, 11])
def test_a_batch_is_replayed(spark, tmp_path, number):
    index = KeyIndex(spark, str(tmp_path / "keys"), SCHEMA, 3)
    for n in range(number + 1):
        index.add(keys_of(spark, n), n)
    # The last batch was written, perhaps merged, and comes once more.
    assert found(index, number) == list(range(number * ROWS))
    index.add(keys_of(spark, number), number)
    assert found(index, number + 1) == list(range((number + 1) * ROWS))


@pytest.mark.parametrize("step", ["_write", "write_text", "remove_folder"])
def test_a_merge_that_dies(spark, tmp_path, monkeypatch, step):
    index = KeyIndex(spark, str(tmp_path / "keys"), SCHEMA, 2)
    for n in range(3):
        index.add(keys_of(spark, n), n)
    holder = index if step == "_write" else index._storage
    real, calls = getattr(holder, step), []

    def dying(*args):
        calls.append(args)
        if len(calls) == 2 or step == "write_text":
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(holder, step, dying)
    with pytest.raises(OSError):
        index.add(keys_of(spark, 3), 3)
    monkeypatch.undo()
    assert found(index, 3) == list(range(3 * ROWS))
    index.add(keys_of(spark, 3), 3)
    for n in range(4, 8):
        index.add(keys_of(spark, n), n)
    assert found(index, 8) == list(range(8 * ROWS)) and len(index.folders(8)) == 1


def test_baseline_stays_and_fanout_may_change(spark, tmp_path):
    folder = str(tmp_path / "keys")
    index = KeyIndex(spark, folder, SCHEMA, 2)
    assert not index.has_baseline() and found(index, 0) == []
    index.add(keys_of(spark, 100), BASELINE_BATCH)
    for n in range(6):
        index.add(keys_of(spark, n), n)
    other = KeyIndex(spark, folder, SCHEMA, 3)
    for n in range(6, 9):
        other.add(keys_of(spark, n), n)
    assert found(other, 9) == [*range(9 * ROWS), *range(100 * ROWS, 101 * ROWS)]
    assert other.folders(9) == [f"{folder}/batch=-1", f"{folder}/through=8"]


def test_lost_keys_are_noticed(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), SCHEMA, 4)
    for n in range(3):
        index.add(keys_of(spark, n), n)
    index._storage.remove_folder(f"{index.folder}/batch=1")
    with pytest.raises(LostKeys, match="batch 1"):
        index.before(3)
