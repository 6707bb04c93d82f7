"""A stream that publishes: every batch once, whatever dies."""

from dataclasses import replace

import pytest

from firstseen.plans.daily import run_daily
from firstseen.storage import Storage
from firstseen.streaming.incremental import PUBLISHED, IncrementalDedup
from tests.conftest import DAY
from tests.test_daily import CONFIG, feed, keys_of, lines
from tests.test_stream import finish


def job(spark, write, config=CONFIG, state="state", **more):
    root = write.root
    return IncrementalDedup(spark, str(root / "in"), str(root / state), config, str(root / "out"), publish=True, **more)


def published(write, table="account"):
    return keys_of(write.root / f"out/{table}/{DAY}")


def test_batches_follow_what_is_there(spark, write):
    write(f"out/account/{DAY}/old.json", lines("p1"))
    feed(write, "account", 2, "a1", "p1", "a1")
    feed(write, "award", 1, "w1")
    stream = finish(job(spark, write))
    assert sorted(published(write)) == ["a1", "p1"] and published(write, "award") == ["w1"]
    # A batch without survivors counts as published too.
    feed(write, "account", 1, "a1", "a2", "p1")
    finish(stream)
    feed(write, "account", 3, "a2")
    finish(stream)
    assert sorted(published(write)) == ["a1", "a2", "p1"]
    assert stream.published_through() == 2
    assert finish(job(spark, write)).published_through() == 2
    # A daily run takes the stream's files as published, the stream's notes as nothing.
    daily = run_daily(spark, str(write.root / "in"), str(write.root / "out"), CONFIG)
    assert daily.survivors.count() == 0


def test_one_file_per_table(spark, write):
    config = replace(CONFIG, single_file=True)
    feed(write, "account", 2, "a1")
    stream = finish(job(spark, write, config))
    feed(write, "account", 1, "a2", "a1")
    finish(stream)
    assert [p.name for p in (write.root / f"out/account/{DAY}").glob("*.json")] == [f"MERGED=account-{DAY}.json"]
    assert published(write) == ["a1", "a2"]


STEPS = ["write_text", "move", "replace", "remove_file", "remove_folder"]


@pytest.mark.parametrize("died", ["before", "after"])
@pytest.mark.parametrize("at", [1, 4, 7])
def test_a_batch_that_died_is_published_once(spark, write, monkeypatch, at, died):
    """The job dies at the given file-system call of the second batch."""
    feed(write, "account", 1, "a1", "a2")
    feed(write, "award", 1, "w1")
    stream = finish(job(spark, write))
    feed(write, "account", 2, "a2", "a3")
    feed(write, "award", 2, "w2")
    calls = [0]

    def counted(name, plain):
        def step(self, *args):
            calls[0] += 1
            dies = calls[0] >= at
            if dies and died == "before":
                raise OSError("lost")
            done = plain(self, *args)
            if dies:
                raise OSError("lost")
            return done

        return step

    publish_batch = stream._publish

    def dying(number):
        for name in STEPS:
            monkeypatch.setattr(Storage, name, counted(name, getattr(Storage, name)))
        try:
            publish_batch(number)
        finally:
            monkeypatch.undo()

    stream._publish = dying
    try:
        finish(stream)
    except Exception as error:
        assert "lost" in str(error)
    again = finish(job(spark, write))
    assert sorted(published(write)) == ["a1", "a2", "a3"] and sorted(published(write, "award")) == ["w1", "w2"]
    assert again.published_through() == 1
    work = write.root / "out/_firstseen"
    assert not work.exists() or not list(work.iterdir())


def test_a_stream_that_begins_to_publish_later(spark, write):
    feed(write, "account", 1, "a1")
    finish(IncrementalDedup(spark, str(write.root / "in"), str(write.root / "state"), CONFIG, str(write.root / "out")))
    assert not (write.root / f"out/account/{DAY}").exists()
    feed(write, "account", 2, "a1", "a2")
    finish(job(spark, write))
    assert published(write) == ["a1", "a2"]


def test_a_new_state_is_another_stream(spark, write):
    feed(write, "account", 1, "a1")
    finish(job(spark, write))
    feed(write, "account", 2, "a2")
    other = finish(job(spark, write, state="state2"))
    # The first stream's line is its baseline.
    assert published(write) == ["a1", "a2"] and other.published_through() == 0
    assert len(list((write.root / "out" / PUBLISHED).glob("*.json"))) == 2


def test_settings_that_cannot_be(spark, write):
    with pytest.raises(ValueError, match="merge"):
        job(spark, write, replace(CONFIG, publish_mode="replace"))
    with pytest.raises(ValueError, match="output"):
        IncrementalDedup(spark, "in", "state", CONFIG, publish=True)
