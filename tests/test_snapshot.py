"""Readers while a run publishes: all of it or nothing of it."""

import shutil
import threading
from dataclasses import replace

import pytest

from firstseen.plans import snapshot
from firstseen.plans.publish import finish_open, propose, publish
from firstseen.plans.snapshot import Unsettled, read_whole
from firstseen.storage import Storage
from tests.conftest import DAY
from tests.test_daily import CONFIG, keys_of, lines, survivors_frame

TABLES = ["account", "award"]
STEPS = ["write_text", "move", "replace", "remove_file", "remove_folder"]


def keys(frame):
    """(table, key) in the order of the files; lines of a file are read in order."""
    rows = sorted(frame.collect(), key=lambda r: (r.table_name, r.file_name))
    return [(r.table_name, r.raw_line.split('"')[3]) for r in rows]


def read(spark, root, action=keys, **more):
    return read_whole(spark, str(root), TABLES, action, **more)


def start(write):
    write(f"out/account/{DAY}/MERGED=account-{DAY}.json", lines("o1", "o2"))
    write(f"out/account/{DAY}/older.json", lines("o3"))
    write(f"out/award/{DAY}/MERGED=award-{DAY}.json", lines("v1"))
    return write.root / "out"


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("mode", ["merge", "replace"])
def test_a_reader_before_every_step(spark, write, monkeypatch, mode, single):
    """What a reader finds before a step is also what it finds where the run dies there."""
    root, config = start(write), replace(CONFIG, publish_mode=mode, single_file=single)
    seen, turn = [read(spark, root)], threading.Lock()
    originals = {name: getattr(Storage, name) for name in STEPS}

    def step(name):
        def call(self, *args):
            # Moves run side by side; here one at a time, each after a read.
            if not turn.acquire(blocking=False):
                if getattr(owner, "inside", False):
                    return originals[name](self, *args)
                turn.acquire()
            owner.inside = True
            try:
                seen.append(read(spark, root))
                return originals[name](self, *args)
            finally:
                owner.inside = False
                turn.release()

        return call

    owner = threading.local()
    for name in STEPS:
        monkeypatch.setattr(Storage, name, step(name))
    publish(survivors_frame(spark, "n1", "n2"), str(root), config, "run")
    monkeypatch.undo()
    seen.append(read(spark, root))
    old = [("account", "o1"), ("account", "o2"), ("account", "o3"), ("award", "v1")]
    new = [("account", "n1"), ("account", "n2"), ("award", "w1")]
    after = sorted(new + (old if mode == "merge" else []))
    assert sorted(seen[0]) == old and sorted(seen[-1]) == after
    kinds = [sorted(found) for found in seen]
    change = kinds.index(after)
    assert kinds == [old] * change + [after] * (len(kinds) - change)
    # Files move in after the snapshot has changed, and readers do not notice.
    assert len(kinds) - change >= 3


def test_an_intent_nobody_carries_out(spark, write):
    """The order of a snapshot is that of the files once they are in place."""
    root = start(write)
    propose(survivors_frame(spark, "n1", "n2"), str(root), CONFIG, "run")
    assert keys_of(root / f"account/{DAY}") == ["o1", "o2", "o3"]
    waiting = read(spark, root)
    finish_open(Storage(spark, str(root)), str(root))
    assert read(spark, root) == waiting
    assert sorted(waiting) == sorted([("account", k) for k in ("n1", "n2", "o1", "o2", "o3")] + [("award", "v1"), ("award", "w1")])


def test_tables_and_dates(spark, write):
    root = start(write)
    propose(survivors_frame(spark, "n1"), str(root), CONFIG, "run")
    other = DAY.replace(day=12)
    write(f"out/award/{other}/x.json", lines("v2"))
    assert read_whole(spark, str(root), ["award"], keys, [other]) == [("award", "v2")]
    assert sorted(read_whole(spark, str(root), ["award"], keys)) == [("award", "v1"), ("award", "v2"), ("award", "w1")]
    assert read_whole(spark, str(root), ["nothing"], keys) == []
    assert read_whole(spark, str(write.root / "none"), TABLES, keys) == []


def test_a_run_during_a_read(spark, write):
    """A single file is replaced under its name: the read is made again."""
    root, calls = start(write), []
    config = replace(CONFIG, publish_mode="replace", single_file=True)

    def action(frame):
        half = keys(frame)
        if not calls:
            publish(survivors_frame(spark, "n1"), str(root), config, "run")
        calls.append(half)
        return half

    assert read(spark, root, action) == [("account", "n1"), ("award", "w1")]
    assert len(calls) == 2


def test_a_file_that_goes_during_a_read(spark, write):
    root, calls = start(write), []

    def action(frame):
        if not calls:
            calls.append((root / f"account/{DAY}/older.json").unlink())
        return keys(frame)

    assert sorted(read(spark, root, action)) == [("account", "o1"), ("account", "o2"), ("award", "v1")]


def test_what_never_settles_and_what_fails_by_itself(spark, write, monkeypatch):
    root, calls = start(write), []
    monkeypatch.setattr(snapshot, "ATTEMPTS", 2)

    def action(frame):
        calls.append(write(f"out/account/{DAY}/{len(calls)}.json", lines("x")))

    with pytest.raises(Unsettled):
        read(spark, root, action)
    with pytest.raises(Exception, match="no_such_column"):
        read(spark, root, lambda frame: frame.select("no_such_column").collect())
    shutil.rmtree(root)
    assert read(spark, root) == []
