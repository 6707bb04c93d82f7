"""Runs with kept keys against runs that read the baseline again."""

import shutil
from dataclasses import replace

import pytest

from firstseen.operators.prepare import prepare, records
from firstseen.plans import kept_baseline
from firstseen.plans.daily import TooManyRejects, run_daily
from firstseen.plans.kept_baseline import KEPT, KeptBaseline
from firstseen.sources import feeds
from tests.conftest import DAY
from tests.test_daily import CONFIG, feed, lines

KEEP = replace(CONFIG, keep_baseline=True, baseline_buckets=2)


def outcome(result):
    """Everything a run says, without the random parts of names."""
    return {
        "survivors": sorted((r.file_path[-20:], r.line_no, r.raw_line) for r in result.survivors.collect()),
        "duplicates": sorted((r.file_path[-20:], r.line_no, r.first_path.split(".part")[0][-12:], r.first_line_no, r.dup_kind) for r in result.duplicates.collect()),
        "rejects": sorted((r.role, r.file_path[-20:], r.line_no, r.raw_line, r.reason) for r in result.rejects.collect()),
        "counts": sorted((r.role, r.table_name, r.read_count, r.written_count, r.filtered_count, r.skipped_count, r.blank_count) for r in result.file_counts.collect()),
        "summary": sorted((r.table_name, r.total_processed, r.total_duplicates, r.total_rejected, r.output_count) for r in result.summary.collect()),
    }


def published(root):
    return sorted(line for p in root.glob("*/*/*.json") for line in p.read_text().splitlines())


@pytest.fixture
def both(spark, write):
    """run(**settings): one run with kept keys and one without, on twin outputs."""

    def run(**settings):
        found = []
        for out, config in (("out", KEEP), ("plain", CONFIG)):
            result = run_daily(spark, str(write.root / "in"), str(write.root / out), replace(config, **settings))
            found.append(outcome(result))
        assert found[0] == found[1]
        assert published(write.root / "out") == published(write.root / "plain")
        return found[0]

    return run


def old(write, name, text):
    for out in ("out", "plain"):
        write(f"{out}/account/{DAY}/{name}.json", text)


def test_runs_agree_day_after_day(write, both):
    old(write, "old", lines("p1", "p2", "p1") + "\nbad\n")
    feed(write, "account", 1, "a1", "p1", "a1", "a2")
    feed(write, "award", 1, "w1")
    assert len(both()["survivors"]) == 3
    # All of it is published now.
    feed(write, "account", 2, "a3", "p2", "w1")
    assert len(both()["survivors"]) == 2


@pytest.mark.parametrize("settings", [{"publish_mode": "replace"}, {"single_file": True}])
def test_other_modes(write, both, settings):
    old(write, "old", lines("p1", "p2"))
    feed(write, "account", 1, "a1", "p1")
    both(**settings)


@pytest.fixture
def keep(spark, write):
    """What a run with kept keys lets through."""

    def run(**settings):
        result = run_daily(spark, str(write.root / "in"), str(write.root / "out"), replace(KEEP, **settings))
        return sorted(r.raw_line.split('"')[3] for r in result.survivors.collect())

    return run


def test_changes_by_others_are_noticed(write, keep):
    old(write, "old", lines("p1", "p2"))
    old(write, "more", lines("p3"))
    feed(write, "account", 1, "a1", "p1", "p3")
    assert keep(publish_mode="replace", single_file=True) == ["a1"]
    # The run replaced the files; a file comes.
    old(write, "new", lines("n1"))
    feed(write, "account", 2, "n1", "p2")
    assert keep() == ["p1", "p2", "p3"]
    # One changes, one goes.
    old(write, "new", lines("changed"))
    (write.root / f"out/account/{DAY}/MERGED=account-{DAY}.json").unlink()
    feed(write, "account", 3, "changed")
    assert keep() == ["a1", "n1"]


def test_refresh_says_what_it_did(spark, write):
    old(write, "old", lines("p1", "p2"))
    baseline = KeptBaseline(spark, str(write.root / "out"), KEEP, ["account"])
    assert baseline.refresh() == {DAY: "grown"} and baseline.refresh() == {}
    old(write, "old", lines("p1", "p2", "p3"))
    assert baseline.refresh() == {DAY: "stale"} and baseline.refresh() == {}
    assert baseline.keys([DAY]).count() == 3
    # Other key fields have kept keys of their own.
    other = KeptBaseline(spark, str(write.root / "out"), replace(KEEP, key_fields=("x",)), ["account"])
    assert other.refresh() == {DAY: "grown"} and other.keys([DAY]).count() == 1


def test_a_fresh_baseline_is_not_read(spark, write, monkeypatch):
    old(write, "old", lines("p1"))
    feed(write, "account", 1, "a1", "p1")
    run_daily(spark, str(write.root / "in"), str(write.root / "out"), KEEP)

    def refused(*args, **more):
        raise AssertionError("the baseline is read")

    read = []
    whole = feeds.lines_of_published
    monkeypatch.setattr("firstseen.plans.daily.baseline_lines", refused)
    monkeypatch.setattr(feeds, "baseline_lines", refused)
    monkeypatch.setattr(feeds, "lines_of_published", lambda s, o, paths: read.extend(paths) or whole(s, o, paths))
    feed(write, "account", 2, "a2", "p1", "a1")
    result = run_daily(spark, str(write.root / "in"), str(write.root / "out"), KEEP)
    assert [r.raw_line for r in result.survivors.collect()] == ['{"k":"a2"}']
    # Only what this run has published itself.
    assert len(read) == 1 and "part" in read[0]


@pytest.mark.parametrize("step", ["_append", "_staged"])
@pytest.mark.parametrize("call", [1, 2, 3])
def test_a_refresh_that_dies_is_made_again(spark, write, monkeypatch, step, call):
    old(write, "old", lines("p1", "p2") + "bad\n")
    baseline = KeptBaseline(spark, str(write.root / "out"), KEEP, ["account"])
    real, calls = getattr(baseline, step), []

    def dying(*args):
        calls.append(args)
        if len(calls) == call:
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(baseline, step, dying)
    with pytest.raises(OSError):
        baseline.refresh()
    monkeypatch.undo()
    assert baseline.refresh() == {DAY: "grown"}
    feed(write, "account", 1, "p2", "p9")
    today = records(prepare(feeds.today_lines(spark, str(write.root / "in"), ["account"]), KEEP))
    assert [r.raw_line for r in baseline.anti_join(today).collect()] == ['{"k":"p9"}']
    known = baseline.matching(today).collect()
    assert [(r.line_no, r.file_path[-8:]) for r in known] == [(2, "old.json")]
    assert baseline.rejects([DAY]).count() == 1 and baseline.published_counts([DAY]).first().output_count == 3


def test_a_filter_grows_with_its_keys(spark, write, monkeypatch):
    monkeypatch.setattr(kept_baseline.prefilter, "BITS_PER_KEY", 32_768)
    monkeypatch.setattr(kept_baseline.prefilter, "LEAST_BITS_PER_KEY", 16_384)
    baseline = KeptBaseline(spark, str(write.root / "out"), KEEP, ["account"])
    sizes = []
    for number in range(4):
        old(write, f"f{number}", lines(*[f"{number}-{k}" for k in range(2**number)]))
        baseline.refresh()
        sizes.append(max(r.blocks for r in baseline._files([DAY]).collect()))
    assert sizes == [1, 3, 7, 15]
    feed(write, "account", 1, *[f"{n}-{k}" for n in range(4) for k in range(2**n)])
    today = records(prepare(feeds.today_lines(spark, str(write.root / "in"), ["account"]), KEEP))
    assert baseline.doubtful(today, [DAY]).count() == 15 and baseline.anti_join(today).count() == 0


def test_the_kept_side_is_not_shuffled(spark, write):
    old(write, "old", lines(*range(50)))
    baseline = KeptBaseline(spark, str(write.root / "out"), KEEP, ["account"])
    baseline.refresh()
    feed(write, "account", 1, *range(40, 90))
    today = records(prepare(feeds.today_lines(spark, str(write.root / "in"), ["account"]), KEEP))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined, side in ((baseline.anti_join(today), 1), (baseline.matching(today), 0)):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "Bucketed: true" in line]
            assert scan, plan
            above = _ancestors(plan, scan[0])
            assert not any("Exchange" in line for line in above), plan
            joined.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def _ancestors(plan, wanted):
    """Lines of the operators above one, up to and without the first join."""
    listed = plan.splitlines()
    at = listed.index(wanted)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    above, level = [], depth(wanted)
    for line in reversed(listed[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Join" in line:
                break
            above.append(line)
    return above


def test_limits_hold(spark, write):
    old(write, "old", "bad\nbad\n" + lines("p1"))
    feed(write, "account", 1, "a1")
    with pytest.raises(TooManyRejects):
        run_daily(spark, str(write.root / "in"), str(write.root / "out"), replace(KEEP, prior_reject_limit=1))


def test_kept_keys_may_be_thrown_away(write, keep):
    feed(write, "account", 1, "a1", "p1")
    assert keep() == ["a1", "p1"]
    shutil.rmtree(write.root / f"out/{KEPT}")
    feed(write, "account", 2, "a1", "a2")
    assert keep() == ["a2"]


def test_dates_without_kept_keys_are_read_by_folder(spark, write, monkeypatch):
    for number in range(3):
        old(write, f"f{number}", lines(f"p{number}"))
    write(f"out/award/{DAY}/f.json", lines("w"))

    def refused(*args):
        raise AssertionError("a path for each file")

    monkeypatch.setattr(feeds, "lines_of_published", refused)
    baseline = KeptBaseline(spark, str(write.root / "out"), KEEP, ["account"])
    assert baseline.refresh() == {DAY: "grown"} and baseline.refresh() == {}
    assert [r.output_count for r in baseline.published_counts([DAY]).collect()] == [3]


def test_an_anti_join_parses_the_feed_once(spark, write):
    old(write, "old", lines("p1"))
    baseline = KeptBaseline(spark, str(write.root / "out"), KEEP, ["account"])
    baseline.refresh()
    feed(write, "account", 1, "p1", "a1")
    parsed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    today = records(prepare(feeds.today_lines(spark, str(write.root / "in"), ["account"]), KEEP))
    today = today.mapInArrow(seen, today.schema)
    assert [r.raw_line for r in baseline.anti_join(today).collect()] == ['{"k":"a1"}']
    assert parsed.value == 2
