import shutil
from dataclasses import replace

import pytest

from firstseen.config import DedupConfig
from firstseen.plans import daily
from firstseen.plans.daily import TooManyRejects, WrongCount, run_daily
from firstseen.plans.publish import finish_open, part_number, publish
from firstseen.storage import Storage
from tests import brute
from tests.conftest import DAY

CONFIG = DedupConfig(key_fields=("k",), tables=["account", "award"], run_dates=[DAY])


def lines(*keys):
    return "".join(f'{{"k":"{k}"}}\n' for k in keys)


def keys_of(path):
    """Lines of the published files of a folder, in file-name order."""
    text = "".join(p.read_text() for p in sorted(path.glob("*.json")))
    return [line.split('"')[3] for line in text.splitlines()]


def feed(write, table, number, *keys):
    write(f"in/{DAY}/{table}/{table}-{DAY}-{number}.json", lines(*keys))


def run(spark, write, config=CONFIG, **more):
    return run_daily(spark, str(write.root / "in"), str(write.root / "out"), config, **more)


def test_merge_order_and_one_output_per_table(spark, write):
    feed(write, "account", 2, "a3")
    feed(write, "account", 1, "a1", "a2")
    feed(write, "award", 1, "w1")
    result = run(spark, write)
    assert keys_of(write.root / f"out/account/{DAY}") == ["a1", "a2", "a3"]
    assert keys_of(write.root / f"out/award/{DAY}") == ["w1"]
    assert {p.table_name for p in result.published} == {"account", "award"}


def test_order_over_many_parts(spark, write):
    """Part names run in merge order, inside a table and across its files."""
    expected = []
    for number in (1, 2, 10):
        keys = [f"{number}-{n}" for n in range(40)]
        feed(write, "account", number, *keys)
        expected += keys
    feed(write, "award", 1, *[f"w{n}" for n in range(40)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run(spark, write)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    folder = write.root / f"out/account/{DAY}"
    assert len(list(folder.glob("*.json"))) > 1
    assert keys_of(folder) == expected


def test_file_without_survivors(spark, write):
    feed(write, "account", 1, "a1")
    feed(write, "account", 2, "a1", "a1")
    result = run(spark, write)
    assert keys_of(write.root / f"out/account/{DAY}") == ["a1"]
    kinds = sorted((r.file_path[-6:], r.line_no, r.first_line_no, r.dup_kind) for r in result.duplicates.collect())
    assert kinds == [("2.json", 1, 1, "cross_file"), ("2.json", 2, 1, "cross_file")]


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("mode", ["merge", "replace"])
def test_publish_modes(spark, write, mode, single):
    """Merge keeps what is published; replace keeps it only where nothing new came."""
    config = replace(CONFIG, publish_mode=mode, single_file=single)
    write(f"out/account/{DAY}/MERGED=account-{DAY}.json", lines("old1", "old2"))
    write(f"out/award/{DAY}/MERGED=award-{DAY}.json", lines("w1"))
    feed(write, "account", 1, "new1", "old1", "new2")
    feed(write, "award", 1, "w1")
    result = run(spark, write, config)
    kept = ["old1", "old2"] if mode == "merge" else []
    assert keys_of(write.root / f"out/account/{DAY}") == kept + ["new1", "new2"]
    assert keys_of(write.root / f"out/award/{DAY}") == ["w1"]
    names = sorted(p.name for p in (write.root / f"out/account/{DAY}").glob("*.json"))
    if single:
        assert names == [f"MERGED=account-{DAY}.json"]
    manifest = (write.root / f"out/triggerFile/{DAY}.trg").read_text().splitlines()
    multi = f"MERGED=account-{DAY}." + ("json" if single else "*json")
    assert manifest == [f"account,{multi},{len(kept) + 2}", f"award,MERGED=award-{DAY}.json,1"]
    assert result.summary.count() == 2


def test_single_file_whatever_its_size(spark, write):
    config = replace(CONFIG, single_file=True)
    keys = [f"a{n}" for n in range(500)]
    feed(write, "account", 1, *keys[:250])
    run(spark, write, config)
    feed(write, "account", 2, *keys[250:])
    result = run(spark, write, config)
    assert [p.name for p in (write.root / f"out/account/{DAY}").glob("*.json")] == [f"MERGED=account-{DAY}.json"]
    assert keys_of(write.root / f"out/account/{DAY}") == keys
    assert result.summary.first().output_count == 500


@pytest.mark.parametrize("single", [False, True])
def test_a_limit_on_records_per_file_loses_nothing(spark, write, single):
    """Clusters set it; every part has to be published."""
    write(f"out/account/{DAY}/old.json", lines("old"))
    feed(write, "account", 1, *[f"a{n}" for n in range(10)])
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "4")
    try:
        result = run(spark, write, replace(CONFIG, single_file=single))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted(keys_of(write.root / f"out/account/{DAY}")) == sorted(["old", *[f"a{n}" for n in range(10)]])
    assert result.summary.first().output_count == 11


def test_second_run_keeps_nothing(spark, write):
    feed(write, "account", 1, "a1", "a2", "a1")
    first = run(spark, write)
    assert first.survivors.count() == 2
    second = run(spark, write)
    assert second.survivors.count() == 0 and second.published == []
    assert keys_of(write.root / f"out/account/{DAY}") == ["a1", "a2"]
    row = second.summary.first()
    assert (row.total_processed, row.total_duplicates, row.output_count) == (3, 3, 2)
    assert {r.dup_kind for r in second.duplicates.collect()} == {"baseline"}


class Lost(RuntimeError):
    pass


def survivors_frame(spark, *keys):
    rows = [("account", "account", DAY, 1, "f", 0, n, f'{{"k":"{k}"}}') for n, k in enumerate(keys)]
    rows.append(("award", "award", DAY, 1, "g", 0, 0, '{"k":"w1"}'))
    return spark.createDataFrame(
        rows,
        "scope_table STRING, table_name STRING, file_date DATE, sequence INT, file_path STRING, "
        "split_start BIGINT, row_id BIGINT, raw_line STRING",
    )


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("mode", ["merge", "replace"])
def test_dying_at_any_step_of_publishing(spark, write, monkeypatch, mode, single):
    """Whatever call is the last, what is published is as before or becomes whole."""
    config = replace(CONFIG, publish_mode=mode, single_file=single)
    write(f"start/account/{DAY}/MERGED=account-{DAY}.json", lines("o1", "o2"))
    write(f"start/account/{DAY}/older.json", lines("o3"))
    old, new = ["o1", "o2", "o3"], ["n1", "n2"]
    after = sorted([*(old if mode == "merge" else []), *new])
    steps = ["write_text", "move", "replace", "remove_file", "remove_folder"]
    originals = {name: getattr(Storage, name) for name in steps}
    outcomes, last = [], 0
    while True:
        last += 1
        target, done = write.root / f"out{last}", []
        shutil.copytree(write.root / "start", target)

        def step(name):
            def call(self, *args):
                done.append(name)
                if len(done) == last:
                    raise Lost(name)
                return originals[name](self, *args)

            return call

        for name in steps:
            monkeypatch.setattr(Storage, name, step(name))
        try:
            publish(survivors_frame(spark, *new), str(target), config, "run")
        except Lost:
            pass
        finally:
            monkeypatch.undo()
        between = sorted(keys_of(target / f"account/{DAY}"))
        assert set(between) >= set(old) or set(between) >= set(after), (last, done)
        opened = finish_open(Storage(spark, str(target)), str(target))
        found = sorted(keys_of(target / f"account/{DAY}"))
        assert found == (after if opened or found != sorted(old) else sorted(old)), (last, done)
        assert (found == after) == (target / f"award/{DAY}").exists()
        assert not list((target / "_firstseen").iterdir())
        outcomes.append(found == after)
        if len(done) < last:
            break
    assert outcomes[-1] and not outcomes[0] and len(outcomes) >= 5


def test_a_run_completes_the_one_that_died(spark, write, monkeypatch):
    write(f"out/account/{DAY}/old.json", lines("o1"))
    feed(write, "account", 1, "n1", "n2")
    feed(write, "award", 1, "w1")

    def lost(self, *args):
        raise Lost

    monkeypatch.setattr(Storage, "remove_file", lost)
    with pytest.raises(Lost):
        run(spark, write, replace(CONFIG, publish_mode="replace"))
    monkeypatch.undo()
    result = run(spark, write, replace(CONFIG, publish_mode="replace"))
    assert result.survivors.count() == 0
    assert keys_of(write.root / f"out/account/{DAY}") == ["n1", "n2"]
    assert keys_of(write.root / f"out/award/{DAY}") == ["w1"]


def test_a_wrong_count_is_found(spark, write, monkeypatch):
    feed(write, "account", 1, "a1", "a2")
    monkeypatch.setattr("firstseen.plans.publish._carry_out", lambda *args: None)
    with pytest.raises(WrongCount, match="account"):
        run(spark, write)


def test_part_order_beyond_five_digits():
    names = [f"x/part-{n:05d}-c000.txt" for n in (100001, 99999, 7, 100000)]
    assert [part_number(n)[0] for n in sorted(names, key=part_number)] == [7, 99999, 100000, 100001]


def test_staging_is_removed(spark, write):
    feed(write, "account", 1, "a1", "a1")
    with run(spark, write) as result:
        assert Storage(spark, result.staging).exists(result.staging)
        assert result.duplicates.count() == 1
    assert not Storage(spark, result.staging).exists(result.staging)


def test_no_join_carries_the_text(spark, write):
    """Text is shuffled by key with the survivors and by output order, nowhere else."""
    feed(write, "account", 1, *[f"a{n}" for n in range(20)], "a1")
    plans = []
    original = daily.staged

    def seen(frame, path, *partition_by):
        plan = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        plans.append((path.rsplit("/", 1)[-1], "\n".join(line for line in plan if "Relation [" not in line)))
        return original(frame, path, *partition_by)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(daily, "staged", seen)
            run(spark, write)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [(name, plan) for name, plan in plans if "Join" in plan]
    assert joined and all("raw_line" not in plan for _, plan in joined)
    grouped = [name for name, plan in plans if "Aggregate" in plan and "raw_line" in plan]
    assert grouped == ["survivors"]


def test_names_that_differ_in_case(spark, write):
    """One scope, one output. The key holds the table a record names, exact case."""

    def put(table, number, *keys):
        texts = [f'{{"Source":{{"Table":"t"}},"k":"{k}"}}\n' for k in keys]
        write(f"in/{DAY}/{table}-{DAY}-{number}.json", "".join(texts))

    def published():
        text = "".join(p.read_text() for p in sorted((write.root / f"out/Account/{DAY}").glob("*.json")))
        return [line.split('"')[9] for line in text.splitlines()]

    put("Account", 1, "a1")
    put("account", 2, "a1", "a2")
    run(spark, write)
    assert published() == ["a1", "a2"]
    put("account", 1, "a3")
    run(spark, write)
    assert published() == ["a1", "a2", "a3"]
    assert not (write.root / "out/account").exists()


def test_no_input(spark, write):
    feed(write, "other", 1, "a1")
    with pytest.raises(FileNotFoundError):
        run(spark, write)


def test_reject_limits(spark, write):
    feed(write, "account", 1, "a1")
    write(f"in/{DAY}/account/account-{DAY}-2.json", "bad\n" * 3)
    with pytest.raises(TooManyRejects):
        run(spark, write, replace(CONFIG, skip_malformed=False))
    assert run(spark, write).rejects.count() == 3
    write(f"out/account/{DAY}/old.json", "bad\nbad\n")
    assert run(spark, write, replace(CONFIG, prior_reject_limit=2)).rejects.count() == 5
    with pytest.raises(TooManyRejects, match="old.json"):
        run(spark, write, replace(CONFIG, prior_reject_limit=1))


def test_reports(spark, write):
    feed(write, "account", 1, "a1", "a1")
    write(f"in/{DAY}/award/award-{DAY}-1.json", '\n{"k":1}\nbad\n')
    run(spark, write, replace(CONFIG, run_id="my run"), log_dir=str(write.root / "logs"))
    summary = (write.root / f"logs/{DAY}/stats-my_run.log").read_text().splitlines()
    assert summary[:5] == ["Run ID: my_run", f"Run Date: {DAY}", "", "Data Processed Summary:", "account:"]
    assert summary[5:8] == ["\tTotal Records processed: 2", "\tTotal Rejected: 0", "\tTotal Duplicates: 1"]
    assert "\tTotal Rejected: 1" in summary and "Grand Total: 3" in summary
    details = write.root / f"logs/{DAY}/stats-detailed-my_run.log"
    text = "".join(p.read_text() for p in sorted(details.glob("part-*"))).splitlines()
    one, two = (f"file:{write.root}/in/{DAY}/{t}/{t}-{DAY}-1.json" for t in ("account", "award"))
    assert text == [
        f"Line 2 in {one} is a duplicate of line 1 in {one}",
        f"Line 3 in {two} has been rejected due to invalid data/format",
    ]


def test_whole_run_against_brute_force(spark, write):
    from tests.test_first_seen import FIELDS, random_files

    files, root = [], write.root
    for role, table, sequence, path, texts in random_files(21):
        number = path.rsplit("/", 1)[-1]
        if role == "TODAY":
            place = f"in/{table}/{table}-{DAY}-{number}.json"
        else:
            place = f"out/{table}/{DAY}/{number}.json"
        write(place, "".join(t + "\n" for t in texts))
        files.append((role, table, sequence, f"file:{root}/{place}", texts))
    survivors, duplicates, rejected = brute.run(files, FIELDS)
    config = DedupConfig(key_fields=FIELDS, tables=["a", "b"], run_dates=[DAY], hot_min_copies=3, hot_keys=2)
    result = run(spark, write, config)
    assert sorted((r.file_path, r.line_no) for r in result.survivors.collect()) == sorted(survivors)
    found = result.duplicates.collect()
    assert sorted((r.file_path, r.line_no, r.first_path, r.first_line_no, r.dup_kind) for r in found) == sorted(duplicates)
    assert sorted((r.file_path, r.line_no) for r in result.rejects.collect()) == sorted(rejected)


def test_the_feed_is_read_once(spark, write, monkeypatch):
    feed(write, "account", 1, "a1")
    reads = []
    original = daily.today_lines
    monkeypatch.setattr(daily, "today_lines", lambda *a, **k: reads.append(k) or original(*a, **k))
    run(spark, write)
    assert reads == [{"numbered": False}]
