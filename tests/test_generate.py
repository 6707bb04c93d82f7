import json
import os

import pytest

from firstseen.config import DedupConfig
from firstseen.plans.daily import run_daily
from firstseen.sources.generate import generate_records, write_feed
from firstseen.storage import Storage
from tests.conftest import DAY


@pytest.mark.parametrize("across, kind", [(False, "same_file"), (True, "cross_file")])
def test_known_number_of_duplicates(spark, tmp_path, across, kind):
    specs = spark.createDataFrame([("account", DAY, 1050), ("award", DAY, 19)], "table_name STRING, file_date DATE, total INT")
    made = generate_records(specs, records_per_file=200, across_files=across)
    assert write_feed(made, str(tmp_path / "in")) == 6 + 1
    config = DedupConfig(tables=["account", "award"], run_dates=[DAY])
    result = run_daily(spark, str(tmp_path / "in"), str(tmp_path / "out"), config)
    found = result.duplicates.collect()
    assert len(found) == (1050 // 20 - (200 // 20 if across else 0))
    assert {r.dup_kind for r in found} == {kind}
    assert result.survivors.count() == 1050 + 19 - len(found)


def test_first_record(spark, tmp_path):
    specs = spark.createDataFrame([("account", DAY, 1)], "table_name STRING, file_date DATE, total INT")
    write_feed(generate_records(specs), str(tmp_path))
    text = (tmp_path / f"{DAY}/account/account-{DAY}-1.json").read_text()
    assert text.startswith('{"Source":{"Table":"account","System":"CORE"},"ChangeData":{"id":"000000000001",')
    assert json.loads(text)["Data"] == {
        "_creationdate": f"{DAY}T01:00:00.00Z", "accountId": "A101", "status": "OPEN", "balanceBand": "HIGH",
    }


ODD = "table_name STRING, file_date DATE, sequence INT, line_no BIGINT, raw_line STRING"


def odd_records(spark):
    rows = [("a", DAY, 1, 3, "c"), ("a", DAY, 1, 1, "\u00e9"), ("a", DAY, 1, 2, None), ("b:%", DAY, 12, 1, ""), (None, DAY, 2, 1, "n")]
    return spark.createDataFrame(rows, ODD)


def files_below(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file() and p.suffix != ".crc"}


def test_a_mounted_folder_gets_the_files_of_other_stores(spark, tmp_path, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(Storage, "mounted", lambda self, path: None)
        assert write_feed(odd_records(spark), str(tmp_path / "moved")) == 3
    assert write_feed(odd_records(spark), str(tmp_path / "written")) == 3
    found = files_below(tmp_path / "written")
    assert found == files_below(tmp_path / "moved")
    assert found[f"{DAY}/a/a-{DAY}-1.json"] == "\u00e9\n\nc\n".encode()


def test_the_driver_moves_no_file_of_a_mounted_folder(spark, tmp_path, monkeypatch):
    def refused(*args):
        raise AssertionError("the driver handles single files")

    for name in ("glob", "move", "move_all"):
        monkeypatch.setattr(Storage, name, refused)
    assert write_feed(odd_records(spark), str(tmp_path / "in")) == 3


def test_a_file_that_is_there_is_kept(spark, tmp_path):
    write_feed(odd_records(spark), str(tmp_path))
    before = files_below(tmp_path)
    # As a task does that runs again.
    write_feed(odd_records(spark), str(tmp_path))
    assert files_below(tmp_path) == before
    target = tmp_path / f"{DAY}/a/a-{DAY}-1.json"
    target.write_text("other\n")
    with pytest.raises(Exception, match="FileExistsError"):
        write_feed(odd_records(spark), str(tmp_path))
    assert target.read_text() == "other\n"
    assert not [name for _, _, names in os.walk(tmp_path) for name in names if name.endswith(".writing")]


def test_names_of_a_folder_are_a_few_calls(spark, tmp_path, monkeypatch):
    expected = sorted([*(f"f {k}.json" for k in range(60)), "a, b", "\u00e9%3A"])
    for name in expected:
        (tmp_path / name).touch()
    storage, calls = Storage(spark, str(tmp_path)), []
    client = spark.sparkContext._gateway._gateway_client
    real = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *args, **more: calls.append(args) or real(*args, **more))
    assert storage.names(str(tmp_path)) == expected
    assert len(storage.glob(f"{tmp_path}/f*")) == 60
    # Py4J asks for a name of Java's packages step by step.
    assert len(calls) < 60
