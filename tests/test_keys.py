import hashlib

import pytest
from pyspark.sql import functions as F

from firstseen.config import DEFAULT_KEY_FIELDS, DedupConfig
from firstseen.functions.keys import dedup_key, key_hex
from firstseen.operators.prepare import prepare
from tests.test_lines import envelope

GENERATED = (
    '{"Source":{"Table":"account","System":"CORE"},"ChangeData":{"id":"000000000001",'
    '"ChangeDateTime":"2026-03-11T01:00:00.00Z","Operation":"UPSERT"},'
    '"Data":{"_creationdate":"2026-03-11T01:00:00.00Z","accountId":"A101"}}'
)
THREE = ("Source.Table", "ChangeData.ChangeDateTime", "Data._creationdate")
SHORT = '{"Source":{"Table":"account"},"ChangeData":{"ChangeDateTime":"2026-03-11T10:%s:00Z"},"Data":{"_creationdate":"2026-03-01"}}'

GOLDEN = [
    (GENERATED, "account", DEFAULT_KEY_FIELDS, "5f0b8e5c99478fd9505517389ce2365298956b6b49bb1d50e78b4d8857ad8a5e"),
    ("{}", "account", DEFAULT_KEY_FIELDS, "e99f6f1f1e3bb5d802befaece9dfab39f7669d409f543d56c5d20d1bf772245c"),
    (SHORT % "00", "account", THREE, "484084eb546ba79b12317f4a7f4813389f74fd54575a58955b1321f04dd97850"),
    ('{"Data":{"id":"100"}}', "award", ("Data.id",), "4d2bbff11e07713ed0d2736be104259a60c6cef4e8413da4c2920c1c2407204a"),
    ('{"Data":{"id":100}}', "award", ("Data.id",), "4d2bbff11e07713ed0d2736be104259a60c6cef4e8413da4c2920c1c2407204a"),
]


def key_of(spark, line, table, config):
    row = spark.createDataFrame([(line, table)], "l STRING, t STRING")
    return row.select(key_hex(dedup_key(F.col("l"), F.col("t"), config))).first()[0]


@pytest.mark.parametrize("line, table, fields, expected", GOLDEN)
def test_golden(spark, line, table, fields, expected):
    assert key_of(spark, line, table, DedupConfig(key_fields=fields)) == expected


def test_golden_through_prepare(spark):
    frame = envelope(spark, [GENERATED, "{}"]).withColumn("table_name", F.lit("account"))
    rows = prepare(frame, DedupConfig()).orderBy("line_no").collect()
    assert [bytes(r.dedup_key).hex() for r in rows] == [GOLDEN[0][3], GOLDEN[1][3]]


def test_change_time_matters(spark):
    config = DedupConfig(key_fields=THREE)
    assert key_of(spark, SHORT % "00", "account", config) != key_of(spark, SHORT % "30", "account", config)


def test_override(spark):
    config = DedupConfig(table_key_fields={"award": ("Data.id",), "Mixed": ("Data.other",)})
    one, two = '{"Data":{"id":1,"other":1}}', '{"Data":{"id":1,"other":2}}'
    assert key_of(spark, one, "award", config) == key_of(spark, two, "award", config)
    assert key_of(spark, one, "Mixed", config) != key_of(spark, two, "Mixed", config)
    # The lookup is by exact case: this table uses the global fields, all missing.
    text = "\x1f".join(["mixed", *[p for f in DEFAULT_KEY_FIELDS for p in (f, "<null>")], ""])
    assert key_of(spark, one, "mixed", config) == hashlib.sha256(text.encode()).hexdigest()
    loose = DedupConfig(table_key_fields=config.table_key_fields, case_insensitive_overrides=True)
    assert key_of(spark, one, "mixed", loose) != key_of(spark, two, "mixed", loose)


def test_settings_are_checked():
    for bad in (
        {"key_fields": ()},
        {"key_fields": ("a..b",)},
        {"table_key_fields": {"t": ("",)}},
        {"publish_mode": "append"},
        {"tables": ["", " "]},
    ):
        with pytest.raises(ValueError):
            DedupConfig(**bad)
