import pytest
from pyspark.sql import functions as F

from firstseen.config import DedupConfig, path_segments
from firstseen.functions import lines
from firstseen.operators.prepare import prepare

VALID = ["{}", "123", '"s"', "null", "[1]", "true", ' {"a":1} ', "-0", "1e5", '{"a":{"b":[1,{"c":2}]}}', '{"a":"]}"}']
MALFORMED = [
    '{"a":1',
    "not json",
    "{'a':1}",
    '{"b":01}',
    '{"a":1} junk',
    '{"a":1}{"c":1}',
    '{"a":1}]junk',
    '{"a":1}}junk',
    "1],[2",
    "1,0]",
    '1,"x":2',
    "1,2",
    "}",
    "]",
    "[1,]",
    '{"a":1,}',
    "NaN",
    "\u00a0",
    "\ufeff{}",
    '{"a":"x\ty"}',
]
# A repeated field is valid JSON; its last value counts, wherever it stands.
REPEATED = [
    ('{"a":{"b":1,"b":2}}', "2"),
    ('{"a":{"b":"x"},"a":{"b":"y"}}', "y"),
    ('{"a":{"b":1.5,"b":2.5}}', "2.5"),
    ('{"a":{"b":{"z":1},"b":{"z":2}}}', '{"z":2}'),
    ('{"a":{"b":{"z":1,"z":2}}}', '{"z":2}'),
    ('{"a":{"b":[1],"b":[2,3]}}', "[2,3]"),
    ('{"a":{"b":{"c":1},"b":7}}', "7"),
    ('{"a":{"b":7,"b":null}}', "<null>"),
]


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i INT, v STRING")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_valid_lines(spark):
    assert column(spark, VALID, lines.is_json) == [True] * len(VALID)


def test_malformed_lines(spark):
    found = column(spark, MALFORMED, lines.is_json)
    assert [line for line, ok in zip(MALFORMED, found) if ok] == []


def test_blank_lines(spark):
    values = ["", "  \t", "\u2003", "\x1f", "\u00a0", "\u0085", "x"]
    assert column(spark, values, lines.is_blank) == [True, True, True, True, False, False, False]


PARTS = [
    ('{"a":{"b":null}}', "<null>"),
    ('{"a":{}}', "<null>"),
    ('{"a":[{"b":1}]}', "<null>"),
    ('{"a":"x"}', "<null>"),
    ("5", "<null>"),
    ('{"a":{"b":"<null>"}}', "<null>"),
    ('{"a":{"b":100}}', "100"),
    ('{"a":{"b":"100"}}', "100"),
    ('{"a":{"b":1.10}}', "1.1"),
    ('{"a":{"b":1.0}}', "1.0"),
    ('{"a":{"b":1e2}}', "100.0"),
    ('{"a":{"b":true}}', "true"),
    ('{"a":{"b":""}}', ""),
    ('{"a":{"b":12345678901234567890123}}', "12345678901234567890123"),
    ('{"a":{"b":{"z":1, "y":2}}}', '{"z":1,"y":2}'),
    ('{"a":{"b":[ 1, "q\\"" ]}}', '[1,"q\\""]'),
    ('{"a":{"b":"q\\u00e9\\n"}}', "qé\n"),
]


def test_key_parts(spark):
    values = [line for line, _ in PARTS]
    expected = [part for _, part in PARTS]
    assert column(spark, values, lambda c: lines.key_part(c, "a.b")) == expected

    def from_variant(c):
        text = lines.value_text(lines.value_at(lines.parse(c), "a.b"), c, "a.b")
        return F.coalesce(text, F.lit("<null>"))

    assert column(spark, values, from_variant) == expected
    values = [line for line, _ in REPEATED]
    assert column(spark, values, lines.is_json) == [True] * len(values)
    assert column(spark, values, from_variant) == [part for _, part in REPEATED]
    assert column(spark, values, lambda c: lines.key_part(c, "a.b")) == [part for _, part in REPEATED]


def test_paths():
    assert path_segments("a.b..") == ["a", "b"]
    for bad in ("", ".", "a..b", ".a", "a.*", "a.b'c"):
        with pytest.raises(ValueError):
            path_segments(bad)


def envelope(spark, texts):
    rows = [("TODAY", 1, "Account", 1, "p", "n", i, t) for i, t in enumerate(texts, start=1)]
    frame = spark.createDataFrame(
        rows,
        "role STRING, role_rank INT, table_name STRING, sequence INT, file_path STRING, "
        "file_name STRING, line_no BIGINT, raw_line STRING",
    )
    return frame.withColumn("file_date", F.lit("2026-03-11").cast("date"))


def test_reasons_and_effective_table(spark):
    texts = [
        '{"Source":{"Table":"award"}}',
        '{"Source":{"Table":null}}',
        '{"Source":{"Table":7}}',
        '{"Source":{"Table":{"x":1}}}',
        '{"Source":{"Table":["x"]}}',
        '{"Source":{"Table":"[1]"}}',
        "   ",
        "{",
    ]
    rows = prepare(envelope(spark, texts), DedupConfig()).orderBy("line_no").collect()
    assert [(r.line_kind, r.reason, r.effective_table) for r in rows] == [
        ("record", None, "award"),
        ("record", None, "Account"),
        ("record", None, "7"),
        ("reject", "unusable Source.Table", None),
        ("reject", "unusable Source.Table", None),
        ("record", None, "[1]"),
        ("blank", None, None),
        ("reject", "invalid data/format", None),
    ]
    assert {r.scope_table for r in rows} == {"account"}
    assert [r.dedup_key is None for r in rows] == [r.line_kind != "record" for r in rows]


def test_invalid_encoding(spark, write):
    from firstseen.sources.feeds import today_lines

    write("in/account-2026-03-11-1.json", b'{"a":1}\n{"a":"\xff"}\n')
    rows = prepare(today_lines(spark, str(write.root / "in"), ["account"]), DedupConfig()).collect()
    assert sorted((r.line_no, r.reason) for r in rows) == [(1, None), (2, "invalid encoding")]
