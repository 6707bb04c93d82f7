"""Lyndon arrays, runs and collapsed texts against trying every stretch."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from firstseen.llm import periodic
from firstseen.llm.frames import small_batches


def brute_lyndon(ranks):
    out = []
    for i in range(len(ranks)):
        j = i + 1
        while j < len(ranks) and ranks[j:] > ranks[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(words, least=6, periods=4):
    n, found = len(words), set()
    for p in range(1, n // periods + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(least, periods * p):
                part = words[i : i + length]
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    found.add((i, length, p))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest(),
    )


def sequences():
    r = random.Random(5)
    yield from ([], [1], [1] * 40, [1, 2] * 20, [2, 1] * 20 + [2])
    for _ in range(300):
        alphabet = r.choice([1, 2, 3, 8])
        one = []
        while len(one) < r.randrange(70):
            piece = [r.randrange(alphabet) for _ in range(r.randrange(1, 8))]
            one += piece * r.choice([1, 1, 2, 4, 6])
        yield one


def test_lyndon_arrays():
    for one in sequences():
        assert periodic.lyndon_lengths(one).tolist() == brute_lyndon(one), one


def test_runs():
    for one in sequences():
        found = brute_runs(one)
        assert periodic.runs_of(np.array(one, np.int64)) == found, one
        words = [str(k).encode() for k in one]
        assert periodic.find_runs([words, [], words + [b"x"] * 6, words]) == [found, [], brute_runs(words + [b"x"] * 6), found]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 7)), max_size=8))
def test_runs_of_any_words(parts):
    words = [w.encode() for piece, times in parts for w in piece * times]
    assert periodic.find_runs([words]) == [brute_runs(words)]


def test_false_hash_matches_are_seen(monkeypatch):
    monkeypatch.setattr(periodic, "_PRIME", np.uint64(3))
    for one in sequences():
        assert periodic.runs_of(np.array(one, np.int64)) == brute_runs(one), one


def test_long_texts():
    assert periodic.find_runs([[b"a"] * 300_000]) == [[(0, 300_000, 1)]]
    assert periodic.find_runs([[b"a", b"b", b"a"] * 100_000]) == [[(0, 300_000, 3)]]
    unequal = [str(k).encode() for k in range(300_000)]
    assert periodic.find_runs([unequal + unequal]) == [[]]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    out = [(None, None), (None, "a " * 9), (0, ""), (1, " \t"), (2, "é\x85é \x1c b\x0bb\x0cb b b b\r\nb")]
    for k in range(60):
        piece = [r.choice("abcdefghij") for _ in range(r.randrange(1, 90))]
        out.append((r.randrange(10**6), r.choice([" ", "\n", " \t"]).join(piece * r.choice([1, 1, 5]))))
    # Ids whose text is rewritten.
    out += [(k, " ".join(str(j % 50) for j in range(40 + k % 97))) for k in range(4000) if zlib.crc32(str(k).encode()) % 10 == 0][:60]
    return out + [out[7]]


def test_query(spark, rows, tmp_path):
    from firstseen.llm.queries import QUERIES

    frame = spark.createDataFrame([(*row, 1, "r") for row in rows], "doc_id bigint, text string, n int, runs string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    result = QUERIES["op13_periodic"](spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert dict(result.dtypes) == {c: "string" if "sha" in c else "bigint" for c in result.columns}
    expected = [brute_row(d, t) for d, t in rows]
    assert sorted(map(tuple, result.collect()), key=str) == sorted(expected, key=str)
    assert sum(row[1] for row in expected) > 30


def test_given_documents(spark):
    from firstseen.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    short = [row for row in given if len(row[1] or "") < 6000]
    found = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic"](spark, folder).collect()}
    assert len(found) == len(given) and all(found[d] == brute_row(d, t) for d, t in short)


def test_no_documents(spark):
    small_batches(spark)
    assert periodic.collapse_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
