"""Repeated byte strings against a dictionary of all strings."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from firstseen.llm import columnwise, repeats
from firstseen.llm.frames import small_batches

WIDTH = 50


def brute(rows, width=WIDTH):
    first: dict[bytes, int] = {}
    texts = [(d, (t or "").encode()) for d, t, *_ in rows]
    for d, raw in texts:
        if d is not None:
            for k in range(len(raw) - width + 1):
                s = raw[k : k + width]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, raw in texts:
        gone = np.zeros(len(raw), bool)
        if d is not None:
            for k in range(len(raw) - width + 1):
                if first[raw[k : k + width]] < d:
                    gone[k : k + width] = True
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    random = np.random.default_rng(seed)
    letters = list("abcdé \n")
    word = lambda n: "".join(random.choice(letters, n))
    passages = [word(n) for n in (30, 50, 60, 90, 400)]
    rows = []
    for k in range(120):
        text = word(int(random.integers(0, 300)))
        for _ in range(int(random.integers(0, 3))):
            at = int(random.integers(0, len(text) + 1))
            passage = passages[int(random.integers(0, len(passages)))]
            cut = int(random.integers(0, 20))
            text = text[:at] + passage[cut:] + text[at:]
        rows.append((int(random.integers(0, 1000)), text, "x"))
    rows += [(2000 + k, rows[k][1], "copy") for k in range(10)]
    rows += [(3000 + k, rows[k][1][:-1] + "z" + rows[k + 1][1], "near") for k in range(10)]
    rows += [(1, "ab" * 120, ""), (4000, "ab" * 90, ""), (4001, "a" * 200, ""), (5, "a" * 70, "")]
    rows += [(4002, None, None), (None, rows[3][1], None), (None, "", ""), rows[0], rows[0], (rows[1][0], rows[2][1], "")]
    return rows


@pytest.mark.parametrize(("seed", "hot", "groups"), [(1, 2000, 5), (2, 3, 4), (3, 2, 1)])
def test_against_all_strings(spark, seed, hot, groups):
    small_batches(spark)
    rows = corpus(seed)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, pid string")
    found = repeats.remove_repeats(frame, group_bytes=1 << 30, min_groups=groups, hot=hot).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_slices_of_a_long_text(spark, monkeypatch):
    random = np.random.default_rng(9)
    raw = "".join(random.choice(list("abcd"), 3000))
    monkeypatch.setattr(repeats, "SLICE", 128)
    table = __import__("pyarrow").table({"doc_id": [1, 2], "h": [0, 0], "text": [raw, raw[700:1900]]})
    position, document, hashes = repeats._Group(table, None, WIDTH).anchors()
    monkeypatch.setattr(repeats, "SLICE", 1 << 20)
    whole = repeats._Group(table, None, WIDTH).anchors()
    assert position.tolist() == whole[0].tolist() and hashes.tolist() == whole[2].tolist()
    # Every string of the width holds an anchor.
    own = position[document == 0]
    assert all(((own >= k) & (own <= k + WIDTH - repeats.GRAM)).any() for k in range(3000 - WIDTH + 1))


def test_no_rows_and_short_texts(spark):
    schema = "doc_id bigint, text string"
    assert repeats.remove_repeats(spark.createDataFrame([], schema)).count() == 0
    few = [(1, "short"), (2, "short"), (3, "")]
    assert sorted(map(tuple, repeats.remove_repeats(spark.createDataFrame(few, schema)).collect()), key=str) == brute(few)


@pytest.mark.parametrize(("n", "length", "width", "symbols"), [(1, 5, 3, 2), (60, 12, 4, 2), (200, 20, 6, 3), (50, 8, 8, 2)])
def test_column_wise_order(n, length, width, symbols):
    random = np.random.default_rng(n)
    pieces = random.integers(0, symbols, (n, length)).astype(np.uint8)
    for column, order, prefixes in columnwise.rounds(pieces, width):
        suffixes = [bytes(pieces[k, column:]) for k in order]
        assert suffixes == sorted(suffixes)
        for a, b, common in zip(suffixes, suffixes[1:], prefixes[1:], strict=False):
            same = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
            assert common == min(same, width)
