"""Fingerprints, links and classes against comparing all pairs."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from firstseen.llm import bitslice, components, simhash
from firstseen.llm.frames import small_batches


def one(text):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not parts:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts[k : k + 4]), 42) for k in range(max(1, len(parts) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(link, start):
    labels = np.array(start)
    while True:
        best = np.minimum(labels, np.where(link, labels[None, :], labels.max()).min(axis=1))
        if (best == labels).all():
            return labels
        labels = best


@pytest.mark.parametrize("text", ["", " \n", "A b", "a b c d", "Éa B\tc\x0bD e f g \x85 h", "x " * 50, "a b c\x1fd e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == one(text)


@pytest.mark.parametrize(("n", "groups"), [(0, 1), (1, 1), (64, 1), (200, 3), (2000, 40)])
@pytest.mark.parametrize("radius", [0, 4, 7])
def test_bit_sliced_classes(n, groups, radius):
    random = np.random.default_rng(n)
    words = random.integers(0, 2**63, 40, dtype=np.uint64)[random.integers(0, 40, n)]
    for _ in range(4):
        words = words ^ (np.uint64(1) << random.integers(0, 64, n, dtype=np.uint64)) * (random.random(n) < 0.8).astype(np.uint64)
    group = np.sort(random.integers(0, groups, n))
    link = (np.bitwise_count(words[:, None] ^ words[None, :]) <= radius) & (group[:, None] == group[None, :])
    expected = closure(link, np.arange(n)) if n else np.arange(0)
    assert bitslice.classes(group, words, radius).tolist() == expected.tolist()


def test_components_of_long_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(5, k) for k in range(1000, 1200)]
    odd = [(7, 7), (None, 3), (1005, 5), (5, 1005), (9, 8)]
    found = components.components(spark.createDataFrame(chain + star + odd, "a bigint, b bigint")).collect()
    expected = {k: 100 for k in range(100, 161)} | {k: 5 for k in [5, *range(1000, 1200)]} | {8: 8, 9: 8}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(500)]
    base = [" ".join(random.choice(vocabulary, 120)) for _ in range(40)]
    out = [(3 * k, text, "s") for k, text in enumerate(base)]
    for k in range(160):
        words = base[k % 8].split()
        for _ in range(k % 4):
            words[int(random.integers(0, 120))] = str(random.choice(vocabulary))
        out.append((1000 + k, " ".join(words), "s"))
    return out + [(2000, None, None), (2001, "", "s"), (1, " \t", "s"), (2002, base[0], "s"), (2002, base[0], "s"), (None, base[0], "s")]


@pytest.mark.parametrize("chunk", [4096, 7])
def test_near_duplicates(spark, rows, chunk):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    found = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame, chunk=chunk).collect() if r.doc_id is not None)
    known = [(d, one(t or "")) for d, t, _ in rows if d is not None]
    prints = np.array([p for _, p in known], np.uint64)
    link = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    labels = closure(link, [d for d, _ in known])
    assert found == sorted((d, f"{p:016x}", int(c)) for (d, p), c in zip(known, labels, strict=True))


@pytest.mark.parametrize("middle", [None, 3])
def test_rows_without_id_link_others(spark, monkeypatch, middle):
    """Fingerprints 1 - middle - 2 in a chain of which the ends are too far apart."""
    prints = [(1, 0), (middle, 0b1111), (2, 0b11111111), (None, 1 << 40 | 0xFFFFF << 20)]
    monkeypatch.setattr(simhash, "fingerprints", lambda documents: spark.createDataFrame(prints, "doc_id bigint, fp bigint"))
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(None).collect()}
    assert found == {(d, f"{p:016x}"): None if k == 3 else 1 for k, (d, p) in enumerate(prints)}


def test_first_of_each_class_stays(spark, rows):
    small_batches(spark)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, first string")
    firsts = {r.doc_id for r in simhash.near_duplicates(frame).collect() if r.doc_id is not None and r.doc_id == r.component_id}
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(firsts) and ids.count(None) == 1


def test_no_documents(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
