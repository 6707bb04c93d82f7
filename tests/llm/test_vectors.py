"""Links and classes of vectors against comparing all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from firstseen.llm import vectors
from firstseen.llm.frames import small_batches

DIMENSION = 24


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near(random, base, cosine):
    away = random.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    return cosine * base + np.sqrt(1 - cosine**2) * unit(away)


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(3)
    alone = unit(random.normal(size=(400, DIMENSION)))
    edge = near(random, alone[:200], random.uniform(0.935, 0.999, (200, 1)))
    crowd = near(random, np.repeat(alone[:1], 150, axis=0), 0.99)
    every = np.vstack([alone, edge, crowd]).astype(np.float32)
    every[5] = every[6]
    every[7] = every[6]
    out = [(3 * k + 1, [float(x) for x in v], 0) for k, v in enumerate(every)]
    odd = [None, [0.0] * DIMENSION, [float("nan")] + [1.0] * (DIMENSION - 1), [None] + [1.0] * (DIMENSION - 1)]
    odd += [[float("inf")] + [0.0] * (DIMENSION - 1), [], [1.0, 2.0]]
    return out + [(5000 + k, v, 1) for k, v in enumerate(odd)] + [(5001, [0.0] * DIMENSION, 1)]


def brute(rows, cosine=0.95):
    good = [(i, v) for i, v, _ in rows if v and len(v) == DIMENSION and None not in v and np.isfinite(v).all() and any(v)]
    ids = np.array([i for i, _ in good])
    units = unit(np.array([v for _, v in good], np.float64))
    link = units @ units.T >= cosine
    np.fill_diagonal(link, False)
    labels = ids.copy()
    while True:
        best = np.minimum(labels, np.where(link, labels[None, :], labels.max()).min(axis=1))
        if (best == labels).all():
            break
        labels = best
    found = {int(i): (int(n), int(c)) for i, n, c in zip(ids, link.sum(axis=1), labels, strict=True)}
    return found, int(link.sum())


@pytest.mark.parametrize("chunk", [2048, 40])
def test_links_against_all_pairs(spark, rows, chunk):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, copies int")
    found = {r.vec_id: r for r in vectors.near_duplicates(frame, chunk=chunk).collect() if r.vec_id < 5000}
    expected, links = brute(rows)
    assert found.keys() == expected.keys()
    # Every link found is one; nearly all are found.
    assert all(found[i].n_links <= expected[i][0] for i in expected)
    assert sum(r.n_links for r in found.values()) >= 0.97 * links
    assert np.mean([found[i].component_id == expected[i][1] for i in expected]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_odd_vectors_link_with_nothing(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, copies int")
    odd = [r for r in vectors.near_duplicates(frame).collect() if r.vec_id >= 5000]
    assert len(odd) == 8 and all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in odd)


def test_empty_and_few(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([(2, [1.0, 0.0]), (1, [1.0, 0.0]), (9, [1.0, 0.01]), (None, [1.0, 0.0])], schema)
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(few).collect()}
    assert found == {2: (2, 1), 1: (2, 1), 9: (2, 1), None: (0, None)}
    assert small_batches(spark) is spark


@pytest.mark.parametrize("chunk", [2048, 16])
def test_each_number_of_components_is_compared(spark, chunk):
    random = np.random.default_rng(8)
    given, expected = [], {}
    for number, (dimension, count) in enumerate([(4, 10), (2, 3), (24, 120), (16, 60)]):
        base = unit(random.normal(size=(count // 2 + 1, dimension)))
        every = np.vstack([base, near(random, base, 0.98)])[:count] if dimension > 2 else np.array([[1, 0], [1, 0.01], [1, 0.02]])
        ids = 100 + 1000 * number + np.arange(len(every))
        part = [(int(i), [float(x) for x in v], 0) for i, v in zip(ids, every, strict=True)]
        given += part
        for i, v, _ in part:
            expected[i] = (i, v)
    frame = spark.createDataFrame(given, "vec_id bigint, embedding array<double>, copies int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame, chunk=chunk).collect()}
    wanted = {}
    for dimension in (2, 4, 16, 24):
        units = unit(np.array([v for _, v in expected.values() if len(v) == dimension]))
        ids = np.array([i for i, v in expected.values() if len(v) == dimension])
        link = units @ units.T >= 0.95
        np.fill_diagonal(link, False)
        wanted |= {int(i): int(n) for i, n in zip(ids, link.sum(axis=1), strict=True)}
    assert found.keys() == wanted.keys()
    assert [found[1100 + k] for k in range(3)] == [(2, 1100)] * 3
    assert all(found[i][0] <= wanted[i] for i in wanted)
    assert sum(n for n, _ in found.values()) >= 0.97 * sum(wanted.values())
    only = {r.vec_id: r.n_links for r in vectors.near_duplicates(frame, dimension=4).collect()}
    assert only.keys() == wanted.keys() and all(not n or i < 1000 for i, n in only.items())
