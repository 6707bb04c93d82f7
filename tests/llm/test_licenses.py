"""Licence scans against every template at every place."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import numpy as np
import pytest

from firstseen.llm import licenses
from firstseen.llm.frames import small_batches
from firstseen.llm.licenses import TEMPLATES, Index, rarity

DATA = Path("/root/testdata/sf0.001")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, percent=licenses.PERCENT):
    """Per text: number of words and (template, start, end, share) of all matches."""
    split = [words_of(text) for text in texts]
    held = [set(words) for words in split]
    weight = {w: rarity(len(texts), sum(w in h for h in held)) for one in TEMPLATES for w in one.words}
    out = []
    for words in split:
        found = []
        for number, one in enumerate(TEMPLATES):
            total = sum(weight[w] for w in one.words)
            for start in range(-len(one.words), len(words)):
                hits = {q for q, w in enumerate(one.words) if 0 <= start + q < len(words) and words[start + q] == w}
                got = sum(weight[one.words[q]] for q in hits)
                if hits >= set(one.keys) and got * 100 >= percent * total:
                    found.append((number, max(start, 0), min(start + len(one.words), len(words)), got / total))
        out.append((len(words), sorted(found, key=lambda row: (row[1], row[0]))))
    return out


@pytest.fixture(scope="module")
def given():
    random = np.random.default_rng(11)
    pool = [w for one in TEMPLATES for w in one.words] + ["zzz", "é", "CC-BY", "By"]
    texts = [
        None,
        "",
        " .,\n",
        "cc by cc by CC-BY, general Public\nLicense; all RIGHTS reserved",
        "cc by",
        "cc\x7fby ccby ccé by",
        "Licensed under the Apache License, Version 2.0.",
        "the Apache License, Version 2.0",
        "Released under the MIT License.",
        "under one MIT License",
        "Licensed under CC BY-NC 4.0.",
        "GNU General Public License, version 3.",
        "Permission is hereby granted, free of charge, to any person obtaining a COPY of this software",
        "Permission is hereby granted, free of charge, to one person obtaining a copy",
        "ＣＣ by Cc By İ by",
    ]
    texts += [" ".join(random.choice(pool, random.integers(1, 60))) for _ in range(40)]
    for one in TEMPLATES:
        words = one.words * 2
        words[int(random.integers(0, len(words)))] = "zzz"
        texts.append("x " + " ".join(words))
    return texts


def test_scan(spark, given):
    small_batches(spark)
    rows = [(k if k % 5 else None, text, "s", 1) for k, text in enumerate(given)] + [(3, given[3], "s", 2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, found string, n_words int")
    labels = [(one.label, one.base) for one in TEMPLATES]
    found = [(r.n_words, [(labels.index((f.label, f.base)), f.start, f.end, f.share) for f in r.found]) for r in licenses.scan(frame).collect()]
    expected = brute([row[1] for row in rows])
    named = [(n, [(labels.index(labels[k]), *rest) for k, *rest in some]) for n, some in expected]
    assert sorted(map(str, found)) == sorted(map(str, named))


@pytest.mark.parametrize("size", [1, 7, 64, 10**6])
def test_slices_change_nothing(given, size):
    weights = {w: 1 + len(w) for one in TEMPLATES for w in one.words}
    index = Index(TEMPLATES, weights, 80)
    text = " ".join(t or "" for t in given)
    assert index.scan(text, size) == index.scan(text) and len(index.scan(text)[1]) > 30


def test_hot_words_in_a_long_text(given):
    index = Index(TEMPLATES, {w: 1 + len(w) for one in TEMPLATES for w in one.words}, 80)
    n, found = index.scan("license cc by " * 700_000)
    assert n == 2_100_000 and len(found) == 700_000


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "cc by")]])
def test_small_tables(spark, rows):
    found = licenses.digests(licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    assert [(r.doc_id, r.n_base, r.base_labels, r.score) for r in found] == [
        (d, int(bool(t)), "cc-by" if t else "", float(bool(t))) for d, t in rows
    ]


def test_query_and_sql(spark, given, tmp_path):
    from firstseen.llm.queries import ORACLES, QUERIES

    frame = spark.createDataFrame(list(enumerate(given)), "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    for folder, files in ((DATA, "documents.parquet"), (tmp_path, "documents.parquet/*.parquet")):
        base = duckdb.connect()
        base.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/{files}'")
        result = QUERIES["op11_licenses"](spark, str(folder))
        expected = base.sql(ORACLES["op11_licenses"])
        assert result.columns == expected.columns
        assert sorted(map(tuple, result.collect()), key=str) == sorted(expected.fetchall(), key=str)
