"""Retrieval against exhaustive scores, verification against shingles."""

from __future__ import annotations

import numpy as np
import pytest

from firstseen.llm import decontaminate as d
from firstseen.llm.frames import small_batches


def corpus(seed, items=60):
    random = np.random.default_rng(seed)
    weights = 1 / np.arange(1, 800)
    vocabulary = np.array([f"w{k}" for k in range(1, 800)])
    text = lambda n: " ".join(random.choice(vocabulary, n, p=weights / weights.sum()))
    tests = [(k, text(int(random.integers(8, 40))) + ("\n" + text(10) if k % 2 else "")) for k in range(items)]
    documents = []
    for k in range(150):
        body = text(int(random.integers(0, 400)))
        if k % 3 == 0:
            words = tests[k % items][1].split()
            for _ in range(k % 5):
                words[int(random.integers(0, len(words)))] = "changed"
            body = f"{body} {' '.join(words).upper()}! {text(int(random.integers(0, 200)))}"
        documents.append((k, body))
    return tests, documents


@pytest.mark.parametrize("seed", range(4))
def test_search_against_all_scores(seed):
    tests, _ = corpus(seed)
    index, random = d.Index(tests), np.random.default_rng(seed)
    for _ in range(150):
        terms = set(random.choice(len(index.terms), int(random.integers(1, 60)), replace=False).tolist())
        own = int(random.integers(0, len(index.items)))
        terms |= {t for t, postings in enumerate(index.postings) if any(k == own for k, _ in postings) and random.random() < 0.8}
        scores = np.zeros(len(index.items))
        for term in terms:
            for item, impact in index.postings[term]:
                scores[item] += impact
        threshold = float(random.uniform(0.05, 0.9))
        if np.abs(scores - threshold).min() > 1e-6:
            found = dict(index.search(sorted(terms), threshold))
            assert set(found) == set(np.flatnonzero(scores >= threshold).tolist())
            assert all(found[k] == pytest.approx(scores[k]) for k in found)


def test_parts_of_an_item():
    item = d.Item.of(1, "a b c d e f g h\ni j")
    reaching = {"a b c d e", "b c d e f", "c d e f g", "d e f g h", "e f g h i", "f g h i j"}
    assert item.question == reaching
    assert item.answer == {"e f g h i", "f g h i j"}
    assert d.Item.of(2, "one two").overlaps({"one two"}) == (1, 1, 1)


def brute(tests, documents):
    out = set()
    for doc_id, text in documents:
        for item_id, item in tests:
            if width := min(5, len(d.words(item or ""))):
                sequence = d.words(text or "")
                have = {" ".join(sequence[k : k + width]) for k in range(len(sequence) - width + 1)}
                whole, question, answer = d.Item.of(item_id, item).overlaps(have)
                if whole >= 0.8 and min(question, answer) >= 0.25:
                    out.add((doc_id, item_id))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_pairs_against_all_shingles(spark, seed):
    small_batches(spark)
    tests, documents = corpus(seed)
    docs = spark.createDataFrame([(*r, 0.0) for r in documents], "doc_id bigint, text string, score double")
    bench = spark.createDataFrame([(*r, "x") for r in tests], "item_id bigint, text string, doc_id string")
    found = [(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()]
    expected = brute(tests, documents)
    assert set(found) == expected and len(found) == len(expected) > 12
    clean = {r.doc_id for r in d.keep_clean(docs, bench).collect()}
    assert clean == {k for k, _ in documents} - {k for k, _ in expected}


def test_several_passes_and_indexes(spark, monkeypatch):
    tests, documents = corpus(7)
    docs = spark.createDataFrame(documents, "doc_id bigint, text string")
    bench = spark.createDataFrame(tests, "item_id bigint, text string")
    monkeypatch.setattr(d, "PASS_BYTES", 2000)
    monkeypatch.setattr(d, "INDEX_ITEMS", 5)
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()} == brute(tests, documents)
    expected = {k for k, _ in documents} - {k for k, _ in brute(tests, documents)}
    assert {r.doc_id for r in d.keep_clean(docs, bench).collect()} == expected


SHORT = [(1, "capital of\nFrance"), (2, "yes"), (3, "zwei\nWörter"), (4, "a b\nc d"), (5, "法国的首都是哪里？巴黎"), (6, "เมืองหลวง ปารีส"), (7, "東京"), (8, "a b c d e f\ng h")]
HOLDERS = [
    (1, "The capital of France is known."), (2, "the capital of all France"), (3, "capital of France"), (4, "Yes"), (5, "yesterday"),
    (6, "x a b c d y"), (7, "a b c e d"), (8, "请问法国的首都是哪里？答案是巴黎。法国的首都是哪里？巴黎"), (9, "法国的首都"), (10, "zwei wörter und zwei"),
    (11, "เมืองหลวง ปารีส คือ"), (12, "今日は東京へ"), (13, "京東"), (14, "東 京 yes"), (15, None), (16, ""), (17, "a b c d e f g h"), (18, "of France the capital"),
]


def test_short_items_and_scripts_without_spaces(spark, tmp_path):
    """The operator, all shingles and the SQL agree."""
    import duckdb

    from firstseen.llm.queries import ORACLES, QUERIES

    expected = brute(SHORT, HOLDERS)
    assert {(1, 1), (3, 1), (4, 2), (6, 4), (8, 5), (10, 3), (12, 7), (14, 2), (14, 7), (17, 4), (17, 8)} <= expected
    assert not expected & {(2, 1), (5, 2), (7, 4), (9, 5), (13, 7), (18, 1)}
    spark.createDataFrame(HOLDERS, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(SHORT, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    result = QUERIES["op8_decontaminate"](spark, str(tmp_path))
    base = duckdb.connect()
    for name in ("documents", "benchmark"):
        base.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    by_sql = base.sql(ORACLES["op8_decontaminate"])
    assert {(r.doc_id, r.item_id) for r in result.collect()} == expected
    assert sorted(map(tuple, result.select(*by_sql.columns).collect())) == sorted(by_sql.fetchall())
    docs = spark.createDataFrame(HOLDERS, "doc_id bigint, text string")
    kept = d.keep_clean(docs, spark.createDataFrame(SHORT, "item_id bigint, text string"))
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in HOLDERS} - {k for k, _ in expected}


def test_question_and_answer_far_apart(spark):
    """A worksheet: questions first, the key to them at the end."""
    question, other, answer = ([f"{c}{k}" for k in range(n)] for c, n in (("q", 30), ("o", 200), ("a", 20)))
    tests = [(1, f"{' '.join(question)}\n{' '.join(answer)}")]
    scattered = " . ".join(" ".join(part + other) for part in (question[:15], question[10:], answer[:12], answer[8:]))
    docs = [(1, " ".join(question + other + answer)), (2, scattered), (3, " ".join(question + other)), (4, " ".join(other + answer))]
    assert brute(tests, docs) == {(1, 1), (2, 1)}
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(tests, "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in d.contaminated(frame, bench).collect()} == {(1, 1), (2, 1)}
    assert {r.doc_id for r in d.keep_clean(frame, bench).collect()} == {3, 4}


def test_rare_words_at_the_end_of_a_template():
    """Nearly all of the score lies in five of 41 words; a text may lack them."""
    template = [f"t{k}" for k in range(36)]
    tests = [(k, " ".join([*template, *(f"r{k}x{j}" for j in range(5))])) for k in range(300)]
    texts = [" ".join([*template, *(f"other{j}" for j in range(5))]), " ".join(template[:20]), tests[0][1]]
    expected = [{k for d, k in brute(tests, enumerate(texts)) if d == row} for row in range(3)]
    assert len(expected[0]) == 300 and not expected[1] and len(expected[2]) == 300
    for size in (300, 7, 1):
        indexes = [d.Index(tests[k : k + size]) for k in range(0, 300, size)]
        assert [{indexes[i].items[k].item_id for i, k in one} for one in d.matches(indexes, texts)] == expected


def test_least_share_against_all_choices():
    random = np.random.default_rng(3)
    for _ in range(60):
        words = [f"w{k}" for k in random.integers(0, 14, int(random.integers(1, 14)))]
        impacts = {w: float(random.random()) for w in words}
        names, whole, least = list(impacts), d.shingles(words, min(5, len(words))), 1.0
        for chosen in range(2 ** len(names)):
            lost = {w for k, w in enumerate(names) if chosen >> k & 1}
            if sum(not lost & set(s.split()) for s in whole) / len(whole) >= d.OVERLAP:
                least = min(least, 1 - sum(impacts[w] for w in lost) / sum(impacts.values()))
        found = d.least_share(words, impacts)
        assert found <= least
        if len(set(words)) == len(words):
            assert found == pytest.approx(max(least, 1e-9), abs=2e-6)


def test_odd_rows_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (None, "a b c d e f g h"), (3, "!!"), (4, "one two"), (4, "one two"), (5, "z " * 60_000 + "a b c d e f g h")]
    tests = [(1, "a b c d e f g h"), (None, "a b c d e f g h"), (3, None), (4, ""), (5, "one two"), (6, "...")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(tests, "item_id bigint, text string")
    found = sorted(((r.doc_id, r.item_id) for r in d.contaminated(frame, bench).collect()), key=str)
    assert found == sorted([(None, 1), (None, None), (4, 5), (4, 5), (5, 1), (5, None)], key=str)
    assert d.contaminated(frame.limit(0), bench).count() == 0
    assert d.contaminated(frame, bench.limit(0)).count() == 0
    assert d.keep_clean(frame, bench.limit(0)).count() == len(docs)
