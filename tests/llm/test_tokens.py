"""Ids by words against ids of whole texts; token files; packing."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from firstseen.llm import packing, token_files
from firstseen.llm.frames import small_batches
from firstseen.llm.tokens import WordEncoder, default_vocabulary

ODD = [
    "", " ", "\n", "á ́b", "İx Σας ẞ ÀÉÖ.", "it's we'll 's ''s", "a<|endoftext|>b <|startoftext|>",
    "tab\tand\x1cand\x85and\xa0and end", "3.14 555-7962 x9y", "THE,*** word&&& ...", "ﬁ ǅ ÷×ß µ", "日本語 テスト", "x" * 3000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def whole(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_give_the_ids_of_the_text(tokenizer):
    found = WordEncoder(default_vocabulary(), words_kept=3).encode(ODD)
    assert found == [whole(tokenizer, text) for text in ODD]
    encoder = WordEncoder(default_vocabulary(), words_kept=3)
    for text in ODD + ODD:
        assert encoder.encode([text]) == [whole(tokenizer, text)]


ENCODER, WHOLE = WordEncoder(default_vocabulary()), Tokenizer.from_file(default_vocabulary())


def other_vocabulary(folder, name):
    """Vocabularies that cut otherwise: tokens with their space, word by word, cut short."""
    import public_tokenizers
    from tokenizers import pre_tokenizers

    spaced = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    if name == "words":
        spaced.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    elif name == "short":
        spaced.enable_truncation(3)
    elif name == "strips":
        spaced.add_special_tokens([AddedToken("<x>", lstrip=True)])
    spaced.save(str(folder / f"{name}.json"))
    return str(folder / f"{name}.json")


@pytest.mark.parametrize("name, by_words", [("spaced", False), ("words", True), ("short", False), ("strips", False)])
def test_other_vocabularies_give_the_ids_of_the_text(tmp_path, name, by_words):
    path = other_vocabulary(tmp_path, name)
    found, plain = WordEncoder(path), Tokenizer.from_file(path)
    plain.no_truncation()
    given_texts = [*ODD, "Two  words, a <x> mark\n and Ends.", " led by a space"]
    assert found.by_words == by_words
    assert found.encode(given_texts) == [whole(plain, text) for text in given_texts]


def test_default_vocabulary_goes_by_words():
    assert ENCODER.by_words


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=["Cs"]), max_size=40))
def test_any_text(text):
    assert ENCODER.encode([text]) == [whole(WHOLE, text)]


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 9, 100])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert (token_files.from_planes(token_files.to_planes(ids, planes), n, planes) == ids).all()


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_segment_blocks_read_alone(planes):
    ids = [np.arange(5, dtype="<u4"), np.zeros(0, "<u4"), np.arange(70000, 70007, dtype="<u4")]
    segment = token_files.Segment(token_files.encode_segment([4, None, -2], ids, planes, 4))
    assert segment.n_blocks == 3 and segment.block(1).tolist() == [4, 70000, 70001, 70002]
    assert segment.ids().tolist() == np.concatenate(ids).tolist()
    assert segment.documents()[0] == [4, None, -2] and segment.documents()[1].tolist() == [5, 0, 7]


@pytest.fixture(scope="module")
def rows():
    many = [(k, "word " * (k % 7) + str(k), "x") for k in range(300)]
    return many + [(7, "again", "x"), (7, "again", "x"), (900, None, None), (None, "no id", "y"), (901, "long " * 9000, "z")]


@pytest.fixture(scope="module")
def documents(spark, rows):
    small_batches(spark)
    return spark.createDataFrame(rows, "doc_id bigint, text string, start string")


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_files_hold_every_id_in_order(spark, documents, rows, tokenizer, tmp_path, planes):
    path = str(tmp_path / "ids")
    token_files.write_token_files(documents, path, planes=planes, block_ids=64, segment_ids=500)
    found = {tuple(r) for r in token_files.read_token_files(spark, path).collect()}
    expected, at = set(), 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        raw = whole(tokenizer, text or "") + np.array([1], "<u4").tobytes()
        expected.add((doc_id, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    assert found == expected


def test_empty_table(spark, documents, tmp_path):
    none = documents.limit(0)
    token_files.write_token_files(none, str(tmp_path / "none"))
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0
    assert packing.pack(none).count() == 0


def best(lengths, capacity):
    sums = {0}
    for length in lengths:
        sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=12), st.integers(0, 64))
def test_fill_is_closest(lengths, capacity):
    taken = packing.fill(np.bincount(lengths, minlength=65), capacity)
    assert sum(n * k for n, k in taken.items()) == best(lengths, capacity)
    assert all(k <= lengths.count(n) for n, k in taken.items())


def test_packed_sequences_are_gapless(documents, rows, tokenizer):
    found = packing.pack(documents, window=64, shard_pieces=100).toPandas()
    expected = []
    for doc_id, text, _ in rows:
        raw = whole(tokenizer, text or "") + np.array([1], "<u4").tobytes()
        for at in range(0, len(raw), 256):
            expected.append((doc_id, at // 4, zlib.crc32(raw[at : at + 256]), len(raw) // 4))
    key = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    listed = [tuple(None if x != x else int(x) for x in row) for row in found[key].itertuples(index=False, name=None)]
    assert sorted(map(str, listed)) == sorted(map(str, expected))
    for _, sequence in found.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        ends = (sequence["offset"] + sequence["length"]).tolist()
        assert sequence["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 64
        assert (sequence["sequence_tokens"] == ends[-1]).all()
    sizes = found.groupby("sequence_id")["length"].sum()
    assert (64 * len(sizes) - sizes.sum()) / sizes.sum() < 0.05


def test_equal_rows_spread(spark, documents, tmp_path):
    """Rows without id and text are no task's burden: not in packing, not in files."""
    equal = spark.range(0, 6000, 1, 6).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text")
    )
    found = packing.pack(equal, window=64, shard_pieces=500).toPandas()
    assert len(found) == 6000 and found["length"].eq(1).all()
    # Sequence numbers tell the shard: twelve of them.
    shards = found["sequence_id"] % 12
    assert shards.nunique() == 12 and shards.value_counts().max() < 700
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        token_files.write_token_files(equal, str(tmp_path / "equal"))
    finally:
        spark.conf.set(name, before)
    parts = spark.read.parquet(str(tmp_path / "equal")).groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    assert len(parts) > 2 and max(row.n for row in parts) < 3000
    back = token_files.read_token_files(spark, str(tmp_path / "equal")).toPandas()
    assert sorted(back["start"]) == list(range(6000)) and back["doc_id"].isna().all()
