"""Groups, links and counts against whole texts and sets of ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from firstseen.llm import alignment
from firstseen.llm.frames import small_batches
from firstseen.llm.tokens import byte_letters

PATHS = alignment.default_vocabularies()


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens(tokenizers, text):
    """(ids, byte strings) of both; nothing if one differs from the text."""
    a, b = tokenizers
    if not text:
        return None
    letters = {x: k for k, x in enumerate(byte_letters())}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(letters[x] for x in a.id_to_token(k)) for k in ids_a]
    ids_b = b.encode(text)
    bytes_b = [bytes([int(p[1:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(ids_b, map(b.id_to_piece, ids_b))]
    whole = (" " + text).encode()
    return ((ids_a, bytes_a), (ids_b, bytes_b)) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None


def brute(tokenizers, rows):
    docs = []
    for doc_id, text in rows:
        found = tokens(tokenizers, text)
        if not found:
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        (ids_a, bytes_a), (ids_b, bytes_b) = found
        ends = [np.cumsum([len(x) for x in one]).tolist() for one in (bytes_a, bytes_b)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for cut in shared:
            groups.append("|".join(",".join(str(k) for k, e in zip(ids, one) if low < e <= cut) for ids, one in zip((ids_a, ids_b), ends)))
            low = cut
        links = [
            (x, y)
            for x, ex, bx in zip(ids_a, ends[0], bytes_a)
            for y, ey, by in zip(ids_b, ends[1], bytes_b)
            if ex - len(bx) < ey and ey - len(by) < ex
        ]
        docs.append((doc_id, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for *_, links, _ in docs for pair in set(links))
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [
        (d, a, b, g, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), sha)
        for d, a, b, g, links, sha in docs
    ]


def odd_texts():
    r = random.Random(3)
    marks = ["a", "Hello", "world", " ", "  ", "\n", "\t", "é", "日本語", "👩‍👩‍👧", "<|endoftext|>", "<s>", "<0x41>", "\x00", "don't", "12345", "...", " ", " ", "\r\n", "ﬁ"]
    yield from [None, "", " ", "  ", "\n", "x ", " x", "▁", "a▁b", "a b ", "a  b", "a\n b", "a \n  b", "　 a", "a\x1c b", "a\x85 b"]
    for _ in range(150):
        yield "".join(r.choice(marks) + r.choice(["", " ", ""]) for _ in range(r.randrange(30)))


def test_parts_are_encoded_as_in_the_whole(tokenizers):
    pair = alignment.token_pair(PATHS)
    assert pair.cut
    for text in odd_texts():
        found = tokens(tokenizers, text)
        a, b = pair.encode([text or ""])[0]
        expected = (found[0][0], found[1][0]) if found else ([], [])
        assert (np.frombuffer(a, "<i4").tolist(), np.frombuffer(b, "<i4").tolist()) == expected, text


@pytest.mark.parametrize("seed", range(8))
def test_shared_ends(seed):
    random_ = np.random.default_rng(seed)
    a, b, last, base = [], [], [], 0
    for _ in range(seed * 3):
        size = int(random_.integers(1, 400))
        pick = [sorted({size, *random_.choice(size, int(random_.integers(0, size)), replace=False).tolist()} - {0}) for _ in range(2)]
        a += [base + k for k in pick[0]]
        b += [base + k for k in pick[1]]
        last.append(len(a) - 1)
        base += size
    found = alignment.shared_ends(np.array(a, np.int64), np.array(b, np.int64), np.array(last, np.int64))
    assert found.tolist() == [k for k, e in enumerate(a) if e in set(b)]


def test_long_intervals_without_shared_ends():
    n = 1_000_000
    a, b = np.append(np.arange(1, n, 2), n), np.arange(2, n + 2, 2)
    assert alignment.shared_ends(a, b, np.array([len(a) - 1])).tolist() == [len(a) - 1]
    # Shared ends at both borders alone.
    a = np.concatenate([np.arange(1, 1000), np.arange(1001, n, 2), np.arange(n, n + 1000)])
    b = np.concatenate([np.arange(1, 1000), np.arange(1002, n, 2), np.arange(n, n + 1000)])
    found = alignment.shared_ends(a, b, np.array([len(a) - 1]))
    assert a[found].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def rows_of(spark, paths=None):
    texts = list(odd_texts()) + ["the same text", "the same text"]
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    return [(k if k % 7 else None, text) for k, text in enumerate(texts)] + [(1000 + r.doc_id, r.text[:2500]) for r in given]


@pytest.mark.parametrize(("block", "chunk"), [(2 << 20, 16 << 20), (400, 3000)])
def test_align(spark, tokenizers, monkeypatch, tmp_path, block, chunk):
    from firstseen.llm import queries

    rows = rows_of(spark)
    rows.append((5000, rows[-1][1]))
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id bigint, text string, chunk string, n_a int")
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    # Workers see the sizes as they are when the function is sent.
    whole = alignment._aligned

    def small(paths, groups):
        run = whole(paths, groups)

        def sized(batches):
            alignment.BLOCK_CHARS, alignment.CHUNK_CHARS = block, chunk
            try:
                yield from run(batches)
            finally:
                alignment.BLOCK_CHARS, alignment.CHUNK_CHARS = 2 << 20, 16 << 20

        return sized

    monkeypatch.setattr(alignment, "_aligned", small)
    result = queries.QUERIES["op12_alignment"](spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, result.collect()), key=str) == sorted(brute(tokenizers, rows), key=str)


def test_written_groups(spark):
    small_batches(spark)
    frame = spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in alignment.align(frame, groups=True).collect()}
    assert hashlib.sha256(found[1].groups.encode()).hexdigest() == found[1].groups_sha256
    assert found[1].groups.count(";") == found[1].n_groups - 1 and found[2].groups == "" == found[2].groups_sha256


def test_no_documents(spark):
    small_batches(spark)
    assert alignment.align(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_text_without_spaces_and_a_long_one(tokenizers):
    pair = alignment.token_pair(PATHS)
    aligner = alignment._Aligner(pair)
    text = "日本語のテキスト" * 3000
    found = aligner.align(pair.encode([text]))[0]
    expected = brute(tokenizers, [(1, text[:800])])[0]
    assert found[0] > expected[1] and found[2] > expected[3]
    words = "alpha beta, gamma " * 400_000
    parts = alignment._slices(words, True)
    assert len(parts) > 1 and " ".join(parts) == words
