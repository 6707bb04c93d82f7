"""Base spans against the plain patterns; gradients; what the tagger finds."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from firstseen.llm import pii, tagger
from firstseen.llm.frames import small_batches

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(p) > 255 for p in match[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((match.start(), match.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("0123459.@+- ()ab%_é\n"), max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize(
    "text",
    ["a@b.c", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (578) 555-6437", "255.255.255.255 256.1.1.1", "0001.2.3.4", "1.2.3.4.5.6.7.8", "x" * 60_000 + "@", "1" * 5000, "(" * 5000, "+1" + " " * 5000],
)
def test_base_spans_of_known_texts(text):
    assert pii.base_spans(text) == plain(text)


def test_chain_gradients_are_those_of_the_loss():
    random = np.random.default_rng(0)
    unary, transitions = random.normal(size=(4, 2, 3)), random.normal(size=(3, 3))
    tags = random.integers(0, 3, (4, 2))
    loss, d_unary, d_transitions = tagger._chain_gradients(unary, transitions, tags)
    for array, grad in ((unary, d_unary), (transitions, d_transitions)):
        for place in np.ndindex(array.shape):
            array[place] += 1e-5
            more = tagger._chain_gradients(unary, transitions, tags)[0]
            array[place] -= 1e-5
            assert (more - loss) / 1e-5 == pytest.approx(grad[place], abs=1e-3)


def test_recurrent_gradients_are_those_of_the_states():
    random = np.random.default_rng(1)
    ids = random.integers(0, tagger.VOCABULARY, (5, 3))
    inputs, recurrent = random.normal(size=(tagger.VOCABULARY, 8)), random.normal(size=(2, 8))
    weight = random.normal(size=(5, 3, 2))
    states, kept = tagger._run(inputs, recurrent, ids, keep=True)
    d_inputs, d_recurrent = tagger._back(recurrent, ids, kept, weight)
    value = (states * weight).sum()
    for array, grad in ((inputs, d_inputs), (recurrent, d_recurrent)):
        for place in [tuple(random.integers(0, n) for n in array.shape) for _ in range(20)] + [(int(ids[0, 0]), 1)][: array is inputs]:
            array[place] += 1e-6
            more = (tagger._run(inputs, recurrent, ids)[0] * weight).sum()
            array[place] -= 1e-6
            assert (more - value) / 1e-6 == pytest.approx(grad[place], abs=1e-3)


def test_best_tags_are_the_best():
    random = np.random.default_rng(2)
    unary, transitions = random.normal(size=(4, 1, 3)), random.normal(size=(3, 3))
    found = tagger._viterbi(unary, transitions)[0]
    score = lambda t: sum(unary[k, 0, t[k]] for k in range(4)) + sum(transitions[a, b] for a, b in zip(t, t[1:], strict=False))
    assert score(found) == pytest.approx(max(score(t) for t in np.ndindex(3, 3, 3, 3)))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n1@é"), max_size=700))
def test_windows_hold_every_anchor_deep(text):
    starts = pii._windows(text)
    assert starts == sorted(set(starts))
    step = pii.WINDOW - pii.OVERLAP
    needed = {s for s in range(0, len(text) + 1, step) if re.search("[0-9@]", text[s : s + pii.WINDOW])}
    assert needed <= set(starts)


def texts_with(spans):
    random = np.random.default_rng(3)
    word = lambda: "".join(random.choice(list("abcdefghijklmnop"), int(random.integers(2, 9))))
    make = {
        "email": lambda: f"{word()}.{random.integers(10, 99)}@{word()}.example.com",
        "ip": lambda: ".".join(str(random.integers(1, 255)) for _ in range(4)),
        "phone": lambda: f"+1 ({random.integers(200, 999)}) 555-{random.integers(1000, 9999)}",
        "card": lambda: _card(random),
    }
    out = []
    for k in range(spans):
        kind = list(make)[k % 4]
        out.append(" ".join([*(word() for _ in range(12)), make[kind](), *(word() for _ in range(8)), f"no {random.integers(1, 99)}", word()]))
    return out


def _card(random):
    digits = "4" + "".join(str(d) for d in random.integers(0, 10, 14))
    return next(digits + str(d) for d in range(10) if pii.luhn(digits + str(d)))


def test_held_out_spans_are_found_by_the_tagger(spark):
    small_batches(spark)
    texts = texts_with(400)
    frame = spark.createDataFrame(list(enumerate(texts[:300])), "doc_id bigint, text string")
    model = pii.fit(frame)
    held = texts[300:]
    tags = pii.tag_texts(held, model)
    hits = [span in set(pii.read_spans(t)) for text, t in zip(held, tags, strict=True) for span in pii.base_spans(text)]
    assert len(hits) >= 100 and np.mean(hits) > 0.9
    # A text cut into the same windows alone or among others gives the same tags.
    long = " ".join(held)
    assert (pii.tag_texts([long], model)[0] == pii.tag_texts(["x 1", long, held[0]], model)[1]).all()
    found = pii.detect(spark.createDataFrame([(1, long, "clash"), (2, None, ""), (None, "a@b.cc", "")], "doc_id bigint, text string, spans string"), model)
    rows = {r.doc_id: r for r in found.collect()}
    base = plain(long)
    assert rows[1].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
    assert set(pii.joined(base).split(",")) <= set(rows[1].spans.split(","))
    assert [rows[1][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in base) for k in pii.KINDS]
    assert rows[2].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[None].n_email == 1


def test_redaction_and_empty_tables(spark):
    small_batches(spark)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    frame = spark.createDataFrame([(1, "to a@b.cc now", "en", "s", 13), (2, None, None, None, None)], schema)
    model = pii.fit(frame.limit(0))
    out = {r.doc_id: r for r in pii.redact(frame, model).collect()}
    assert out[1].text == "to [EMAIL] now" and out[1].n_chars == 14 and out[2].text is None
    assert pii.redact(frame, model).schema.names == frame.schema.names
    assert pii.detect(frame.limit(0)).count() == 0
    assert pii.redact_text("abcdef", [(1, 4, "ip"), (2, 5, "card")]) == "a[IP]f"
