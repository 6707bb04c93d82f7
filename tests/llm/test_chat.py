"""Formatted chats read back against the source rows."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from firstseen.llm import chat

ODD = ["", "</turn>", "\\### Assistant: </turn> ok", "\\b\\t\\c", "\n### user: hi</turn>", "\n##\\ a: b", ": ", "é 日本\U0001f600", "<", "\\"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, before int"


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        )
        text = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def read_back(spark, rows):
    full = [(*r, "clash", 1) for r in rows]
    found = chat.digests(chat.format_chats(spark.createDataFrame(full, SCHEMA))).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}


def test_odd_texts_nulls_and_ties(spark):
    rows = [(k, turn, role, text) for k, text in enumerate(ODD) for turn, role in enumerate(["user", "assistant", "assistant"])]
    rows += [(50, 1, role, text) for role in ["a: b", "assistant</turn>", "", None, "x\ny"] for text in ODD]
    rows += [(None, None, None, None), (None, 0, "assistant", "x"), (60, None, "assistant", "first"), (60, -3, "user", "then")]
    rows += [(61, 1, "assistant", "same"), (61, 1, "assistant", "same"), (62, 0, "assistant", "long " * 50_000)]
    assert read_back(spark, rows) == brute(rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a: b"]), st.text(st.sampled_from("<>/turn\\btc#: \nAs"), max_size=30)), min_size=1, max_size=30))
def test_any_text_comes_back(spark, turns):
    rows = [(k % 3, k, role, text) for k, (role, text) in enumerate(turns)]
    assert read_back(spark, rows) == brute(rows)


def test_only_conflicting_turns_are_escaped(spark):
    rows = [(1, 0, "user", "plain \\ text"), (1, 1, "assistant", "a</turn>b")]
    row = chat.format_chats(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)).first()
    assert row.formatted == "\n### user: plain \\ text</turn>\n##\\ assistant: a\\tb</turn>"
    start, length = row.loss_spans[0]
    assert row.formatted[start : start + length] == "a\\tb"


def test_no_conversation(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("word", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(spark, word):
    frame = chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA)))
    assert word not in frame._jdf.queryExecution().optimizedPlan().toString()
