"""Personal data: fixed patterns, and spans added by a trained character tagger.

The patterns give the base spans. The tagger learns from windows of texts whose
spans the patterns labelled: a bounded sample, taken by hash over all documents
(``TRAINING_WINDOWS``). It reads every text in overlapping windows. All kinds
hold a digit or an at sign, so spans without one are barred and a window with
neither decodes to no span; such windows are not run. Each character's tag is
taken from the window it lies deepest in, which gives one tag sequence per text;
its spans that touch no base span are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.llm.frames import texts
from firstseen.llm.tagger import Tagger, character_ids, train

# Kinds in the order they are listed, with their patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number that starts inside a run of digits matches only if the whole run does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")

TRAINING_WINDOWS = 1500
TRAINING_LENGTH = 64
UPDATES = 300
BATCH = 32
WINDOW = 128
OVERLAP = 48
# Windows run through the tagger together.
WINDOWS_TOGETHER = 256

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    values = [int(d) for d in digits[::-1]]
    doubled = (v * 2 for v in values[1::2])
    return (sum(values[::2]) + sum(v - 9 if v > 9 else v for v in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches: an at sign, as far left as the local part goes."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end, "email"
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind as listed."""
    if not _ANCHOR.search(text):
        return []
    found = list(_emails(text))
    for match in _IP.finditer(text):
        # Longer parts than any number are cut before they are read as one.
        if all(int(part[-4:]) <= 255 and not part[:-4].strip("0") for part in match[0].split(".")):
            found.append((*match.span(), "ip"))
    for match in _CARD.finditer(text):
        if 12 <= len(match[0]) - match[0].count(" ") - match[0].count("-") <= 19:
            digits = match[0].replace(" ", "").replace("-", "")
            if luhn(digits):
                found.append((*match.span(), "card"))
    for match in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, match[0])) <= 15:
            found.append((*match.span(), "phone"))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def tags_of(spans: list[Span], size: int) -> np.ndarray:
    tags = np.zeros(size, np.int64)
    for start, end, kind in spans:
        if not tags[start:end].any():
            first = 2 * KINDS.index(kind) + 1
            tags[start:end] = first + 1
            tags[start] = first
    return tags


def _placed(ids: np.ndarray, start: int, length: int) -> np.ndarray:
    """``length`` values from ``start`` on, zero outside."""
    out = np.zeros(length, ids.dtype)
    low, high = max(start, 0), min(start + length, len(ids))
    if low < high:
        out[low - start : high - start] = ids[low:high]
    return out


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around spans, and around digits and at signs outside of spans."""
    for batch in batches:
        rows: list[tuple[int, bool, bytes, bytes]] = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            if not spans and not _ANCHOR.search(text):
                continue
            centres = [(start + end) // 2 for start, end, _ in spans]
            # Where a text has no span, or far from its spans.
            other = [m.start() for m in _ANCHOR.finditer(text) if all(abs(m.start() - c) > TRAINING_LENGTH for c in centres[:50])]
            places = [(c, True) for c in centres] + [(c, False) for c in other[:: max(1, len(other) // 3)][:3]]
            if not places:
                continue
            ids, tags = character_ids(text), tags_of(spans, len(text))
            for centre, holds in places:
                mark = xxhash.xxh64_intdigest(f"{centre} {text[max(0, centre - 40) : centre + 40]}")
                start = centre - 8 - mark % (TRAINING_LENGTH - 16)
                window = [_placed(x, start, TRAINING_LENGTH).astype(np.uint8).tobytes() for x in (ids, tags)]
                rows.append((mark >> 1, holds, *window))
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in columns], names=["mark", "holds", "ids", "tags"])


def fit(documents: DataFrame, windows: int = TRAINING_WINDOWS) -> Tagger:
    """Train on at most ``windows`` windows, two thirds of them with spans."""
    found = texts(documents).mapInArrow(_training_windows, "mark bigint, holds boolean, ids binary, tags binary")
    chosen = found.filter("holds").orderBy("mark", "ids", "tags").limit(windows * 2 // 3).unionAll(
        found.filter("NOT holds").orderBy("mark", "ids", "tags").limit(windows // 3)
    )
    rows = sorted((r.mark, bytes(r.ids), bytes(r.tags)) for r in chosen.collect())
    ids, tags = (np.array([np.frombuffer(r[k], np.uint8) for r in rows], np.int64).reshape(-1, TRAINING_LENGTH) for k in (1, 2))
    return train(ids, tags, len(KINDS), UPDATES, BATCH)


def _windows(text: str) -> list[int]:
    """Starts of the windows of a text that hold a digit or an at sign."""
    step = WINDOW - OVERLAP
    starts: list[int] = []
    for match in _ANCHOR.finditer(text):
        last = match.start() // step
        first = max(0, -(-(match.start() - WINDOW + 1) // step))
        for number in range(max(first, starts[-1] // step + 1 if starts else 0), last + 1):
            starts.append(number * step)
    return starts


def tag_texts(texts: list[str], tagger: Tagger) -> list[np.ndarray]:
    """One tag per character, from the window each character lies deepest in."""
    places = [(k, start) for k, text in enumerate(texts) for start in _windows(text)]
    stitched = [np.zeros(len(text), np.int64) for text in texts]
    for first in range(0, len(places), WINDOWS_TOGETHER):
        some = places[first : first + WINDOWS_TOGETHER]
        known = {k: character_ids(texts[k]) for k in {k for k, _ in some}}
        tags = tagger.decode(np.stack([_placed(known[k], start, WINDOW) for k, start in some]))
        for (k, start), found in zip(some, tags, strict=True):
            low = 0 if start == 0 else OVERLAP // 2
            high = min(WINDOW - OVERLAP // 2 if start + WINDOW < len(texts[k]) else WINDOW, len(texts[k]) - start)
            if low < high:
                stitched[k][start + low : start + high] = found[low:high]
    return stitched


def read_spans(tags: np.ndarray) -> Iterator[Span]:
    """Runs of one kind; a B starts a new one."""
    inside = np.flatnonzero(tags)
    start = None
    for k in inside.tolist():
        tag = int(tags[k])
        if start is not None and (tag % 2 == 1 or k != end or (tag + 1) // 2 != (int(tags[k - 1]) + 1) // 2):
            yield start, end, KINDS[(int(tags[end - 1]) - 1) // 2]
            start = None
        if start is None:
            start = k
        end = k + 1
    if start is not None:
        yield start, end, KINDS[(int(tags[end - 1]) - 1) // 2]


def find(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    out = []
    for text, tags in zip(texts, tag_texts(texts, tagger), strict=True):
        base = base_spans(text)
        taken = np.zeros(len(text) + 1, bool)
        for start, end, _ in base:
            taken[start:end] = True
        added = [
            (start, end, kind)
            for start, end, kind in read_spans(tags)
            if not taken[start:end].any() and (("@" in text[start:end]) if kind == "email" else re.search("[0-9]", text[start:end]))
        ]
        out.append((base, sorted(base + added, key=_order)))
    return out


def detect(documents: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """One row per document: counts per kind and hash of the base spans, all spans.

    doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added. A null
    text is empty; rows that repeat stay; an empty table gives no row.
    """
    tagger = tagger or fit(documents)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = find(batch.column("text").to_pylist(), tagger)
            counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in rows], pa.int64()) for kind in KINDS]
            hashes = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows], pa.string())
            spans = pa.array([joined(every) for _, every in rows], pa.string())
            added = pa.array([len(every) - len(base) for base, every in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, hashes, spans, added],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return texts(documents).mapInArrow(found, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_added bigint")


def redact_text(text: str, spans: list[Span]) -> str:
    """Put ``[KIND]`` for each span; spans that overlap become one."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def redact(documents: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """The same rows and columns with personal data replaced in ``text``.

    ``n_chars``, where there is one, counts the new text. A null text stays null.
    """
    tagger = tagger or fit(documents)

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("text").to_pylist()
            spans = find([text or "" for text in given], tagger)
            new = [None if text is None else redact_text(text, every) for text, (_, every) in zip(given, spans, strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = documents.mapInArrow(replaced, documents.schema)
    return out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in documents.columns else out
