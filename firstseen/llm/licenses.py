"""Licence scans with a positional index of rare words.

A template is a run of words; some of them, its key phrases, must stand at their
places, and of all of them a share by weight. Weights are rarities (IDF) counted
over all documents. The index has one posting per template: its rarest key word
and that word's place. A file's words are looked up there; each hit fixes where
the template would start, and the other postings are intersected at their relative
places, rarest first, until the share is out of reach. No match can do without
its rarest key word, so nothing is lost.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.llm.frames import texts

# Part of a template's weight that must stand in place.
PERCENT = 80
# Bytes of a text split into words at once.
SLICE_BYTES = 4 << 20


class Template(NamedTuple):
    """Words with key phrases between brackets. ``base`` ones are plain phrases."""

    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.replace("[", " ").replace("]", " ").split()

    @property
    def keys(self) -> list[int]:
        """Places of the words of key phrases."""
        found, inside = [], False
        place = 0
        for part in self.text.replace("[", " [ ").replace("]", " ] ").split():
            if part in "[]":
                inside = part == "["
            else:
                if inside:
                    found.append(place)
                place += 1
        return found


# Phrases and labels of the contract, and sentences of public licence
# notices in lower case without punctuation.
TEMPLATES = [
    Template("cc-by", "[cc by]", True),
    Template("gpl", "[general public license]", True),
    Template("reserved", "[all rights reserved]", True),
    Template("agpl", "gnu [affero general public license]"),
    Template("apache-2.0", "under the [apache license version 2 0]"),
    Template("apache-2.0", "you may not use this file except in [compliance with the license]"),
    Template("apache-2.0", "distributed under the license is distributed on an [as is basis] without warranties or conditions of any kind"),
    Template("bsd", "redistribution and use in [source and binary forms] with or without modification are permitted"),
    Template("bsd-3-clause", "nor the names of its contributors may be used to [endorse or promote products] derived from this software"),
    Template("bsl-1.0", "distributed under the [boost software license] version 1 0"),
    Template("cc-by-4.0", "[creative commons attribution 4 0] international"),
    Template("cc-by-nc", "under [cc by nc] 4 0"),
    Template("cc-by-nd", "under [cc by nd] 4 0"),
    Template("cc-by-sa", "under [cc by sa] 4 0"),
    Template("cc0-1.0", "waived [all copyright and related or neighboring rights]"),
    Template("epl-2.0", "under the terms of the [eclipse public license] 2 0"),
    Template("gpl-2.0", "[gnu general public license version 2]"),
    Template("gpl-3.0", "[gnu general public license version 3]"),
    Template("isc", "use copy modify and or distribute this software for any purpose [with or without fee] is hereby granted"),
    Template("lgpl", "gnu [lesser general public license]"),
    Template("mit", "under the [mit license]"),
    Template("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software"),
    Template("mit", "the above copyright notice and this [permission notice shall be included] in all copies"),
    Template("mpl-2.0", "subject to the terms of the [mozilla public license] v 2 0"),
    Template("unlicense", "this is [free and unencumbered software] released into the public domain"),
    Template("zlib", "[altered source versions must be plainly marked] as such and must not be misrepresented"),
]

# Digits and letters, in lower case, and every byte above ASCII are kept.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_FOUND = "array<struct<label:string,base:boolean,start:bigint,end:bigint,share:double>>"


def word_slices(text: str, size: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, some millions of bytes at a time."""
    data = text.encode().translate(_WORD_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + size)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def rarity(documents: int, holding: int) -> int:
    """A word's weight, in thousandths, at least 1."""
    return 1 + math.floor(1000 * math.log((documents + 1) / (holding + 1)))


class Index:
    """Templates by their rarest key word."""

    def __init__(self, templates: Sequence[Template], weights: dict[str, int], percent: int):
        self.openers: dict[bytes, list[tuple]] = {}
        self.reach = 0
        for number, one in enumerate(templates):
            words, keys = one.words, set(one.keys)
            rarest = min(keys, key=lambda q: (-weights[words[q]], q))
            rest = sorted((q for q in range(len(words)) if q != rarest), key=lambda q: (q not in keys, -weights[words[q]], q))
            total = sum(weights[word] for word in words)
            steps = [(q - rarest, words[q].encode(), weights[words[q]], q in keys) for q in rest]
            self.openers.setdefault(words[rarest].encode(), []).append((number, rarest, len(words), total, steps))
            self.reach = max(self.reach, len(words))
        self.percent = percent

    def matches(self, words: list[bytes], first: int, end: int) -> Iterator[tuple[int, int, int, float]]:
        """(template, start, end, share) of matches whose rarest key word is at ``first`` up to ``end``."""
        for opener in frozenset(self.openers).intersection(words):
            place = first - 1
            while True:
                try:
                    place = words.index(opener, place + 1, end)
                except ValueError:
                    break
                for number, rarest, length, total, steps in self.openers[opener]:
                    got = self._aligned(words, place, total, steps)
                    if got * 100 >= total * self.percent:
                        start = place - rarest
                        yield number, max(start, 0), min(start + length, len(words)), got / total

    def _aligned(self, words: list[bytes], place: int, total: int, steps: list) -> int:
        """The weight that stands in place; -1 once it cannot be enough."""
        got = total
        for shift, word, weight, key in steps:
            at = place + shift
            if not 0 <= at < len(words) or words[at] != word:
                got -= weight
                if key or got * 100 < total * self.percent:
                    return -1
        return got

    def scan(self, text: str, size: int = SLICE_BYTES) -> tuple[int, list[tuple[int, int, int, float]]]:
        """Number of words, and matches by start. Long texts pass slice by slice."""
        words: list[bytes] = []
        found, before, done = [], 0, 0
        for more in chain(word_slices(text, size), [None]):
            words += more or []
            # A match may go on in the words that follow.
            end = len(words) if more is None else max(done, len(words) - self.reach)
            found += [(n, a + before, b + before, share) for n, a, b, share in self.matches(words, done, end)]
            gone = max(0, end - self.reach)
            del words[:gone]
            before, done = before + gone, end - gone
        return before + len(words), sorted(found, key=lambda row: (row[1], row[0]))


def weights(documents: DataFrame, templates: Sequence[Template] = TEMPLATES) -> dict[str, int]:
    """The rarity of every word of the templates over all documents."""
    vocabulary = {word.encode() for one in templates for word in one.words}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column("text"):
                present: set[bytes] = set()
                for words in word_slices(text.as_py()):
                    present |= vocabulary.intersection(words)
                held.update(present)
        names = ["", *(word.decode() for word in held)]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([rows, *held.values()], pa.int64())], names=["word", "n"])

    counted = texts(documents).select("text").mapInArrow(count, "word string, n bigint")
    # As many rows as the templates have words, and one.
    found = {r.word: r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = found.get("", 0)
    return {word.decode(): rarity(total, found.get(word.decode(), 0)) for word in vocabulary}


def scan(documents: DataFrame, templates: Sequence[Template] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, found: one row per document, with every place of a licence.

    ``found`` is by start, in words from 0; ``share`` is the part of the template's
    weight that stands there, 1 for the plain phrases. A match that the start or
    end of a text cuts ends there. A null text is empty; empty texts have no words
    and nothing found. Rows are scanned one by one, so repeated rows and rows
    without doc_id give a row each; other columns, whatever their names, are left
    behind. Texts are whole, however long: words pass in slices and a template
    across two slices is found. An empty table gives no row.
    """
    index = Index(templates, weights(documents, templates), percent)
    labels, bases = [one.label for one in templates], [one.base for one in templates]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, rows = [], []
            for text in batch.column("text"):
                n, found = index.scan(text.as_py())
                counts.append(n)
                rows.append([{"label": labels[k], "base": bases[k], "start": a, "end": b, "share": s} for k, a, b, s in found])
            kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(rows, kind)], names=["doc_id", "n_words", "found"]
            )

    return texts(documents).mapInArrow(find, f"doc_id bigint, n_words bigint, found {_FOUND}")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place of the plain phrases, labels and the best share."""
    base = F.filter("found", lambda one: one["base"])
    starts = F.transform(base, lambda one: one["start"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda one: one["label"]))), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda one: one["share"])), F.lit(0.0)).alias("score"),
    )


def oracle(templates: Sequence[Template] = TEMPLATES, percent: int = PERCENT) -> str:
    """The digests in SQL: every word of every text against every posting."""
    rows = ", ".join(
        f"({number}, '{one.label}', {one.base}, {q}, '{word}', {q in one.keys})"
        for number, one in enumerate(templates)
        for q, word in enumerate(one.words)
    )
    return rf"""
        WITH postings(t, label, base, q, word, key) AS (VALUES {rows}),
        docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), held AS (SELECT r, unnest(list_distinct(w)) AS word FROM docs),
        holding AS (SELECT word, count(*) AS n FROM held GROUP BY word),
        weighted AS (
            SELECT p.*, 1 + floor(1000 * ln(((SELECT count(*) FROM docs) + 1) / (coalesce(n, 0) + 1)))::BIGINT AS weight
            FROM postings p LEFT JOIN holding USING (word)
        ), totals AS (
            SELECT t, label, base, sum(weight) AS total, count(*) FILTER (key) AS keys FROM weighted GROUP BY ALL
        ), places AS (
            SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs
        ), votes AS (
            SELECT r, t, p - q AS start, sum(weight) AS got, count(*) FILTER (key) AS keyed
            FROM places JOIN weighted USING (word) GROUP BY ALL
        ), found AS (
            SELECT r, label, base, start, got::DOUBLE / total AS share FROM votes JOIN totals USING (t)
            WHERE keyed = keys AND got * 100 >= total * {percent}
        ), summed AS (
            SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
                max(start) FILTER (base) AS last_word, max(share) AS score,
                string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                string_agg(DISTINCT label, ',' ORDER BY label) AS labels
            FROM found GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
            coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM docs LEFT JOIN summed USING (r)
    """
