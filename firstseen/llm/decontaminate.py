"""Benchmark decontamination: BM25 over test items with block-max WAND.

Test items are the indexed side; the distinct words of every whole text are a
query, so parts of an item are found together wherever they stand. Scores are
shares of an item's score against itself. An item's threshold is the least share
that a text with enough of its shingles can have, so retrieval loses nothing and
the pairs found do not depend on which items share an index; scores do.
Items lie in blocks; each posting list keeps its largest impact per block.
Blocks whose summed maxima stay below their least threshold are passed over for
many texts at a time; in the others the pointer algorithm runs. What it retrieves is
verified by the five-word shingles of the whole text, of the item and of its
question (up to its first line break, else its first half) and its answer (the
rest). An item of fewer words is one shingle of its own length. In scripts that
are written without spaces each character is a word.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firstseen.llm.frames import texts

K1, B = 1.2, 0.75
SHINGLE_WORDS = 5
OVERLAP = 0.8
# Least share of the question's and of the answer's shingles: a few changed words
# may fall into a short answer, but some of it has to be there.
PART_OVERLAP = 0.25
BLOCKS = 100
# Items of one index, and bytes of items sent to the workers at once; a larger
# benchmark takes more passes over the texts.
INDEX_ITEMS = 2048
PASS_BYTES = 32 << 20
# Terms of texts whose bounds are computed together; a text with more goes alone.
TERMS_TOGETHER = 50_000

# Ranges of characters that are written without spaces between words
# (Thai and Lao, Burmese, Khmer, kana, Han).
UNSPACED = (
    (0x0E00, 0x0EFF),
    (0x1000, 0x109F),
    (0x1780, 0x17FF),
    (0x3040, 0x30FF),
    (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF),
    (0x20000, 0x3FFFF),
)
_alone = "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSPACED)
_words = re.compile(rf"[{_alone}]|[^\W{_alone}]+").findall


def words(text: str) -> list[str]:
    return _words(text.lower())


def shingles(sequence: list[str], width: int = SHINGLE_WORDS) -> set[str]:
    """The shingles of a text for items of that width; of fewer words none."""
    return {" ".join(sequence[k : k + width]) for k in range(len(sequence) - width + 1)}


def _shingles(sequence: list[str]) -> Iterator[str]:
    """An item's shingles: of five words, or the whole of a shorter one."""
    if sequence:
        for k in range(max(1, len(sequence) - SHINGLE_WORDS + 1)):
            yield " ".join(sequence[k : k + SHINGLE_WORDS])


@dataclass(frozen=True)
class Item:
    """What verifying an item needs."""

    item_id: int | None
    width: int
    whole: frozenset
    question: frozenset
    answer: frozenset

    @staticmethod
    def of(item_id: int | None, text: str) -> Item:
        sequence = words(text)
        line = len(words(text.strip().split("\n", 1)[0]))
        cut = line if 0 < line < len(sequence) else (len(sequence) + 1) // 2
        # Shingles that reach into a part stand for it; a part may be shorter than one.
        question, answer = sequence[: cut + SHINGLE_WORDS - 1], sequence[max(0, cut - SHINGLE_WORDS + 1) :]
        parts = (frozenset(_shingles(part)) for part in (sequence, question, answer))
        return Item(item_id, min(SHINGLE_WORDS, len(sequence)), *parts)

    def overlaps(self, found: set[str]) -> tuple[float, float, float]:
        return tuple(len(part & found) / len(part) for part in (self.whole, self.question, self.answer))


def least_share(sequence: list[str], impacts: dict[str, float]) -> float:
    """The least share of an item's score that a text with ``OVERLAP`` of its shingles has.

    A word that a text lacks takes all shingles around it along. The dearest set of
    words whose loss costs few enough shingles is found place by place: the rows are
    distances to the last lost word, the columns shingles lost. A word's impact is
    spread over its places, and shingles that repeat cost nothing, so the share found
    is never too large.
    """
    parts = list(_shingles(sequence))
    often, frequency = Counter(parts), Counter(sequence)
    spare = max(k for k in range(len(often) + 1) if (len(often) - k) / len(often) >= OVERLAP)
    costs = np.cumsum([0] + [often[part] == 1 for part in parts]).tolist()
    best = np.full((SHINGLE_WORDS, spare + 1), -np.inf)
    best[-1] = 0
    for place, word in enumerate(sequence):
        taken = np.full(spare + 1, -np.inf)
        end = min(place + 1, len(parts))
        for k, row in enumerate(best):
            # Shingles up to the last lost word's place are lost already.
            begin = min(end, max(place - (k if k < SHINGLE_WORDS - 1 else SHINGLE_WORDS - 1), 0))
            cost = costs[end] - costs[begin]
            if cost <= spare:
                np.maximum(taken[cost:], row[: spare + 1 - cost], out=taken[cost:])
        taken += impacts[word] / frequency[word]
        best = np.vstack([taken, best[: SHINGLE_WORDS - 2], np.maximum(best[-2], best[-1])])
    return max(1 - float(best.max()) / sum(impacts.values()) - 1e-6, 1e-9)


class Index:
    """Inverted lists of test items, with maxima per list and block."""

    def __init__(self, items: list[tuple[int | None, str]]):
        tokens = [(item_id, text, words(text)) for item_id, text in items]
        tokens = [t for t in tokens if t[2]]
        # Items alike in their most frequent word share blocks, which keeps maxima low.
        tokens.sort(key=lambda t: (Counter(t[2]).most_common(1)[0][0], len(t[2]), t[1], str(t[0])))
        self.items = [Item.of(item_id, text) for item_id, text, _ in tokens]
        n = len(tokens)
        average = sum(len(t[2]) for t in tokens) / max(n, 1)
        frequency = Counter(w for _, _, sequence in tokens for w in set(sequence))
        self.terms = {w: k for k, w in enumerate(frequency)}
        self.size = -(-n // BLOCKS) if n else 1
        self.block_max = np.zeros((len(self.terms), -(-n // self.size) if n else 0), np.float32)
        lists: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        # What a text has to score for an item, and for any item of a block.
        self.least: list[float] = []
        for number, (_, _, sequence) in enumerate(tokens):
            scale = K1 * (1 - B + B * len(sequence) / average)
            impacts = {
                w: log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5)) * f * (K1 + 1) / (f + scale)
                for w, f in Counter(sequence).items()
            }
            whole = sum(impacts.values())
            self.least.append(least_share(sequence, impacts))
            for w, impact in impacts.items():
                term = self.terms[w]
                lists[term].append((number, impact / whole))
                block = number // self.size
                self.block_max[term, block] = max(self.block_max[term, block], impact / whole)
        self.postings = lists
        self.block_least = np.array([min(self.least[k : k + self.size]) for k in range(0, n, self.size)])

    def search(self, terms: list[int], threshold: float | None = None, blocks: list[int] | None = None) -> list[tuple[int, float]]:
        """Items of the blocks, all by default, that score the threshold, or else their own, or more."""
        found = []
        for block in range(self.block_max.shape[1]) if blocks is None else blocks:
            found += self._search(terms, threshold, block)
        return found

    def _search(self, terms: list[int], threshold: float | None, block: int) -> list[tuple[int, float]]:
        """WAND inside a block, by the lists' maxima there."""
        first, end = block * self.size, min((block + 1) * self.size, len(self.items))
        maxima, least = self.block_max[terms, block], float(self.block_least[block]) if threshold is None else threshold
        # Cursors: current item, place in the list, term, maximum.
        cursors = []
        for k in np.flatnonzero(maxima).tolist():
            at = bisect_left(self.postings[terms[k]], (first,))
            cursors.append([self.postings[terms[k]][at][0], at, terms[k], float(maxima[k]) * (1 + 1e-6)])
        found = []

        def forward(cursor: list, item: int) -> None:
            postings, at = self.postings[cursor[2]], cursor[1]
            while at < len(postings) and postings[at][0] < item:
                at += 1
            cursor[1] = at
            cursor[0] = min(postings[at][0], end) if at < len(postings) else end

        while True:
            cursors.sort()
            bound, pivot = 0.0, end
            for item, _, _, most in cursors:
                if item == end:
                    break
                bound += most
                if bound >= least:
                    pivot = item
                    break
            if pivot == end:
                return found
            ahead = [c for c in cursors if c[0] <= pivot]
            if ahead[0][0] == pivot:
                score = sum(self.postings[c[2]][c[1]][1] for c in ahead)
                if score >= (self.least[pivot] if threshold is None else threshold):
                    found.append((pivot, score))
                for cursor in ahead:
                    forward(cursor, pivot + 1)
            else:
                for cursor in ahead:
                    if cursor[0] < pivot:
                        forward(cursor, pivot)


def _terms(index: Index, sequences: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of all texts, in order of texts, and where each text's begin."""
    get, size = index.terms.get, len(index.terms)
    found = []
    for k, sequence in enumerate(sequences):
        ids = np.fromiter(map(get, sequence, [-1] * len(sequence)), np.int64, len(sequence))
        found.append(np.unique(ids[ids >= 0]) + k * size)
    pairs = np.concatenate(found)
    return pairs % size, np.searchsorted(pairs, np.arange(len(sequences) + 1) * size)


def _retrieved(index: Index, sequences: list[list[str]]) -> Iterator[tuple[int, list[tuple[int, float]]]]:
    """(place of a text, the items it scores enough for)."""
    terms, starts = _terms(index, sequences)
    first = 0
    while first < len(sequences):
        stop = max(first + 1, int(np.searchsorted(starts, starts[first] + TERMS_TOGETHER, "right")) - 1)
        low, high = starts[first], starts[stop]
        held = np.flatnonzero(starts[first + 1 : stop + 1] > starts[first:stop])
        if len(held):
            bound = np.add.reduceat(index.block_max[terms[low:high]], starts[first:stop][held] - low, axis=0)
            reached = bound >= index.block_least * (1 - 1e-5)
            for k in np.flatnonzero(reached.any(axis=1)).tolist():
                row = first + int(held[k])
                hits = index.search(terms[starts[row] : starts[row + 1]].tolist(), blocks=np.flatnonzero(reached[k]).tolist())
                if hits:
                    yield row, hits
        first = stop


def matches(indexes: list[Index], texts: list[str]) -> list[dict]:
    """Per text: verified items by (index, number), with score and overlaps."""
    out: list[dict] = [{} for _ in texts]
    sequences = [words(text) for text in texts]
    for which, index in enumerate(indexes):
        if not index.items or not texts:
            continue
        for row, hits in _retrieved(index, sequences):
            wanted = set().union(*(index.items[number].whole for number, _ in hits))
            widths = {index.items[number].width for number, _ in hits}
            have = set().union(*(wanted.intersection(shingles(sequences[row], width)) for width in widths))
            for number, score in hits:
                whole, question, answer = index.items[number].overlaps(have)
                if whole >= OVERLAP and min(question, answer) >= PART_OVERLAP:
                    out[row][(which, number)] = (score, whole, question, answer)
    return out


def _passes(benchmark: DataFrame) -> Iterator[list[Index]]:
    """Indexes of the test items, as many at once as the bytes allow."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, -(-size // PASS_BYTES))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(parts)))
    for part in range(parts):
        rows = sorted((r.text, -1 if r.item_id is None else r.item_id, r.item_id) for r in dealt.filter(F.col("part") == part).collect())
        held = [(item_id, text) for text, _, item_id in rows]
        yield [Index(held[k : k + INDEX_ITEMS]) for k in range(0, len(held), INDEX_ITEMS)]


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap.

    One row per row of ``documents`` and test item found in its text; clean texts
    give none. Null or wordless texts and items match nothing. Items or documents
    that repeat are reported each. Empty tables give no row. Texts are whole; a
    task's memory grows with its longest text.
    """
    schema = "doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, answer_overlap double"
    result = None
    for indexes in _passes(benchmark):

        def found(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                hits = matches(indexes, batch.column("text").to_pylist())
                for doc_id, one in zip(batch.column("doc_id").to_pylist(), hits, strict=True):
                    rows += [(doc_id, indexes[i].items[k].item_id, *values) for (i, k), values in sorted(one.items())]
                if rows:
                    kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
                    columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

        one = texts(documents).mapInArrow(found, schema)
        result = one if result is None else result.unionAll(one)
    return result


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, whose text holds no test item."""
    for indexes in _passes(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = matches(indexes, [text or "" for text in batch.column("text").to_pylist()])
                yield batch.filter(pa.array([not one for one in hits], pa.bool_()))

        documents = documents.mapInArrow(clean, StructType(documents.schema.fields))
    return documents
