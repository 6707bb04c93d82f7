"""Runs of repeated words by Lyndon roots.

A run is a stretch with a smallest period that no neighbouring word extends. One of
its periods is a Lyndon word, the longest that starts there under an order of the
words or under the reversed order. The first phase of a suffix sorter by groups
gives both Lyndon arrays: suffixes are grouped by first word, groups are taken from
the greatest down, and each suffix lengthens the prefix of the nearest smaller one
to its left. Each root is then extended both ways by its longest common extension.

Only stretches in which every four words occur again are sorted: within a run of
four periods and six words they do, one period on. Other words are in no run.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.llm.frames import texts

# What counts as a run: at least so many words and so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
# Words of a stretch that must occur again in it.
GRAM = 4
PRUNINGS = 3
# Words of texts handled together.
WORDS_TOGETHER = 400_000
_PRIME = np.uint64(2_147_483_647)
_BASE = np.uint64(1_000_003)


def lyndon_lengths(ranks: Sequence[int] | np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place.

    Phase one of sorting suffixes by groups. ``order`` holds the suffixes group
    after group; ``group`` is where a suffix's group starts there.
    """
    ranks = np.asarray(ranks, np.int64)
    n = len(ranks)
    found = np.ones(n, np.int64)
    if not n:
        return found
    by_rank = np.argsort(ranks, kind="stable")
    place = np.empty(n, np.int64)
    place[by_rank] = np.arange(n)
    first = np.searchsorted(ranks[by_rank], ranks)
    sizes = np.bincount(first, minlength=n)
    order, place, group, size = (array("q", a.astype(np.int64).tobytes()) for a in (by_rank, place, first, sizes))
    length = array("q", [1]) * n
    lyndon = array("q", [1]) * n
    # left[i + 1] is i + 1 while suffix i waits, else a place further left.
    left = array("q", range(n + 1))
    end = n
    while end:
        start = group[order[end - 1]]
        members = order[start:end]
        grow = length[start]
        end = start
        pointed: dict[int, int] = {}
        for i in members:
            lyndon[i] = grow
            left[i + 1] = i
        for i in members:
            j = i
            while left[j] != j:
                left[j] = left[left[j]]
                j = left[j]
            left[i + 1] = j
            if j:
                pointed[j - 1] = pointed.get(j - 1, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, count in pointed.items():
            by_count.setdefault(count, []).append(j)
        # Suffixes that more of the group's words follow are greater: they go
        # behind their group first, and the others between.
        for count in sorted(by_count, reverse=True):
            moved = by_count[count]
            for j in moved:
                g = group[j]
                size[g] -= 1
                last, at = g + size[g], place[j]
                other = order[last]
                order[at], place[other] = other, at
                order[last], place[j] = j, last
            fresh: dict[int, int] = {}
            for j in moved:
                g = group[j]
                new = fresh.get(g)
                if new is None:
                    new = fresh[g] = g + size[g]
                    length[new] = length[g] + count * grow
                group[j] = new
            for g, new in fresh.items():
                size[new] = 0
            for j in moved:
                size[group[j]] += 1
    return np.frombuffer(lyndon, np.int64)


class _Prefixes:
    """Hashes of all prefixes, to compare stretches of codes."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.power = np.ones(n + 1, np.uint64)
        known = 1
        while known <= n:
            more = min(known, n + 1 - known)
            step = self.power[known - 1] * _BASE % _PRIME
            self.power[known : known + more] = self.power[:more] * step % _PRIME
            known += more
        terms = (codes.astype(np.uint64) + np.uint64(1)) % _PRIME * self.power[:n] % _PRIME
        sums = np.zeros(n + 1, np.uint64)
        # Sums of numbers below 2**31 stay exact for 2**33 words.
        np.cumsum(terms, out=sums[1:])
        self.sums = sums % _PRIME

    def _stretch(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[start + length] + _PRIME - self.sums[start]) % _PRIME

    def ahead(self, start: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Words from ``start`` on that equal those ``shift`` further, at least."""
        return self._longest(len(self.sums) - 1 - start - shift, lambda some, n: (start[some], n, shift[some]))

    def behind(self, end: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Words up to ``end`` that equal those ``shift`` further, at least."""
        return self._longest(end, lambda some, n: (end[some] - n, n, shift[some]))

    def _longest(self, most: np.ndarray, placed) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        some = np.flatnonzero(low < high)
        while len(some):
            middle = (low[some] + high[some] + 1) // 2
            start, n, shift = placed(some, middle)
            same = self._stretch(start, n) * self.power[shift] % _PRIME == self._stretch(start + shift, n)
            low[some[same]] = middle[same]
            high[some[~same]] = middle[~same] - 1
            some = some[low[some] < high[some]]
        return low


def _extended(codes: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """Start and end of what has the period around a root, word by word."""
    same = codes[:-period] == codes[period:]
    breaks = np.flatnonzero(~same)
    at = np.searchsorted(breaks, place)
    start = int(breaks[at - 1]) + 1 if at else 0
    return start, (int(breaks[at]) if at < len(breaks) else len(same)) + period


def _roots(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for ranks in (codes, -codes):
        period = lyndon_lengths(ranks)
        place = np.flatnonzero(LEAST_PERIODS * period <= len(codes))
        yield place, period[place]


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a stretch, by start and period."""
    codes = np.asarray(codes, np.int64)
    prefixes = _Prefixes(codes)
    found: set[tuple[int, int, int]] = set()
    for place, period in _roots(codes):
        start = place - prefixes.behind(place, period)
        end = place + period + prefixes.ahead(place, period)
        enough = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        rows = np.stack([start, end, period], axis=1)[enough]
        once, of = np.unique(rows, axis=0, return_inverse=True)
        of = of.reshape(-1)
        for number, (a, b, p) in enumerate(once.tolist()):
            if np.array_equal(codes[a : b - p], codes[a + p : b]):
                found.add((a, b - a, p))
                continue
            # Hashes were equal where words are not.
            for i in place[enough][of == number].tolist():
                a, b = _extended(codes, i, p)
                if b - a >= max(LEAST_WORDS, LEAST_PERIODS * p):
                    found.add((a, b - a, p))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _grams(codes: np.ndarray) -> np.ndarray:
    """A number for each four words in a row."""
    for step in (1, 2):
        pairs = codes[:-step] * (codes.max() + 1) + codes[step:]
        codes = np.unique(pairs, return_inverse=True)[1]
    return codes


def stretches(codes: np.ndarray, document: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of stretches in one document that may hold runs."""
    if len(codes) < LEAST_WORDS:
        return []
    grams = _grams(codes)
    at = np.flatnonzero(document[: len(grams)] == document[GRAM - 1 :])
    part = document[at]
    for _ in range(PRUNINGS):
        if not len(at):
            return []
        _, of, n = np.unique(part.astype(np.int64) * (int(grams.max()) + 1) + grams[at], return_inverse=True, return_counts=True)
        kept = n[of] >= 2
        at, part = at[kept], part[kept]
        if not len(at):
            return []
        part = np.cumsum(np.append(True, (np.diff(at) > 1) | (np.diff(document[at]) != 0)))
    first = np.flatnonzero(np.append(True, np.diff(part) > 0))
    last = np.append(first[1:], len(at)) - 1
    found = zip(at[first].tolist(), (at[last] + GRAM).tolist(), strict=True)
    return [(a, b) for a, b in found if b - a >= LEAST_WORDS]


def find_runs(texts_words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start and period."""
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(word, len(numbers)) for words in texts_words for word in words], np.int64)
    ends = np.cumsum([len(words) for words in texts_words])
    document = np.repeat(np.arange(len(texts_words)), [len(words) for words in texts_words])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts_words]
    for a, b in stretches(codes, document):
        owner = int(document[a])
        before = a - (int(ends[owner]) - len(texts_words[owner]))
        here = np.unique(codes[a:b], return_inverse=True)[1]
        found[owner] += [(before + start, length, period) for start, length, period in runs_of(here)]
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words of no run, and the first period of each where no other run drops it."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(ids: list, held: list[list[bytes]]) -> pa.RecordBatch:
        runs = find_runs(held)
        named = [[dict(zip(("start", "length", "period"), run, strict=True)) for run in one] for one in runs]
        left = [b" ".join(kept_words(words, one)).decode() for words, one in zip(held, runs, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(named, pa.list_(_RUN)), pa.array(left, pa.string())],
            names=["doc_id", "runs", "collapsed"],
        )

    for batch in batches:
        ids, held, total = [], [], 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            # Bytes split at space, tab, line feed, vertical tab, form feed and return.
            ids.append(doc_id)
            held.append(text.as_py().encode().split())
            total += len(held[-1])
            if total >= WORDS_TOGETHER:
                yield rows(ids, held)
                ids, held, total = [], [], 0
        yield rows(ids, held)


def collapse_runs(documents: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period in words), collapsed: one row per document.

    ``runs`` has every run of at least ``LEAST_WORDS`` words and ``LEAST_PERIODS``
    smallest periods, by start and period. ``collapsed`` is the text's words but
    for those that a run holds after its first period, joined by one space. A null
    text is empty and has no runs; so has a text without words. Each row is handled
    by itself: repeated rows and rows without doc_id give a row each, and other
    columns, whatever their names, are left behind. Texts are whole; the memory of
    a task grows with its longest text, about 100 bytes a word and 60 more a word
    of a stretch that repeats. An empty table gives no row.
    """
    kind = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return texts(documents).mapInArrow(_found, kind)


def digests(collapsed: DataFrame) -> DataFrame:
    """Counts, the longest run, and hashes of all runs and of what is kept."""
    written = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    # The longest run has the greatest of these; of equals, the first start and period.
    marks = F.transform("runs", lambda run: F.struct(run["length"].alias("length"), (-run["start"]).alias("s"), (-run["period"]).alias("p")))
    best = F.array_max(marks)
    return collapsed.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["length"].alias("length"),
        (-best["p"]).alias("period"),
        F.floor(best["length"] * 1000 / -best["p"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(written, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
