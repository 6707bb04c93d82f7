"""Removal of long byte strings that an earlier document already holds.

The suffix order is built column-wise (``columnwise``), for aligned pieces instead
of whole texts, so rounds are few, a collection fits a task, and collections are
spread over the cluster:

1. Whole copies are found by hash; all but the first are removed outright.
2. In every run of ``width`` bytes the 20-byte gram with the least hash is an
   anchor, so equal strings have equal anchors. Groups of documents report their
   anchor hashes; those in two documents or more are shared.
3. A piece is the bytes around a shared anchor in which a string with this anchor
   can lie. Equal pieces of a group are one. Pieces meet by anchor hash, and the
   column-wise order finds the strings that a smaller document holds too.
4. The groups cover what was found and hash what is left.

An anchor in very many documents (``HOT``) would bring many unequal pieces into
one task where its surroundings differ. Its strings meet one by one instead, each
once per group, by 128-bit hashes of their own. A task never gets more rows of a
key than there are groups. Groups and collections are sized by bytes and counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.llm.columnwise import repeats
from firstseen.llm.frames import staged, texts

WIDTH = 50
GRAM = 20
GROUP_BYTES = 8 << 20
MIN_GROUPS = 64
ANCHORS_PER_BUCKET = 1_000_000
PIECES_PER_COLLECTION = 100_000
HOT = 2000
SLICE = 1 << 20

_random = np.random.default_rng(20)
# Per byte and per doubling, for two independent hashes.
_TABLES = _random.integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _random.integers(0, 2**63, (2, 80), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)

NOTE = "pid bigint, kind int, doc_id bigint, h bigint, a binary, b binary"
_COPY, _SHARED, _FOUND, _FOUND_HOT = range(4)
_PIECES, _STRINGS = 0, 1
MEET = "kind int, bucket bigint, pid bigint, a binary, b binary, c binary, d binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _hashes(symbols: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``width`` symbols along the last axis, by doubling."""
    powers, size = {1: _TABLES[which][symbols]}, 1
    while size * 2 <= width:
        part = powers[size]
        powers[size * 2] = part[..., :-size] * _FACTORS[which][size.bit_length()] + part[..., size:]
        size *= 2
    out, done = None, 0
    for size in sorted(powers, reverse=True):
        if width & size:
            part = powers[size][..., done:]
            if out is None:
                out = part
            else:
                out = out[..., : part.shape[-1]] * _FACTORS[which][40 + size.bit_length()] + part[..., : out.shape[-1]]
            done += size
    count = symbols.shape[-1] - width + 1
    out = out[..., :count].copy()
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """Least or largest of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


class _Group:
    """The documents of a group, in order of id, and their anchors."""

    def __init__(self, table: pa.Table, notes: pa.Table | None, width: int):
        copies = set()
        if notes is not None:
            for kind, doc_id, h in zip(*(notes.column(c).to_pylist() for c in ("kind", "doc_id", "h")), strict=True):
                if kind == _COPY:
                    copies.add((doc_id, h))
        rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("h").to_pylist(), table.column("text").to_pylist(), strict=True))
        self.copies = [(d, text) for d, h, text in rows if (d, h) in copies]
        rows = [(d, text.encode()) for d, h, text in rows if (d, h) not in copies]
        self.width = width
        self.doc_ids = np.array([d for d, _ in rows], np.int64)
        self.rank = np.unique(self.doc_ids, return_inverse=True)[1] if rows else np.zeros(0, np.int64)
        self.ends = np.cumsum([len(raw) for _, raw in rows], dtype=np.int64)
        self.starts = self.ends - np.array([len(raw) for _, raw in rows], np.int64)
        self.bytes = np.frombuffer(b"".join(raw for _, raw in rows), np.uint8)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, document, hash) of all anchors, by position."""
        reach, found, hashes = self.width - GRAM, [], []
        for first in range(0, len(self.bytes), SLICE):
            part = self.bytes[first : first + SLICE + self.width - 1]
            if len(part) < self.width:
                break
            h = _hashes(part, GRAM)
            # Grams that cross into the next document never count.
            inner = self.ends[np.searchsorted(self.ends, first, side="right") :]
            inner = inner[inner < first + len(part)] - first
            cross = (inner[:, None] - np.arange(1, GRAM)).reshape(-1)
            cross = cross[(cross >= 0) & (cross < len(h))]
            h[cross] = _ALL
            least = _slide(h, reach + 1, np.minimum)
            edge = np.zeros(reach, np.uint64)
            largest = _slide(np.concatenate([edge, least, edge]), reach + 1, np.maximum)
            at = np.flatnonzero((h == largest) & (h != _ALL))
            found.append(at + first)
            hashes.append(h[at])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        position, once = np.unique(np.concatenate(found), return_index=True)
        return position, np.searchsorted(self.ends, position, side="right"), np.concatenate(hashes)[once]

    def report(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor hashes and in how many documents each is."""
        _, document, hashes = self.anchors()
        if not len(hashes):
            return hashes, np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        hashes, rank = hashes[order], self.rank[document[order]]
        fresh = np.append(True, hashes[1:] != hashes[:-1])
        starts = np.flatnonzero(fresh)
        fresh[1:] |= rank[1:] != rank[:-1]
        return hashes[starts], np.add.reduceat(fresh.astype(np.int64), starts)


class _Pieces:
    """Pieces of a group around its shared anchors; the same on every call."""

    def __init__(self, group: _Group, notes: pa.Table):
        shared, hot = _shared(notes)
        width, reach = group.width, group.width - GRAM
        position, document, hashes = group.anchors()
        place = np.searchsorted(shared, hashes)
        known = np.zeros(len(hashes), bool)
        if len(shared):
            place = np.minimum(place, len(shared) - 1)
            known = shared[place] == hashes
        position, document, hashes, place = position[known], document[known], hashes[known], place[known]
        self.start = position - reach
        self.rank, self.doc_id = group.rank[document], group.doc_ids[document]
        self.length = width + reach
        low = np.maximum(group.starts[document] - self.start, 0)
        high = np.minimum(group.ends[document] - self.start, self.length)
        at = np.arange(self.length)
        padded = np.concatenate([np.zeros(reach, np.uint8), group.bytes, np.zeros(self.length, np.uint8)])
        content = padded[(self.start + reach)[:, None] + at]
        content[(at < low[:, None]) | (at >= high[:, None])] = 0
        # Equal pieces are one, held by the first document.
        key = np.ascontiguousarray(np.hstack([content, low[:, None].astype(np.uint8), high[:, None].astype(np.uint8)]))
        _, self.first, self.of = np.unique(key.view([("", np.void, key.shape[1])]).reshape(-1), return_index=True, return_inverse=True)
        self.low, self.high, self.content = low[self.first], high[self.first], content[self.first]
        self.hash = hashes[self.first]
        self.hot = hot[place][self.first] if len(shared) else np.zeros(0, bool)
        self.width, self.columns = width, reach + 1

    def valid(self) -> np.ndarray:
        """Which strings of a piece lie in its document."""
        column = np.arange(self.columns)
        return (self.low[:, None] <= column) & (self.high[:, None] >= column + self.width)

    def hot_strings(self):
        """Distinct strings of hot pieces: (hashes, least rank, piece and column, which)."""
        piece = np.flatnonzero(self.hot)
        row, column = np.nonzero(self.valid()[piece])
        marks = np.stack([_hashes(self.content[piece], self.width, k)[row, column] for k in (0, 1)], axis=1)
        keys = np.ascontiguousarray(marks).view([("a", np.uint64), ("b", np.uint64)]).reshape(-1)
        held, first, of = np.unique(keys, return_index=True, return_inverse=True)
        rank = self.rank[self.first[piece[row]]]
        least = np.full(len(held), np.iinfo(np.int64).max)
        np.minimum.at(least, of, rank)
        return held, least, piece[row], column, of, rank


def _shared(notes: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    hashes, hot = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for kind, a, b in zip(*(notes.column(c).to_pylist() for c in ("kind", "a", "b")), strict=True):
        if kind == _SHARED:
            hashes.append(np.frombuffer(a, np.uint64))
            hot.append(np.frombuffer(b, bool))
    hashes, hot = np.concatenate(hashes), np.concatenate(hot)
    order = np.argsort(hashes)
    return hashes[order], hot[order]


def _rows(schema: str, columns: list[list]) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.table({name: pa.array(values, kinds[kind]) for (name, kind), values in zip(fields, columns, strict=True)})


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places) of the buckets that occur."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
    for first, end in zip(bounds, [*bounds[1:], len(order)], strict=True):
        yield int(bucket[order[first]]), order[first:end]


def _reporter(width: int, buckets: int):
    def report(key: tuple, table: pa.Table, notes: pa.Table) -> pa.Table:
        hashes, counts = _Group(table, notes, width).report()
        rows: list[list] = [[], [], [], []]
        for bucket, at in _dealt(((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)):
            values = bucket, _pid(table), hashes[at].tobytes(), np.minimum(counts[at], 2**31).astype(np.uint32).tobytes()
            for column, value in zip(rows, values, strict=True):
                column.append(value)
        return _rows("bucket bigint, pid bigint, hashes binary, counts binary", rows)

    return report


def _pid(table: pa.Table) -> int:
    return table.column("pid")[0].as_py()


def _share(hot_documents: int):
    def share(table: pa.Table) -> pa.Table:
        """Per group, those of its anchors that two documents hold, and which are hot."""
        parts = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        hashes = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(hashes)
        hashes, source, counts = hashes[order], source[order], counts[order]
        starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        total = np.repeat(np.add.reduceat(counts, starts), np.diff(np.append(starts, len(hashes))))
        kept = np.flatnonzero(total >= 2)
        pids = table.column("pid").to_pylist()
        rows: list[list] = [[] for _ in range(7)]
        for k, at in _dealt(source[kept]):
            mine = kept[at]
            hot = total[mine] >= hot_documents
            values = pids[k], _SHARED, None, None, hashes[mine].tobytes(), hot.tobytes(), int(counts[mine].sum())
            for column, value in zip(rows, values, strict=True):
                column.append(value)
        return _rows(NOTE + ", pieces bigint", rows)

    return share


def _cutter(width: int, buckets: int):
    def cut(key: tuple, table: pa.Table, notes: pa.Table) -> pa.Table:
        pieces = _Pieces(_Group(table, notes, width), notes)
        pid, rows = _pid(table), [[] for _ in range(7)]
        squeeze = zstandard.ZstdCompressor(level=1).compress

        def put(*values) -> None:
            for column, value in zip(rows, values, strict=True):
                column.append(value)

        plain = np.flatnonzero(~pieces.hot)
        for bucket, at in _dealt((pieces.hash[plain] % np.uint64(buckets)).astype(np.int64)):
            mine = plain[at]
            edges = np.stack([pieces.low[mine], pieces.high[mine]]).astype(np.uint8)
            owner = pieces.doc_id[pieces.first[mine]]
            put(_PIECES, bucket, pid, mine.astype(np.uint32).tobytes(), owner.tobytes(), edges.tobytes(), squeeze(pieces.content[mine].tobytes()))
        if pieces.hot.any():
            held, least, *_ = pieces.hot_strings()
            by_rank = dict(zip(pieces.rank.tolist(), pieces.doc_id.tolist(), strict=True))
            owner = np.array([by_rank[r] for r in least.tolist()], np.int64)
            for bucket, at in _dealt((held["b"] % np.uint64(buckets)).astype(np.int64)):
                put(_STRINGS, bucket, pid, held[at].tobytes(), owner[at].tobytes(), None, None)
        return _rows(MEET, rows)

    return cut


def _meeting(width: int):
    length = 2 * width - GRAM

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        pids = table.column("pid").to_pylist()
        a, b, c, d = (table.column(x).to_pylist() for x in "abcd")
        source_owner = [np.frombuffer(x, np.int64) for x in b]
        source = np.repeat(np.arange(len(pids)), [len(x) for x in source_owner])
        owner = np.concatenate(source_owner)
        rows: list[list] = [[] for _ in range(6)]
        if key[0].as_py() == _PIECES:
            expand = zstandard.ZstdDecompressor().decompress
            content = np.concatenate([np.frombuffer(expand(x), np.uint8).reshape(-1, length) for x in d])
            edges = np.concatenate([np.frombuffer(x, np.uint8).reshape(2, -1) for x in c], axis=1).astype(np.int64)
            number = np.concatenate([np.frombuffer(x, np.uint32) for x in a])
            found = repeats(content, edges[0], edges[1], owner, width)
            hits = np.flatnonzero(found.any(axis=1))
            for k, at in _dealt(source[hits]):
                mine = hits[at]
                values = pids[k], _FOUND, None, None, number[mine].tobytes(), np.packbits(found[mine], axis=1).tobytes()
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
        else:
            marks = np.concatenate([np.frombuffer(x, [("a", np.uint64), ("b", np.uint64)]) for x in a])
            _, of = np.unique(marks, return_inverse=True)
            least = np.full(of.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, of, owner)
            hits = np.flatnonzero(owner > least[of])
            for k, at in _dealt(source[hits]):
                values = pids[k], _FOUND_HOT, None, None, marks[hits[at]].tobytes(), None
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
        return _rows(NOTE, rows)

    return meet


def _covered(group: _Group, notes: pa.Table) -> np.ndarray:
    """Which bytes of a group belong to a string of a smaller document."""
    pieces = _Pieces(group, notes)
    found = np.zeros((len(pieces.first), pieces.columns), bool)
    hot_marks = [np.zeros(0, [("a", np.uint64), ("b", np.uint64)])]
    for kind, a, b in zip(*(notes.column(x).to_pylist() for x in ("kind", "a", "b")), strict=True):
        if kind == _FOUND:
            number = np.frombuffer(a, np.uint32)
            packed = np.frombuffer(b, np.uint8).reshape(len(number), -1)
            found[number] = np.unpackbits(packed, axis=1, count=pieces.columns).astype(bool)
        elif kind == _FOUND_HOT:
            hot_marks.append(np.frombuffer(a, hot_marks[0].dtype))
    if pieces.hot.any():
        held, least, piece, column, of, rank = pieces.hot_strings()
        elsewhere = np.isin(held, np.concatenate(hot_marks))
        found[piece, column] = elsewhere[of] | (rank > least[of])
    every = found[pieces.of]
    # A later document with the same piece repeats all of it.
    later = pieces.rank > pieces.rank[pieces.first[pieces.of]]
    every |= later[:, None] & pieces.valid()[pieces.of]
    at, column = np.nonzero(every)
    start = pieces.start[at] + column
    change = np.zeros(len(group.bytes) + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + group.width, -1)
    return np.cumsum(change[:-1]) > 0


def _remover(width: int):
    def remove(key: tuple, table: pa.Table, notes: pa.Table) -> pa.Table:
        group = _Group(table, notes, width)
        covered = _covered(group, notes)
        rows: list[list] = [[] for _ in range(5)]
        for doc_id, start, end in zip(group.doc_ids.tolist(), group.starts.tolist(), group.ends.tolist(), strict=True):
            gone = covered[start:end]
            spans = int(gone[:1].sum()) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
            kept = hashlib.sha256(group.bytes[start:end][~gone].tobytes()).hexdigest()
            for column, value in zip(rows, (doc_id, end - start, int(gone.sum()), spans, kept), strict=True):
                column.append(value)
        nothing = hashlib.sha256(b"").hexdigest()
        for doc_id, text in group.copies:
            size = len(text.encode())
            for column, value in zip(rows, (doc_id, size, size, 1, nothing), strict=True):
                column.append(value)
        return _rows(RESULT, rows)

    return remove


def _copies(grouped: DataFrame, width: int) -> DataFrame:
    """Notes on documents whose whole text a smaller one has."""
    hashed = grouped.select("pid", "doc_id", "h", F.unhex(F.sha2("text", 256)).alias("sha"), F.octet_length("text").alias("n"))
    hashed = staged(hashed.filter(F.col("n") >= width).drop("n"), "text-hashes")
    first = hashed.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("most > least")
    later = hashed.join(first.select("sha", "least"), "sha").filter("doc_id > least").select("pid", "doc_id", "h").distinct()
    nothing = F.lit(None).cast("binary")
    return later.select("pid", F.lit(_COPY).alias("kind"), "doc_id", "h", nothing.alias("a"), nothing.alias("b"))


def remove_repeats(
    documents: DataFrame,
    width: int = WIDTH,
    group_bytes: int = GROUP_BYTES,
    min_groups: int = MIN_GROUPS,
    hot: int = HOT,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document.

    Bytes are removed that ``width`` bytes cover which also start in a document
    with a smaller doc_id, by the texts as given. A null text is empty. Rows that
    share a doc_id do not take from each other. A row without doc_id has no
    smaller or larger one: it keeps all and takes nothing. An empty table gives none.
    """
    if not GRAM < width <= 4 * GRAM:
        raise ValueError(f"width {width} is not between {GRAM + 1} and {4 * GRAM}")
    rows = texts(documents)
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    groups = max(min_groups, -(-total // group_bytes))
    named = rows.filter("doc_id IS NOT NULL").withColumn("h", F.xxhash64("text"))
    grouped = named.select(F.pmod(F.xxhash64("doc_id", "h"), F.lit(groups)).alias("pid"), "doc_id", "h", "text")
    copies = staged(_copies(grouped, width), "whole-copies")
    dealt = grouped.repartition("pid")
    buckets = max(min_groups, -(-total // (8 * ANCHORS_PER_BUCKET)))
    reported = (
        dealt.groupBy("pid")
        .cogroup(copies.groupBy("pid"))
        .applyInArrow(_reporter(width, buckets), "bucket bigint, pid bigint, hashes binary, counts binary")
    )
    shared = staged(reported.groupBy("bucket").applyInArrow(_share(hot), NOTE + ", pieces bigint"), "shared-anchors")
    collections = max(min_groups, -(-(shared.agg(F.sum("pieces").alias("n")).first().n or 0) // PIECES_PER_COLLECTION))
    notes = shared.drop("pieces").unionAll(copies)
    cut = dealt.groupBy("pid").cogroup(notes.groupBy("pid")).applyInArrow(_cutter(width, collections), MEET)
    found = cut.groupBy("kind", "bucket").applyInArrow(_meeting(width), NOTE)
    result = dealt.groupBy("pid").cogroup(notes.unionAll(found).groupBy("pid")).applyInArrow(_remover(width), RESULT)
    alone = rows.filter("doc_id IS NULL").select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
    )
    return result.unionAll(alone)
