"""Alignment of two tokenizers' tokens over the same bytes.

Tokens of a text are cut into groups where both tokenizers end a token. Shared ends
are found by divide and conquer, all texts of a block at once: in every interval the
shared end nearest the middle is looked for by bisection among the other tokenizer's
ends, ever further out, and both halves go on alone; an interval without one is a
group.

How many documents link two ids is counted over the whole corpus. Documents are
dealt into chunks of bounded text. A chunk reports each pair of ids once, so counts
and look-ups move distinct pairs of chunks, not of documents, and a pair that every
document holds is one row a chunk.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstseen.llm.frames import staged, texts
from firstseen.llm.tokens import byte_letters

# Characters of text aligned at once, and in a chunk of documents.
BLOCK_CHARS = 2 << 20
CHUNK_CHARS = 16 << 20
# Chunks whose counts one task looks up, and the least number of such tasks.
CHUNKS_PER_TASK = 2
MIN_TASKS = 8
# What a row counts besides its text.
ROW_CHARS = 64
# Pieces of text a worker remembers in each of two generations.
PIECES_KEPT = 250_000
# A space after something else: no byte-level token and no piece of the other kind
# goes across its left side.
_CUT = re.compile(r"(?<=\S) (?=.)", re.DOTALL)

_PAIRS: dict[tuple[str, str], TokenPair] = {}


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class TokenPair:
    """A byte-level vocabulary (A) and one of pieces with byte fallback (B)."""

    def __init__(self, path_a: str, path_b: str, kept: int = PIECES_KEPT):
        import os

        # Spark already runs a worker per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.bytes_a: list[bytes] = [b""] * self._a.get_vocab_size()
        for token, number in self._a.get_vocab().items():
            if all(letter in letters for letter in token):
                self.bytes_a[number] = bytes(letters[letter] for letter in token)
        self.bytes_b = [self._piece(k) for k in range(self._b.get_piece_size())]
        self.lengths_a = np.fromiter(map(len, self.bytes_a), np.int64)
        self.lengths_b = np.fromiter(map(len, self.bytes_b), np.int64)
        self.cut = self._cuttable(path_a)
        self._kept = kept
        # Ids of A and of B by part, of two generations; parts whose bytes differ.
        self._young: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self._old: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self._unlike: set[str] = set()

    def _piece(self, number: int) -> bytes:
        piece = self._b.id_to_piece(number)
        if self._b.is_byte(number):
            return bytes([int(piece[1:-1], 16)])
        return b"" if self._b.is_control(number) else piece.replace("▁", " ").encode()

    def _cuttable(self, path_a: str) -> bool:
        """Whether texts may be encoded in parts cut before spaces."""
        with open(path_a, encoding="utf-8") as file:
            known = json.load(file)
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        found = known.get("pre_tokenizer") or {}
        if known.get("normalizer") or {k: found.get(k) for k in usual} != usual:
            return False
        pieces = (self._b.id_to_piece(k) for k in range(self._b.get_piece_size()))
        return not any(re.search("[^▁]▁", piece) for piece in pieces)

    def _learn(self, parts: list[str]) -> None:
        encoded = [one.ids for one in self._a.encode_batch([" " + part for part in parts], add_special_tokens=False)]
        both = (encoded, self.bytes_a, self.lengths_a), (self._b.encode(parts, num_threads=1), self.bytes_b, self.lengths_b)
        data = [b" " + part.encode() for part in parts]
        sizes = np.cumsum([len(one) for one in data])
        for (lists, table, lengths), known in zip(both, self._young, strict=True):
            ids = np.fromiter(chain.from_iterable(lists), "<i4", sum(map(len, lists)))
            bounds = np.append(0, np.cumsum([len(one) for one in lists]))
            # Bytes and lengths agree as a whole, or each part is looked at.
            written = np.append(0, np.cumsum(lengths[ids]))[bounds[1:]]
            if not np.array_equal(written, sizes) or b"".join(map(table.__getitem__, ids.tolist())) != b"".join(data):
                for part, one, wanted in zip(parts, lists, data, strict=True):
                    if b"".join([table[k] for k in one]) != wanted:
                        self._unlike.add(part)
            flat, ends = ids.tobytes(), (bounds * 4).tolist()
            known.update((part, flat[x:y]) for part, x, y in zip(parts, ends[:-1], ends[1:], strict=True))

    def encode(self, slices: Sequence[str]) -> list[tuple[bytes, bytes]]:
        """Ids of both, as bytes, of a space and each text; nothing where bytes differ
        or the text is empty."""
        split = [(_CUT.split(one) if self.cut else [one]) if one else [] for one in slices]
        if len(self._young[0]) > self._kept:
            self._young, self._old = ({}, {}), self._young
            self._unlike.intersection_update(self._old[0])
        (young_a, young_b), (old_a, old_b) = self._young, self._old
        unknown: list[str] = []
        for part in set().union(*split).difference(young_a):
            if part in old_a:
                young_a[part], young_b[part] = old_a[part], old_b[part]
            else:
                unknown.append(part)
        if unknown:
            self._learn(unknown)
        nothing = b"", b""
        return [
            (b"".join(map(young_a.__getitem__, parts)), b"".join(map(young_b.__getitem__, parts)))
            if self._unlike.isdisjoint(parts)
            else nothing
            for parts in split
        ]


def token_pair(paths: tuple[str, str]) -> TokenPair:
    """This worker's tokenizers."""
    if paths not in _PAIRS:
        _PAIRS[paths] = TokenPair(*paths)
    return _PAIRS[paths]


def _nearest(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """In each low <= k < high, the k nearest the middle whose end is shared; else -1."""
    middle = (low + high) // 2
    found = np.full(len(low), -1)
    some, reach, more = np.arange(len(low)), 0, 1
    while len(some):
        # Places at a distance of ``reach`` up to ``reach + more`` on either side.
        begin = np.concatenate([np.maximum(low[some], middle[some] - reach - more + 1), middle[some] + max(reach, 1)])
        end = np.concatenate([middle[some] - reach + 1, np.minimum(high[some], middle[some] + reach + more)])
        count = np.maximum(end - begin, 0)
        owner = np.repeat(np.concatenate([some, some]), count)
        place = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        hit = ends_b[np.searchsorted(ends_b, ends_a[place])] == ends_a[place]
        owner, place = owner[hit], place[hit]
        if reach:
            order = np.lexsort((np.abs(place - middle[owner]), owner))
            owner, place = owner[order], place[order]
            first = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
            owner, place = owner[first], place[first]
        found[owner] = place
        reach, more = reach + more, 2 * more
        some = some[(found[some] < 0) & ((middle[some] - reach >= low[some]) | (middle[some] + reach < high[some]))]
    return found


def shared_ends(ends_a: np.ndarray, ends_b: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which ends of A are ends of B too, as places, by divide and conquer.

    ``last`` are the places of the last token of each text, whose end is shared.
    """
    low, high = np.append(0, last[:-1] + 1) if len(last) else last, last
    found = [last]
    while True:
        open_ = low < high
        low, high = low[open_], high[open_]
        if not len(low):
            return np.sort(np.concatenate(found))
        cut = _nearest(ends_a, ends_b, low, high)
        hit = cut >= 0
        low, high, cut = low[hit], high[hit], cut[hit]
        found.append(cut)
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut, high])


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal numbers below ``size`` with room for a sign behind, and their lengths."""
    written = [str(k).encode() for k in range(size)]
    width = len(written[-1]) + 1
    return np.frombuffer(b"".join(one.ljust(width) for one in written), np.uint8).reshape(size, width), np.fromiter(map(len, written), np.int64)


class _Aligner:
    def __init__(self, pair: TokenPair):
        self.pair = pair
        self.size_b = len(pair.bytes_b)
        self._table, self._lengths = _digits(max(len(pair.bytes_a), self.size_b))

    def align(self, encoded: list[tuple[bytes, bytes]]) -> list[tuple[int, int, int, int, bytes, np.ndarray, np.ndarray]]:
        """Of each text: tokens of A and B, groups, links, the groups as written, id
        pairs and how often each is linked."""
        ids_a = np.frombuffer(b"".join([a for a, _ in encoded]), "<i4").astype(np.int64)
        ids_b = np.frombuffer(b"".join([b for _, b in encoded]), "<i4").astype(np.int64)
        n_a = np.array([len(a) // 4 for a, _ in encoded], np.int64)
        n_b = np.array([len(b) // 4 for _, b in encoded], np.int64)
        if not len(ids_a):
            return [(0, 0, 0, 0, b"", ids_a, ids_a)] * len(encoded)
        ends_a, ends_b = np.cumsum(self.pair.lengths_a[ids_a]), np.cumsum(self.pair.lengths_b[ids_b])
        used = np.flatnonzero(n_a)
        last = np.cumsum(n_a)[used] - 1
        cuts = shared_ends(ends_a, ends_b, last)
        cuts_b = np.searchsorted(ends_b, ends_a[cuts])
        group_a, group_b = (np.repeat(np.arange(len(cuts)), np.diff(ends, prepend=-1)) for ends in (cuts, cuts_b))
        # Which text each token and each group belongs to.
        text_a, text_b = np.repeat(np.arange(len(encoded)), n_a), np.repeat(np.arange(len(encoded)), n_b)
        n_groups = np.bincount(text_a[cuts], minlength=len(encoded))
        # Two divisions of the same bytes share as many parts as they have ends.
        n_links = n_a + n_b - n_groups

        # Each group's tokens of A, then those of B.
        first_b = np.append(0, cuts_b[:-1] + 1)
        number = np.empty(len(ids_a) + len(ids_b), np.int64)
        sign = np.full(len(number), ord(","), np.uint8)
        at_a = np.arange(len(ids_a)) + first_b[group_a]
        at_b = np.arange(len(ids_b)) + (cuts + 1)[group_b]
        number[at_a], number[at_b] = ids_a, ids_b
        sign[at_a[cuts]] = ord("|")
        sign[at_b[cuts_b]] = ord(";")
        lengths = self._lengths[number]
        written = self._table[number]
        written[np.arange(len(number)), lengths] = sign
        flat = written[np.arange(written.shape[1]) <= lengths[:, None]].tobytes()
        bounds = np.cumsum(lengths + 1)
        text_bounds = np.append(0, bounds[np.cumsum(n_a + n_b)[used] - 1])

        # A link for every end of A, and for every end that only B has.
        alone = np.ones(len(ids_b), bool)
        alone[cuts_b] = False
        owner = np.concatenate([text_a, text_b[alone]])
        code = np.concatenate([
            ids_a * self.size_b + ids_b[np.searchsorted(ends_b, ends_a)],
            ids_a[np.searchsorted(ends_a, ends_b[alone])] * self.size_b + ids_b[alone],
        ])
        pairs = len(self.pair.bytes_a) * self.size_b
        key, count = np.unique(owner * pairs + code, return_counts=True)
        owner, code = np.divmod(key, pairs)
        code_bounds = np.searchsorted(owner, np.append(used, len(encoded)))
        found = [(0, 0, 0, 0, b"", code[:0], code[:0])] * len(encoded)
        for k, text in enumerate(used.tolist()):
            some = slice(code_bounds[k], code_bounds[k + 1])
            groups = flat[text_bounds[k] : text_bounds[k + 1] - 1]
            found[text] = (int(n_a[text]), int(n_b[text]), int(n_groups[text]), int(n_links[text]), groups, code[some], count[some])
        return found


def _slices(text: str, cut: bool) -> list[str]:
    """Parts of a text that may be encoded alone, about a block long."""
    found, start = [], 0
    while cut and len(text) - start > BLOCK_CHARS and (match := _CUT.search(text, start + BLOCK_CHARS // 2)):
        found.append(text[start : match.start()])
        start = match.end()
    found.append(text[start:])
    return found


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(codes) == 1:
        return codes[0], counts[0]
    code, of = np.unique(np.concatenate(codes or [np.zeros(0, np.int64)]), return_inverse=True)
    return code, np.bincount(of, np.concatenate(counts or [np.zeros(0, np.int64)]), len(code)).astype(np.int64)


class _Document:
    """A document whose slices come one by one."""

    def __init__(self, doc_id: int | None, slices: int, groups: bool):
        self.doc_id, self.left, self.same = doc_id, slices, True
        self.sums = np.zeros(4, np.int64)
        self.digest = hashlib.sha256()
        self.written: list[bytes] | None = [] if groups else None
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, found: tuple) -> None:
        self.left -= 1
        *sums, groups, code, count = found
        if not sums[0]:
            self.same = False
            return
        if self.sums[0]:
            groups = b";" + groups
        self.sums += sums
        self.digest.update(groups)
        if self.written is not None:
            self.written.append(groups)
        self.codes.append(code)
        self.counts.append(count)

    def row(self) -> tuple:
        if not self.same:
            return self.doc_id, 0, 0, 0, 0, "", None if self.written is None else "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        written = None if self.written is None else b"".join(self.written).decode()
        return self.doc_id, *self.sums.tolist(), self.digest.hexdigest(), written, *_merged(self.codes, self.counts)


# One row per document; one per chunk without ``n_a``, whose ``codes`` are the pairs
# of the chunk and ``counts`` the documents that hold them.
_ROWS = (
    "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " groups_sha256 string, groups string, codes array<bigint>, counts array<bigint>"
)
_LONGS = pa.list_(pa.int64())
_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("groups", pa.string()), ("codes", _LONGS), ("counts", _LONGS)]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    *columns, codes, counts = zip(*rows, strict=True)
    bounds = pa.array(np.append(0, np.cumsum([len(code) for code in codes])), pa.int32())
    lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(one), pa.int64())) for one in (codes, counts)]
    kinds = [field.type for field in _SCHEMA][:-2]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + lists, schema=_SCHEMA)


def _aligned(paths: tuple[str, str], groups: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(paths)
        aligner = _Aligner(pair)
        chunk = TaskContext.get().partitionId() << 32
        filled = 0
        held: tuple[np.ndarray, np.ndarray] = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[tuple[_Document, str]] = []
        size = 0

        def done() -> list[tuple]:
            nonlocal held
            owners = [owner for owner, _ in waiting]
            for owner, found in zip(owners, aligner.align(pair.encode([text for _, text in waiting])), strict=True):
                owner.add(found)
            rows = [(chunk, *owner.row()) for owner in dict.fromkeys(owners) if not owner.left]
            codes = [row[-2] for row in rows]
            held = _merged([held[0], *codes], [held[1], *(np.ones(len(code), np.int64) for code in codes)])
            waiting.clear()
            return rows

        def closed() -> pa.RecordBatch:
            return _batch([(chunk, None, None, None, None, None, None, None, *held)])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                slices = _slices(text.as_py(), pair.cut)
                document = _Document(doc_id, len(slices), groups)
                for one in slices:
                    waiting.append((document, one))
                    filled += len(one) + ROW_CHARS
                    size += len(one) + ROW_CHARS
                    if size >= BLOCK_CHARS:
                        if rows := done():
                            yield _batch(rows)
                        size = 0
                if filled >= CHUNK_CHARS:
                    if waiting:
                        yield _batch(done())
                    yield closed()
                    chunk, filled, size, held = chunk + 1, 0, 0, (held[0][:0], held[1][:0])
        if waiting and (rows := done()):
            yield _batch(rows)
        if filled:
            yield closed()

    return align


def _scored(key: tuple, documents: pa.Table, known: pa.Table) -> pa.Table:
    """Sums over the links of a chunk's documents."""
    codes, counts, best = (known.column(name).to_numpy() for name in ("code", "n", "best"))
    order = np.argsort(codes)
    codes, counts, best = codes[order], counts[order], best[order].astype(bool)
    columns: list[list[int]] = [[], []]
    for code, count in zip(documents.column("codes"), documents.column("counts"), strict=True):
        at = np.searchsorted(codes, code.values.to_numpy())
        links = count.values.to_numpy()
        columns[0].append(int(links[best[at]].sum()))
        columns[1].append(int((links * counts[at]).sum()))
    kept = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    for name, values in zip(("n_best", "count_sum"), columns, strict=True):
        kept = kept.append_column(name, pa.array(values, pa.int64()))
    return kept.append_column("groups_sha256", documents.column("groups_sha256")).append_column("groups", documents.column("groups"))


def align(documents: DataFrame, vocabularies: tuple[str, str] | None = None, groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups.

    One row per document: tokens of both vocabularies, groups between shared ends,
    links (pairs of tokens that share bytes), those whose pair of ids is as frequent
    as any of its A id, and the sum of the links' counts of documents. ``groups`` is
    null unless asked for: ``a1,a2|b1;a3|b2,b3``, by ids. A null or empty text, and
    one that either vocabulary does not give back byte by byte, has no tokens: zeros
    and ''. Each row is a document of its own, so repeated rows count each and rows
    without doc_id stay; other columns, whatever their names, are left behind. Texts
    are whole: long ones pass in slices cut where both vocabularies must cut; one
    without spaces is a slice. An empty table gives no row.
    """
    paths = vocabularies or default_vocabularies()
    rows = staged(texts(documents).mapInArrow(_aligned(paths, groups), _ROWS), "aligned")
    chunks = rows.filter("n_a IS NULL").select("chunk", F.explode(F.arrays_zip("codes", "counts")).alias("one"))
    chunks = chunks.select("chunk", F.col("one.codes").alias("code"), F.col("one.counts").alias("n"))
    counted = staged(chunks.groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    counted = counted.withColumn("a", F.expr(f"code DIV {len(token_pair(paths).bytes_b)}"))
    # At most one row per id of the vocabulary.
    highest = counted.groupBy("a").agg(F.max("n").alias("most"))
    flagged = counted.join(F.broadcast(highest), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    known = chunks.select("chunk", "code").join(flagged, "code").select(F.col("chunk").alias("of"), "code", "n", "best")
    result = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint,"
        " groups_sha256 string, groups string"
    )
    tasks = max(MIN_TASKS, -(-rows.filter("n_a IS NULL").count() // CHUNKS_PER_TASK))
    held, known = rows.filter("n_a IS NOT NULL").repartition(tasks, "chunk"), known.repartition(tasks, "of")
    return held.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_scored, result)
