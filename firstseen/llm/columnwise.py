"""Column-wise construction of suffix order and common prefixes of many pieces.

All pieces have one length. Rounds go from the last column to the first: each
round puts the symbol of its column before every piece's suffix. The new order of
suffixes is the old one stably sorted by that symbol, and the common prefix of
neighbours is one more than the least common prefix between them in the old
order. What a round reads of the Burrows-Wheeler transform is the column before
it in that order. Pieces are aligned, so a round's suffixes are compared with
each other only, and the state is one order and one prefix array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def _next_prefixes(prefixes: np.ndarray, symbols: np.ndarray, moved: np.ndarray, limit: int) -> np.ndarray:
    """Common prefixes in the new order; ``moved`` lists old places by symbol."""
    out = np.zeros(len(prefixes), prefixes.dtype)
    sorted_symbols = symbols[moved]
    bounds = np.append(np.flatnonzero(np.append(True, sorted_symbols[1:] != sorted_symbols[:-1])), len(moved))
    for first, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - first > 1:
            places = moved[first:end]
            least = np.minimum.reduceat(prefixes[: places[-1] + 1], places[:-1] + 1)
            out[first + 1 : end] = np.minimum(least + 1, limit)
    return out


def rounds(pieces: np.ndarray, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(column, order, common prefixes) of uint8[n, length], from the last column.

    ``order[k]`` is the piece whose suffix from that column is k-th. A common
    prefix is that of the suffix with the one before it, ``limit`` at most.
    """
    count, length = pieces.shape
    columns = np.ascontiguousarray(pieces.T)
    order, prefixes = np.arange(count), np.zeros(count, np.uint8)
    for column in range(length - 1, -1, -1):
        symbols = columns[column][order]
        moved = np.argsort(symbols, kind="stable")
        if column == length - 1:
            # Before the first round all suffixes are empty, hence equal.
            prefixes = np.append(np.uint8(0), (symbols[moved][1:] == symbols[moved][:-1]).astype(np.uint8))
        else:
            prefixes = _next_prefixes(prefixes, symbols, moved, limit)
        order = order[moved]
        yield column, order, prefixes


def repeats(pieces: np.ndarray, valid_from: np.ndarray, valid_to: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """bool[n, length - width + 1]: does a piece of a smaller owner hold the same
    ``width`` symbols from that column on? Only columns between ``valid_from``
    and ``valid_to`` of a piece count."""
    count, length = pieces.shape
    out = np.zeros((count, max(0, length - width + 1)), bool)
    if not count:
        return out
    last = np.iinfo(np.int64).max
    for column, order, prefixes in rounds(pieces, width):
        if column + width > length:
            continue
        valid = (valid_from[order] <= column) & (valid_to[order] >= column + width)
        owners = np.where(valid, owner[order], last)
        starts = np.flatnonzero(np.append(True, prefixes[1:] < width))
        smallest = np.repeat(np.minimum.reduceat(owners, starts), np.diff(np.append(starts, count)))
        out[order, column] = valid & (owners > smallest)
    return out
