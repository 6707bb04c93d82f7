"""Hamming comparison of 64-bit words on vertical bit planes.

Lane k of word w holds bit b of row 64 w + k in plane b. One query is compared
with 64 rows by one xor a plane; carry-save counters of one, two, four and an
overflow bit take the distances of all lanes at once. A block of 64 lanes is
abandoned as soon as every lane is beyond the radius.
"""

from __future__ import annotations

import numpy as np

BITS = 64
LANES = 64
# Comparisons of a query with 64 lanes that run together.
ITEMS = 1 << 15
# Counters end at seven.
MAX_RADIUS = 7
# Abandoning is looked at after each so many planes.
STRIDE = 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def planes_of(words: np.ndarray) -> np.ndarray:
    """uint64[64, ceil(n / 64)] of uint64[n]."""
    count = -(-len(words) // LANES)
    padded = np.zeros(count * LANES, np.uint64)
    padded[: len(words)] = words
    bits = np.unpackbits(padded.view(np.uint8).reshape(count, LANES, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").reshape(BITS, count)


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bit vectors."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _beyond(ones, twos, fours, over, radius: int) -> np.ndarray:
    """Lanes whose count is larger than the radius."""
    more = np.zeros_like(ones)
    equal = ~more
    for counter, bit in ((fours, radius >> 2 & 1), (twos, radius >> 1 & 1), (ones, radius & 1)):
        if bit:
            equal &= counter
        else:
            more |= equal & counter
            equal &= ~counter
    return over | more


def within(words: np.ndarray, planes: np.ndarray, query: np.ndarray, block: np.ndarray, valid: np.ndarray, radius: int):
    """Lanes of ``block[i]`` in ``valid[i]`` within the radius of row ``query[i]``.

    Returns (item numbers, lane masks) of the items with such a lane.
    """
    item = np.arange(len(query))
    asked = words[query]
    ones, twos, fours, over = (np.zeros(len(query), np.uint64) for _ in range(4))
    for plane in range(0, BITS, 4):
        x = [planes[b][block] ^ (np.uint64(0) - ((asked >> np.uint64(b)) & np.uint64(1))) for b in range(plane, plane + 4)]
        ones, carry = _add(ones, x[0], x[1])
        ones, other = _add(ones, x[2], x[3])
        twos, four = _add(twos, carry, other)
        over = over | (fours & four)
        fours = fours ^ four
        if (plane + 4) % STRIDE == 0:
            alive = (valid & ~_beyond(ones, twos, fours, over, radius)) != 0
            if not alive.all():
                item, block, valid, asked = item[alive], block[alive], valid[alive], asked[alive]
                ones, twos, fours, over = ones[alive], twos[alive], fours[alive], over[alive]
            if not len(item):
                break
    return item, valid & ~_beyond(ones, twos, fours, over, radius)


def join_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Merge the classes of linked rows; a label is the smallest row of its class."""
    while len(u):
        a, b = labels[u], labels[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(shorter := labels[labels], labels):
            labels = shorter
    return labels


def classes(groups: np.ndarray, words: np.ndarray, radius: int) -> np.ndarray:
    """The first row of each row's class, by links inside equal neighbouring groups."""
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"radius {radius} is not between 0 and {MAX_RADIUS}")
    n = len(words)
    labels = np.arange(n)
    if n < 2:
        return labels
    ends = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, n)
    end = ends[np.searchsorted(ends, np.arange(n), side="right")]
    query = np.flatnonzero(end - np.arange(n) > 1)
    planes = planes_of(words)
    first, last = (query + 1) // LANES, (end[query] - 1) // LANES
    counts = np.cumsum(last - first + 1)
    done = 0
    while done < len(query):
        # At least one query, else as many as fill a block of items.
        taken = counts[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(counts, taken + ITEMS, side="right")))
        size = (last - first + 1)[done:stop]
        asked = np.repeat(query[done:stop], size)
        block = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[done:stop], size)
        low = np.clip(asked + 1 - block * LANES, 0, LANES - 1).astype(np.uint64)
        high = np.clip(end[asked] - block * LANES, 1, LANES).astype(np.uint64)
        valid = (_ALL << low) & (_ALL >> (np.uint64(LANES) - high))
        item, hits = within(words, planes, asked, block, valid, radius)
        if len(item):
            lanes = np.unpackbits(hits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(lanes)
            labels = join_labels(labels, asked[item[at]], block[item[at]] * LANES + lane)
        done = stop
    return labels
