"""Suffixes sorted by mergesort with hash comparisons, and the repeats between them.

A row of a batch is a context: bytes around an anchor at a known offset. ``sort_rows`` sorts the
byte strings that begin at the anchor (or end there, reversed). Two strings are compared through
prefix polynomial hashes: binary search over the length finds their common extension in a
logarithmic number of hash comparisons, and the byte after it decides. All comparisons of one
merge step run as one array operation. Afterwards the bytes of neighbours are compared; should a
hash collision have misled the sort, the batch is sorted by its bytes instead.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)


def prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of byte rows, modulo 2**64."""
    out = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
    for i in range(rows.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + rows[:, i] + np.uint64(1)
    return out


def common_prefixes(hashes: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of rows ``a`` and ``b``, by binary search over the hashes."""
    low = np.zeros(len(a), np.int64)
    high = np.minimum(sizes[a], sizes[b])
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        equal = hashes[a, middle] == hashes[b, middle]
        low = np.where(open_ & equal, middle, low)
        high = np.where(open_ & ~equal, middle - 1, high)


def sort_rows(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows (padded with zeros; ``sizes`` are their lengths; a prefix comes first,
    equal rows stay in place) and the common prefix of each with the row before it."""
    n = len(rows)
    hashes = prefix_hashes(rows)
    order = np.arange(n)

    def before(a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether row ``a`` comes before row ``b``."""
        shared = common_prefixes(hashes, sizes, a, b)
        at = np.minimum(shared, rows.shape[1] - 1)
        a_ends, b_ends = shared == sizes[a], shared == sizes[b]
        smaller = rows[a, at] < rows[b, at]
        return np.where(a_ends, ~b_ends | or_equal, ~b_ends & smaller)

    width = 1
    while width < n:
        place = np.arange(n)
        run = place // width
        start = (run ^ 1) * width  # of the neighbour that each run is merged with
        low, high = np.minimum(start, n), np.minimum(start + width, n)
        first, left = low.copy(), run % 2 == 0
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            ahead = np.empty(len(open_), bool)
            for side, or_equal in ((True, False), (False, True)):
                mine = np.flatnonzero(left[open_] == side)
                ahead[mine] = before(order[middle[mine]], order[open_[mine]], or_equal)
            low[open_] = np.where(ahead, middle + 1, low[open_])
            high[open_] = np.where(ahead, high[open_], middle)
        target = (run - run % 2) * width + place % width + (low - first)
        merged = np.full(n, -1)
        merged[target] = order
        order = merged
        if (order < 0).any():  # comparisons that contradict each other
            break
        width *= 2
    shared = np.zeros(n, np.int64)
    sound = not (order < 0).any()
    if sound:
        shared[1:] = _verified(rows, sizes, order)
        sound = _ascending(rows, sizes, order, shared[1:])
    if not sound:
        keyed = np.concatenate([rows, sizes.astype(">u4").view(np.uint8).reshape(n, 4)], axis=1)
        order = np.lexsort(keyed.T[::-1])
        shared[1:] = _verified(rows, sizes, order)
    return order, shared


def _verified(rows: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefixes of neighbours by their bytes."""
    differ = rows[order[:-1]] != rows[order[1:]]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[order[:-1]], sizes[order[1:]]))


def _ascending(rows: np.ndarray, sizes: np.ndarray, order: np.ndarray, shared: np.ndarray) -> bool:
    a, b = order[:-1], order[1:]
    at = np.minimum(shared, rows.shape[1] - 1)
    return bool(np.all((shared == sizes[a]) | ((shared < sizes[b]) & (rows[a, at] < rows[b, at]))))


def repeats(contexts: list[bytes], anchors: np.ndarray, counts: np.ndarray, rank: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` bytes stand earlier in another context of the batch.

    Context ``i`` holds ``counts[i]`` windows, which begin at its first bytes and all contain its
    anchor at ``anchors[i]``. Equal windows have the anchor at the same place, so a window is
    named by the bytes that it has before the anchor. Lower ``rank`` is earlier. Returns a matrix
    of rows and windows.
    """
    n, most = len(contexts), int(counts.max())
    left, right = _sides(contexts, anchors)
    classes = []
    for rows, sizes in (left, right):
        order, shared = sort_rows(rows, sizes)
        classes.append((order, shared))
    (left_order, left_shared), (right_order, right_shared) = classes
    out = np.zeros((n, most), bool)
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for behind in range(int((anchors - counts).min()) + 1, int(anchors.max()) + 1):
        begin = anchors - behind
        taking = np.flatnonzero((begin >= 0) & (begin < counts))
        if len(taking) < 2:
            continue
        left_class[left_order] = np.cumsum(left_shared < behind)
        right_class[right_order] = np.cumsum(right_shared < size - behind)
        key = left_class[taking] * (n + 1) + right_class[taking]
        order = np.lexsort((rank[taking], key))
        again = np.zeros(len(taking), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        out[taking, begin[taking]] = again
    return out


def _sides(contexts: list[bytes], anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The bytes before each anchor, reversed, and those from it on, as padded rows and sizes."""
    lengths = np.array([len(c) for c in contexts])
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    out = []
    for sizes, step in ((anchors, -1), (lengths - anchors, 1)):
        width = max(1, int(sizes.max()))
        first = starts + anchors - (step < 0)
        at = first[:, None] + step * np.arange(width)[None, :]
        held = np.arange(width)[None, :] < sizes[:, None]
        out.append((np.where(held, flat[np.clip(at, 0, max(0, len(flat) - 1))], 0).astype(np.uint8), sizes))
    return out
