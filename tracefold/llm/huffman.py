"""Canonical length-limited Huffman codes over token ids: lengths, bits, and decoding from many places at once."""

from __future__ import annotations

import numpy as np

EVERY = 64  # ids between two places from which decoding can start


def code_lengths(counts: np.ndarray, limit: int = 18) -> np.ndarray:
    """The length of each id's code (0 for ids that do not occur), at most ``limit``: optimal by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order].astype(np.float64)
    packages = np.zeros(0)
    is_single = []
    for _ in range(limit):
        merged = np.concatenate([single, packages])
        by_weight = np.argsort(merged, kind="stable")
        is_single.append(by_weight < len(single))
        merged = merged[by_weight]
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    depth, need = np.zeros(len(order), np.int64), 2 * len(order) - 2
    for level in reversed(is_single):
        singles = int(level[:need].sum())
        depth[:singles] += 1
        need = 2 * (need - singles)
    lengths[order] = depth
    return lengths


class Code:
    """Codes are numbered by length, then by id, so the lengths are all that a file has to hold."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.longest = int(self.lengths.max(initial=1))
        ids = np.lexsort((np.arange(len(lengths)), self.lengths))
        ids = ids[self.lengths[ids] > 0]
        width = self.longest - self.lengths[ids]
        spans = np.left_shift(1, width)
        first = np.cumsum(spans) - spans  # left-aligned codes
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[ids] = (first >> width).astype(np.uint64)
        self.table = np.zeros(1 << self.longest, np.int64)
        self.table[:spans.sum()] = np.repeat(ids, spans)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Bit offsets of every EVERY-th id, and the bits."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 32 + 2, np.uint64)
        if len(ids):
            at = starts >> 5
            placed = self.codes[ids] << (64 - (starts & 31) - sizes).astype(np.uint64)
            new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            where = at[new]
            # the bits of different ids do not overlap, so sums are unions
            words[where] += np.add.reduceat(placed >> np.uint64(32), new)
            words[where + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), new)
        return starts[::EVERY].astype("<u4"), words.astype(">u4").tobytes()[:(total + 7) // 8]

    def decode(self, offsets: np.ndarray, bits: bytes, n: int) -> np.ndarray:
        """All lanes, one from each offset, take a step at a time by table."""
        padded = np.frombuffer(bits + bytes(EVERY * self.longest // 8 + 8), np.uint8)
        # the four bytes from each byte on, as one number
        windows = (padded[:-3].astype(np.uint32) << 24) | (padded[1:-2].astype(np.uint32) << 16) | (padded[2:-1].astype(np.uint32) << 8) | padded[3:]
        at, out = offsets.astype(np.int64), np.zeros((EVERY, len(offsets)), np.int64)
        mask = (1 << self.longest) - 1
        for step in range(EVERY):
            seen = (windows[at >> 3].astype(np.int64) >> (32 - self.longest - (at & 7))) & mask
            out[step] = self.table[seen]
            at = at + self.lengths[out[step]]
            np.minimum(at, (len(windows) - 1) * 8, out=at)
        return out.T.reshape(-1)[:n]
