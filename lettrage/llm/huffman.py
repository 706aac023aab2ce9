"""Canonical, length-limited Huffman codes with vectorised coding of bit streams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAX_BITS = 16


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits per symbol of an optimal prefix code with no code over ``limit`` bits (package-merge); 0 for absent symbols."""
    present = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(present) > 1 << limit:
        raise ValueError("more symbols than codes of this length")
    if len(present) == 1:
        lengths[present] = 1
    if len(present) < 2:
        return lengths
    order = present[np.argsort(counts[present], kind="stable")]
    weights = counts[order].astype(np.float64)
    n = len(order)
    kinds = []  # of each level, which entries of its sorted list are packages
    level = weights
    packages = np.zeros(n, dtype=bool)
    for _ in range(limit - 1):
        kinds.append(packages)
        paired = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weights, paired])
        place = np.argsort(merged, kind="stable")
        level, packages = merged[place], place >= n
    kinds.append(packages)
    take = 2 * n - 2
    depth = np.zeros(n, dtype=np.int64)
    for packages in reversed(kinds):
        chosen = packages[:take]
        depth[: take - int(chosen.sum())] += 1  # symbols come in ascending order, so the chosen ones are the first
        take = 2 * int(chosen.sum())
    lengths[order] = depth
    return lengths


@dataclass
class Code:
    lengths: np.ndarray
    codes: np.ndarray
    symbols: np.ndarray  # by the next MAX_BITS bits
    widths: np.ndarray

    @classmethod
    def canonical(cls, lengths: np.ndarray) -> Code:
        """Codes in order of length, then symbol; the tables map the next bits to a symbol and its length."""
        present = np.flatnonzero(lengths)
        order = present[np.lexsort((present, lengths[present]))]
        spans = 1 << (MAX_BITS - lengths[order].astype(np.int64))
        starts = np.concatenate([[0], np.cumsum(spans)])
        codes = np.zeros(len(lengths), dtype=np.uint64)
        codes[order] = (starts[:-1] >> (MAX_BITS - lengths[order].astype(np.int64))).astype(np.uint64)
        symbols, widths = np.zeros(1 << MAX_BITS, dtype=np.uint32), np.ones(1 << MAX_BITS, dtype=np.uint8)
        symbols[: starts[-1]] = np.repeat(order, spans)
        widths[: starts[-1]] = np.repeat(lengths[order], spans)
        return cls(lengths, codes, symbols, widths)

    def encode(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """The bit stream, most significant bit first, and the bit offset of every ``every``-th id."""
        widths = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(widths)
        starts = ends - widths
        word = starts >> 5
        shifted = self.codes[ids] << (64 - widths - (starts & 31)).astype(np.uint64)
        words = np.zeros(int(ends[-1] >> 5) + 2 if len(ids) else 0, dtype=np.uint64)
        if len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] = np.bitwise_or.reduceat(shifted, first)
        high = (words >> np.uint64(32)).astype(np.uint32)
        high[1:] |= (words[:-1] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        size = (int(ends[-1]) + 7) // 8 if len(ids) else 0
        return high.astype(">u4").tobytes()[:size], starts[::every]

    def decode(self, streams: bytes, offsets: np.ndarray, sizes: np.ndarray, counts: np.ndarray, every: int) -> np.ndarray:
        """The ids of streams one after another, each of ``sizes`` bytes and ``counts`` ids, with the offsets within
        each. All runs between checkpoints are decoded side by side, one id of each in a step."""
        runs = -(-counts // every)
        if not runs.sum():
            return np.zeros(0, dtype=np.uint32)
        padded = np.frombuffer(streams + bytes(3), dtype=np.uint8).astype(np.uint32)
        window = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
        begins = np.cumsum(sizes) - sizes
        at = np.repeat(begins * 8, runs) + offsets
        lengths = np.full(len(at), every)
        lengths[np.cumsum(runs)[runs > 0] - 1] = (counts - (runs - 1) * every)[runs > 0]
        order = np.argsort(-lengths, kind="stable")  # runs that end early are at the end, and drop out
        at, live = at[order], np.searchsorted(-lengths[order], -np.arange(every), side="left")
        out = np.zeros((len(at), every), dtype=np.uint32)
        for step in range(every):
            part = at[: live[step]]
            bits = (window[part >> 3] >> (8 - (part & 7)).astype(np.uint32)) & 0xFFFF
            out[: live[step], step] = self.symbols[bits]
            part += self.widths[bits]
        back = np.empty_like(out)
        back[order] = out
        return back[np.arange(every) < lengths[:, None]]
