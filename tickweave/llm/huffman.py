"""Canonical length-limited Huffman codes over integer symbols, with numpy.

Code lengths come from package-merge, so they are the best under the limit. A coded block carries the
bit offset of every ``EVERY``-th symbol; decoding walks all those places at once through one table.
"""

from __future__ import annotations

import numpy as np

LIMIT = 16
EVERY = 256
#: A code has no more bits than this: the decoding table has an entry for every value of so many bits.
MOST_BITS = 28
PAD = 5


def least_limit(counts: np.ndarray, limit: int = LIMIT) -> int:
    """The limit, or the least higher one that has codes for all symbols that occur."""
    return max(limit, int(np.count_nonzero(counts) - 1).bit_length() if np.any(counts) else 0)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each symbol's code, ``limit`` at most; 0 for symbols that never occur."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes of more than {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    level, leaves = weights, []
    for _ in range(limit):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1) if leaves else weights[:0]
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        level = both[order]
        leaves.append(np.cumsum(order < len(weights)))
    take = 2 * len(used) - 2
    depth = np.zeros(len(used) + 1, dtype=np.int64)
    for count in reversed(leaves):
        if take <= 0:
            break
        chosen = int(count[take - 1])
        depth[0] += 1
        depth[chosen] -= 1
        take = 2 * (take - chosen)
    lengths[used] = np.cumsum(depth[:-1])
    return lengths


class Codebook:
    """Codes and decoding table that follow from code lengths alone."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.bits = max(int(lengths.max(initial=1)), 1)
        if self.bits > MOST_BITS:
            raise ValueError(f"codes have at most {MOST_BITS} bits")
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        size = lengths[order].astype(np.int64)
        room = np.left_shift(1, self.bits - size)
        begin = np.cumsum(room) - room
        if len(order) and begin[-1] + room[-1] > 1 << self.bits:
            raise ValueError("no prefix code has these lengths")
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[order] = (begin >> (self.bits - size)).astype(np.uint64)
        self.symbol = np.zeros(1 << self.bits, dtype=np.uint32)
        self.step = np.zeros(1 << self.bits, dtype=np.int64)
        filled = int(begin[-1] + room[-1]) if len(order) else 0
        self.symbol[:filled] = np.repeat(order, room)
        self.step[:filled] = np.repeat(size, room)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the codes in turn, and the bit offset of every ``EVERY``-th."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        size = self.lengths[ids].astype(np.int64)
        if not size.all():
            raise ValueError("a symbol has no code")
        end = np.cumsum(size)
        begin = end - size
        value = self.codes[ids] << (64 - (begin & 31) - size).astype(np.uint64)
        word = begin >> 5
        fresh = np.flatnonzero(np.diff(word, prepend=-1))
        total = int(end[-1])
        out = np.zeros(total // 32 + 2, dtype=np.uint64)
        out[word[fresh]] += np.add.reduceat(value >> np.uint64(32), fresh)
        out[word[fresh] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), fresh)
        return out.astype(">u4").tobytes()[: (total + 7) // 8], begin[::EVERY]

    def decode(self, blocks: list[bytes], marks: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """All symbols of some blocks, one after another. ``marks``: the bit offsets of each block."""
        total = int(sizes.sum())
        out = np.zeros(total, dtype=np.uint32)
        if not total:
            return out
        data = np.frombuffer(b"".join(b + bytes(PAD) for b in blocks), np.uint8)
        base = np.cumsum([0, *[8 * (len(b) + PAD) for b in blocks[:-1]]])
        places = [len(m) for m in marks]
        bit = np.concatenate(marks) + np.repeat(base, places)
        block = np.repeat(np.arange(len(blocks)), places)
        nth = np.concatenate([np.arange(n) for n in places]) * EVERY
        start = np.cumsum(sizes) - sizes
        target = start[block] + nth
        left = np.minimum(sizes[block] - nth, EVERY)
        order = np.argsort(-left, kind="stable")
        bit, target, left = bit[order], target[order], left[order]
        # a code may begin at any bit of a byte, so it spans up to 7 bits more than it has
        wide = -(-(self.bits + 7) // 8)
        mask, shift = (1 << self.bits) - 1, 8 * wide - self.bits
        for turn in range(EVERY):
            lanes = int(np.searchsorted(-left, -turn, side="left"))
            if not lanes:
                break
            bit, target = bit[:lanes], target[:lanes]
            byte = bit >> 3
            window = data[byte].astype(np.int64)
            for more in range(1, wide):
                window = (window << 8) | data[byte + more]
            code = (window >> (shift - (bit & 7))) & mask
            out[target + turn] = self.symbol[code]
            bit = bit + self.step[code]
        return out
