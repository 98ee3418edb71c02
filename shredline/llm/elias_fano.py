"""Elias-Fano sequences over numpy arrays: monotone integers in about 2 + log2(universe / n) bits each.

All reads are vectorised and touch only the words that they need, so the arrays may be views of a mapped file."""

from __future__ import annotations

import json

import numpy as np

_ONE = np.uint64(1)
_SELECT = np.zeros((256, 8), np.int64)
for _byte in range(256):
    for _k, _bit in enumerate(b for b in range(8) if _byte >> b & 1):
        _SELECT[_byte, _k] = _bit


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: np.uint64) -> np.ndarray:
    """Positions of the k-th (from 0) set bits of ``words ^ flip``; before: how many precede each word."""
    word = np.searchsorted(before, k, side="right") - 1
    left, value, at = k - before[word], words[word] ^ flip, word * 64
    for half in (32, 16, 8):
        lower = value & np.uint64((1 << half) - 1)
        n = np.bitwise_count(lower).astype(np.int64)
        on = left >= n
        left -= np.where(on, n, 0)
        at += np.where(on, half, 0)
        value = np.where(on, value >> np.uint64(half), lower)
    return at + _SELECT[value.astype(np.intp), left]


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], prefix: str):
        self.n, self.width = (int(x) for x in arrays[f"{prefix}.shape"])
        self.high, self.low = arrays[f"{prefix}.high"], arrays[f"{prefix}.low"]
        self.ones, self.zeros = arrays[f"{prefix}.ones"], arrays[f"{prefix}.zeros"]
        self.most = int(arrays[f"{prefix}.buckets"][0])
        self.mask = np.uint64((1 << self.width) - 1)

    @staticmethod
    def build(values: np.ndarray, universe: int, prefix: str) -> dict[str, np.ndarray]:
        """Arrays of the sequence; values are uint64, never decreasing and below ``universe``."""
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        buckets = (universe >> width) + 1
        bits = n + buckets + 1
        words = -(-bits // 64) + 1
        place = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        flags = np.zeros(words * 64, bool)
        flags[place] = True
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)[:-1]])
        zeros = np.arange(len(ones)) * 64 - ones
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width:
            value = values & np.uint64((1 << width) - 1)
            at = np.arange(n, dtype=np.int64) * width
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            # each word is filled by consecutive values: add up without carries
            np.add.at(low, word, value << shift)
            over = np.flatnonzero(shift + np.uint64(width) > 64)
            np.add.at(low, word[over] + 1, value[over] >> (np.uint64(64) - shift[over]))
        parts = {"shape": np.array([n, width], np.int64), "buckets": np.array([buckets], np.int64), "high": high, "low": low, "ones": ones, "zeros": zeros}
        return {f"{prefix}.{k}": v for k, v in parts.items()}

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = self.low[word] >> shift
        second = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | second) & self.mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at these indices."""
        high = _select(self.high, self.ones, i.astype(np.int64), np.uint64(0)) - i
        return (high.astype(np.uint64) << np.uint64(self.width)) | self._lows(i.astype(np.int64))

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the index of the first element that is not smaller, and whether it is equal."""
        if not self.n:
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        h = np.minimum((values >> np.uint64(self.width)).astype(np.int64), self.most - 1)
        rest = values & self.mask
        at = np.zeros_like(h)  # the first bit of the bucket: after the zero that ends the one before
        some = np.flatnonzero(h)
        at[some] = _select(self.high, self.zeros, h[some] - 1, ~np.uint64(0)) + 1
        start = at - h
        ends = ~self.high[at >> 6] >> (at & 63).astype(np.uint64)
        end = start + np.bitwise_count((ends & (~ends + _ONE)) - _ONE)
        some = np.flatnonzero(ends == 0)  # the bucket goes on in the next word
        end[some] = _select(self.high, self.zeros, h[some], ~np.uint64(0)) - h[some]
        low, high = start, end.copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            less = self._lows(middle) < rest[active]
            low[active] = np.where(less, middle + 1, low[active])
            high[active] = np.where(less, high[active], middle)
            active = active[low[active] < high[active]]
        equal = low < end
        some = np.flatnonzero(equal)
        equal[some] = self._lows(low[some]) == rest[some]
        return low, equal


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """One block of bytes with all arrays, each aligned to 64 bytes."""
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (str(a.dtype), at, a.nbytes)
        at += a.nbytes + -a.nbytes % 64
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    return b"".join([len(text).to_bytes(8, "little"), text, *(x for a in arrays.values() for x in (a.tobytes(), b"\0" * (-a.nbytes % 64)))])


def unpack(block: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the arrays of a packed block (bytes as uint8, mapped or not)."""
    n = int.from_bytes(block[:8].tobytes(), "little")
    head = json.loads(block[8 : 8 + n].tobytes())
    return {k: block[8 + n + at : 8 + n + at + size].view(kind) for k, (kind, at, size) in head.items()}
