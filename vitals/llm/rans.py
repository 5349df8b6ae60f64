"""Static range asymmetric numeral system (rANS) over token ids, numpy-vectorised.

A block of ids is dealt over interleaved lanes (id i goes to lane i mod lanes). All lanes
share one frequency table whose entries sum to 2**bits; each lane keeps a 63-bit state and
renormalises by 32-bit words, written so that the decoder reads them forwards.
Every ``checkpoint`` steps the lane states and the word offset are kept, so that a block
can be decoded from any checkpoint.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


def quantise(counts: np.ndarray, bits: int) -> np.ndarray:
    """Integer frequencies that sum to 2**bits, at least 1 for every id that occurs."""
    total, size = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.int64)
    used = counts > 0
    if used.sum() > size:
        raise ValueError("more symbols than slots")
    freq = np.where(used, np.maximum(1, counts * (size / total)).astype(np.int64), 0)
    order = np.argsort(-freq, kind="stable")
    rest = size - int(freq.sum())
    if rest > 0:
        freq[order[0]] += rest
    for at in order:  # at most one slot of each id is over, so this ends early
        if rest >= 0:
            break
        take = min(-rest, int(freq[at] - 1) // 2 + int(freq[at] == 2))
        freq[at] -= take
        rest += take
    return freq


@dataclass
class Table:
    freq: np.ndarray
    bits: int

    def __post_init__(self):
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.f = self.freq.astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)


def encode(ids: np.ndarray, table: Table, lanes: int, checkpoint: int) -> tuple[bytes, bytes, list[int]]:
    """(words, lane states before step 0 and before each checkpoint, word offsets of those)."""
    n, bits = len(ids), np.uint64(table.bits)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    out, states, behind, written = [], [], [], 0
    for step in range(steps - 1, -1, -1):
        sym = ids[step * lanes : (step + 1) * lanes]
        m = len(sym)
        x, f = state[:m], table.f[sym]
        over = x >= (f << (np.uint64(63) - bits))
        if over.any():
            out.append(x[over].astype(np.uint32))
            written += len(out[-1])
            x = np.where(over, x >> WORD, x)
        q = x // f
        state[:m] = (q << bits) + (x - q * f) + table.start[sym]
        if step % checkpoint == 0:
            states.append(state.copy())
            behind.append(written)
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    return words.tobytes(), np.concatenate(states[::-1]).tobytes() if states else b"", [written - b for b in behind[::-1]]


def decode(words: bytes, states: bytes, offsets: list[int], n: int, table: Table, lanes: int, checkpoint: int, part: int | None = None) -> np.ndarray:
    """The ids of a block, or of the stretch that starts at checkpoint ``part`` alone."""
    if not n:
        return np.zeros(0, np.uint32)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    if part is None:
        first, last, part = 0, steps, 0
    else:
        first, last = part * checkpoint, min(steps, (part + 1) * checkpoint)
    stream = np.frombuffer(words, np.uint32)
    state = np.frombuffer(states, np.uint64)[part * lanes : (part + 1) * lanes].copy()
    at, bits, mask = offsets[part], np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    out = np.empty((last - first) * lanes, np.uint32)
    for step in range(first, last):
        m = min(lanes, n - step * lanes)
        x = state[:m]
        slot = x & mask
        sym = table.symbol[slot]
        x = table.f[sym] * (x >> bits) + slot - table.start[sym]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << WORD) | stream[at : at + len(low)]
            at += len(low)
        state[:m] = x
        out[(step - first) * lanes : (step - first) * lanes + m] = sym
    return out[: min(n, last * lanes) - first * lanes]


def crc_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
