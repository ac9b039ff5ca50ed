"""Hashed text features, computed over the UTF-8 bytes of a whole Arrow batch at once.

A *channel* is one kind of feature: whole words, word beginnings of one length, or character n-grams
(byte n-grams of the UTF-8 text). Each channel has its own ``2 ** bits`` hash slots. A document's value in a
slot is the slot's share of the channel (``mean``) or 1 if it occurs at all (``present``).

A substring hash is a difference of prefix sums of ``byte * base ** position`` modulo 2 ** 64, scaled back
by the inverse power and mixed; so every length costs one vector operation, whatever the length.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from .common import GROUP_BYTES, groups

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _tables(lower: bool, letters_only: bool) -> tuple[np.ndarray, np.ndarray]:
    folded = np.arange(256, dtype=np.uint8)
    if lower:
        folded[65:91] += 32
    separator = np.zeros(256, bool)
    separator[[32, 9, 10, 11, 12, 13]] = True
    if letters_only:
        separator[:128] = True
        separator[[*range(65, 91), *range(97, 123)]] = False
    return folded, separator


@dataclass
class HashedText:
    """``words``, word ``prefixes`` (in bytes) and n-gram ``sizes``, ``2 ** bits`` slots each.

    N-grams count bytes, or code points with ``characters``. ``echoes`` adds a channel of two slots in use: whether a word equals the one before it.
    """

    bits: int = 16
    words: bool = True
    prefixes: tuple[int, ...] = ()
    sizes: tuple[int, ...] = ()
    lower: bool = False
    letters_only: bool = False
    echoes: bool = False
    characters: bool = False
    _cache: dict = field(default_factory=dict, repr=False, compare=False)

    @property
    def channels(self) -> int:
        return int(self.words) + int(self.echoes) + len(self.prefixes) + len(self.sizes)

    @property
    def slots(self) -> int:
        return self.channels << self.bits

    def __getstate__(self):
        return {**self.__dict__, "_cache": {}}

    def _power(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = self._cache.get("powers")
        if have is None or len(have[0]) < n:
            size = max(n, GROUP_BYTES + 64)
            have = _powers(_BASE, size), _powers(_INVERSE, size)
            if size <= 4 * GROUP_BYTES:
                self._cache["powers"] = have
        return have

    def _slot(self, value: np.ndarray, salt: int) -> np.ndarray:
        value = value ^ np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
        value ^= value >> np.uint64(33)
        value *= _MIX
        value ^= value >> np.uint64(29)
        value *= _MIX
        return (value >> np.uint64(64 - self.bits)).astype(np.int64)

    def segments(self, data: np.ndarray, offsets: np.ndarray):
        """Per channel: slots, and per row the first and last (exclusive) place in them."""
        if "tables" not in self._cache:
            self._cache["tables"] = _tables(self.lower, self.letters_only)
        folded, separator = self._cache["tables"]
        base = int(offsets[0])
        at = (offsets - base).astype(np.int64)
        raw = folded[data[base:int(offsets[-1])]]
        n = len(raw)
        power, inverse = self._power(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        channel = 0
        if self.words or self.prefixes:
            inside = ~separator[raw]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            row_starts = at[:-1][at[:-1] < n]
            first[row_starts] = inside[row_starts]
            final = inside.copy()
            final[:-1] &= ~inside[1:]
            row_ends = at[1:][at[1:] > 0] - 1
            final[row_ends] = inside[row_ends]
            start, end = np.flatnonzero(first), np.flatnonzero(final) + 1
            if self.words:
                channel += 1
                slot = self._slot((total[end] - total[start]) * inverse[start], channel)
                lo, hi = np.searchsorted(start, at[:-1]), np.searchsorted(start, at[1:])
                yield slot, lo, hi
                if self.echoes:
                    channel += 1
                    same = np.zeros(len(slot), np.int64)
                    same[1:] = slot[1:] == slot[:-1]
                    same[lo[lo < hi]] = 0
                    yield same, lo, hi
            for length in self.prefixes:
                channel += 1
                long = start[end - start >= length]
                slot = self._slot((total[long + length] - total[long]) * inverse[long], channel)
                yield slot, np.searchsorted(long, at[:-1]), np.searchsorted(long, at[1:])
        if self.characters:  # first bytes of code points
            lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), n)
            at = np.searchsorted(lead, at)
            n = len(lead) - 1
        for size in self.sizes:
            channel += 1
            places = max(n - size + 1, 0)
            if self.characters:
                start, end = lead[:places], lead[size:size + places]
                slot = self._slot((total[end] - total[start]) * inverse[start], channel)
            else:
                slot = self._slot((total[size:size + places] - total[:places]) * inverse[:places], channel)
            lo = np.minimum(at[:-1], places)
            yield slot, lo, np.clip(at[1:] - size + 1, lo, places)

    def mean_scores(self, data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Per row: the sum over channels of the mean weight of the channel's features."""
        table = weights.reshape(self.channels, 1 << self.bits)
        out = np.zeros(len(offsets) - 1)
        for first, last in groups(offsets):
            for channel, (slot, lo, hi) in enumerate(self.segments(data, offsets[first:last + 1])):
                running = np.zeros(len(slot) + 1)
                np.cumsum(table[channel][slot], out=running[1:])
                out[first:last] += (running[hi] - running[lo]) / np.maximum(hi - lo, 1)
        return out

    def presence_scores(self, data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Per row: the sum of the weights of all features that occur, each counted once."""
        table = weights.reshape(self.channels, 1 << self.bits)
        out = np.zeros(len(offsets) - 1)
        for first, last in groups(offsets):
            rows = last - first
            for channel, (slot, lo, hi) in enumerate(self.segments(data, offsets[first:last + 1])):
                size = hi - lo
                row = np.repeat(np.arange(rows), size)
                own = slot[np.arange(len(row)) + np.repeat(lo - np.cumsum(size) + size, size)]
                used = table[channel][own] != 0
                if used.any():
                    pair = np.unique(row[used] << self.bits | own[used])
                    out[first:last] += np.bincount(pair >> self.bits, table[channel][pair & ((1 << self.bits) - 1)],
                                                   minlength=rows)
        return out

    def sparse_rows(self, data: np.ndarray, offsets: np.ndarray, present: bool = False):
        """Per row: slot numbers over all channels, and their values."""
        for first, last in groups(offsets):
            parts = list(self.segments(data, offsets[first:last + 1]))
            for row in range(last - first):
                slots, values = [], []
                for channel, (slot, lo, hi) in enumerate(parts):
                    found, count = np.unique(slot[lo[row]:hi[row]], return_counts=True)
                    slots.append(found + (channel << self.bits))
                    values.append(np.ones(len(found)) if present else count / max(hi[row] - lo[row], 1))
                yield np.concatenate(slots).astype(np.int32), np.concatenate(values).astype(np.float32)


@dataclass
class Sparse:
    """Rows of slots and values, as the trainers read them."""

    slots: np.ndarray
    values: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[bytes, bytes]]) -> "Sparse":
        slots = [np.frombuffer(s, np.int32) for s, _ in rows]
        values = [np.frombuffer(v, np.float32) for _, v in rows]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int64)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return cls(join(slots, np.int32), join(values, np.float32), bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def dot(self, weights: np.ndarray) -> np.ndarray:
        running = np.zeros(len(self.slots) + 1)
        np.cumsum(weights[self.slots] * self.values, out=running[1:])
        return running[self.bounds[1:]] - running[self.bounds[:-1]]

    def back(self, per_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.slots, np.repeat(per_row, np.diff(self.bounds)) * self.values, minlength=size)


class Adam:
    """Full-batch steps on one weight vector."""

    def __init__(self, rate: float):
        self.rate, self.step, self.mean, self.square = rate, 0, 0.0, 0.0

    def update(self, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.99 * self.square + 0.01 * gradient * gradient
        mean, square = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.99**self.step)
        return weights - self.rate * mean / (np.sqrt(square) + 1e-8)
