"""Runs of repeated word groups: maximal stretches of words with a smallest period that they hold at least four times.

The words of some documents are numbered and laid end to end, with a symbol of its own after each document. Longest
common extensions come from a difference cover: only suffixes at positions whose remainder by ``STEP`` is in ``COVER``
are sorted (by doubling, which stays among sampled positions). Any two positions are at most ``STEP - 1`` words before
two sampled ones; those few words are compared directly, and a sparse table over the sorted suffixes' common lengths
answers the rest. The reversed words do the same backwards.

A stretch of at least four periods p holds p pairs of equal words p apart at 3p following places, so one of them lies on
the grid 0, 3p, 6p, ... of its document. The grids of all p are about n ln(n) / 3 pairs; each pair of equal words is
extended both ways. Stretches found with several periods have the smallest.

Defined results: a null text has no words; texts with fewer than six words have no runs; ties between runs are settled
by start, then period; repeated rows and ids are scanned row by row; an empty table gives no rows. Words are what
space and \\x09-\\x0D separate. Only the id and the text are read, except by ``collapse``, which passes other columns on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import groups, map_rows, text_bytes

LEAST_WORDS, LEAST_PERIODS = 6, 4
STEP, COVER = 7, (1, 2, 4)
_GRID = LEAST_PERIODS - 1  # grid distance in periods
_PAIRS = 1 << 20  # grid pairs looked at together, or those of one period
# For two positions by remainder and distance: words to the first place where both are sampled.
_SHIFT = np.array([[next(d for d in range(STEP) if (i + d) % STEP in COVER and (i + apart + d) % STEP in COVER)
                    for apart in range(STEP)] for i in range(STEP)])


def _ranks(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1].astype(np.int64)


class Extensions:
    """Longest common extensions to the right in an array of symbols from 0 on.

    No two different positions may have equal suffixes: the end must be marked by symbols that occur once.
    """

    def __init__(self, symbols: np.ndarray):
        top = int(symbols.max(initial=-1)) + 1
        self.symbols = np.concatenate([symbols, np.arange(top, top + 3 * STEP)])
        self.per_class = (len(symbols) + STEP) // STEP + 1
        self.first = np.full(STEP, -1)
        self.first[list(COVER)] = np.arange(len(COVER)) * self.per_class
        at = (np.array(COVER)[:, None] + STEP * np.arange(self.per_class)).ravel()
        levels = self._sorted(at)
        self.rank = levels.pop()
        order = np.empty(len(at), np.int64)
        order[self.rank] = np.arange(len(at))
        self.table = self._minima(self._neighbours(at, order, levels))

    def _sorted(self, at: np.ndarray) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first STEP, 2 STEP, 4 STEP, ... words, until all differ."""
        bits = int(self.symbols[-1]).bit_length()
        each, keys = 62 // bits, []
        for place in range(0, STEP, each):
            key = np.zeros(len(at), np.int64)
            for word in range(place, min(place + each, STEP)):
                key = key << bits | self.symbols[at + word]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), np.int64)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        ranks = np.empty(len(at), np.int64)
        ranks[order] = np.cumsum(new)
        levels, step = [ranks], 1
        while ranks.max() + 1 < len(at):
            beyond = np.zeros((len(COVER), self.per_class), np.int64)
            beyond[:, :-step] = ranks.reshape(len(COVER), -1)[:, step:] + 1
            ranks = _ranks(ranks * (len(at) + 1) + beyond.ravel())
            levels.append(ranks)
            step *= 2
        return levels

    def _neighbours(self, at: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common lengths of suffixes next to each other in the order."""
        a, b = order[:-1].copy(), order[1:].copy()
        for level in range(len(levels) - 1, -1, -1):
            same = levels[level][a] == levels[level][b]
            a[same] += 1 << level
            b[same] += 1 << level
        length = (a - order[:-1]) * STEP
        a, b, same = at[a], at[b], np.ones(len(a), bool)
        for word in range(STEP):
            same &= self.symbols[a + word] == self.symbols[b + word]
            length += same
        return length

    @staticmethod
    def _minima(lengths: np.ndarray) -> list[np.ndarray]:
        table, width = [lengths], 1
        while 2 * width <= len(lengths):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from ``i`` on that are those from ``j`` on, for pairs of different positions."""
        shift = _SHIFT[i % STEP, (j - i) % STEP]
        length, same = np.zeros(len(i), np.int64), np.ones(len(i), bool)
        for word in range(STEP - 1):
            near = word < shift
            same &= ~near | (self.symbols[i + word] == self.symbols[j + word])
            length += same & near
        i, j = i[same] + shift[same], j[same] + shift[same]
        a, b = (self.rank[self.first[x % STEP] + x // STEP] for x in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        found = np.empty(len(low), np.int64)
        for size in np.unique(level):
            mine = level == size
            row = self.table[size]
            found[mine] = np.minimum(row[low[mine]], row[high[mine] - (1 << int(size))])
        length[same] += found
        return length


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of each of ``counts`` items per owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First position and period of all grid pairs, about ``_PAIRS`` at a time."""
    document, period = _ragged(np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0))
    period += 1
    counts = -(-(sizes[document] - period) // (_GRID * period))
    total, first = np.cumsum(counts), 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + _PAIRS, side="right")))
        owner, place = _ragged(counts[first:last])
        owner += first
        yield starts[document[owner]] + _GRID * period[owner] * place, period[owner]
        first = last


def find_runs(documents: list[np.ndarray]) -> list[np.ndarray]:
    """Per document, given as numbers of its words: rows of start, length, period, by start, then period."""
    sizes = np.array([len(d) for d in documents], np.int64)
    none = [np.zeros((0, 3), np.int64)] * len(documents)
    if not (sizes >= LEAST_WORDS).any():
        return none
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.empty(int((sizes + 1).sum()), np.int64)
    top = 1 + max(int(d.max(initial=-1)) for d in documents)
    symbols[starts + sizes] = top + np.arange(len(documents))
    for document, start, size in zip(documents, starts, sizes):
        symbols[start:start + size] = document
    last, ahead, back, found = len(symbols) - 1, None, None, []
    for i, period in _grid(starts, sizes):
        same = symbols[i] == symbols[i + period]
        i, period = i[same], period[same]
        if not len(i):
            continue
        if ahead is None:
            ahead, back = Extensions(symbols), Extensions(symbols[::-1])
        left = back(last + 1 - i, last + 1 - i - period)
        length = left + period + ahead(i, i + period)
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.stack([(i - left)[long], length[long], period[long]], 1))
    runs = np.concatenate(found) if found else none[0]
    if not len(runs):
        return none
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = (runs[1:, :2] == runs[:-1, :2]).all(1)
    runs = runs[np.concatenate([[True], ~again])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs[:, 0] -= starts[owner]
    ends = np.searchsorted(owner, np.arange(len(documents) + 1))
    return [runs[a:b] for a, b in zip(ends[:-1], ends[1:])]


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Mask of the words that no run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the most periods; the first, then the one of the smallest period, of several."""
    return max(map(tuple, runs.tolist()), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


Words = list[bytes]
Rewrite = Callable[[object, Words], Words]


def scanned(batch: pa.RecordBatch, id_col: str, text_col: str, rewrite: Rewrite | None = None) -> Iterator[tuple[Words, np.ndarray]]:
    """Words and runs of each row; ``rewrite`` may change the words of an id first."""
    data, offsets = text_bytes(batch.column(text_col))
    ids = batch.column(id_col).to_pylist()
    for first, last in groups(offsets):
        number: dict[bytes, int] = {}
        texts = [data[offsets[row]:offsets[row + 1]].tobytes().split() for row in range(first, last)]
        if rewrite:
            texts = [rewrite(ids[first + n], words) for n, words in enumerate(texts)]
        documents = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in texts]
        yield from zip(texts, find_runs(documents))


def collapsed(words: Words, runs: np.ndarray) -> bytes:
    """The kept words with one space between them."""
    if not len(runs):
        return b" ".join(words)
    return b" ".join(words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist())


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """A row per run: the id of its row, ``start`` (word number), ``length`` and ``period`` in words."""
    def run(batch: pa.RecordBatch) -> dict:
        found = [r for _, r in scanned(batch, id_col, text_col, rewrite)]
        owner = pa.array(np.repeat(np.arange(len(found)), [len(r) for r in found]))
        every = np.concatenate(found)
        return {id_col: batch.column(id_col).take(owner), **{n: every[:, k] for k, n in enumerate(("start", "length", "period"))}}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, start long, length long, period long", run)


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with each text's runs cut to their first period, other columns as they were.

    A text without runs stays as it is; words of other texts are joined by one space.
    """
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                old = batch.column(text_col)
                new = [collapsed(w, r) if len(r) else None for w, r in scanned(batch, id_col, text_col)]
                texts = [o if n is None else n.decode("utf-8", "replace") for o, n in zip(old.to_pylist(), new)]
                place = batch.schema.get_field_index(text_col)
                yield batch.set_column(place, batch.schema.field(place), pa.array(texts, old.type))

    return docs.mapInArrow(run, docs.schema)
