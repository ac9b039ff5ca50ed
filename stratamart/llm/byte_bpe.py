"""Byte-level BPE from a table of ranks, merging with a segment tree; encoding and decoding.

A text is split by the vocabulary's pattern, each match is encoded alone. A match that is a token is that token.
Otherwise a segment tree over its byte positions holds, at the leaf of each live token's first byte, the rank of the
pair that starts there; an inner node holds the smallest rank below it and the leftmost place of it. The root names
the next merge, which changes three leaves: the merged pair, the token before it and the token taken in. So a match of
n bytes takes O(n log n) steps whatever it holds.

Matches met before are remembered per worker (``REMEMBERED`` of at most ``SHORT`` bytes); the others are merged each time.

Defined results: a null text counts as empty and has no ids; bytes that are not UTF-8 count as U+FFFD; rows are encoded
one by one, so repeated rows and ids stay and there are no ties between rows; an empty table gives no rows. Only the id
and the text are read. Decoding takes any ids of the vocabulary; bytes that are not UTF-8 come back as U+FFFD in a text.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows

REMEMBERED, SHORT = 1_000_000, 64
# Texts from this length on are split piece by piece instead of into one list.
LONG = 1 << 20
_NO_PAIR = 1 << 62
_PLACE = 32  # bits for a byte position below the rank


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: always the leftmost pair of the smallest rank is merged first."""
    if piece in ranks:
        return [ranks[piece]]
    n, rank = len(piece), ranks.get
    leaves = 1 << max(n - 2, 0).bit_length()
    tree = [_NO_PAIR] * (2 * leaves)

    def pair(first: int, stop: int) -> int:
        """What the leaf of ``first`` holds if its token and the next one end at ``stop``."""
        found = rank(piece[first:stop])
        return _NO_PAIR if found is None else found << _PLACE | first

    def put(place: int, value: int) -> None:
        node = leaves + place
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            node >>= 1
            least = value if value < other else other
            if tree[node] == least:
                return
            tree[node] = value = least

    for first in range(n - 1):
        tree[leaves + first] = pair(first, first + 2)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    end = list(range(1, n + 1))  # of the live token that starts here
    before = list(range(-1, n))  # start of the live token before the one that starts here
    while tree[1] < _NO_PAIR:
        first = tree[1] & (1 << _PLACE) - 1
        taken = end[first]
        stop = end[first] = end[taken]
        before[stop] = first
        if taken < n - 1:
            put(taken, _NO_PAIR)
        put(first, pair(first, end[stop]) if stop < n else _NO_PAIR)
        if before[first] >= 0:
            put(before[first], pair(before[first], stop))
    ids, first = [], 0
    while first < n:
        ids.append(ranks[piece[first:end[first]]])
        first = end[first]
    return ids


class _Matches(dict):
    """Ids of a match; merges those that are new."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, match: str) -> array:
        piece = match.encode("utf-8", "replace")
        found = array("I", merge(piece, self.ranks))
        if len(piece) <= SHORT and len(self) < REMEMBERED:
            self[match] = found
        return found


_workers: dict[int, tuple] = {}


class ByteBpe:
    """A rank file's content and a split pattern; travels to the executors as these."""

    def __init__(self, content: bytes, pattern: str):
        self.content, self.pattern = content, pattern

    @classmethod
    def load(cls, path: str, pattern: str) -> "ByteBpe":
        """``path``: a file with one base64 token and its rank a line."""
        with open(path, "rb") as file:
            return cls(file.read(), pattern)

    def _ready(self) -> tuple:
        """The compiled pattern, the matches, and bytes and decimal digits by id; made once a worker."""
        key = hash((self.content, self.pattern))
        if key not in _workers:
            import regex

            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, self.content.splitlines())}
            _workers[key] = (regex.compile(self.pattern), _Matches(ranks), {r: t for t, r in ranks.items()},
                             {r: str(r) for r in ranks.values()})
        return _workers[key]

    def encode(self, text: str) -> array:
        pattern, matches = self._ready()[:2]
        found = pattern.findall(text) if len(text) < LONG else (m.group() for m in pattern.finditer(text))
        return array("I", chain.from_iterable(map(matches.__getitem__, found)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self._ready()[2].__getitem__, ids))

    def digits(self, ids: Iterable[int]) -> str:
        """The ids in decimal with one space between them."""
        return " ".join(map(self._ready()[3].__getitem__, ids))


def texts(column: pa.Array) -> list[str]:
    """The rows as text; null counts as empty."""
    return ["" if t is None else t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()]


def encode(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``ids``."""
    def run(batch: pa.RecordBatch) -> dict:
        ids = [memoryview(bpe.encode(t)) for t in texts(batch.column(text_col))]
        return {id_col: batch.column(id_col), "ids": pa.array([i.tolist() for i in ids], pa.list_(pa.int32()))}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, ids array<int>", run)


def decode(encoded: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id, ``bytes`` and ``text``; null ids count as none."""
    def run(batch: pa.RecordBatch) -> dict:
        found = [bpe.decode(ids or ()) for ids in batch.column(ids_col).to_pylist()]
        return {id_col: batch.column(id_col), "bytes": pa.array(found, pa.binary()),
                "text": pa.array([b.decode("utf-8", "replace") for b in found], pa.string())}

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_rows(encoded, [id_col, ids_col], f"{id_col} {kind}, bytes binary, text string", run)
