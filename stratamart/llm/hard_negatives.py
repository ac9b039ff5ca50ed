"""Hard negatives: per anchor and positive, the best rows of other labels whose score lies in a window below the positive's.

All vectors are whole numbers, a score is an exact inner product. Rows are dealt into blocks by a hash of their number and
anchors into groups, so that a cell (block, group) has a bounded size whatever key, label or vector is frequent; every
group meets every block once to find positives and once to find negatives.

Within a cell each anchor scans the block's columns in descending order of its own components' magnitude, ``SCAN``
columns at a time. What the columns not read yet can add lies between the sums of their smallest and largest
contributions, so a row's score is known to lie in an interval that narrows as columns are read. Rows that cannot matter
any more leave the candidate bitmap:

* positives: rows whose upper bound is below the k-th best lower bound;
* negatives: rows outside every window, or below the k-th best of the rows that are surely inside.

After the last column intervals are exact scores, and what is left is ranked.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part; ids may repeat, each
row counts on its own and only the anchor's own row is left out; equal scores go to the smaller id, null ids last; missing
components of shorter vectors count as zero; components are held to +-2^24, so that a score fits a long. Anchors without
positives, or positives without rows in their window, give no rows, as does an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

POSITIVES, NEGATIVES = 5, 3
# A negative's score is between 50 and 95 hundredths of the positive's.
WINDOW = (50, 95)
UNIT, LARGEST = 256, 1 << 24
BLOCK, GROUP = 4096, 16384  # rows of a block, anchors of a group
SCAN = 8
_LAST_ID = np.iinfo(np.int64).max


def whole_numbers(vector: Column, unit: int = UNIT) -> Column:
    """``floor(unit * x)`` of each component."""
    held = lambda x: F.least(F.greatest(x.cast("double") * unit, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))
    return F.transform(vector, lambda x: F.floor(held(x)).cast("int"))


def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``id``, ``label`` and ``vector`` of the rows that take part."""
    unfit = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return (rows.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).filter(~unfit)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                    whole_numbers(F.col(vector_col)).alias("vector")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row per component and a column per vector; short vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((width, len(column)), np.int64)
    owner = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[place, owner] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Block:
    """Vectors by column, with the smallest and largest value of each."""

    def __init__(self, columns: np.ndarray):
        self.columns = columns.astype(float)
        self.low, self.high = columns.min(1), columns.max(1)

    def scan(self, anchor: np.ndarray, alive: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Candidate places with lower and upper bounds of their scores, after each ``SCAN`` columns.

        ``alive`` holds the candidates' places; the caller sends those that stay. The last bounds are equal.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[:np.count_nonzero(anchor)]
        ends = np.stack([anchor[order] * self.low[order], anchor[order] * self.high[order]])
        least, most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in (ends.min(0), ends.max(0)))
        score = np.zeros(len(alive), np.int64)
        for first in range(0, max(len(order), 1), SCAN):
            columns = order[first:first + SCAN]
            # Whole numbers below 2^53, so sums in double are exact and run in the matrix library.
            score = score + (anchor[columns].astype(float) @ self.columns[np.ix_(columns, alive)]).astype(np.int64)
            read = min(first + SCAN, len(order))
            stay = yield alive, score + least[read], score + most[read]
            if stay is not None:
                alive, score = alive[stay], score[stay]


def _kth(values: np.ndarray, k: int) -> int | None:
    """The k-th largest, if there are so many."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def nearest(block: Block, ids: np.ndarray, anchor: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the best ``k`` candidates."""
    scan, stay = block.scan(anchor, alive), None
    while True:
        try:
            alive, lower, upper = scan.send(stay)
        except StopIteration:
            break
        worst = _kth(lower, k)
        stay = np.ones(len(alive), bool) if worst is None else upper >= worst
        alive, lower = alive[stay], lower[stay]
    best = _first(lower, ids[alive], k)
    return alive[best], lower[best]


def within(block: Block, ids: np.ndarray, anchor: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], k: int) -> list:
    """Per window: places and scores of the best ``k`` candidates inside it."""
    scan, stay = block.scan(anchor, alive), None
    while True:
        try:
            alive, lower, upper = scan.send(stay)
        except StopIteration:
            break
        stay = np.zeros(len(alive), bool)
        for low, high in windows:
            worst = _kth(lower[(lower >= low) & (upper <= high)], k)
            stay |= (upper >= (low if worst is None else worst)) & (lower <= high)
        alive, lower = alive[stay], lower[stay]
    found = []
    for low, high in windows:
        inside = np.flatnonzero((lower >= low) & (lower <= high))
        best = inside[_first(lower[inside], ids[alive[inside]], k)]
        found.append((alive[best], lower[best]))
    return found


def window(score: int) -> tuple[int, int] | None:
    """Smallest and largest allowed score of a negative, if any: WINDOW[0] s <= 100 x <= WINDOW[1] s."""
    low, high = -(-WINDOW[0] * score // 100), WINDOW[1] * score // 100
    return (low, high) if low <= high else None


def _cell(rows: pa.Table, anchors: pa.Table, width: int):
    """The block, its labels, ids (nulls last) and row numbers, and the anchors as Python rows with their vectors."""
    block = Block(_matrix(rows.column("vector"), width))
    ids = rows.column("id").fill_null(_LAST_ID).to_numpy()
    vectors = _matrix(anchors.column("vector"), width).T
    return block, rows.column("label").to_numpy(), ids, rows.column("row").to_numpy(), vectors


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, block_rows: int, group_rows: int):
    """Rows and anchors grouped by cell: each row is in one block, sent to every group; each anchor the other way round."""
    blocks, n_groups = max(1, -(-n_rows // block_rows)), max(1, -(-n_anchors // group_rows))
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = rows.withColumn("block", deal(blocks, 1)).withColumn("group", every(n_groups))
    right = anchors.withColumn("group", deal(n_groups, 2)).withColumn("block", every(blocks))
    right = right.select([F.col(c).alias(c) for c in right.columns])  # columns of its own: both sides come from the same table
    cell = ("block", "group")
    return left.groupBy(*cell).cogroup(right.groupBy(*cell))


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key by score and id, with their ``rank``. Spark keeps ``k`` per key and task before it shuffles."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("other"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, block_rows: int = BLOCK, group_rows: int = GROUP) -> DataFrame:
    """Per anchor, positive and rank: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``is_anchor`` is a condition on the column ``id``.
    """
    every = stage(usable(rows, id_col, label_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    marked = is_anchor & F.col("id").isNotNull()
    n_rows, n_anchors, width = every.agg(
        F.count(F.lit(1)), F.count_if(marked), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    anchors = every.filter(marked)
    shape = (n_rows, n_anchors, block_rows, group_rows)

    def own_label(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            block, labels, ids, numbers, vectors = _cell(left, right, width)
            members = {label: np.flatnonzero(labels == label) for label in np.unique(labels)}
            for row, label, vector in zip(right.column("row").to_pylist(), right.column("label").to_pylist(), vectors):
                alive = members.get(label, np.zeros(0, np.int64))
                places, scores = nearest(block, ids, vector, alive[numbers[alive] != row], positives)
                out += zip([row] * len(places), left.column("id").take(places).to_pylist(), scores.tolist())
        return pa.Table.from_pylist([dict(zip(("anchor", "other", "score"), r)) for r in out],
                                    pa.schema([("anchor", pa.int64()), ("other", pa.int64()), ("score", pa.int64())]))

    found = _met(every, anchors, *shape).applyInArrow(own_label, "anchor long, other long, score long")
    chosen = stage(_best(found, ["anchor"], positives), "negatives-positives")
    asked = (anchors.join(chosen.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_set("score")).alias("scores")), "row"))

    def other_labels(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            block, labels, ids, _, vectors = _cell(left, right, width)
            others = {label: np.flatnonzero(labels != label) for label in set(right.column("label").to_pylist())}
            for row, label, scores, vector in zip(right.column("row").to_pylist(), right.column("label").to_pylist(),
                                                  right.column("scores").to_pylist(), vectors):
                windows = {s: w for s in scores if (w := window(s))}
                if windows:
                    hits = within(block, ids, vector, others[label], list(windows.values()), negatives)
                    for asked_score, (places, got) in zip(windows, hits):
                        out += zip([row] * len(places), [asked_score] * len(places), left.column("id").take(places).to_pylist(), got.tolist())
        names = ("anchor", "positive_score", "other", "score")
        return pa.Table.from_pylist([dict(zip(names, r)) for r in out], pa.schema([(n, pa.int64()) for n in names]))

    found = _met(every, asked, *shape).applyInArrow(other_labels, "anchor long, positive_score long, other long, score long")
    ranked = _best(found, ["anchor", "positive_score"], negatives)
    named = chosen.select("anchor", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    at = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (ranked.join(named, ["anchor", "positive_score"]).join(at, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def shifted_labels(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", every: int = 7, labels: int = 10) -> DataFrame:
    """The rows with the next label where the id is divisible by ``every``."""
    label = F.col(label_col)
    return rows.withColumn(label_col, F.when(F.col(id_col) % every == 0, (label + 1) % labels).otherwise(label))
