"""Near copies by resemblance: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8; on request
also by SimHash, in one grouping: fingerprints that differ in at most two bits, found by pigeonring chains as op3 does
(``simhash.links``). A chain of links of both kinds connects.

Candidates of the first kind share a band of min-hashes: ``BANDS`` keys of ``ROWS`` minima each, so a pair at exactly 0.8 is in no common
band with probability (1 - 0.8 ** 5) ** 24 = 7e-5 and a nearer one less often. SimHash alone does not find them: at
0.8 about ten bits differ, and ring keys for such a radius select nothing.

Only distinct texts are compared, and the number of comparisons grows with the texts, not with the pairs of a band:

* Each text meets the centre of its band: the text whose keys are shared most often. Edits of one text meet that text.
* The texts of a band are sorted by the minima that follow the band's, so that texts alike stand together, and each
  meets the next ``NEXT``. Bands of up to ``NEXT + 1`` texts are so compared in full, with any edits.

* In a larger band each text that is not connected to most of the band by then meets all texts of other groups there, block
  by block, so no pair of a band is left out, whatever the band's size. What such a block finds are links between groups,
  at most one fewer than it holds groups; the pairs themselves never become rows. This part is quadratic in texts that share a
  band and do not resemble each other.

Pairs are first checked by the sizes of their sets (which loses nothing) and by the minima that agree (a pair at 0.8 fails with probability 2e-4), then on
the whole sets (64-bit hashes of the shingles), so nothing below the threshold is linked. Texts that are connected already
are not compared again: centres and SimHash come first, then each text's next one in its bands, which connects most of a large
group, and only then the next ``NEXT``. Between these rounds a group is drawn together into one node, so the links that are
followed stay a few a text, however large the group.

Defined results: a null text counts as empty; texts without words are copies of each other, texts of fewer than five
words have all of them as their one shingle; of a group's rows that with the smallest id stays, rows that repeat an id and
its text count once; equally central texts are settled by a number given once; an empty table gives no rows. Words are
ASCII-lower-cased as in op3.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from . import simhash
from .common import groups, map_rows, text_bytes, unused

SHINGLE, SEED = 5, 42
LEAST = (4, 5)  # similarity, as a fraction
BANDS, ROWS = 24, 5
NEXT, ORDER = 24, 24  # neighbours a text meets in a band, minima that a band is sorted by
ROUNDS = (1, NEXT)  # neighbours met in each round
BLOCK, HASHES = 512, 1 << 19  # texts, and hashes of their sets, that a block of a band holds on average at most
ALIKE = 80  # of BANDS * ROWS minima that have to agree
_rng = np.random.default_rng(SEED)
_TURN, _FACTOR = (_rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64) for _ in range(2))
_FACTOR |= np.uint64(1)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the shingles, repeats included; at least one."""
    import xxhash

    words = text.lower().split() or [b""]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    found = np.zeros(len(words) - size + 1, np.uint64)
    for place in range(size):
        found = found * _STEP + hashes[place:place + len(found)]
    return _mixed(found)


def band_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``BANDS`` signed keys per text, and a row with a byte of each of its minima."""
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    keys, signs = np.empty((len(sets), BANDS), np.uint64), np.empty((len(sets), BANDS * ROWS), np.uint8)
    for band in range(BANDS):
        key = np.full(len(sets), band, np.uint64)
        for row in range(band * ROWS, (band + 1) * ROWS):
            least = np.minimum.reduceat((every ^ _TURN[row]) * _FACTOR[row], starts)
            key = _mixed(key * _STEP + least)
            signs[:, row] = _mixed(least) >> np.uint64(56)
        keys[:, band] = key
    return keys.view(np.int64), signs


def _digest(text_col: str):
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def _keyed(docs: DataFrame, id_col: str, text_col: str, marked: bool) -> DataFrame:
    """Per row: ``id``, ``same`` (a digest of the text), the band ``keys``, ``signs`` (bytes of the minima), ``size`` of the set and
    if ``marked`` ``mark``, op3's fingerprint."""
    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = text_bytes(batch.column("text"))
        marks = [simhash._signed(simhash.fingerprint(data[a:b].tobytes())) for a, b in zip(offsets[:-1], offsets[1:])
                 ] if marked else [None] * batch.num_rows
        keys, signs, sizes = [], [], []
        for first, last in groups(offsets):
            sets = [shingles(data[a:b].tobytes()) for a, b in zip(offsets[first:last], offsets[first + 1:last + 1])]
            part = band_keys(sets)
            keys.append(part[0])
            signs += [row.tobytes() for row in part[1]]
            sizes += [len(np.unique(found)) for found in sets]
        flat = pa.array(np.concatenate(keys).ravel(), pa.int64())
        ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS)
        return {"id": batch.column("id"), "same": batch.column("same"), "keys": pa.ListArray.from_arrays(ends, flat),
                "signs": pa.array(signs, pa.binary()), "size": pa.array(sizes, pa.int32()), "mark": pa.array(marks, pa.int64())}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), _digest(text_col).alias("same"), F.col(text_col).alias("text"))
    return map_rows(rows, ["id", "same", "text"], f"id {kind}, same string, keys array<long>, signs binary, size int, mark long", run)


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``fp`` and ``hashes``, the distinct shingle hashes of its text. Texts are found by their smallest id."""
    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = text_bytes(batch.column("text"))
        found = [np.unique(shingles(data[a:b].tobytes())).view(np.int64) for a, b in zip(offsets[:-1], offsets[1:])]
        return {"fp": batch.column("fp"), "hashes": pa.array(found, pa.list_(pa.int64()))}

    rows = docs.select(F.col(id_col).alias("first"), _digest(text_col).alias("same"), F.col(text_col).alias("text"))
    chosen = rows.join(nodes, ["first", "same"]).dropDuplicates(["first", "same"])
    return map_rows(chosen, ["fp", "text"], "fp long, hashes array<long>", run)


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``low``, ``high``) that are similar enough."""
    low, high = (sets.select(F.col("fp").alias(name), F.col("hashes").alias(f"{name}_set")) for name in ("low", "high"))
    common = F.size(F.array_intersect("low_set", "high_set"))
    counted = pairs.join(low, "low").join(high, "high").select(
        *pairs.columns, common.alias("common"), (F.size("low_set") + F.size("high_set")).alias("both"))
    part, whole = LEAST
    return counted.filter(F.col("common") * whole >= (F.col("both") - F.col("common")) * part).select(*pairs.columns)


def _matching(low: np.ndarray, high: np.ndarray, low_size: np.ndarray, high_size: np.ndarray) -> np.ndarray:
    """Mask of the pairs whose sets can be similar enough by their sizes, and are by their minima."""
    part, whole = LEAST
    good = np.minimum(low_size, high_size) * whole >= np.maximum(low_size, high_size) * part
    good[good] = (low[good] == high[good]).sum(1) >= ALIKE
    return good


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


_ENDS = ("low", "high", "one", "two")


def _pair(one: str, other: str, names: tuple[str, ...] = _ENDS[:2]) -> list:
    return [F.least(one, other).alias(names[0]), F.greatest(one, other).alias(names[1])]


def _alike(pairs: DataFrame, *also: str) -> DataFrame:
    """Of rows with two texts (``fp``, ``other``), their sizes and signs, the pairs that match, once each; ``also`` are longs
    to keep."""
    def run(batch: pa.RecordBatch) -> dict:
        sizes = [batch.column(n).to_numpy() for n in ("size", "other_size")]
        good = batch.filter(pa.array(_matching(_signs(batch.column("signs")), _signs(batch.column("other_signs")), *sizes)))
        return {n: good.column(n) for n in ("fp", "other", *also)}

    names = ["fp", "other", "size", "other_size", "signs", "other_signs", *also]
    return map_rows(pairs.filter("fp <> other"), names, ", ".join(f"{n} long" for n in ("fp", "other", *also)), run).distinct()


def _central(filed: DataFrame) -> DataFrame:
    """Each text of a large band (``fp``) with the band's centre (``other``)."""
    large = filed.filter(F.col("n") > NEXT + 1)
    centres = (large.groupBy("key").agg(F.max(F.struct("weight", "fp", "size", "signs")).alias("centre"))
               .select("key", *(F.col(f"centre.{a}").alias(b) for a, b in
                                (("fp", "other"), ("size", "other_size"), ("signs", "other_signs")))))
    return _alike(large.join(centres, "key"))


def _neighbours(filed: DataFrame, reach: int) -> DataFrame:
    """Each text of a band with the next ``reach`` in the band's order, if they match and have no ``leader`` in common, and
    the leaders of both (``one``, ``two``).

    The order is dealt out by ranges, so a band that holds a large share of the texts lies in several slices. The first
    and last rows of each slice are brought together afterwards; they are ``2 * reach`` rows a slice at most.
    """
    columns = ("key", "fp", "size", "leader", "signs")

    def run(batches):
        part, place, before = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.select(columns)
            if place < reach:
                yield edges(rows.slice(0, reach - place), part, place)
            place += rows.num_rows
            line = pa.Table.from_batches([before, rows] if before else [rows]).combine_chunks().to_batches()[0]
            yield pairs(line, line.num_rows - rows.num_rows)
            before = line.slice(max(line.num_rows - reach, 0))
        if before:  # but those that were among the first
            start = place - before.num_rows
            known = max(reach - start, 0)
            yield edges(before.slice(known), part, start + known)

    def pairs(line: pa.RecordBatch, known: int) -> pa.RecordBatch:
        key, fp, size, leader = (line.column(n).to_numpy() for n in columns[:4])
        signs, met = _signs(line.column("signs")), []
        for step in range(1, reach + 1):
            later = np.arange(max(known, step), len(key))
            later = later[(key[later] == key[later - step]) & (leader[later] != leader[later - step])]
            later = later[_matching(signs[later - step], signs[later], size[later - step], size[later])]
            met.append(np.stack([fp[later - step], fp[later], leader[later - step], leader[later]]))
        found = np.concatenate(met, 1)
        ends = np.concatenate([np.sort(found[:2], 0), np.sort(found[2:], 0)])
        found = np.unique(ends, axis=1)
        return answer(found.shape[1], {name: pa.array(column) for name, column in zip(_ENDS, found)})

    def edges(rows: pa.RecordBatch, part: int, place: int) -> pa.RecordBatch:
        return answer(rows.num_rows, {n: rows.column(n) for n in columns} | {
            "slice": pa.array(np.full(rows.num_rows, part, np.int32)), "place": pa.array(np.arange(rows.num_rows) + place)})

    def answer(n: int, values: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    schema = pa.schema([*((name, pa.int64()) for name in _ENDS), ("key", pa.int64()), ("fp", pa.int64()), ("size", pa.int32()),
                        ("leader", pa.int64()), ("signs", pa.binary()), ("slice", pa.int32()), ("place", pa.int64())])
    order = ["key", "order", "fp"]
    slices = int(filed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    following = F.substring(F.concat("signs", "signs"), F.lit(ROWS + 1) + ROWS * F.col("band"), F.lit(ORDER))
    found = stage(filed.withColumn("order", following).repartitionByRange(slices, *order).sortWithinPartitions(*order).mapInArrow(
        run, "low long, high long, one long, two long, key long, fp long, size int, leader long, signs binary, slice int, place long"), "copies-neighbours")
    line = Window.partitionBy("key").orderBy("slice", "place")
    edge = found.filter("fp is not null")
    across = [edge.select(*columns[1:], *(F.lead(n, step).over(line).alias(f"other{rest}") for n, rest in
                                          (("fp", ""), ("size", "_size"), ("leader", "_leader"), ("signs", "_signs"))))
              .filter("other is not null and leader <> other_leader")
              for step in range(1, reach + 1)]
    edges = _alike(reduce(DataFrame.union, across), "leader", "other_leader").select(*_pair("fp", "other"), *_pair("leader", "other_leader", _ENDS[2:]))
    return found.filter("fp is null").select(*_ENDS).union(edges).distinct()


def _blocks(led: DataFrame, sets: DataFrame) -> DataFrame | None:
    """The texts of large bands that hold more than one group: those outside the band's largest group (``left``) and all of
    them, so dealt to blocks (``key``, ``row``, ``column``) that each of the first meets each of the second once; None if
    there is no such band."""
    large = led.filter(F.col("n") > NEXT + 1)
    sizes = large.groupBy("key", "leader").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("hashes"))
    bands = sizes.groupBy("key").agg(F.max(F.struct("m", "hashes", "leader")).alias("main"), F.sum("m").alias("texts"),
                                     F.sum("hashes").alias("every"), F.count(F.lit(1)).alias("leaders")).filter("leaders > 1")
    count = lambda texts, hashes: F.ceil(F.greatest(texts / BLOCK, hashes / HASHES, F.lit(1.0))).cast("int")
    bands = stage(bands.select("key", F.col("main.leader").alias("main"),
                               count(F.col("texts") - F.col("main.m"), F.col("every") - F.col("main.hashes")).alias("rows"),
                               count(F.col("texts"), F.col("every")).alias("columns")), "copies-bands")
    if bands.isEmpty():
        return None
    placed = large.join(bands, "key").join(sets, "fp")
    place = lambda seed, blocks: F.pmod(F.xxhash64("fp", F.lit(seed)), F.col(blocks)).cast("int")
    upto = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    kept = ("key", "band", "leader", "size", "signs", "hashes")
    return placed.filter("leader <> main").select(
        *kept, F.lit(True).alias("left"), place(1, "rows").alias("row"), upto("columns").alias("column")).unionByName(
        placed.select(*kept, F.lit(False).alias("left"), upto("rows").alias("row"), place(2, "columns").alias("column")))


def _across(block: pa.Table) -> pa.Table:
    """Links (``low``, ``high``) that connect the groups of a block whose texts are similar enough."""
    block = block.combine_chunks()
    left = block.column("left").to_numpy()
    leader, size, band = (block.column(n).to_numpy() for n in ("leader", "size", "band"))
    signs = _signs(block.column("signs"))
    lists = block.column("hashes").combine_chunks()
    ends = lists.offsets.to_numpy()
    codes = np.unique(lists.values.to_numpy(), return_inverse=True)[1]
    rights, found = np.flatnonzero(~left), []
    root, held = np.unique(leader, return_inverse=True)[1], np.zeros(codes.max() + 1, bool)
    part, whole = LEAST
    for one in np.flatnonzero(left):
        met = rights[root[rights] != root[one]]
        if not len(met):
            continue
        met = met[np.minimum(size[met], size[one]) * whole >= np.maximum(size[met], size[one]) * part]
        alike = signs[met] == signs[one]
        good = alike.sum(1) >= ALIKE
        # Of the bands that two texts share only the first compares them.
        met, alike = met[good], alike[good].reshape(-1, BANDS, ROWS).all(2)
        met = met[alike.argmax(1) == band[one]]
        if not len(met):
            continue
        own = codes[ends[one]:ends[one + 1]]
        held[own] = True
        starts = np.concatenate([[0], np.cumsum(ends[met + 1] - ends[met])[:-1]])
        common = np.add.reduceat(held[np.concatenate([codes[ends[other]:ends[other + 1]] for other in met])], starts, dtype=np.int64)
        held[own] = False
        for other in met[common * whole >= (size[one] + size[met] - common) * part]:
            if root[other] != root[one]:
                found.append(sorted((leader[one], leader[other])))
                root[root == root[other]] = root[one]
    low, high = np.array(found, np.int64).reshape(-1, 2).T
    return pa.table({"low": low, "high": high})


def _same_marks(distinct: DataFrame) -> DataFrame:
    """Texts (``fp``) whose fingerprints are linked, each as a pair with the smallest of its group."""
    marks = stage(distinct.groupBy("mark").agg(F.min("fp").alias("first_fp")), "copies-marks")
    roots = simhash.components(simhash.links(marks.select(F.col("mark").alias("fp")))).withColumnRenamed("fp", "linked")
    rooted = marks.join(roots, F.col("mark") == F.col("linked"), "left").select(
        "mark", "first_fp", F.coalesce("root", "mark").alias("group"))
    smallest = rooted.groupBy("group").agg(F.min("first_fp").alias("low"))
    low = stage(rooted.join(smallest, "group").select("mark", "low"), "copies-marked")
    return distinct.select("fp", "mark").join(low, "mark").filter("low <> fp").select("low", F.col("fp").alias("high"))


def _joined(roots: DataFrame, groups_of: DataFrame) -> DataFrame:
    """``fp`` and ``root`` of texts in a group after groups (``fp``, by their smallest) were joined; a text alone is its own group."""
    inner = groups_of.select(F.col("fp").alias("old"), F.col("root").alias("new"))
    kept = roots.join(inner, F.col("root") == F.col("old"), "left").select("fp", F.coalesce("new", "root").alias("root"))
    return stage(kept.union(groups_of.join(roots, "fp", "left_anti").select("fp", "root")), "copies-roots")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_simhash: bool = False) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, all columns as they were.

    With ``by_simhash`` op3's links connect texts too. Rows with a null id cannot be told apart and all stay.
    """
    named = docs.filter(F.col(id_col).isNotNull())
    found = stage(_keyed(named, id_col, text_col, by_simhash), "copies")
    distinct = stage(found.groupBy("same").agg(F.min("id").alias("first"), *(F.first(c).alias(c) for c in ("keys", "signs", "size", "mark")))
                     .withColumn("fp", F.monotonically_increasing_id()), "copies-distinct")
    keyed = distinct.select("fp", F.posexplode("keys").alias("band", "key"))
    shared = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "copies-keys")
    # At most BANDS keys a text.
    placed = keyed.join(shared, "key").groupBy("fp").agg(F.sum("n").alias("weight"), F.collect_list(F.struct("band", "key", "n")).alias("at"))
    nodes = stage(distinct.drop("keys", "mark").join(placed, "fp"), "copies-nodes")
    sets = stage(_sets(named, nodes.select("fp", "first", "same"), id_col, text_col), "copies-sets")
    filed = nodes.select("fp", "size", "signs", "weight", F.inline("at"))
    linked = _near(stage(_central(filed).select(*_pair("fp", "other")), "copies-central"), sets)
    roots = simhash.components(linked.union(_same_marks(distinct)) if by_simhash else linked)
    for reach in ROUNDS:
        led = nodes.join(roots, "fp", "left").select("fp", "size", "signs", F.coalesce("root", "fp").alias("leader"), F.inline("at"))
        met = stage(_neighbours(led, reach), "copies-near-by")
        groups_met = stage(_near(met, sets).select(F.col("one").alias("low"), F.col("two").alias("high")).distinct(), "copies-near")
        roots = _joined(roots, simhash.components(groups_met))
    led = nodes.join(roots, "fp", "left").select("fp", "size", "signs", F.coalesce("root", "fp").alias("leader"), F.inline("at"))
    blocks = _blocks(led, sets)
    if blocks is not None:
        across = stage(blocks.groupBy("key", "row", "column").applyInArrow(_across, "low long, high long").distinct(), "copies-across")
        roots = _joined(roots, simhash.components(across))
    rooted = distinct.join(roots, "fp", "left").select(F.coalesce("root", "fp").alias("root"), "first", "same")
    key, digest, mark = (unused(docs, name) for name in ("kept", "same", "mark"))
    kept = stage(rooted.groupBy("root").agg(F.min(F.struct("first", "same")).alias("at"))
                 .select(F.col("at.first").alias(key), F.col("at.same").alias(digest)), "copies-kept")
    marked = named.withColumn(mark, _digest(text_col))
    rows = marked.join(kept, (F.col(id_col) == F.col(key)) & (F.col(mark) == F.col(digest)), "left_semi")
    return rows.dropDuplicates([id_col, mark]).drop(mark).unionByName(docs.filter(F.col(id_col).isNull()))
