"""SimHash near-duplicates with pigeonring filtering.

Fingerprints that differ in at most ``BITS`` = 2 bits are linked. The 64 bits form a ring of three segments.
By the pigeonring principle a linked pair has a segment from which every chain of consecutive segments keeps
within its share of the budget: none of the first, at most one in the first two, two in all three. The chain
of two is the join key: the first segment whole and one half of the next (one difference leaves one of two halves
equal). The chain's budget is checked before the full Hamming distance.

Only distinct fingerprints are joined, so exact copies cost one row. A key that more than ``PAIRED`` fingerprints
share is not paired up: each of its fingerprints is filed under itself and its one-bit neighbours outside the key.
Two fingerprints meet in such a file exactly if they differ in at most two bits, a file never holds more than
33 of them, and all in a file are linked, so a link to its smallest gives the same components.

Components come from smallest-label spreading with shortcuts; each round is a written table.

Defined results: a null text counts as empty; texts without words have fingerprint zero and are linked like any
other; repeated rows are rows of one group; rows with a null id are grouped too but cannot name a group (the
id is null if all are). An empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import map_rows, text_bytes, unused

BITS, SHINGLE, SEED = 2, 3, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
PAIRED = 64
_COUNT_STEP = 1 << 14  # shingles whose bits are spread out at a time


def _mask(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the shingles of ASCII-lower-cased words, repeats included."""
    import xxhash

    words = text.lower().split()  # on bytes: only A-Z change, only space and \x09-\x0D separate
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())),
                         np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), _COUNT_STEP):
        part = hashes[first:first + _COUNT_STEP]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``fp``, the fingerprint as a signed long."""
    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = text_bytes(batch.column(text_col))
        found = [_signed(fingerprint(data[a:b].tobytes())) for a, b in zip(offsets[:-1], offsets[1:])]
        return {id_col: batch.column(id_col), "fp": pa.array(found, pa.int64())}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, fp long", run)


def _halves(first: int, width: int) -> tuple[tuple[int, int], tuple[int, int]]:
    return (first, width // 2), (first + width // 2, width - width // 2)


def _chains():
    """Per key: its number, the mask of bits it fixes, and the mask of its chain of two segments."""
    for place, segment in enumerate(SEGMENTS):
        following = SEGMENTS[(place + 1) % len(SEGMENTS)]
        for side, half in enumerate(_halves(*following)):
            yield 2 * place + side, _mask(*segment) | _mask(*half), _mask(*segment) | _mask(*following)


def _keyed(distinct: DataFrame) -> DataFrame:
    """Each fingerprint once per key: ``key`` is a hash of the fixed bits, ``chain`` their number."""
    keys = [F.struct(F.lit(number).alias("chain"), F.col("fp").bitwiseAND(F.lit(_signed(fixed))).alias("key"))
            for number, fixed, _ in _chains()]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("_k")).select("fp", "_k.chain", "_k.key")


def _by_chain(values: dict[int, int]):
    """A long per chain number."""
    return F.element_at(F.array(*[F.lit(_signed(values[n])) for n in sorted(values)]), F.col("chain") + 1)


def links(distinct: DataFrame) -> DataFrame:
    """Linked fingerprints as (``low``, ``high``), enough of them to connect what is connected.

    ``distinct`` has distinct ``fp`` and should be a written table: it is read more than once.
    """
    keyed = _keyed(distinct)
    shared = stage(keyed.groupBy("chain", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-keys")
    filed = stage(keyed.join(shared, ["chain", "key"]), "simhash-filed")
    few = filed.filter(F.col("n") <= PAIRED).select("chain", "key", "fp")
    differing = F.col("fp").bitwiseXOR(F.col("other"))
    chain_of_two = _by_chain({number: chain for number, _, chain in _chains()})
    pairs = (
        few.join(few.withColumnRenamed("fp", "other"), ["chain", "key"]).filter(F.col("fp") < F.col("other"))
        .filter(F.bit_count(differing.bitwiseAND(chain_of_two)) <= 1)
        .filter(F.bit_count(differing) <= BITS)
        .select(F.col("fp").alias("low"), F.col("other").alias("high"))
    )
    free = F.bitwise_not(_by_chain({number: fixed for number, fixed, _ in _chains()}))
    flips = F.array(*[F.lit(_signed(1 << bit)) for bit in range(64)])
    near = F.concat(F.array(F.lit(0).cast("long")), F.filter(flips, lambda bit: bit.bitwiseAND(F.col("free")) != 0))
    files = (
        filed.filter(F.col("n") > PAIRED).withColumn("free", free)
        .select("chain", "key", "fp", F.explode(near).alias("flip"))
        .groupBy("chain", "key", F.col("fp").bitwiseXOR(F.col("flip")).alias("file"))
        .agg(F.sort_array(F.collect_set("fp")).alias("fps"))  # at most 33
        .filter(F.size("fps") > 1)
        .select(F.col("fps")[0].alias("low"), F.explode(F.slice("fps", 2, 64)).alias("high"))
    )
    return pairs.union(files).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``fp`` and ``root``, the smallest fingerprint that can be reached, for every fingerprint in ``edges``."""
    both = stage(edges.select(F.col("low").alias("a"), F.col("high").alias("b"))
                 .union(edges.select(F.col("high").alias("a"), F.col("low").alias("b"))), "simhash-edges")
    labels = stage(both.groupBy(F.col("a").alias("fp")).agg(F.min(F.least("a", "b")).alias("root")), "simhash-labels")
    while True:
        heard = both.join(labels, both["a"] == labels["fp"]).groupBy(F.col("b").alias("fp")).agg(F.min("root").alias("heard"))
        spread = stage(labels.join(heard, "fp").select("fp", F.least("root", "heard").alias("new"),
                                                       F.col("root").alias("old")), "simhash-spread")
        jump = spread.select(F.col("fp").alias("at"), F.col("new").alias("beyond"))
        moved = stage(spread.join(jump, F.col("new") == F.col("at")).select(
            "fp", F.least("new", "beyond").alias("root"), "old"), "simhash-labels")
        labels = moved.select("fp", "root")
        if moved.filter("root <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``fingerprint`` as 16 hex digits, and ``component_id``, the smallest id in its group."""
    found = stage(fingerprints(docs, id_col, text_col), "simhash")
    distinct = stage(found.groupBy("fp").agg(F.min(id_col).alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = stage(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-groups")
    groups = stage(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-components")
    return found.join(groups, "fp").select(
        F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group: that with the smallest id, all columns as they were.

    Of rows that repeat the kept id one stays. Rows with a null id cannot be told apart and all stay.
    """
    named = docs.filter(F.col(id_col).isNotNull())
    grouped = near_duplicates(named, id_col, text_col)
    first = unused(docs, "kept")
    kept = stage(grouped.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(first)), "simhash-kept")
    rows = named.join(kept, F.col(id_col) == F.col(first), "left_semi").dropDuplicates([id_col])
    return rows.unionByName(docs.filter(F.col(id_col).isNull()))
