"""Checksum trees, maintained views, bitmaps and validity intervals against plain recomputation."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.operators import bitmaps, changes, checksums, validity
from stratamart.operators.maintained import MaintainedView, signed
from stratamart.session import stage


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- checksum tree


def snapshot(spark, n=60_000):
    return stage(spark.range(n).select("id", (F.col("id") % 7).alias("kind"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("text")))


def test_one_changed_hundredth_moves_under_a_twentieth_of_the_rows(spark):
    prev = snapshot(spark)
    edited = F.col("id").between(30_000, 30_599)
    curr = stage(prev.where("id <> 30050").withColumn("kind", F.when(edited, F.lit(99).cast("long")).otherwise(F.col("kind"))))
    found = checksums.differing_rows(prev, curr, ["id"])
    checksum_rows = 2 * sum(compared for compared, _ in found.levels)
    assert found.prev.count() + found.curr.count() + checksum_rows < 0.05 * (prev.count() + curr.count())
    assert rows_of(checksums.changes_by_checksum(prev, curr, ["id"])) == rows_of(changes.table_changes(prev, curr, ["id"]))


@pytest.mark.parametrize("keys", [["id"], ["text"], ["kind", "id"]])
def test_scattered_changes_and_other_keys(spark, keys):
    prev = snapshot(spark, 4000).where("text is not null")
    curr = stage(prev.where("id % 97 <> 3").withColumn("kind", F.when(F.col("id") % 50 == 1, -F.col("kind")).otherwise(F.col("kind")))
                 if "kind" not in keys else prev.where("id % 97 <> 3").withColumn("text", F.when(F.col("id") % 50 == 1, "x").otherwise(F.col("text"))))
    assert rows_of(checksums.changes_by_checksum(prev, curr, keys, fanout=8)) == rows_of(changes.table_changes(prev, curr, keys))


def test_equal_and_empty_snapshots_null_keys_and_swapped_nulls(spark):
    one = spark.createDataFrame([(1, "a", None), (2, None, "a"), (None, "n", "n"), (5, "b", "b")], "id long, x string, y string")
    swapped = spark.createDataFrame([(1, None, "a"), (2, None, "a"), (5, "b", "b")], "id long, x string, y string")
    assert checksums.differing_rows(one.where("id is not null"), one.where("id is not null"), ["id"]).levels[-1][1] == 0
    assert rows_of(checksums.changes_by_checksum(one, swapped, ["id"])) == rows_of(changes.table_changes(one, swapped, ["id"]))
    nothing = one.limit(0)
    for prev, curr in ((one, nothing), (nothing, one), (nothing, nothing)):
        assert rows_of(checksums.changes_by_checksum(prev, curr, ["id"])) == rows_of(changes.table_changes(prev, curr, ["id"]))


def test_more_differing_ranges_than_may_be_broadcast(spark, monkeypatch):
    monkeypatch.setattr(checksums, "MOST_RANGES", 3)
    prev = snapshot(spark, 2000)
    curr = prev.withColumn("kind", F.col("kind") + 1)
    assert rows_of(checksums.changes_by_checksum(prev, curr, ["id"])) == rows_of(changes.table_changes(prev, curr, ["id"]))


# --- maintained view


VIEW = MaintainedView(("day", "shop"), {"total": "amount", "pieces": "n"}, {"buyers": "buyer", "goods": "good"})
SALE = "id long, day int, shop string, amount decimal(10,2), n long, buyer string, good long"


def sale(rng, key):
    amount = None if rng.random() < 0.2 else Decimal(rng.randrange(1000)) / 100
    return (key, rng.randrange(3), rng.choice([None, "a", "b"]), amount, rng.randrange(5), rng.choice([None, "u", "v", "w"]), rng.randrange(4))


def test_view_and_members_equal_recomputation_after_every_batch(spark):
    rng = random.Random(11)
    now = {k: sale(rng, k) for k in range(60)}
    frame = lambda: stage(spark.createDataFrame(list(now.values()), SALE))
    prev = frame()
    view, members = VIEW.build(prev)
    for step in range(3):
        for k in rng.sample(sorted(now), 15):
            del now[k]
        for k in rng.sample(sorted(now), 10) + list(range(100 * (step + 1), 100 * (step + 1) + 12)):
            now[k] = sale(rng, k)
        curr = frame()
        view, members = VIEW.apply(stage(view), {n: stage(m) for n, m in members.items()}, signed(changes.table_changes(prev, curr, ["id"])))
        want, want_members = VIEW.build(curr)
        assert rows_of(view.select(want.columns)) == rows_of(want)
        assert {n: rows_of(m) for n, m in members.items()} == {n: rows_of(m) for n, m in want_members.items()}
        prev = curr
    direct = prev.groupBy("day", "shop").agg(F.count("*"), F.sum("amount"), F.countDistinct("buyer"), F.countDistinct("good"))
    assert rows_of(view.select("day", "shop", "row_count", "total", "buyers", "goods")) == rows_of(direct)


def test_groups_without_rows_disappear(spark):
    prev = spark.createDataFrame([(1, 1, "a", Decimal(1), 1, "u", 1), (2, 2, "a", Decimal(1), 1, "u", 1)], SALE)
    view, members = VIEW.build(prev)
    left, kept = VIEW.apply(view, members, signed(changes.table_changes(prev, prev.where("id = 1"), ["id"])))
    assert [r["day"] for r in left.collect()] == [1] and kept["buyers"].count() == 1
    same, _ = VIEW.apply(view, members, signed(changes.table_changes(prev, prev, ["id"])))
    assert rows_of(same) == rows_of(view)


# --- bitmaps


def test_bitmaps_roll_up_to_exact_distinct_counts(spark):
    rows = stage(spark.range(40_000).select(
        (F.col("id") % 13).cast("int").alias("day"), F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(90_000))).alias("who")))
    days = stage(bitmaps.distinct_bitmaps(rows, ["day"], "who"))
    assert rows_of(bitmaps.distinct_counts(days, ["day"], "n")) == rows_of(rows.groupBy("day").agg(F.countDistinct("who")))
    weeks = bitmaps.roll_up(days, (F.col("day") / 7).cast("int").alias("week"))
    want = rows.groupBy((F.col("day") / 7).cast("int").alias("week")).agg(F.countDistinct("who"))
    assert rows_of(bitmaps.distinct_counts(weeks, ["week"], "n")) == rows_of(want)
    assert bitmaps.distinct_bitmaps(rows.limit(0), ["day"], "who").count() == 0


# --- validity


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def versions_and_facts():
    """Key 1 holds a third of everything; days repeat, attributes repeat, some keys have no version."""
    rng = random.Random(2)
    sent = [(1 if rng.random() < 0.33 else rng.randrange(2, 9), day(rng.randrange(200)), rng.choice(["x", "y", None]), arrival) for arrival in range(240)]
    facts = [(n, 1 if rng.random() < 0.33 else rng.randrange(2, 12), day(rng.randrange(-20, 220))) for n in range(400)]
    return sent, facts + [(900, None, day(3)), (901, 1, None)]


def plain_versions(sent):
    last = {}
    for key, start, tier, arrival in sent:
        if (key, start) not in last or arrival > last[key, start][1]:
            last[key, start] = tier, arrival
    return {k: sorted((start, tier) for (own, start), (tier, _) in last.items() if own == k) for k in {k for k, _ in last}}


def plain_intervals(by_key):
    out = []
    for key, line in by_key.items():
        opening = [v for n, v in enumerate(line) if n == 0 or line[n - 1][1] != v[1]]
        ends = [v[0] for v in opening[1:]] + [validity.OPEN_END]
        out += [(key, tier, start, end) for (start, tier), end in zip(opening, ends)]
    return out


def test_intervals_of_late_deliveries(spark):
    sent, _ = versions_and_facts()
    kind = "key long, valid_from date, tier string, arrival long"
    early, late = sent[::2], [s for s in sent[1::2] if s[0] in (1, 4)]
    unkeyed = [(None, day(1), "x", 999), (3, None, "x", 999)]
    first = stage(validity.merge_versions(None, spark.createDataFrame(early + unkeyed, kind), "key", "arrival"))
    both = stage(validity.merge_versions(first, spark.createDataFrame(late, kind), "key", "arrival"))
    stored = stage(validity.intervals(first, "key", ["tier"]))
    assert rows_of(stored) == sorted(plain_intervals(plain_versions(early)), key=str)
    refreshed = validity.refresh_intervals(stored, both, spark.createDataFrame(late, kind), "key", ["tier"])
    want = sorted(plain_intervals(plain_versions(early + late)), key=str)
    assert rows_of(refreshed) == rows_of(validity.intervals(both, "key", ["tier"])) == want
    assert validity.intervals(both.limit(0), "key", ["tier"]).count() == 0


def test_facts_meet_the_version_of_their_day(spark):
    sent, facts = versions_and_facts()
    versions = validity.merge_versions(None, spark.createDataFrame(sent, "key long, valid_from date, tier string, arrival long"), "key", "arrival")
    rows = spark.createDataFrame(facts, "n long, key long, at date")
    by_key = plain_versions(sent)
    want = []
    for n, key, at in facts:
        valid = [v for v in by_key.get(key, []) if at is not None and v[0] <= at]
        want.append((n, key, at, *((valid[-1][1], valid[-1][0]) if valid else (None, None))))
    assert rows_of(validity.as_of_join(rows, versions, "key", "at", ["tier"])) == sorted(want, key=str)
    assert {w[3:] for w in want if w[1] == 1} > {(None, None)}
    assert validity.as_of_join(rows.limit(0), versions, "key", "at", ["tier"]).count() == 0
    assert validity.as_of_join(rows, versions.limit(0), "key", "at", ["tier"]).where("valid_from is null").count() == len(facts)


def test_a_hot_key_is_dealt_out_by_time(spark):
    """One key, facts over two years, versions that hold for many months without a row of their own."""
    facts = spark.range(7300).selectExpr("id as n", "1L as key", "date_add(date'2022-01-01', cast(id % 730 as int)) as at")
    versions = spark.createDataFrame([(1, dt.date(2021, 6, 1), "a"), (1, dt.date(2022, 12, 15), "b")], "key long, valid_from date, tier string")
    got = validity.as_of_join(facts, versions, "key", "at", ["tier"])
    assert rows_of(got.groupBy("tier").count()) == [("a", 348 * 10), ("b", 382 * 10)]
