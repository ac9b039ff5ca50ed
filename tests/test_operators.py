import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from stratamart.operators import changes, merge, ranking
from stratamart.operators.merge import latest_by_key, merge_into_path, merge_upsert, read_table
from stratamart.operators.ordering import asc, desc
from stratamart.operators.scd2 import OPEN_END, scd2
from stratamart.session import stage

DAY = dt.date(2025, 3, 15)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --- merge -------------------------------------------------------------------------------------

SCHEMA = "id string, name string, price int, seq int"


def test_merge_updates_inserts_and_keeps(spark, rows):
    target = frame(spark, [("a", "A", 1, 0), ("b", "B", 2, 0)], SCHEMA)
    source = frame(spark, [("b", "new", 9, 1), ("c", "C", 3, 1), ("c", "late", 4, 2), (None, "x", 0, 1)], SCHEMA)
    merged = merge_upsert(target, source, ["id"], ["price"], order_by=["seq"], with_action=True)
    assert rows(merged) == [("a", "A", 1, 0, "kept"), ("b", "B", 9, 0, "updated"), ("c", "late", 4, 2, "inserted")]


def test_merge_can_set_null(spark, rows):
    target = frame(spark, [("a", "A", 1, 0)], SCHEMA)
    source = frame(spark, [("a", None, None, 1)], SCHEMA)
    assert rows(merge_upsert(target, source, ["id"], ["name", "price"])) == [("a", None, None, 0)]


def test_merge_is_idempotent(spark, rows):
    rng = random.Random(5)
    target = frame(spark, [(f"k{i}", "t", i, 0) for i in range(50)], SCHEMA)
    source = frame(spark, [(f"k{rng.randrange(80)}", "s", i, i) for i in range(60)], SCHEMA)
    once = merge_upsert(target, source, ["id"], ["name", "price"], order_by=["seq"])
    twice = merge_upsert(once, source, ["id"], ["name", "price"], order_by=["seq"])
    assert rows(once) == rows(twice)
    assert once.select("id").distinct().count() == once.count()


def test_latest_by_key_keeps_one_row_of_a_hot_key(spark, rows):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    latest = latest_by_key(hot, ["k"], ["id"])
    assert latest.count() == 20_001
    assert latest.where("k = 'hot'").first()["id"] == 29_997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_merge_into_path(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    stamp = {"ts": F.lit("one")}
    first = frame(spark, [(f"k{i}", "t", i, 0) for i in range(40)], SCHEMA)
    counts = merge_into_path(path, first, ["id"], ["price"], on_insert=stamp, surrogate="sk")
    assert (counts.inserted, counts.updated) == (40, 0)
    second = frame(spark, [("k1", "s", 100, 1), ("k1", "s", 101, 2), ("n1", "s", 7, 1)], SCHEMA)
    for expected in ((1, 1), (0, 2)):
        counts = merge_into_path(path, second, ["id"], ["price"], on_update={"ts": F.lit("two")},
                                 on_insert=stamp, order_by=["seq"], surrogate="sk")
        assert (counts.inserted, counts.updated) == expected
    table = read_table(spark, path)
    assert table.count() == 41
    assert table.select("sk").distinct().count() == 41
    assert rows(table.where("id in ('k1', 'n1', 'k2')"), "id", "name", "price", "ts") == [
        ("k1", "t", 101, "two"), ("k2", "t", 2, "one"), ("n1", "s", 7, "two")]


def test_insert_only_merge_appends(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "o string, line int, v int"
    merge_into_path(path, frame(spark, [("a", 1, 1), ("a", 2, 2)], schema), ["o", "line"], [], surrogate="sk")
    again = frame(spark, [("a", 2, 99), ("b", 1, 3)], schema)
    assert merge_into_path(path, again, ["o", "line"], [], surrogate="sk").inserted == 1
    assert merge_into_path(path, again, ["o", "line"], [], surrogate="sk").inserted == 0
    table = read_table(spark, path)
    assert rows(table, "o", "line", "v") == [("a", 1, 1), ("a", 2, 2), ("b", 1, 3)]
    assert table.select("sk").distinct().count() == 3


def test_source_keys_take_the_tables_types(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_path(path, frame(spark, [(i, i) for i in range(20)], "id long, v int"), ["id"], ["v"])
    again = frame(spark, [("3", 100), ("7", 100), ("50", 100), ("x", 1)], "id string, v int")
    counts = merge_into_path(path, again, ["id"], ["v"])
    assert (counts.inserted, counts.updated, counts.unkeyed) == (1, 2, 1)
    table = read_table(spark, path)
    assert sorted(tuple(r) for r in table.collect()) == sorted(
        [(i, 100 if i in (3, 7) else i) for i in range(20)] + [(50, 100)])
    assert dict(table.dtypes)["id"] == "bigint"


def test_keys_are_the_tables_own(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_in = frame(spark, [(i, i) for i in range(20)], "id long, v int")
    merge_into_path(path, rows_in, ["id"], ["v"])
    counts = merge_into_path(path, frame(spark, [(i, -1) for i in range(15, 22)], "id long, v int"), ["id"], ["v"])
    assert (counts.inserted, counts.updated) == (2, 5)
    table = read_table(spark, path)
    assert table.count() == table.select("id").distinct().count() == 22
    with pytest.raises(ValueError, match="no key columns"):
        merge_into_path(path, rows_in.withColumnRenamed("id", "other"), ["other"], [])


def test_a_merge_that_fails_leaves_the_table_and_can_be_repeated(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    merge_into_path(path, frame(spark, [(i, i) for i in range(20)], "id long, v int"), ["id"], ["v"])
    before = rows(read_table(spark, path))
    second = frame(spark, [(i, -1) for i in range(10, 30)] + [(None, 7)], "id long, v int")
    broken = F.when(F.col("v") >= 15, F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        merge_into_path(path, second, ["id"], ["v"], on_update={"v": broken})
    assert rows(read_table(spark, path)) == before
    for _ in range(2):
        counts = merge_into_path(path, second, ["id"], ["v"])
    assert (counts.inserted, counts.updated, counts.unkeyed) == (0, 20, 1)
    assert rows(read_table(spark, path)) == sorted(
        [(i, i if i < 10 else -1) for i in range(30)], key=lambda r: tuple((False, str(v)) for v in r))


def test_old_runs_go_and_additions_stay(spark, tmp_path):
    path = tmp_path / "t"
    for i in range(3):
        merge_into_path(str(path), frame(spark, [(i, i), (99, i)], "id long, v int"), ["id"], ["v"], surrogate="sk")
    assert sorted(p.name for p in path.glob("*-*")) == ["full-00000002", "full-00000003"]
    for i in (5, 6):
        merge_into_path(str(path), frame(spark, [(i, i), (99, -1)], "id long, v int"), ["id"], [], surrogate="sk")
    table = read_table(spark, str(path))
    assert {tuple(r) for r in table.select("id", "v").collect()} == {(0, 0), (1, 1), (2, 2), (5, 5), (6, 6), (99, 2)}
    assert table.select("sk").distinct().count() == 6
    assert sorted(p.name for p in path.glob("*-*")) == [
        "add-00000004", "add-00000005", "full-00000002", "full-00000003"]


def test_rows_without_key_are_kept_aside(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "id string, v int, seq int"
    first = frame(spark, [("a", 1, 1), (None, 2, 1), (None, 3, 2), ("a", 4, 2)], schema)
    counts = merge_into_path(path, first, ["id"], ["v"], order_by=["seq"], surrogate="sk")
    assert (counts.inserted, counts.unkeyed) == (1, 2)
    assert rows(read_table(spark, path), "id", "v") == [("a", 4)]
    assert rows(spark.read.parquet(f"{path}/unkeyed"), "id", "v") == [(None, 2), (None, 3)]
    assert merge_into_path(path, first.limit(0), ["id"], ["v"], surrogate="sk").inserted == 0


# --- change capture ----------------------------------------------------------------------------


def test_changes_applied_to_old_give_new(spark, rows):
    rng = random.Random(3)
    schema = "id int, a string, b double"
    value = lambda: rng.choice([None, "x", "y"])
    prev = frame(spark, [(i, value(), rng.choice([None, 1.0])) for i in range(60)], schema)
    curr = frame(spark, [(i, value(), rng.choice([None, 1.0])) for i in range(20, 90)], schema)
    diff = changes.table_changes(prev, curr, ["id"])
    deleted = diff.where("_change_type = 'DELETE'").select("id")
    applied = prev.join(deleted, "id", "left_anti").unionByName(changes.inserted_rows(diff))
    assert rows(applied) == rows(curr)
    assert changes.table_changes(curr, curr, ["id"]).count() == 0


def test_update_is_a_flagged_pair_and_variants_compare(spark, rows):
    build = lambda data: frame(spark, data, "id int, j string").select(
        "id", F.parse_json("j").alias("doc"))
    prev, curr = build([(1, '{"a":1}'), (2, '{"a":1}')]), build([(1, '{"a":2}'), (2, '{"a": 1}')])
    diff = changes.table_changes(prev, curr, ["id"])
    got = rows(diff.select("id", "_change_type", "_is_update", F.to_json("doc")))
    assert got == [(1, "DELETE", True, '{"a":1}'), (1, "INSERT", True, '{"a":2}')]


# --- history -----------------------------------------------------------------------------------


def test_scd2(spark, rows):
    columns = "id string, v string, effective_date date, expiration_date date, is_current boolean"
    start = dt.date(2025, 1, 1)
    dim = frame(spark, [
        ("a", "1", start, OPEN_END, True), ("b", "1", start, OPEN_END, True), ("c", "1", start, OPEN_END, True),
        ("b", "0", dt.date(2024, 1, 1), dt.date(2024, 12, 31), False)], columns)
    source = frame(spark, [("a", "1"), ("b", "2"), ("d", None)], "id string, v string")
    after = scd2(dim, source, "id", ["v"], DAY)
    assert rows(after) == [
        ("a", "1", start, OPEN_END, True),
        ("b", "0", dt.date(2024, 1, 1), dt.date(2024, 12, 31), False),
        ("b", "1", start, dt.date(2025, 3, 14), False), ("b", "2", DAY, OPEN_END, True),
        ("c", "1", start, OPEN_END, True), ("d", None, DAY, OPEN_END, True)]
    # A second change on the same day replaces the version opened that day; a repeat changes nothing.
    again = scd2(after, frame(spark, [("b", "3")], "id string, v string"), "id", ["v"], DAY)
    assert rows(again.where("id = 'b' and is_current")) == [("b", "3", DAY, OPEN_END, True)]
    assert again.count() == after.count()
    assert rows(scd2(after, source, "id", ["v"], DAY)) == rows(after)


# --- global order ------------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the rows share one value, some are NULL."""
    rng = random.Random(11)
    data = [(i, rng.choice("ab"), None if i % 17 == 0 else (5 if i % 3 == 0 else rng.randrange(40)))
            for i in range(900)]
    return frame(spark, data, "id int, g string, v int")


@pytest.mark.parametrize("key", [asc("v"), desc("v")])
@pytest.mark.parametrize("within", [(), ("g",)])
def test_rank_equals_plain_window(skewed, rows, key, within):
    window = Window.partitionBy(*within).orderBy(key.column())
    expected = skewed.withColumn("r", F.rank().over(window).cast("long"))
    assert rows(ranking.global_rank(skewed, [key], "r", within)) == rows(expected)
    both = ranking.global_ranks(skewed, [key], {"r": within, "whole": ()})
    assert rows(both.drop("whole")) == rows(expected)


@pytest.mark.parametrize("keys", [[asc("v"), asc("id")], [desc("v"), asc("id")]])
@pytest.mark.parametrize("k", [1, 5, 7])
def test_ntile_equals_plain_window(skewed, rows, keys, k):
    window = Window.orderBy(*(x.column() for x in keys))
    expected = skewed.withColumn("t", F.ntile(k).over(window).cast("long"))
    assert rows(ranking.global_ntile(skewed, k, keys, "t")) == rows(expected)


@pytest.mark.parametrize("key, descending", [("n", False), ("n", True), ("d", True), ("x", False)])
def test_ntile_sorts_only_rows_near_the_cuts(spark, rows, monkeypatch, key, descending):
    """Ties, a value on a third of the rows, NULL, NaN and infinite values; at most the hot run and 2 % are sorted."""
    odd = F.when(F.col("id") % 50 == 0, None)
    frame = spark.range(20_000).select(
        "id", odd.when(F.col("id") % 3 == 0, 70).otherwise(F.xxhash64("id") % 5000).alias("n"),
        odd.otherwise(F.date_add(F.lit("2024-01-01"), (F.xxhash64("id") % 9000).cast("int"))).alias("d"),
        odd.when(F.col("id") % 49 == 0, float("nan")).when(F.col("id") % 47 == 0, float("-inf"))
        .otherwise(F.rand(3) - 0.5).alias("x"))
    frame = stage(frame)
    keys = [ranking.SortKey(key, descending), asc("id")]
    sorted_rows, slices = [], ranking.ordered_slices
    monkeypatch.setattr(ranking, "ordered_slices", lambda df, *a: sorted_rows.append(df.count()) or slices(df, *a))
    expected = frame.withColumn("t", F.ntile(5).over(Window.orderBy(*(k.column() for k in keys))).cast("long"))
    assert rows(ranking.global_ntile(frame, 5, keys, "t"), "id", "t") == rows(expected, "id", "t")
    assert len(sorted_rows) == 1 and sorted_rows[0] < (7500 if key == "n" else 400)


def test_ntile_of_texts_nulls_and_missed_brackets(spark, rows, monkeypatch):
    frame = stage(spark.range(900).select("id", F.lit(None).cast("int").alias("none"), F.hex("id").alias("text")))
    for key in ("none", "text"):
        for keys in ([asc(key), asc("id")], [desc(key), asc("id")]):
            expected = frame.withColumn("t", F.ntile(4).over(Window.orderBy(*(k.column() for k in keys))).cast("long"))
            assert rows(ranking.global_ntile(frame, 4, keys, "t"), "id", "t") == rows(expected, "id", "t")
    monkeypatch.setattr(ranking, "_cut_spans", lambda rows, key, starts, *a: [(1, 2)] * len(starts))
    expected = frame.withColumn("t", F.ntile(4).over(Window.orderBy("id")).cast("long"))
    assert rows(ranking.global_ntile(frame, 4, [asc("id")], "t"), "id", "t") == rows(expected, "id", "t")


def test_ntile_with_more_tiles_than_rows(spark, rows):
    few = frame(spark, [(1,), (2,), (3,)], "id int")
    assert rows(ranking.global_ntile(few, 5, [asc("id")], "t")) == [(1, 1), (2, 2), (3, 3)]
    assert ranking.global_ntile(few.where("id > 9"), 5, [asc("id")], "t").count() == 0


def test_surrogate_keys_are_dense_in_key_order(spark, rows):
    ids = frame(spark, [(f"k{i:03d}",) for i in range(200)], "id string")
    keyed = ranking.with_surrogate_key(ids, "sk", ["id"], start=10)
    assert rows(keyed, "id", "sk") == [(f"k{i:03d}", 11 + i) for i in range(200)]


def test_pct_of_total(spark, rows):
    df = frame(spark, [("a", 1), ("b", 2), ("c", None)], "g string, v int")
    assert rows(ranking.pct_of_total(df, "v", "p"), "g", "p") == [("a", Decimal("33.33")), ("b", Decimal("66.67")), ("c", None)]
    zero = frame(spark, [("a", 0)], "g string, v int")
    assert rows(ranking.pct_of_total(zero, "v", "p"), "p") == [(None,)]


def test_scratch_is_named_by_the_session_and_can_be_cleared(spark, tmp_path):
    from stratamart import session

    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    other = spark.newSession()
    staged = session.stage(other.range(3))
    assert staged.count() == 3
    path = session.scratch_path(spark, "x")
    assert path.startswith(session.shared_dir(spark)) and spark.sparkContext.applicationId in path
