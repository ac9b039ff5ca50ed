"""What the stored tables write."""

import pyarrow as pa

from stratamart.operators.ranking import _changes
from stratamart.session import path_exists
from stratamart.testbed import stored as layers

BASE = "/root/testdata/sf0.001"


def test_documents_are_copied_only_for_the_items(spark, monkeypatch):
    """orders alone read the documents once, so no copy of them is written."""
    monkeypatch.setattr(layers, "_roots", {})
    alone = layers.stored(spark, BASE, "orders").drop("order_sk")
    assert not path_exists(spark, layers._path(spark, BASE, "raw_orders"))
    monkeypatch.setattr(layers, "_roots", {})
    layers.stored(spark, BASE, "order_items")
    assert path_exists(spark, layers._path(spark, BASE, "raw_orders"))
    beside = layers.stored(spark, BASE, "orders")
    assert alone.exceptAll(beside).isEmpty() and beside.exceptAll(alone).isEmpty()


def test_groups_end_where_spark_ends_them():
    """adjacent nulls and NaN are one group."""
    assert _changes(pa.array([None, None, 1.0, float("nan"), float("nan"), 2.0, 2.0])).tolist() == [False, True, True, False, True, False]
    assert _changes(pa.array(["a", "a", None, "b"])).tolist() == [False, True, True]
