"""only lines that share a shipment are collected; the documents stay as they were."""

import datetime as dt
import re
from decimal import Decimal

from stratamart.testbed import inputs

BASE = "/root/testdata/sf0.001"
DAY = dt.datetime(2000, 1, 5)
LINES = "l_orderkey long, l_suppkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, " \
        "l_discount double, l_tax double, l_shipdate timestamp_ntz"


def test_lines_alone_in_their_shipment_are_not_collected(spark):
    plan = inputs.order_documents(spark, BASE)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("collect_list"):]
    assert re.search(r"\(_n#\d+L > 1\)", below[:below.index("RepartitionByExpression")])
    assert plan.count("collect_list") == 1


def test_shipments_of_one_and_of_many_lines(spark):
    lines = spark.createDataFrame([
        (1, 1, 1, 5, 2.0, 10.0, 0.05, 0.02, DAY),  # alone
        (1, 2, 3, 7, 1.0, 3.5, 0.0, 0.1, DAY), (1, 2, 2, 6, 4.0, 20.25, 0.1, 0.0, DAY - dt.timedelta(days=2)),  # two, out of order
        (2, 1, 1, 5, 1.0, 1.0, 0.0, 0.0, DAY), (2, 1, 1, 5, 1.0, 1.0, 0.0, 0.0, DAY),  # one line sent twice
        (3, None, 1, 5, 1.0, 1.0, 0.0, 0.0, DAY), (3, None, 2, 5, 1.0, 2.0, 0.0, 0.0, None),  # no supplier
        (4, None, 1, None, None, None, None, None, None),  # alone, nothing known
        (5, 1, 1, 5, 1.0, None, 0.1, 0.1, DAY), (5, 1, 2, 5, 1.0, 8.0, None, 0.5, DAY),
    ], LINES)
    got = {(r.l_orderkey, r.l_suppkey): r for r in inputs._shipments(lines).collect()}
    assert len(got) == 6 and inputs._shipments(lines).count() == 6

    def seen(*key):
        r = got[key]
        return [tuple(i) for i in r._items], r._shipped, r._subtotal, r._discount, r._tax

    def money(*texts):
        return tuple(None if t is None else Decimal(t) for t in texts)

    day = DAY.date()
    assert seen(1, 1) == ([(1, 5, 2.0, 10.0, 0.05)], day, *money("10.0000", "0.5000", "0.2000"))
    assert seen(1, 2) == ([(2, 6, 4.0, 20.25, 0.1), (3, 7, 1.0, 3.5, 0.0)], day - dt.timedelta(days=2), *money("23.7500", "2.0250", "0.3500"))
    assert seen(2, 1) == ([(1, 5, 1.0, 1.0, 0.0)] * 2, day, *money("2.0000", "0.0000", "0.0000"))
    assert seen(3, None) == ([(1, 5, 1.0, 1.0, 0.0), (2, 5, 1.0, 2.0, 0.0)], day, *money("3.0000", "0.0000", "0.0000"))
    assert seen(4, None) == ([(1, None, None, None, None)], None, None, None, None)
    assert seen(5, 1) == ([(1, 5, 1.0, None, 0.1), (2, 5, 1.0, 8.0, None)], day, *money("8.0000", None, "4.0000"))
