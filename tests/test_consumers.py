"""What the consumers of a stored raw table read."""

import datetime as dt
import json

from stratamart.plans import full_run, silver
from stratamart.sources import load, scan


def land(folder, name, orders):
    folder.mkdir(exist_ok=True)
    text = "".join(json.dumps({"order_id": o, "order_date": "2001-02-03", "items": [{"product_id": "p", "quantity": 2}]}) + "\n" for o in orders)
    (folder / name).write_text(text)


def test_consumers_read_the_files_of_a_batch_and_only_what_they_ask_for(spark, tmp_path):
    """a merge's passes are plain reads of the new files, not of the stream's whole rows."""
    house, landing = full_run.Warehouse(str(tmp_path / "ware house")), tmp_path / "landing"
    seen = []

    def merge(house, raw, as_of, now):
        plan = silver.silver_orders(raw).select("order_id")._jdf.queryExecution().optimizedPlan().toString()
        seen.append((sorted(r["order_id"] for r in raw.collect()), len(raw.inputFiles()), "raw_data" in plan.split("Relation")[0]))

    for name, orders in (("a.json", ["1", "2"]), ("b.json", ["3"]), (None, [])):
        if name:
            land(landing, name, orders)
        load.load_raw(spark, load.RAW_ORDERS, str(landing), house.bronze, fmt=scan.JSON_LINES)
        full_run.consume(spark, house, load.RAW_ORDERS, "orders", merge, dt.date(2002, 1, 1))
    assert [orders for orders, _, _ in seen] == [["1", "2"], ["3"]]
    assert all(files and not documents for _, files, documents in seen)
