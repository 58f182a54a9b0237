"""What the master job rejects, of tables that several tasks write."""

import datetime
from functools import partial

from conftest import rows
from spoorlens.operators import skew
from spoorlens.workload import files

KINDS = ["click", "error", "purchase", "signup", "view"]


def test_each_file_begins_with_its_header(spark, folder, monkeypatch):
    """Lines of one kind that come from several tasks; the header was somewhere between them."""
    at = datetime.datetime(2024, 1, 1)
    given = [(n, at + datetime.timedelta(minutes=n), n % 7, KINDS[n % 5], float(n % 300), "{}") for n in range(2000)]
    events = spark.createDataFrame(given, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.repartition(6).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(k, f"C{k}", 1, 5.0) for k in range(9)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double") \
        .write.parquet(f"{folder}/customer.parquet")
    monkeypatch.setattr(files, "keyed_join", partial(skew.keyed_join, small_rows=0))
    several = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in several.items():
        spark.conf.set(name, value)
    try:
        found = rows(files.rejected_values(spark, folder), "file", "column", "expected", "rejects")
    finally:
        for name in several:
            spark.conf.unset(name)
    want = {}
    for _, _, _, kind, value, _ in given:
        if kind == "error" and value < 20:
            bad = [(kind, None, "line")]
        else:
            bad = [(kind, "service_train_number", "whole number")] if value > 250 else []
            bad += [(kind, "service_date", "date")] if kind == "signup" else []
            bad += [(kind, "stop_departure_delay", "number")] if kind == "click" and value < 50 else []
        for b in bad:
            want[b] = want.get(b, 0) + 1
    assert sorted(found, key=str) == sorted(((*k, n) for k, n in want.items()), key=str)
