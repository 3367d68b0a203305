"""Running totals of the event log, on ids that several events share or none has."""

import duckdb

from quern.plans import registry


def test_scheduled_buckets_counts_events_of_one_id_together(spark, tmp_path):
    rows = [(1, 7, 100.0), (2, 7, 200.0), (2, 7, 300.0), (2, 7, 1.0), (3, 7, 150.0), (None, 7, 260.0), (None, 7, 30.0)]
    rows += [(4, 8, None), (5, 8, 600.0), (5, 8, -700.0), (6, 8, 400.0), (7, None, 250.0), (7, None, 250.0), (1, 9, -10.0), (2, 9, 20.0)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = [tuple(r) for r in registry.QUERIES["scheduled_buckets"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(registry.ORACLE["scheduled_buckets"]).fetchall()
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert (2, 2) in got and (None, 4) in got and (7, 2) in got
