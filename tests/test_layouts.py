"""Calendar bitmaps, bucketed tables, and snapshots that a manifest names."""

from __future__ import annotations

import datetime
import random

import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from railweave.operators import lookups
from railweave.plans import sinks, timetable


def test_bitmaps_say_what_the_calendar_says(spark):
    r = random.Random(3)
    day = lambda k: (datetime.date(2024, 2, 1) + datetime.timedelta(k)).isoformat()
    rows = [(f"s{r.randrange(9)}", day(r.randrange(-3, 64)), r.choice([1, 2, 1, None])) for _ in range(300)] + [("edge", day(0), 1), ("edge", day(60), 1), ("late", day(61), 1), ("none", None, 1), (None, day(5), 1)]
    calendar = spark.createDataFrame(rows, "service_id string, date string, exception_type int").repartition(3)
    days = lookups.service_days(calendar, day(0))
    inside = [x for x in rows if x[1] and day(0) <= x[1] <= day(60)]
    seen = {x["service_id"]: x for x in days.collect()}
    assert set(seen) == {x[0] for x in inside} and "late" not in seen
    for s, x in seen.items():
        for name, kinds in (("listed", (1, 2, None)), ("added", (1,)), ("removed", (2,))):
            assert x[name] == sum(1 << k for k in range(61) if any((s, day(k), kind) in inside for kind in kinds))
    assert {x[0] for x in lookups.active_services(calendar, day(0)).collect()} == set(seen)
    trips = spark.createDataFrame([(f"t{i}", s) for i, s in enumerate(sorted(x for x in seen if x))], "trip_id string, service_id string")
    for k in (0, 17, 60, 61, -1):
        want = {x["trip_id"] for x in timetable.running_on(trips, calendar.filter(F.col("date").between(day(0), day(60))), day(k)).collect()}
        assert {x["trip_id"] for x in timetable.running_in(trips, days, day(k), day(0)).collect()} == want
    with pytest.raises(ValueError, match="does not fit"):
        lookups.service_days(calendar, day(0), 63)


def test_buckets_meet_without_a_shuffle(spark, tmp_path):
    times = spark.range(4000).selectExpr("CAST(id % 300 AS STRING) AS trip_id", "CAST(id AS STRING) AS stop_id", "CAST(id div 300 AS INT) AS stop_sequence", "CAST(id AS INT) AS dep_min")
    a = spark.table(sinks.save_bucketed(times, f"{tmp_path}/a", "trip_id", ["stop_sequence"], 5))
    b = spark.table(sinks.save_bucketed(times.select("trip_id").distinct().filter("trip_id < '2'"), f"{tmp_path}/b", "trip_id", [], 5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for got, want in ((timetable.connections(a), timetable.connections(times)), (lookups.orphans(a, b, "trip_id"), times.filter("trip_id >= '2'")), (a.groupBy("trip_id").count(), times.groupBy("trip_id").count())):
            assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(list((tmp_path / "a").glob("part-*"))) == 5


def tables(spark, k):
    stops = spark.range(k, k + 9).selectExpr("CAST(id AS STRING) AS stop_id", "'u' AS uic", "'p' AS parent_name", "'FR' AS country")
    times = spark.range(k * 2, k * 2 + 40).selectExpr("CAST(id AS STRING) AS trip_id", "CAST(id % 7 AS STRING) AS stop_id", "CAST(id AS INT) AS dep_min")
    return {"stops": stops, "stop_times": times, "other": spark.range(k).toDF("x")}


def held(spark, folder, version=None):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in sinks.snapshot(spark, folder, version).items()}


def rows_of(some):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in some.items()}


def test_snapshots(spark, tmp_path):
    folder = f"{tmp_path}/tables"
    with pytest.raises(FileNotFoundError):
        sinks.snapshot(spark, folder)
    first, second = tables(spark, 3), tables(spark, 5)
    assert sinks.publish(first, folder) == 1
    reader = sinks.snapshot(spark, folder)  # resolved before the refresh, read after it
    assert sinks.publish(second, folder) == 2
    assert rows_of(reader) == rows_of(first) == held(spark, folder, 1) and held(spark, folder) == rows_of(second)
    assert {n: (t["rows"], t["null_keys"]) for n, t in sinks.manifest(folder)["tables"].items()} == {"stops": (9, 0), "stop_times": (40, 0), "other": (5, 0)}
    sinks.publish({"stops": first["stops"].withColumn("stop_id", F.when(F.col("stop_id") > "5", F.col("stop_id")))}, folder)
    assert sinks.manifest(folder)["tables"]["stops"]["null_keys"] == 5
    assert sinks.expire(folder, 1) == [1, 2] and sinks.expire(folder, 1) == [] and len(list((tmp_path / "tables/_data").iterdir())) == 1
    assert set(held(spark, folder)) == {"stops"}


@pytest.mark.parametrize("step", range(8))
def test_a_fault_at_any_step_leaves_the_old_snapshot(spark, tmp_path, monkeypatch, step):
    """Each step of a refresh fails once; readers see the old tables, the next refresh works, and nothing is left behind."""
    folder, old, new = f"{tmp_path}/tables", tables(spark, 3), tables(spark, 5)
    sinks.publish(old, folder)
    if step == 7:  # a key that occurs twice
        bad = new | {"stops": new["stops"].unionAll(new["stops"])}
        with pytest.raises(ValueError, match="occurs 2 times"):
            sinks.publish(bad, folder)
    else:
        count = [0]

        def fail_at(f):
            def g(*a, **k):
                count[0] += 1
                if count[0] == step + 1:
                    raise OSError("lost")
                return f(*a, **k)

            return g

        real = pyarrow.fs.FileSystem.from_uri

        class Store:
            def __init__(self, fs):
                self.fs = fs

            def __getattr__(self, name):
                f = getattr(self.fs, name)
                return fail_at(f) if name in ("create_dir", "open_output_stream", "move") else f

        monkeypatch.setattr(sinks, "assert_unique", fail_at(sinks.assert_unique))
        monkeypatch.setattr(sinks, "_versions", fail_at(sinks._versions))
        monkeypatch.setattr(sinks.json, "dumps", fail_at(sinks.json.dumps))
        monkeypatch.setattr(sinks.pyarrow.fs, "FileSystem", type("F", (), {"from_uri": staticmethod(lambda uri: (Store(real(uri)[0]), real(uri)[1]))}))
        try:
            sinks.publish(new, folder)
            assert count[0] <= step
        except OSError:
            assert count[0] == step + 1
        monkeypatch.undo()
        if count[0] <= step:
            return
    assert held(spark, folder) == rows_of(old) and len(list((tmp_path / "tables/_data").iterdir())) == 1
    sinks.publish(new, folder)
    assert held(spark, folder) == rows_of(new)
