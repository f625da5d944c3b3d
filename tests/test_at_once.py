"""Feeds that are read at the same time, and join orders by the statistics of saved tables."""

from __future__ import annotations

import threading
import time

import pytest

from railweave.plans import ingest, sinks
from test_ingest import archive, rows


def full(path, name):
    return archive(
        path, stops=f"stop_id,stop_name,stop_lat,stop_lon\n{name},A,1,2\n", routes="route_id,agency_id\nr,x\n", trips="trip_id,route_id,service_id,trip_headsign\nt,r,s,h\n",
        stop_times=f"trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt,1:00,1:00,{name},1\n", calendar_dates="service_id,date,exception_type\ns,20240101,2\n",
    )


@pytest.mark.parametrize("at_once", [1, 4])
def test_feeds_are_read_at_once_and_in_their_order(spark, tmp_path, monkeypatch, at_once):
    names = ["C", "A", "B"]
    sources = [(n, full(tmp_path / f"{n}.zip", n.lower()), ["Train"]) for n in names]
    meet, real = threading.Barrier(len(names)), ingest.generic_feed

    def feed(*a):
        if at_once > 1:
            meet.wait(60)  # no feed gets further before all have begun
        return real(*a)

    monkeypatch.setattr(ingest, "generic_feed", feed)
    broken = ("BROKEN", str(tmp_path / "none.zip"), [])
    out = ingest.generic(spark, sources, at_once) if at_once > 1 else ingest.generic(spark, [sources[0], broken, *sources[1:]], at_once)
    assert rows(out["stops"], "stop_id") == [("A_a",), ("B_b",), ("C_c",)] and rows(out["stop_times"], "trip_id") == [("A_t",), ("B_t",), ("C_t",)]
    assert [f.split("/")[-2].split("-stops-")[0] for f in out["stops"].inputFiles()] == names


def test_the_first_fault_cancels_the_jobs_of_its_feed(spark, tmp_path, monkeypatch):
    good, real = full(tmp_path / "g.zip", "g"), ingest.generic_feed

    def feed(spark, op, path, types):
        tables = real(spark, op, path, types)
        if op != "BAD":
            return tables

        def slow(batches):
            time.sleep(90)
            yield from batches

        late = tables["stops"].mapInPandas(slow, tables["stops"].schema)
        return tables | {"stops": late, "routes": tables["routes"].selectExpr("route_id", "raise_error('no route') AS train_type")}

    monkeypatch.setattr(ingest, "generic_feed", feed)
    began = time.time()
    out = ingest.generic(spark, [("BAD", good, []), ("GOOD", good, [])])
    assert time.time() - began < 60 and rows(out["stops"], "stop_id") == [("GOOD_g",)]


def test_joins_follow_the_statistics(spark):
    """The table that leaves few rows is joined first once tables have statistics, though the query names it last."""
    calls = spark.range(40_000).selectExpr("id % 200 AS stop", "id % 5000 AS trip", "id AS call")
    names = spark.range(4000).selectExpr("id % 200 AS stop", "id AS name")  # twenty of each stop
    trips = spark.range(20).selectExpr("id AS trip", "id % 3 AS kind")
    sinks.save_as_tables(spark, {"calls": calls, "names": names, "trips": trips}, "by_cost")
    sql = "SELECT count(*), sum(call), sum(name) FROM by_cost.calls JOIN by_cost.names USING (stop) JOIN by_cost.trips USING (trip)"
    first, want = {}, calls.join(names, "stop").join(trips, "trip").selectExpr("count(*)", "sum(call)", "sum(name)").first()
    for by_cost in (False, True):
        before = {k: spark.conf.get(k) for k in sinks.BY_COST}
        for k, v in sinks.BY_COST.items():
            spark.conf.set(k, v if by_cost else "false")
        try:
            df = spark.sql(sql)
            tree = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
            depth = lambda line: len(line) - len(line.lstrip(" :+-"))
            at = max((i for i, line in enumerate(tree) if "Join" in line), key=lambda i: depth(tree[i]))
            below = next((i for i in range(at + 1, len(tree)) if depth(tree[i]) <= depth(tree[at])), len(tree))
            first[by_cost] = {t for t in ("calls", "names", "trips") for line in tree[at:below] if f"by_cost.{t}[" in line}
            assert df.first() == want
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
    assert first[False] == {"calls", "names"} and first[True] == {"calls", "trips"}
