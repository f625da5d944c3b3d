"""Tables of the harmonized plan that are asked for alone."""

from __future__ import annotations

import pytest

from railweave import schemas
from railweave.operators import lookups
from railweave.plans import feed_queries, ingest
from test_ingest import three  # noqa: F401 the archives of three operators

SF = "/root/testdata/sf0.001"


def test_a_table_alone_is_what_it_is_among_all(spark, three):  # noqa: F811
    every = ingest.harmonized(spark, three, today="2024-01-01")
    rows = {name: sorted(map(str, df.collect())) for name, df in every.items()}
    assert set(every) == {*schemas.HARMONIZED, "report"}
    for names in (["calendar_dates"], ["routes"], ["stops", "report"], ["stop_times", "trips"]):
        some = ingest.harmonized(spark, three, today="2024-01-01", tables=names)
        assert sorted(some) == sorted(names)
        assert all(df.schema == every[name].schema and sorted(map(str, df.collect())) == rows[name] for name, df in some.items())


@pytest.mark.parametrize(("query", "steps"), [("feed_calendar", []), ("feed_stop_sources", ["resolve"]), ("feed_routes", ["times"])])
def test_queries_compute_what_they_return(spark, monkeypatch, query, steps):
    """Stops are resolved once for stop sources, calls are read for routes of one operator, and archives are landed whole for all."""
    monkeypatch.setattr(feed_queries, "_done", {})
    seen, real, times = [], ingest.resolve.resolve, ingest._times
    monkeypatch.setattr(ingest.resolve, "resolve", lambda *a: [seen.append("resolve"), real(*a)][1])
    monkeypatch.setattr(ingest, "_times", lambda *a: [seen.append("times"), times(*a)][1])
    first = feed_queries.QUERIES[query](spark, SF).collect()
    assert seen == steps and first == feed_queries.QUERIES[query](spark, SF).collect() and seen == steps
    assert all(sorted(feed_queries.feeds.members(p)) == sorted(schemas.MEMBERS) for p in feed_queries._feeds(spark, SF).values())


def test_dates_are_parsed_once(spark):
    days = spark.createDataFrame([("a", "20240101", "1 "), ("b", "20240301", "2"), ("c", "20240302", "1"), ("d", "20241399", "1"), ("e", None, "1"), ("f", "20231231", "1"), ("g", "20240215", None)], "service_id string, date string, exception_type string")
    seen = lookups.calendar_window(days, "2024-01-01")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("date_format(") == 1 and seen.columns == days.columns
    assert sorted(map(tuple, seen.collect())) == [("a", "2024-01-01", 1), ("b", "2024-03-01", 2), ("g", "2024-02-15", None)]
