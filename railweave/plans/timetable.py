"""Queries that the tables' indexes are made for (IQ-1 to IQ-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railweave.operators import lookups


def departures(times: DataFrame, stop_id: str, after: int, limit: int, order: list[str]) -> DataFrame:
    """IQ-1: the next departures of a stop from a minute of the day on."""
    return times.filter((F.col("stop_id") == stop_id) & (F.col("dep_min") >= after)).orderBy("dep_min", *order).limit(limit)


def itinerary(times: DataFrame, trip_id) -> DataFrame:
    """IQ-2: a trip's stops in order."""
    return times.filter(F.col("trip_id") == trip_id).orderBy("stop_sequence")


def connections(times: DataFrame) -> DataFrame:
    """IQ-2: (trip_id, origin, destination, dep_min) for each pair of a trip's stops in travel order."""
    a, b = times.alias("a"), times.alias("b")
    return a.join(b, (F.col("a.trip_id") == F.col("b.trip_id")) & (F.col("a.stop_sequence") < F.col("b.stop_sequence"))).select(
        "a.trip_id", F.col("a.stop_id").alias("origin"), F.col("b.stop_id").alias("destination"), F.col("a.dep_min").alias("dep_min")
    )


def running_on(trips: DataFrame, calendar: DataFrame, date: str) -> DataFrame:
    """IQ-3: trips whose service is added on a date."""
    services = calendar.filter((F.col("date") == date) & (F.col("exception_type") == 1)).select("service_id")
    return trips.join(services, "service_id", "left_semi")


def running_in(trips: DataFrame, days: DataFrame, date: str, start: str) -> DataFrame:
    """IQ-3 from bitmaps (lookups.service_days): trips whose service is added on a date."""
    return trips.join(days.filter(lookups.runs_on(F.col("added"), date, start)).select("service_id"), "service_id", "left_semi")


def trips_of(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """IQ-4."""
    return routes.join(trips, "route_id")


def by_code(stops: DataFrame, uic: str) -> DataFrame:
    """IQ-5."""
    return stops.filter(F.col("uic") == uic)


def by_parent(stops: DataFrame) -> DataFrame:
    """IQ-6: stops a parent station has."""
    return stops.groupBy("parent_name").agg(F.count("*").alias("n_stops"))


def by_country(stops: DataFrame) -> DataFrame:
    """IQ-7."""
    return stops.groupBy("country").agg(F.count("*").alias("n_stops"))


def by_name(stops: DataFrame, start: str) -> DataFrame:
    """IQ-8: stops whose name begins so; the filter reaches the scan."""
    return stops.filter(F.col("stop_name").startswith(start))
