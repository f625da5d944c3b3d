"""Schemas of feed members (all strings, as read) and of the tables that the plans produce."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType


def _of(**kinds) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


S, D, I = StringType(), DoubleType(), IntegerType()

#: Operator catalog (SRC-01).
CATALOG = _of(id=S, name=S, enabled=BooleanType(), gtfs_dir=S, db_gz_path=S, script_path=S, gtfs_url=S, transport_types=ArrayType(S))

#: Columns that plans ask of each feed member; all are strings.
MEMBERS = {
    "stops.txt": ["stop_id", "stop_code", "stop_name", "stop_lat", "stop_lon"],
    "routes.txt": ["route_id", "agency_id", "route_short_name", "route_long_name"],
    "trips.txt": ["trip_id", "route_id", "service_id", "trip_headsign", "trip_short_name"],
    "stop_times.txt": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "calendar_dates.txt": ["service_id", "date", "exception_type"],
}
STATIONS = ["id", "name", "parent_station_id", "parent_station_name", "city", "country", "uic", "uic8_sncf", "latitude", "longitude"]

HARMONIZED = {
    "stops": _of(stop_id=S, stop_name=S, parent_name=S, country=S, stop_lat=D, stop_lon=D, uic=S, sncf=I, eurostar=I, renfe=I, source_stop_ids=ArrayType(S)),
    "routes": _of(route_id=S, operator_id=S, train_type=S),
    "trips": _of(trip_id=S, route_id=S, service_id=S, trip_headsign=S, operator_id=S),
    "stop_times": _of(trip_id=S, arrival_time=S, departure_time=S, stop_id=S, stop_sequence=I, dep_min=I, operator_id=S),
    "calendar_dates": _of(service_id=S, date=S, exception_type=I, operator_id=S),
}
GENERIC = {
    "stops": _of(stop_id=S, stop_name=S, stop_lat=D, stop_lon=D, clean_uic=S),
    "routes": _of(route_id=S, train_type=S),
    "trips": _of(trip_id=S, route_id=S, service_id=S, trip_headsign=S, train_type=S, operator_id=S),
    "stop_times": _of(trip_id=S, arrival_time=S, departure_time=S, stop_id=S, stop_sequence=I, dep_min=I),
    "calendar_dates": _of(service_id=S, date=S, exception_type=I),
}
SINGLE = GENERIC | {"trips": _of(trip_id=S, route_id=S, service_id=S, trip_headsign=S)}

PRIMARY_KEYS = {"stops": "stop_id", "routes": "route_id", "trips": "trip_id"}
