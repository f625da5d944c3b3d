"""The three ingestion plans (E1 harmonized, E2 generic, E3 single feed), from landed archives to DataFrames of tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from railweave import schemas
from railweave.functions import rules
from railweave.functions.text import first_digits, first_train_number, prefixed, short_or_train_number
from railweave.functions.times import iso_date, lenient_double, minutes_of_day, strict_int
from railweave.operators import lookups, resolve
from railweave.sources import feeds
from railweave.sources.session import written

log = logging.getLogger("railweave")

#: (operator id, path of its landed archive, transport types)
Feed = tuple[str, str, Sequence[str]]


def landed(catalog: DataFrame, paths: dict[str, str]) -> list[Feed]:
    """Feeds that are on, in catalog order, with the archives that were landed for them."""
    rows = feeds.enabled(catalog).orderBy("op_idx").select("id", "transport_types").collect()
    return [(r["id"], paths[r["id"]], r["transport_types"] or ["Train"]) for r in rows if r["id"] in paths]


def _times(spark: SparkSession, path: str) -> DataFrame:
    """Stop times with their minutes, landed as Parquet: a member in an archive is read by one task, so it is read once."""
    rows = written(feeds.read_member(spark, path, "stop_times.txt", schemas.MEMBERS["stop_times.txt"]), "stop_times")
    return rows.withColumns({"dep_min": minutes_of_day(F.col("departure_time")), "stop_sequence": strict_int(F.col("stop_sequence"))})


def harmonized(spark: SparkSession, sources: Sequence[Feed], stations: str | None = None, today: str | None = None, days: int = 60, tables: Collection[str] | None = None) -> dict[str, DataFrame]:
    """E1: canonical stops over all feeds, then routes, trips, times and dates of each; also the counters ('report').

    tables: the names of those that are wanted, all unless given; each is whole, and what only the others need is not computed.
    """
    today, wanted = today or feeds.today(), set(schemas.HARMONIZED) | {"report"} if tables is None else set(tables)
    out: dict[str, DataFrame] = {}
    mapping = None
    if wanted & {"stops", "stop_times", "report"}:
        raw = lookups.union_all([
            resolve.raw_stops(feeds.read_member(spark, path, "stops.txt", schemas.MEMBERS["stops.txt"], optional=schemas.MEMBERS["stops.txt"][1:]), op, i)
            for i, (op, path, _) in enumerate(sources)
        ])
        resolved = resolve.resolve(raw)
        mapping, out["report"] = resolve.stop_map(resolved), resolve.report(resolved)
    if "stops" in wanted:
        out["stops"] = resolve.canonical_stops(resolved)
        table = feeds.read_stations(spark, stations)
        if table is not None:
            keys = written(lookups.station_keys(table), "stations")
            log.info("%s station codes", lookups.key_count(keys).first()["n_keys"])
            out["stops"] = lookups.with_station(out["stops"], keys)
    parts: dict[str, list[DataFrame]] = {}
    for op, path, _ in sources:
        for name, df in _harmonized_feed(spark, op, path, mapping, today, days, wanted).items():
            parts.setdefault(name, []).append(df)
    out |= {name: lookups.union_all(dfs) for name, dfs in parts.items()}
    return {name: out[name].select(*of.names) for name, of in schemas.HARMONIZED.items() if name in wanted} | ({"report": out["report"]} if "report" in wanted else {})


def _harmonized_feed(spark: SparkSession, op: str, path: str, mapping: DataFrame | None, today: str, days: int, wanted: Collection[str]) -> dict[str, DataFrame]:
    """The wanted tables of one feed."""
    out: dict[str, DataFrame] = {}
    if {"calendar_dates", "trips"} & wanted:
        dates = feeds.read_member(spark, path, "calendar_dates.txt", schemas.MEMBERS["calendar_dates.txt"], optional=["exception_type"])
        if not feeds.has_column(path, "calendar_dates.txt", "exception_type"):
            dates = dates.withColumn("exception_type", F.lit("1"))
        dates = lookups.calendar_window(dates, today, days)
        out["calendar_dates"] = lookups.with_lineage(dates, op, "service_id")
    by_times = op.upper() not in ("EUROSTAR", "RENFE")  # calls give routes their types
    times = _times(spark, path) if "stop_times" in wanted or by_times and "routes" in wanted else None
    optional = {"trips.txt": ["trip_headsign", "trip_short_name"] if op.upper() == "RENFE" else ["trip_short_name"], "routes.txt": schemas.MEMBERS["routes.txt"][1:]}
    trips, routes = (feeds.read_member(spark, path, m, schemas.MEMBERS[m], optional=optional[m]) for m in ("trips.txt", "routes.txt"))
    if "routes" in wanted:
        if op.upper() == "EUROSTAR":
            typed = routes.withColumn("train_type", rules.type_of_merged_agency(F.coalesce("agency_id", F.lit(""))))
        elif op.upper() == "RENFE":
            has = {c: feeds.has_column(path, "routes.txt", c) for c in ("route_short_name", "route_long_name")}
            names = [F.col(c) if has[c] else F.lit("") for c in has]
            typed = routes.withColumn("train_type", rules.type_of_route_names(*names, F.col("route_id")))
        else:
            stops = feeds.read_member(spark, path, "stops.txt", ["stop_id"])
            typed = routes.join(route_types(stops, times, trips), "route_id", "left").withColumn("train_type", F.coalesce("value", F.lit("Train SNCF")))
        out["routes"] = lookups.with_lineage(typed, op, "route_id")
    if "trips" in wanted:
        if op.upper() == "EUROSTAR":
            trips = trips.withColumn("trip_headsign", first_train_number(F.col("trip_id")))
        elif op.upper() == "RENFE":
            trips = trips.withColumn("trip_headsign", short_or_train_number(F.col("trip_short_name"), F.col("trip_id")))
        out["trips"] = lookups.with_lineage(lookups.of_active(trips, dates.select("service_id").distinct()), op, "trip_id", "route_id", "service_id")
    if "stop_times" in wanted:
        out["stop_times"] = lookups.mapped_stop(lookups.with_lineage(times, op, "trip_id"), mapping)
    return {name: df.select(*schemas.HARMONIZED[name].names) for name, df in out.items() if name in wanted}


def route_types(stops: DataFrame, times: DataFrame, trips: DataFrame) -> DataFrame:
    """AGG-01, AGG-02, JON-02 to JON-04: (route_id, value): stop ids give types to trips, and trips, active or not, to routes.

    Each stop id is classified once, and the map is written before it is filtered: else the optimizer applies the rules to every stop time,
    to filter them by the join's key. Until routes have their type, it is the number of a rule.
    """
    typed = written(stops.select("stop_id", rules.index_of(rules.STOP_ID_RULES, F.col("stop_id")).alias("rule")).dropDuplicates(["stop_id"]), "types")
    of_trips = lookups.first_by(times.join(typed.filter("rule IS NOT NULL"), "stop_id"), "trip_id", "rule", ["_row"])
    return lookups.first_label(trips.join(of_trips, "trip_id"), "route_id", F.col("value"), rules.labels_of(rules.STOP_ID_RULES), "_row")


def generic_feed(spark: SparkSession, op: str, path: str, types: Sequence[str]) -> dict[str, DataFrame]:
    """E2 for one operator: no resolution, all ids prefixed. Raises at once if there is no archive."""
    feeds.members(path)
    defaults = F.array(*map(F.lit, types)) if types else F.array().cast("array<string>")
    stops = feeds.read_member(spark, path, "stops.txt", ["stop_id", "stop_name", "stop_lat", "stop_lon"])
    stops = stops.withColumn("stop_id", prefixed(op, F.col("stop_id"))).withColumns({"clean_uic": first_digits(F.col("stop_id")), "stop_lat": lenient_double(F.col("stop_lat")), "stop_lon": lenient_double(F.col("stop_lon"))})
    routes = feeds.read_member(spark, path, "routes.txt", ["route_id", "agency_id"], optional=["agency_id"])
    agencies = lookups.last_by(routes, ["route_id"], F.col("agency_id"), ["_row"]).withColumnRenamed("value", "agency")
    times = _times(spark, path)
    trips = feeds.read_member(spark, path, "trips.txt", ["trip_id", "route_id", "service_id", "trip_headsign"])
    by_agency = lambda c: rules.type_of_agency_or_stop(F.coalesce(c, F.lit("")), F.lit(""), defaults)
    typed = trips.join(agencies, "route_id", "left").withColumn("train_type", by_agency(F.col("agency")))
    if op == "SNCF":  # only here do first stops type their trips, even with the default
        first = lookups.first_by(times, "trip_id", rules.type_of_agency_or_stop(F.lit(""), F.coalesce("stop_id", F.lit("")), defaults), ["_row"], skip_null=False)
        typed = typed.join(first, "trip_id", "left").withColumn("train_type", F.coalesce("value", "train_type"))
    dates = feeds.read_member(spark, path, "calendar_dates.txt", schemas.MEMBERS["calendar_dates.txt"])
    out = {
        "stops": stops,
        "routes": routes.withColumn("train_type", by_agency(F.col("agency_id"))).withColumn("route_id", prefixed(op, F.col("route_id"))),
        "trips": lookups.with_lineage(typed, op, "trip_id", "route_id", "service_id"),
        "stop_times": times.withColumns({c: prefixed(op, F.col(c)) for c in ("trip_id", "stop_id")}),
        "calendar_dates": dates.withColumns({"service_id": prefixed(op, F.col("service_id")), "date": iso_date(F.col("date"), strict=True), "exception_type": strict_int(F.col("exception_type"))}),
    }
    return {name: df.select(*schemas.GENERIC[name].names) for name, df in out.items()}


#: Feeds whose jobs run at the same time.
AT_ONCE = 4


def generic(spark: SparkSession, sources: Sequence[Feed], at_once: int = AT_ONCE) -> dict[str, DataFrame]:
    """E2: the union of all feeds, in their order.

    Feeds are read at the same time, a few at once and each under a job tag of its own, and a feed's tables at the same time too. One with
    any fault, be it no archive, a missing column or a word for a number, is logged and left out whole (ERR-01): at its first fault its
    other jobs are cancelled, and the other feeds go on.
    """
    sc, run = spark.sparkContext, uuid.uuid4().hex
    done: dict[int, dict[str, DataFrame]] = {}

    def one(i: int) -> None:
        op, path, types = sources[i]
        tag = f"feed-{run}-{i}"
        try:
            tables = generic_feed(spark, op, path, types)
            with ThreadPoolExecutor(len(tables)) as pool:
                jobs = {name: pool.submit(tagged(lambda df=df, name=name: written(df, f"{op}-{name}"), tag)) for name, df in tables.items()}
                for job in as_completed(jobs.values()):
                    if job.exception():
                        sc.cancelJobsWithTag(tag)
                        raise job.exception()
            done[i] = {name: job.result() for name, job in jobs.items()}
        except Exception as e:  # noqa: BLE001 the other feeds go on, whatever is wrong with this one
            log.error("feed %s left out: %s", op, e)

    def tagged(job: Callable[[], DataFrame], tag: str) -> Callable[[], DataFrame]:
        """The job under a tag, in a thread with the properties of this one."""

        def go() -> DataFrame:
            sc.addJobTag(tag)
            try:
                return job()
            finally:
                sc.removeJobTag(tag)

        return inheritable_thread_target(spark)(go)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        list(pool.map(inheritable_thread_target(spark)(one), range(len(sources))))
    if not done:
        raise ValueError("no feed could be read")
    return {name: lookups.union_all([done[i][name] for i in sorted(done)]) for name in schemas.GENERIC}


def single_feed(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """E3: one feed, ids as they are, every member required."""
    read = lambda member, columns: feeds.read_member(spark, path, member, columns, missing="error")
    stops = read("stops.txt", ["stop_id", "stop_name", "stop_lat", "stop_lon"])
    times = read("stop_times.txt", schemas.MEMBERS["stop_times.txt"])
    dates = read("calendar_dates.txt", schemas.MEMBERS["calendar_dates.txt"])
    out = {
        "stops": stops.withColumns({"clean_uic": first_digits(F.col("stop_id")), "stop_lat": lenient_double(F.col("stop_lat")), "stop_lon": lenient_double(F.col("stop_lon"))}),
        "routes": read("routes.txt", ["route_id", "agency_id"]).withColumn("train_type", rules.type_of_single_feed_agency(F.coalesce("agency_id", F.lit("")))),
        "trips": read("trips.txt", ["trip_id", "route_id", "service_id", "trip_headsign"]),
        "stop_times": times.withColumns({"dep_min": minutes_of_day(F.col("departure_time")), "stop_sequence": strict_int(F.col("stop_sequence"))}),
        "calendar_dates": dates.withColumns({"date": iso_date(F.col("date"), strict=True), "exception_type": strict_int(F.col("exception_type"))}),
    }
    return {name: df.select(*schemas.SINGLE[name].names) for name, df in out.items()}
