"""Queries over the test tables, one or more for each group of operators, each with its SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from railweave.functions import geo, rules, text, times
from railweave.operators import lookups, resolve
from railweave.plans import derived as d, feed_queries, sinks, timetable
from railweave.sources.session import scratch, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_WINDOW = f"date BETWEEN '{d.START}' AND strftime(CAST('{d.START}' AS DATE) + 60, '%Y-%m-%d')"
_MAPPED = f"SELECT t.trip_id, coalesce(m.canonical_id, t.stop_id) AS stop_id, stop_sequence, dep_min, l_partkey, l_quantity, l_extendedprice FROM ({d.STOP_TIMES}) t LEFT JOIN ({d.STOP_MAP}) m ON m.raw_stop_id = t.stop_id"
BOARD_STOP, BOARD_AFTER, BOARD_ROWS = "CANONICAL_UIC_88888887", 300, 500


def _typed_times(spark: SparkSession, sf: str) -> DataFrame:
    rows = d.stop_times(spark, sf)
    return rows.withColumns({"dep_min": times.minutes_of_day(F.col("departure_time")), "stop_sequence": times.strict_int(F.col("stop_sequence"))})


@query(f"""
WITH c AS ({d.CALENDAR}), a AS (SELECT DISTINCT service_id FROM c WHERE {_WINDOW}),
t AS (SELECT * FROM ({d.TRIPS}) WHERE service_id IN (SELECT service_id FROM a) OR NOT EXISTS (SELECT 1 FROM a))
SELECT trip_id, stop_id, stop_sequence, CAST(dep_min AS INTEGER) AS dep_min FROM ({_MAPPED}) m WHERE trip_id IN (SELECT trip_id FROM t) AND stop_id = '{BOARD_STOP}' AND dep_min >= {BOARD_AFTER}
ORDER BY dep_min, trip_id, stop_sequence LIMIT {BOARD_ROWS}""")
def departures_board(spark: SparkSession, sf: str) -> DataFrame:
    """The next departures of a stop on services of the window (a top-k report)."""
    services = lookups.active_services(lookups.calendar_window(d.calendar(spark, sf), d.START), d.START)
    running = lookups.of_active(d.trips(spark, sf), services)
    here = lookups.times_of_stop(_typed_times(spark, sf), d.stop_map(spark, sf), BOARD_STOP)
    active = here.join(running.select("trip_id"), "trip_id", "left_semi")
    return timetable.departures(active, BOARD_STOP, BOARD_AFTER, BOARD_ROWS, ["trip_id", "stop_sequence"]).select("trip_id", "stop_id", "stop_sequence", "dep_min")


@query(f"SELECT trip_id, stop_id, stop_sequence, CAST(dep_min AS INTEGER) AS dep_min FROM ({_MAPPED})")
def mapped_stop_times(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.mapped_stop(_typed_times(spark, sf), d.stop_map(spark, sf)).select("trip_id", "stop_id", "stop_sequence", "dep_min")


@query(f"SELECT service_id, date, exception_type FROM ({d.CALENDAR}) WHERE {_WINDOW}")
def calendar_window(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.calendar_window(d.calendar(spark, sf), d.START)


@query(f"WITH a AS (SELECT service_id FROM ({d.CALENDAR}) WHERE {_WINDOW}) SELECT trip_id, route_id, service_id, trip_headsign FROM ({d.TRIPS}) WHERE service_id IN (SELECT service_id FROM a) OR NOT EXISTS (SELECT 1 FROM a)")
def active_trips(spark: SparkSession, sf: str) -> DataFrame:
    services = lookups.service_days(lookups.calendar_window(d.calendar(spark, sf), d.START), d.START).filter("listed <> 0")
    return lookups.of_active(d.trips(spark, sf), services).drop("_row")


@query(f"SELECT trip_id, route_id, service_id, trip_headsign FROM ({d.TRIPS})")
def active_trips_bypass(spark: SparkSession, sf: str) -> DataFrame:
    """No service runs in this window, so all trips stay."""
    services = lookups.active_services(lookups.calendar_window(d.calendar(spark, sf), "2050-01-01"), "2050-01-01")
    return lookups.of_active(d.trips(spark, sf), services).drop("_row")


@query("SELECT event_id, CAST(60 * (extract('hour' FROM ts) + 24 * (event_id % 2)) + extract('minute' FROM ts) AS INTEGER) AS minutes FROM events")
def minutes_of_day(spark: SparkSession, sf: str) -> DataFrame:
    clock = F.concat_ws(":", F.lpad((F.hour("ts") + 24 * (F.col("event_id") % 2)).cast("string"), 2, "0"), F.date_format("ts", "mm:ss"))
    return d.load(spark, sf, "events").select("event_id", times.minutes_of_day(clock).alias("minutes"))


@query("""SELECT doc_id, array_to_string(list_filter(string_split_regex(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]', ' ', 'g'), ' +'),
  lambda w: w <> '' AND NOT list_contains(['gare', 'de', 'du', 'des', 'la', 'le', 'l', 'saint', 'st', 'estacion'], w)), ' ') AS norm_name FROM documents""")
def normalized_names(spark: SparkSession, sf: str) -> DataFrame:
    return d.load(spark, sf, "documents").select("doc_id", text.normalized_name(F.col("text")).alias("norm_name"))


_CODES = "CASE c_custkey % 5 WHEN 0 THEN 'StopPoint:OCE-' || (87000000 + c_custkey) WHEN 1 THEN '00' || (7100000 + c_custkey) || '999' WHEN 2 THEN 'A ' || (10000 + c_custkey % 90000) || '!' WHEN 3 THEN 'x_' || (10000 + c_custkey % 90000) ELSE c_name END"


@query(rf"""WITH c AS (SELECT c_custkey, {_CODES} AS code, CASE WHEN c_custkey % 7 <> 0 THEN 'n' || c_custkey END AS other FROM customer),
u AS (SELECT c_custkey, code, coalesce(nullif(regexp_extract(code, '(\d{{7,8}})', 1), ''), '71' || nullif(regexp_extract(code, '\b(\d{{5}})\b', 1), ''), '') AS uic FROM c)
SELECT c_custkey, uic, nullif(regexp_extract(code, '(\d+)', 1), '') AS clean FROM u""")
def uic_codes(spark: SparkSession, sf: str) -> DataFrame:
    code = F.expr(_CODES)
    return d.load(spark, sf, "customer").select("c_custkey", text.uic_code(code).alias("uic"), text.first_digits(code).alias("clean"))


@query(r"""SELECT o_orderkey, coalesce(nullif(regexp_extract('EUROSTAR_' || o_orderkey || '-x', '(\d{3,5})', 1), ''), 'EUROSTAR_' || o_orderkey || '-x') AS first_no,
  CASE WHEN o_orderkey % 3 = 0 THEN regexp_replace(lpad(CAST(o_orderkey AS VARCHAR), 7, '0'), '^0+([0-9])', '\1') WHEN o_orderkey % 3 = 1 THEN o_orderpriority
  ELSE regexp_replace(regexp_extract('t' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0'), '(\d{4,5})', 1), '^0+([0-9])', '\1') END AS short_no FROM orders""")
def train_numbers(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    short = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), F.lpad(key, 7, "0"))).when(F.col("o_orderkey") % 3 == 1, F.col("o_orderpriority")).otherwise("  ")
    return d.load(spark, sf, "orders").select(
        "o_orderkey", text.first_train_number(F.concat(F.lit("EUROSTAR_"), key, F.lit("-x"))).alias("first_no"), text.short_or_train_number(short, F.concat(F.lit("t"), F.lpad(key, 6, "0"))).alias("short_no")
    )


def _upper_holds(text: str, *parts: str) -> str:
    return "(" + " OR ".join(f"contains(upper({text}), '{p}')" for p in parts) + ")"


#: The type rules once more, written out for the SQL side.
def _by_stop_id(x: str) -> str:
    h = functools.partial(_upper_holds, x)
    return f"""CASE WHEN {h('TGV')} OR {h('INOUI')} THEN 'TGV InOui' WHEN {h('OUIGO')} THEN 'OUIGO' WHEN {h('TER')} THEN 'TER' WHEN {h('INTERCITES', 'INTERCITÉS')} THEN 'Intercités'
  WHEN {h('ICE')} THEN 'ICE' WHEN {h('TRANSILIEN', 'RER')} THEN 'Transilien' WHEN {h('EUROSTAR', 'THALYS')} THEN 'Eurostar' END"""


def _by_stop_name(x: str, otherwise: str) -> str:
    h = functools.partial(_upper_holds, x)
    return f"""CASE WHEN {h('CAR TER')} THEN 'Car TER' WHEN {h('CAR À RÉSERVATION', 'CAR A RESERVATION')} THEN 'Car à réservation' WHEN {h('EUROSTAR')} THEN 'Eurostar' WHEN {h('ICE')} THEN 'ICE'
  WHEN {h('INTERCITÉS', 'INTERCITES')} THEN 'INTERCITES' WHEN {h('LYRIA')} THEN 'Lyria' WHEN {h('OUIGO')} THEN 'OUIGO' WHEN {h('INOUI', 'TGV')} THEN 'TGV INOUI'
  WHEN {h('TRAMTRAIN', 'TRAM TRAIN')} THEN 'TramTrain' WHEN {h('TER')} THEN 'Train TER' ELSE {otherwise} END"""


def _by_agency(x: str, otherwise: str) -> str:
    return f"CASE WHEN contains(upper({x}), 'EUROSTAR_CONTINENTAL') THEN 'Thalys' WHEN contains(upper({x}), 'EUROSTAR_CHANNEL') THEN 'Eurostar' ELSE {otherwise} END"


def _by_route_names(x: str, otherwise: str) -> str:
    h = functools.partial(_upper_holds, x)
    return f"""CASE WHEN {h('AVE')} THEN 'AVE' WHEN {h('AVLO')} THEN 'Avlo' WHEN {h('ALVIA')} THEN 'Alvia' WHEN {h('EUROMED')} THEN 'Euromed' WHEN {h('INTERCITY')} THEN 'Intercity'
  WHEN {h('MD', 'MEDIA')} THEN 'Media Distancia' WHEN {h('CERCANIAS', 'RODALIES')} THEN 'Cercanías' WHEN {h('REGIONAL')} THEN 'Regional' WHEN {h('TRENCELTA')} THEN 'Tren Celta' ELSE {otherwise} END"""


_TYPED = f"SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, {d.typed_stop_id('l_suppkey')} AS stop_id, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem"
_FIRST = "(l_linenumber, l_partkey, l_suppkey, l_quantity)"


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    """Calls with their place in the trip."""
    return d.load(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("trip_id"), "l_suppkey", F.expr(d.LINE_ROW).alias("_row"))


def _first_types(spark: SparkSession, sf: str, rule_set: rules.Rules, otherwise: int | None) -> DataFrame:
    """trip_id and the type (value) of its first call that has one: each stop is classified once, calls carry the rule's number.

    The map of stops is written before it is filtered: else the optimizer applies the rules to every call too, to filter them by the join's key.
    """
    calls = _typed(spark, sf)
    number = rules.index_of(rule_set, F.expr(d.typed_stop_id("l_suppkey")))
    stops = calls.select("l_suppkey").distinct().select("l_suppkey", (number if otherwise is None else F.coalesce(number, F.lit(otherwise))).alias("rule"))
    return lookups.first_label(calls.join(written(stops, "types").filter("rule IS NOT NULL"), "l_suppkey"), "trip_id", F.col("rule"), [*rules.labels_of(rule_set), "Car TER"], "_row")


_TRIP_TYPES = f"SELECT trip_id, arg_min(ty, {_FIRST}) AS train_type FROM (SELECT *, {_by_stop_id('stop_id')} AS ty FROM ({_TYPED})) WHERE ty IS NOT NULL GROUP BY trip_id"


@query(_TRIP_TYPES)
def train_types_by_stop(spark: SparkSession, sf: str) -> DataFrame:
    return _first_types(spark, sf, rules.STOP_ID_RULES, None).withColumnRenamed("value", "train_type")


@query(f"""WITH tt AS ({_TRIP_TYPES}), r AS (SELECT route_id, arg_min(train_type, row_no) AS train_type FROM ({d.TRIPS}) JOIN tt USING (trip_id) GROUP BY route_id)
SELECT CAST(c_custkey AS VARCHAR) AS route_id, coalesce(train_type, 'Train SNCF') AS train_type FROM customer LEFT JOIN r ON r.route_id = CAST(c_custkey AS VARCHAR)""")
def train_types_by_route(spark: SparkSession, sf: str) -> DataFrame:
    names = rules.labels_of(rules.STOP_ID_RULES)
    number = F.array_position(F.array(*map(F.lit, names)), F.col("train_type")) - 1
    typed = d.trips(spark, sf).join(train_types_by_stop(spark, sf), "trip_id")
    of_routes = lookups.first_label(typed, "route_id", number, names, "_row")
    routes = d.load(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("route_id"))
    return routes.join(of_routes, "route_id", "left").select("route_id", F.coalesce("value", F.lit("Train SNCF")).alias("train_type"))


@query(f"""WITH f AS (SELECT trip_id, arg_min({_by_stop_name('stop_id', "'Car TER'")}, {_FIRST}) AS ty FROM ({_TYPED}) GROUP BY trip_id)
SELECT t.trip_id, coalesce(ty, {_by_agency(f"coalesce({d.agency('CAST(route_id AS BIGINT)')}, '')", "'Car TER'")}) AS train_type FROM ({d.TRIPS}) t LEFT JOIN f USING (trip_id)""")
def train_types_two_level(spark: SparkSession, sf: str) -> DataFrame:
    """First stop's type, else the type of the route's agency (JON-09, AGG-03)."""
    defaults = F.array(F.lit("Car TER"))
    first = _first_types(spark, sf, rules.STOP_NAME_RULES, len(rules.STOP_NAME_RULES))
    agency = F.coalesce(F.expr(d.agency("CAST(route_id AS BIGINT)")), F.lit(""))
    trips = d.trips(spark, sf).withColumn("by_agency", rules.type_of_agency_or_stop(agency, F.lit(""), defaults))
    return trips.join(first, "trip_id", "left").select("trip_id", F.coalesce("value", "by_agency").alias("train_type"))


_AGENCY = f"coalesce({d.agency('c_custkey')}, '')"


@query(f"""SELECT c_custkey, CASE WHEN contains(upper({_AGENCY}), 'CHANNEL') THEN 'EUROSTAR CHANNEL' WHEN contains(upper({_AGENCY}), 'CONTINENTAL') THEN 'EUROSTAR CONTINENTAL' ELSE 'EUROSTAR' END AS single,
CASE WHEN contains(upper({_AGENCY}), 'THALYS') THEN 'Eurostar (ex-Thalys)' ELSE 'Eurostar' END AS merged,
{_by_route_names(f"'R ' || coalesce({d.long_name('c_custkey')}, 'nan') || ' ' || c_custkey", f"coalesce(nullif(trim(coalesce({d.long_name('c_custkey')}, 'nan')), ''), 'Train Renfe')")} AS by_name FROM customer""")
def route_types_by_rules(spark: SparkSession, sf: str) -> DataFrame:
    agency = F.coalesce(F.expr(d.agency("c_custkey")), F.lit(""))
    return d.load(spark, sf, "customer").select(
        "c_custkey", rules.type_of_single_feed_agency(agency).alias("single"), rules.type_of_merged_agency(agency).alias("merged"),
        rules.type_of_route_names(F.lit("R"), F.expr(d.long_name("c_custkey")), F.col("c_custkey").cast("string")).alias("by_name"),
    )


@query("SELECT 'A_' || c_name AS stop_id, 'A' AS operator_id FROM customer UNION ALL SELECT 'B_' || s_name, 'B' FROM supplier UNION ALL SELECT 'C_' || CASE WHEN p_partkey % 10 <> 0 THEN p_name END, 'C' FROM part")
def prefixed_union(spark: SparkSession, sf: str) -> DataFrame:
    names = [("A", "customer", F.col("c_name")), ("B", "supplier", F.col("s_name")), ("C", "part", F.when(F.col("p_partkey") % 10 != 0, F.col("p_name")))]
    return lookups.union_all([lookups.with_lineage(d.load(spark, sf, t).select(c.alias("stop_id")), op, "stop_id") for op, t, c in names])


_STATIONS = """SELECT c_custkey AS _row, CAST(c_custkey % 700 AS {s}) AS id, CASE WHEN c_custkey % 11 = 0 THEN ' ' WHEN c_custkey % 13 <> 0 THEN c_name END AS name,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 50 AS {s}) WHEN c_custkey % 17 = 0 THEN 'none' END AS parent_station_id, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment WHEN c_custkey % 4 = 1 THEN '' END AS parent_station_name,
  CASE WHEN c_custkey % 5 = 0 THEN 'City ' || (c_custkey % 20) END AS city, CASE WHEN c_custkey % 6 <> 0 THEN ' fr' || (c_custkey % 3) END AS country,
  CASE WHEN c_custkey % 2 = 0 THEN ' ' || (7000000 + c_custkey % 400) ELSE CAST(c_custkey AS {s}) END AS uic, CASE WHEN c_custkey % 3 = 0 THEN CAST(87000000 + c_custkey % 500 AS {s}) END AS uic8_sncf,
  CAST(c_acctbal AS {s}) AS latitude, CAST(NULL AS {s}) AS longitude FROM customer"""


@query(f"""WITH s AS ({_STATIONS.format(s='VARCHAR')}), f AS (SELECT * FROM s WHERE trim(coalesce(name, '')) <> ''),
n AS (SELECT id, arg_max(ROW(name), _row) AS v, arg_max(ROW(parent_station_id), _row) AS p FROM s GROUP BY id),
j AS (SELECT f.*, CASE WHEN n2.id IS NOT NULL THEN n2.v[1] ELSE coalesce(parent_station_name, city) END AS chain, n2.id IS NOT NULL AND n2.v[1] IS NULL AS nameless FROM f LEFT JOIN n n1 ON n1.id = f.id LEFT JOIN n n2 ON n2.id = n1.p[1]),
k AS (SELECT *, trim(coalesce(uic, '')) AS u7, trim(coalesce(uic8_sncf, '')) AS u8 FROM j),
x AS (SELECT *, unnest([nullif(u7, ''), CASE WHEN length(u7) = 7 THEN '8' || u7 END, nullif(u8, ''), CASE WHEN length(u8) = 8 AND u8[1] = '8' THEN u8[2:] END]) AS code, unnest([0, 1, 2, 3]) AS pos FROM k)
SELECT code, arg_max(name, (_row, pos)) AS name, arg_max(ROW(CASE WHEN nameless OR trim(coalesce(chain, '')) <> '' THEN chain ELSE name END), (_row, pos))[1] AS parent_name, arg_max(left(upper(trim(coalesce(country, ''))), 2), (_row, pos)) AS country FROM x WHERE code IS NOT NULL GROUP BY code""")
def station_reference(spark: SparkSession, sf: str) -> DataFrame:
    d.load(spark, sf, "customer").createOrReplaceTempView("_rw_customer")
    stations = spark.sql(_STATIONS.format(s="STRING").replace("FROM customer", "FROM _rw_customer"))
    return lookups.station_keys(stations).select("code", "name", "parent_name", "country")


@query(f"""WITH s AS ({_STATIONS.format(s='VARCHAR')}), k AS (SELECT trim(coalesce(uic, '')) AS u7, trim(coalesce(uic8_sncf, '')) AS u8 FROM s WHERE trim(coalesce(name, '')) <> '')
SELECT count(*) AS n_keys FROM (SELECT u7 AS code FROM k UNION SELECT '8' || u7 FROM k WHERE length(u7) = 7 UNION SELECT u8 FROM k UNION SELECT u8[2:] FROM k WHERE length(u8) = 8 AND u8[1] = '8') WHERE code <> ''""")
def station_key_count(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.key_count(station_reference(spark, sf))


_METRES = "6371000.0 * 2.0 * atan2(sqrt(h), sqrt(1.0 - h))"
_PAIRS = f"""SELECT a, b, metres FROM (SELECT *, {_METRES} AS metres FROM (SELECT x.ord AS a, y.ord AS b,
  pow(sin(radians(y.stop_lat - x.stop_lat) / 2.0), 2) + cos(radians(x.stop_lat)) * cos(radians(y.stop_lat)) * pow(sin(radians(y.stop_lon - x.stop_lon) / 2.0), 2) AS h
  FROM s x JOIN s y ON x.ord < y.ord AND (contains(x.norm_name, y.norm_name) OR contains(y.norm_name, x.norm_name)))) WHERE metres <= 100"""


@query(f"WITH s AS ({d.GEO_STOPS}) SELECT a, b, round(metres, 3) AS metres FROM ({_PAIRS})")
def geo_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.near_pairs(d.geo_stops(spark, sf)).select("a", "b", F.round("metres", 3).alias("metres"))


#: One stop a step, carrying the list of founders.
_RESOLVED = f"""
s AS MATERIALIZED ({d.GEO_STOPS}), i AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY ord) AS i FROM s), p AS MATERIALIZED ({_PAIRS}),
g AS MATERIALIZED (SELECT y.i AS i, list(x.i) AS near FROM p JOIN i x ON x.ord = p.a JOIN i y ON y.ord = p.b GROUP BY y.i),
u AS MATERIALIZED (SELECT y.i AS i, list(x.i) AS code FROM i x JOIN i y ON x.uic = y.uic AND x.uic <> '' AND x.i < y.i GROUP BY y.i),
e AS MATERIALIZED (SELECT i.i, coalesce(near, []) AS near, coalesce(code, []) AS code FROM i LEFT JOIN g USING (i) LEFT JOIN u USING (i)),
r(i, f) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL SELECT e.i, CASE WHEN len(list_intersect(f, list_concat(near, code))) > 0 THEN f ELSE list_append(f, e.i) END FROM r JOIN e ON e.i = r.i + 1),
l AS (SELECT f FROM r ORDER BY i DESC LIMIT 1),
h AS (SELECT i.*, list_contains(f, i.i) AS founds, list_min(list_intersect(f, code)) AS by_code, list_min(list_intersect(f, near)) AS by_place, f FROM i JOIN e USING (i), l),
o AS (SELECT *, CASE WHEN founds THEN 'founder' WHEN by_code IS NOT NULL THEN 'uic' ELSE 'geo' END AS how, CASE WHEN founds THEN i ELSE coalesce(by_code, by_place) END AS founder FROM h),
c AS (SELECT o.*, CASE WHEN q.uic <> '' THEN 'CANONICAL_UIC_' || q.uic ELSE 'CANONICAL_STOP_' || lpad(CAST(list_position(o.f, o.founder) AS VARCHAR), 6, '0') END AS canonical_id FROM o JOIN i q ON q.i = o.founder)"""


@query(f"WITH RECURSIVE {_RESOLVED} SELECT operator_id, raw_stop_id, canonical_id FROM c")
def stop_map(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.stop_map(resolve.resolve(d.geo_stops(spark, sf)))


@query(f"""WITH RECURSIVE {_RESOLVED} SELECT canonical_id AS stop_id, any_value(raw_name) FILTER (WHERE founds) AS stop_name, any_value(uic) FILTER (WHERE founds) AS uic,
CAST(max(CASE WHEN upper(operator_id) = 'SNCF' THEN 1 ELSE 0 END) AS INTEGER) AS sncf, CAST(max(CASE WHEN upper(operator_id) = 'EUROSTAR' THEN 1 ELSE 0 END) AS INTEGER) AS eurostar, CAST(max(CASE WHEN upper(operator_id) = 'RENFE' THEN 1 ELSE 0 END) AS INTEGER) AS renfe,
string_agg(operator_id || ':' || raw_stop_id, ', ' ORDER BY ord) AS source_stop_ids FROM c GROUP BY canonical_id""")
def canonical_stops(spark: SparkSession, sf: str) -> DataFrame:
    stops = resolve.canonical_stops(resolve.resolve(d.geo_stops(spark, sf)))
    return stops.select("stop_id", "stop_name", "uic", "sncf", "eurostar", "renfe", F.array_join("source_stop_ids", ", ").alias("source_stop_ids"))


@query(f"WITH RECURSIVE {_RESOLVED} SELECT count(*) AS total_raw_stops, count(*) FILTER (WHERE how = 'founder') AS unique_canonical_stops, count(*) FILTER (WHERE how = 'uic') AS merges_uic, count(*) FILTER (WHERE how = 'geo') AS merges_geoloc FROM c")
def harmonize_report(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.report(resolve.resolve(d.geo_stops(spark, sf)))


@query(f"SELECT a.trip_id, a.stop_id AS origin, b.stop_id AS destination, CAST(a.dep_min AS INTEGER) AS dep_min FROM ({d.STOP_TIMES}) a JOIN ({d.STOP_TIMES}) b ON a.trip_id = b.trip_id AND a.stop_sequence < b.stop_sequence")
def od_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.connections(_typed_times(spark, sf).select("trip_id", "stop_id", "stop_sequence", "dep_min"))


@query(f"SELECT trip_id, stop_id, stop_sequence, CAST(dep_min AS INTEGER) AS dep_min FROM ({d.STOP_TIMES}) WHERE trip_id = '100'")
def trip_itinerary(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.itinerary(_typed_times(spark, sf), "100").select("trip_id", "stop_id", "stop_sequence", "dep_min")


_STOPS = "SELECT c_name AS stop_name, '87' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS uic, n_name AS country, r_name AS parent_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"


def _stops(spark: SparkSession, sf: str) -> DataFrame:
    nations = d.load(spark, sf, "nation").join(d.load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = d.load(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("c_name").alias("stop_name"), F.concat(F.lit("87"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("uic"), F.col("n_name").alias("country"), F.col("r_name").alias("parent_name"))


@query(f"SELECT country, count(*) AS n_stops FROM ({_STOPS}) GROUP BY country")
def stops_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.by_country(_stops(spark, sf))


@query(f"SELECT parent_name, count(*) AS n_stops FROM ({_STOPS}) GROUP BY parent_name")
def stops_by_parent(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.by_parent(_stops(spark, sf))


@query(f"SELECT * FROM ({_STOPS}) WHERE uic = '87000042'")
def stop_by_uic(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.by_code(_stops(spark, sf), "87000042")


@query(f"SELECT * FROM ({_STOPS}) WHERE starts_with(stop_name, 'Customer#00000001')")
def stop_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return timetable.by_name(_stops(spark, sf), "Customer#00000001")


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS route_id, trip_id, service_id FROM customer JOIN ({d.TRIPS}) ON route_id = CAST(c_custkey AS VARCHAR)")
def route_trips(spark: SparkSession, sf: str) -> DataFrame:
    routes = d.load(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("route_id"))
    return timetable.trips_of(d.trips(spark, sf), routes).select("route_id", "trip_id", "service_id")


@query(f"SELECT trip_id, route_id FROM ({d.TRIPS}) WHERE service_id IN (SELECT service_id FROM ({d.CALENDAR}) WHERE date = '1998-10-05' AND exception_type = 1)")
def service_on_date(spark: SparkSession, sf: str) -> DataFrame:
    days = lookups.service_days(lookups.calendar_window(d.calendar(spark, sf), d.START), d.START)
    return timetable.running_in(d.trips(spark, sf), days, "1998-10-05", d.START).select("trip_id", "route_id")


_DAYS = "SELECT CAST(o_custkey AS VARCHAR) AS service_id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS exception_type FROM orders"


@query(f"""SELECT service_id, count(DISTINCT date) AS n_listed, count(DISTINCT date) FILTER (WHERE exception_type = 1) AS n_added, count(DISTINCT date) FILTER (WHERE exception_type = 2) AS n_removed,
  min(date) FILTER (WHERE exception_type = 1) AS first_day FROM ({_DAYS}) WHERE {_WINDOW} GROUP BY service_id""")
def days_per_service(spark: SparkSession, sf: str) -> DataFrame:
    """How many days of the window list, add and remove a service (one a customer here), and its first day, from its bitmaps."""
    dates = d.calendar(spark, sf).select(F.col("service_id").cast("long").alias("o_orderkey"), "date", "exception_type")
    dates = dates.join(d.load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("service_id")), "o_orderkey")
    days = lookups.service_days(lookups.calendar_window(dates, d.START), d.START)
    first = F.expr(f"CASE WHEN added <> 0 THEN date_format(date_add(DATE '{d.START}', CAST(bit_count((added & -added) - 1) AS INT)), 'yyyy-MM-dd') END")
    return days.select("service_id", *(F.bit_count(c).cast("long").alias(f"n_{c}") for c in ("listed", "added", "removed")), first.alias("first_day"))


@query("SELECT l_orderkey || '-' || l_linenumber AS stop_time_id, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def pk_audit(spark: SparkSession, sf: str) -> DataFrame:
    rows = d.load(spark, sf, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("stop_time_id"))
    return lookups.duplicate_keys(rows, "stop_time_id")


@query(f"SELECT trip_id, stop_id, stop_sequence FROM ({d.STOP_TIMES}) WHERE trip_id NOT IN (SELECT service_id FROM ({d.CALENDAR}) WHERE {_WINDOW})")
def orphan_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Stop times whose trip is not active: they stay in the tables, and this finds them."""
    services = lookups.active_services(lookups.calendar_window(d.calendar(spark, sf), d.START), d.START)
    return lookups.orphans(_typed_times(spark, sf), lookups.of_active(d.trips(spark, sf), services), "trip_id").select("trip_id", "stop_id", "stop_sequence")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS value, CAST(c_custkey AS INTEGER) AS whole FROM customer")
def lenient_numbers(spark: SparkSession, sf: str) -> DataFrame:
    c = d.load(spark, sf, "customer")
    written = F.when(F.col("c_custkey") % 3 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    return c.select("c_custkey", times.lenient_double(written).alias("value"), times.strict_int(F.concat(F.lit(" "), F.col("c_custkey").cast("string"))).alias("whole"))


@query(f"""WITH s AS ({d.GEO_STOPS}) SELECT raw_stop_id, round(coalesce({_METRES}, 'inf'::DOUBLE), 2) AS metres FROM (SELECT raw_stop_id,
  pow(sin(radians(48.8443 - stop_lat) / 2.0), 2) + cos(radians(stop_lat)) * cos(radians(48.8443)) * pow(sin(radians(2.3744 - stop_lon) / 2.0), 2) AS h FROM s)""")
def distance_to_point(spark: SparkSession, sf: str) -> DataFrame:
    return d.geo_stops(spark, sf).select("raw_stop_id", F.round(geo.haversine_m(F.col("stop_lat"), F.col("stop_lon"), F.lit(48.8443), F.lit(2.3744)), 2).alias("metres"))


@query(SQL["od_pairs"])
def od_pairs_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-05, IQ-2: od_pairs over a table of stop times in buckets by trip, which joins itself without a shuffle."""
    table = sinks.save_bucketed(_typed_times(spark, sf).select("trip_id", "stop_id", "stop_sequence", "dep_min"), scratch(spark, "bucketed"), "trip_id", ["stop_sequence"])
    return timetable.connections(spark.table(table))


@query(SQL["orphan_audit"])
def orphan_audit_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-05, CHK-02: orphan_audit over stop times and trips in buckets by trip, which meet without a shuffle."""
    services = lookups.active_services(lookups.calendar_window(d.calendar(spark, sf), d.START), d.START)
    active = lookups.of_active(d.trips(spark, sf), services)
    child, parent = (sinks.save_bucketed(df, scratch(spark, name), "trip_id", []) for df, name in ((_typed_times(spark, sf).select("trip_id", "stop_id", "stop_sequence"), "times"), (active.select("trip_id"), "trips")))
    return lookups.orphans(spark.table(child), spark.table(parent), "trip_id")


QUERIES |= feed_queries.QUERIES
SQL |= feed_queries.oracle(_by_stop_id, _by_route_names, _by_agency, _by_stop_name)
