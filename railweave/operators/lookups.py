"""Joins, filters and ordered aggregations (JON-*, FLT-*, AGG-*, CHK-*).

Order matters to several of them: "first" and "last" follow explicit ordinals of the source, never the order of partitions.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from railweave.functions.text import code_variants, country_code, prefixed
from railweave.functions.times import in_window, iso_date, strict_int


def mapped_stop(times: DataFrame, stop_map: DataFrame) -> DataFrame:
    """JON-01: stop_id becomes the canonical stop of (operator_id, stop_id), or stays as it is; null reads 'nan'.

    Stop times keep their place: the map is small next to them and is broadcast by Spark when its size allows.
    """
    m = stop_map.select(F.col("operator_id").alias("_op"), F.col("raw_stop_id").alias("_raw"), F.col("canonical_id").alias("_canonical"))
    raw = F.coalesce("stop_id", F.lit("nan"))
    return times.join(m, (F.col("operator_id") == F.col("_op")) & (raw == F.col("_raw")), "left").withColumn("stop_id", F.coalesce("_canonical", raw)).drop("_op", "_raw", "_canonical")


def first_by(df: DataFrame, key: str, value: Column | str, order: Sequence[Column | str], skip_null: bool = True) -> DataFrame:
    """AGG-01 to AGG-03: a key's first value in the given order; partial results are combined map-side.

    An integer value with one long to order by fits a hash aggregate's fixed-width buffers; other values or orders are sorted.
    """
    value = F.col(value) if isinstance(value, str) else value
    rows = df.withColumn("_value", value)
    if skip_null:
        rows = rows.filter(F.col("_value").isNotNull())
    kinds = dict(rows.select(F.col(key), "_value", *(F.col(o).alias(f"_o{i}") if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(order))).dtypes)
    if skip_null and len(order) == 1 and kinds["_value"] in ("int", "bigint") and kinds["_o0"] in ("int", "bigint"):
        return rows.groupBy(key).agg(F.min_by("_value", order[0]).alias("value"))
    return rows.groupBy(key).agg(F.min_by(F.struct("_value"), F.struct(*order))["_value"].alias("value"))


def first_label(df: DataFrame, key: str, rule: Column, labels: Sequence[str], order: str) -> DataFrame:
    """first_by for the number of a rule (functions.rules.index_of); value is the rule's label."""
    first = first_by(df, key, rule, [order])
    return first.withColumn("value", F.element_at(F.array(*map(F.lit, labels)), F.col("value").cast("int") + 1))


def times_of_stop(times: DataFrame, stop_map: DataFrame, stop_id: str) -> DataFrame:
    """JON-01 for one canonical stop: the stop times that map to it, with it as their stop_id.

    Only the map's rows that name the stop, as a canonical or as a raw one, meet the stop times, in one scan of these: a stop time is
    kept where its raw id maps to the stop, or is the stop's own id and the map has nothing for it.
    """
    m = stop_map.filter((F.col("canonical_id") == stop_id) | (F.col("raw_stop_id") == stop_id)).select(F.col("operator_id").alias("_op"), F.col("raw_stop_id").alias("_raw"), F.col("canonical_id").alias("_canonical"))
    raw = F.coalesce("stop_id", F.lit("nan"))
    hit = times.join(m, (F.col("operator_id") == F.col("_op")) & (raw == F.col("_raw")), "left").filter(F.coalesce("_canonical", raw) == stop_id)
    return hit.select(*times.columns).withColumn("stop_id", F.lit(stop_id))


def last_by(df: DataFrame, keys: Sequence[str], value: Column, order: Sequence[Column | str]) -> DataFrame:
    """AGG-08: a key's last value in the given order (a mapping that is written again and again)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(value.alias("value")), F.struct(*order))["value"].alias("value"))


def active_services(calendar: DataFrame, start: str | None = None, days: int = 60) -> DataFrame:
    """FLT-01, AGG-04: distinct services with a date in the window, whatever its exception type."""
    return calendar.filter(in_window(F.col("date"), start, days)).select("service_id").distinct()


def calendar_window(calendar: DataFrame, start: str | None = None, days: int = 60) -> DataFrame:
    """DAT-01, FLT-01, NUM-03: ISO dates inside the window, with whole exception types.

    A date is parsed once: behind the explode of its one value the filter's comparisons don't each repeat the parsing.
    """
    once = calendar.select("*", F.explode(F.array(iso_date(F.col("date")))).alias("_iso")).filter(in_window(F.col("_iso"), start, days))
    dated = once.withColumn("date", F.col("_iso")).drop("_iso")
    return dated.withColumn("exception_type", strict_int(F.col("exception_type")))


#: Days that a bitmap of days holds at most.
MOST_DAYS = 63


def service_days(calendar: DataFrame, start: str, days: int = 60) -> DataFrame:
    """FLT-01, AGG-04: one row a service: bitmaps of the days from start on that list it (whatever the exception type), add or remove it.

    Bit k is the day k after start. The bits are combined map-side into three longs a service, and what is asked of a calendar afterwards (is a
    service active, does it run on a date, how often) is a test of bits in a table of one row a service.
    """
    if not 0 <= days < MOST_DAYS:
        raise ValueError(f"a window of {days} days does not fit in a bitmap")
    dated = calendar.filter(in_window(F.col("date"), start, days))
    bit = F.expr(f"shiftleft(1L, datediff(CAST(date AS DATE), DATE '{start}'))")
    of = lambda kind: F.coalesce(F.bit_or(F.when(F.col("exception_type") == kind, bit)), F.lit(0).cast("long"))
    return dated.groupBy("service_id").agg(F.bit_or(bit).alias("listed"), of(1).alias("added"), of(2).alias("removed"))


def runs_on(bitmap: Column, date: str, start: str) -> Column:
    """Whether a bitmap of days from start on has a date."""
    after = (datetime.date.fromisoformat(date) - datetime.date.fromisoformat(start)).days
    return F.lit(False) if not 0 <= after < MOST_DAYS else bitmap.bitwiseAND(F.lit(1 << after)) != 0


def of_active(trips: DataFrame, services: DataFrame) -> DataFrame:
    """FLT-02: trips of active services; all trips where no service is active."""
    if not services.take(1):
        return trips
    return trips.join(services.select("service_id"), "service_id", "left_semi").select(*trips.columns)


def station_keys(stations: DataFrame) -> DataFrame:
    """CND-01, JON-06, STR-07, STR-08, AGG-08: per code the station written last: code, name, parent_name, country, lat, lon."""
    full = stations.filter(F.regexp_replace(F.coalesce("name", F.lit("")), r"^\s+|\s+$", "") != "")
    names = last_by(stations.filter("id IS NOT NULL"), ["id"], F.col("name"), ["_row"]).select(F.col("id").alias("_pid"), F.struct(F.col("value").alias("name")).alias("_pname"))
    parents = last_by(stations.filter("id IS NOT NULL"), ["id"], F.col("parent_station_id"), ["_row"]).select(F.col("id").alias("_id"), F.col("value").alias("_parent"))
    joined = full.join(parents, full["id"] == F.col("_id"), "left").join(names, F.col("_parent") == F.col("_pid"), "left")
    chain = F.when(F.col("_pname").isNotNull(), F.col("_pname.name")).otherwise(F.coalesce("parent_station_name", "city"))
    nameless = F.col("_pname").isNotNull() & F.col("_pname.name").isNull()  # a parent without a name leaves the value missing
    parent = F.when(nameless | (F.regexp_replace(F.coalesce(chain, F.lit("")), r"^\s+|\s+$", "") != ""), chain).otherwise(F.col("name"))
    info = F.struct("name", parent.alias("parent_name"), country_code(F.col("country")).alias("country"), F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    keyed = joined.select("_row", info.alias("info"), F.posexplode(code_variants(F.col("uic"), F.col("uic8_sncf"))).alias("_pos", "code"))
    return last_by(keyed, ["code"], F.col("info"), ["_row", "_pos"]).select("code", "value.*")


def key_count(keys: DataFrame) -> DataFrame:
    """AGG-09: how many codes the reference has."""
    return keys.agg(F.count_distinct("code").alias("n_keys"))


def with_station(stops: DataFrame, keys: DataFrame) -> DataFrame:
    """JON-05: names and country of the station with a stop's code, where there is one; coordinates stay the stop's own."""
    k = keys.select(F.col("code").alias("_code"), F.struct("name", "parent_name", "country").alias("_station"))
    hit = F.col("_station").isNotNull()
    return stops.join(k, (F.col("uic") == F.col("_code")) & (F.col("uic") != ""), "left").withColumns({
        "stop_name": F.when(hit, F.col("_station.name")).otherwise(F.col("stop_name")),
        "parent_name": F.when(hit, F.col("_station.parent_name")).otherwise(F.col("parent_name")),
        "country": F.when(hit, F.col("_station.country")).otherwise(F.col("country")),
    }).drop("_code", "_station")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """SNK-03, SET-01."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def with_lineage(df: DataFrame, operator: str, *ids: str) -> DataFrame:
    """PRJ-01, PRJ-02: prefixed ids and the operator's id."""
    return df.withColumns({c: prefixed(operator, F.col(c)) for c in ids} | {"operator_id": F.lit(operator)})


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """CHK-01: keys that occur more than once; several nulls are allowed."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """df; raises if CHK-01 finds a key."""
    if bad := duplicate_keys(df, key).take(1):
        raise ValueError(f"{key} {bad[0][0]!r} occurs {bad[0]['n']} times")
    return df


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """CHK-02: rows whose key the parent lacks."""
    return child.join(parent.select(key), key, "left_anti")
