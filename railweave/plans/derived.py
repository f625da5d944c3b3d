"""Feed-shaped tables projected from the star-schema test tables, and the same projections in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: First day of the window that the test calendar is read by.
START = "1998-10-01"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def calendar_columns() -> dict[str, Column]:
    """What `calendar` makes of an order."""
    return {
        "service_id": F.col("o_orderkey").cast("string"),
        "date": F.when(F.col("o_orderkey") % 97 == 0, "19981399").otherwise(F.date_format("o_orderdate", "yyyyMMdd")),
        "exception_type": F.when(F.col("o_orderkey") % 5 == 0, " 2").otherwise("1 "),
    }


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One service per order, running on its day; every fifth service is a removal, every 97th date is no date."""
    return load(spark, sf_dir, "orders").select(*(c.alias(n) for n, c in calendar_columns().items()))


CALENDAR = """SELECT CAST(o_orderkey AS VARCHAR) AS service_id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
  CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS exception_type FROM orders"""


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("trip_id"), F.col("o_custkey").cast("string").alias("route_id"), F.col("o_orderkey").cast("string").alias("service_id"), F.col("o_orderpriority").alias("trip_headsign"), F.col("o_orderkey").alias("_row"),
    )


TRIPS = "SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id, CAST(o_orderkey AS VARCHAR) AS service_id, o_orderpriority AS trip_headsign, o_orderkey AS row_no FROM orders"


def departure() -> Column:
    """A line item's departure; hours go beyond 24, and every 101st departure is missing."""
    minute = F.col("l_partkey") * 7 % 1600
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.when(F.col("l_partkey") % 101 != 0, F.concat(two(F.expr("(l_partkey * 7 % 1600) div 60")), F.lit(":"), two(minute % 60), F.lit(":00")))


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call per line item."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("stop_id"), F.col("l_linenumber").cast("string").alias("stop_sequence"),
        departure().alias("departure_time"), F.lit("SNCF").alias("operator_id"), "l_partkey", "l_quantity", "l_extendedprice",
    )


STOP_TIMES = """SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, 'S' || l_suppkey AS stop_id, l_linenumber AS stop_sequence,
  CASE WHEN l_partkey % 101 = 0 THEN 0 ELSE l_partkey * 7 % 1600 END AS dep_min, l_suppkey, l_partkey, l_quantity, l_extendedprice FROM lineitem"""


def stop_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of four suppliers are canonical stops."""
    return load(spark, sf_dir, "supplier").filter("s_suppkey % 4 <> 0").select(
        F.lit("SNCF").alias("operator_id"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("raw_stop_id"), F.concat(F.lit("CANONICAL_UIC_"), F.lpad(F.col("s_suppkey").cast("string"), 8, "8")).alias("canonical_id")
    )


STOP_MAP = "SELECT 'S' || s_suppkey AS raw_stop_id, 'CANONICAL_UIC_' || lpad(CAST(s_suppkey AS VARCHAR), 8, '8') AS canonical_id FROM supplier WHERE s_suppkey % 4 <> 0"

_TYPED_ID = "CASE {k} % 9 WHEN 0 THEN 'StopPoint:OCETGV INOUI-' WHEN 1 THEN 'StopPoint:OCEOUIGO-' WHEN 2 THEN 'StopPoint:OCETrain TER-' WHEN 3 THEN 'StopPoint:OCEINTERCITES-' WHEN 4 THEN 'StopPoint:OCEICE-' WHEN 5 THEN 'StopPoint:OCEThalys-' WHEN 6 THEN 'StopPoint:OCECar TER-' WHEN 7 THEN 'StopPoint:OCELyria-' ELSE 'StopArea:' END || {k}"


#: A line item's place in its order: number, part, supplier and quantity in one long (up to 2**28 parts and 2**24 suppliers).
LINE_ROW = "((CAST(l_linenumber AS BIGINT) * 268435456 + l_partkey) * 16777216 + l_suppkey) * 128 + CAST(l_quantity AS BIGINT)"


def typed_stop_id(key: str) -> str:
    """An SQL expression, alike in both engines: stop ids that name train types."""
    return _TYPED_ID.format(k=key)


_AGENCY = "CASE {k} % 5 WHEN 0 THEN 'EUROSTAR_CONTINENTAL' WHEN 1 THEN 'Eurostar_Channel' WHEN 2 THEN 'Thalys Belgium' WHEN 3 THEN 'OTHER' END"


def agency(key: str) -> str:
    return _AGENCY.format(k=key)


_LONG = "CASE {k} % 12 WHEN 0 THEN 'AVE Madrid' WHEN 1 THEN 'Avlo' WHEN 2 THEN 'Alvia' WHEN 3 THEN 'Euromed' WHEN 4 THEN 'InterCity' WHEN 5 THEN 'MD' WHEN 6 THEN 'Rodalies' WHEN 7 THEN 'Regional' WHEN 8 THEN 'TrenCelta' WHEN 9 THEN ' Costa ' WHEN 10 THEN '' END"


def long_name(key: str) -> str:
    return _LONG.format(k=key)


_GEO = {
    "stop_lat": "CASE WHEN vec_id % 13 <> 0 THEN 48.85 + 0.01 * CAST(e1 AS DOUBLE) END",
    "stop_lon": "CASE WHEN vec_id % 13 <> 0 THEN 2.35 + 0.01 * CAST(e2 AS DOUBLE) END",
    "uic": "CASE WHEN vec_id % 3 = 0 THEN '87' || lpad(CAST(vec_id % 40 AS VARCHAR(9)), 6, '0') ELSE '' END",
    "raw_name": "CASE vec_id % 6 WHEN 0 THEN 'Gare de Lyon' WHEN 1 THEN 'Lyon Part-Dieu' WHEN 2 THEN 'Lyon' WHEN 3 THEN 'Paris' WHEN 4 THEN 'Gare' ELSE 'Paris Nord' END",
    "norm_name": "CASE vec_id % 6 WHEN 0 THEN 'lyon' WHEN 1 THEN 'lyon part dieu' WHEN 2 THEN 'lyon' WHEN 3 THEN 'paris' WHEN 4 THEN '' ELSE 'paris nord' END",
    "operator_id": "CASE vec_id % 4 WHEN 0 THEN 'SNCF' WHEN 1 THEN 'EUROSTAR' WHEN 2 THEN 'Renfe' ELSE 'OTHER' END",
}


def geo_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops scattered over some kilometres: near and far, with and without codes and coordinates, in the order of ids within operators."""
    e = load(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding")[0].alias("e1"), F.col("embedding")[1].alias("e2"))
    return e.selectExpr("(vec_id % 4) * 1000000000 + vec_id AS ord", "CAST(vec_id AS STRING) AS raw_stop_id", *(f"{x.replace('VARCHAR(9)', 'STRING')} AS {n}" for n, x in _GEO.items()))


GEO_STOPS = f"SELECT (vec_id % 4) * 1000000000 + vec_id AS ord, CAST(vec_id AS VARCHAR) AS raw_stop_id, {', '.join(f'{x} AS {n}' for n, x in _GEO.items())} FROM (SELECT vec_id, embedding[1] AS e1, embedding[2] AS e2 FROM embeddings)"
