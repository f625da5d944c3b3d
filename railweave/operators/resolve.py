"""Entity resolution of stops (DED-01 to DED-04).

One by one and in order, a stop joins the canonical stop of its station code, else the earliest canonical stop within 100 m whose name
holds its own or is held by it, else it founds a canonical stop.

Stops of one name in one cube of 57 m are all near one another, so such a group has one founder at most, and what is compared is groups,
never their stops pair by pair. Groups with names that hold one another are found through an index of the names' three-letter pieces by
cell: the shorter name looks its rarest piece up, so a cell of very many stops costs what its matching names cost. Groups and codes
are the vertices of a graph, whose connected components don't depend on one another: whole components are dealt to tasks, which decide
their stops in order. A component of more than LAST stops is decided in parallel rounds instead: its founders are the lexicographically
first maximal independent set (Blelloch, Fineman and Shun, 2012), where a group's first open stop founds if no first open stop of a
neighbouring group or of its code is earlier. Rounds are tables in the shared folder.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from railweave.functions.geo import EARTH_M, around, cell, haversine_m, names_match
from railweave.functions.text import normalized_name, stop_uic
from railweave.functions.times import strict_double
from railweave.sources.session import ship, written

RADIUS_M = 100.0
#: Width of the ordinal ranges within which rows are numbered.
RANGE = 1 << 16
#: Stops of a component that one task decides, and about as many as a task gets in all.
LAST = 1 << 17
#: Stops of a group that a task pairs at once, about.
BLOCK = 1 << 12
#: Letters of the pieces by which names are looked up.
PIECE = 3


def raw_stops(stops: DataFrame, operator: str, op_idx: int) -> DataFrame:
    """PRJ-05: the eight fields that resolution needs, and the stop's place `ord` in the order of operators and rows."""
    missing = F.lit("nan")  # a missing id or name reads as this word
    raw_id = F.coalesce("stop_id", missing)
    name = F.coalesce("stop_name", missing)
    code = F.coalesce("stop_code", F.lit(""))
    return stops.select(
        (F.lit(op_idx).cast("long") * F.lit(1 << 40) + F.col("_row")).alias("ord"), F.lit(operator).alias("operator_id"), raw_id.alias("raw_stop_id"), code.alias("stop_code"), name.alias("raw_name"),
        strict_double(F.col("stop_lat")).alias("stop_lat"), strict_double(F.col("stop_lon")).alias("stop_lon"), stop_uic(code, raw_id).alias("uic"), normalized_name(name).alias("norm_name"),
    )


def numbered(df: DataFrame, order: str) -> DataFrame:
    """df with n = 1, 2, .. by a long column, counted in ranges of it so that no task sees all rows."""
    ranged = df.withColumn("_range", F.floor(F.col(order) / RANGE))
    before = ranged.groupBy("_range").agg(F.count("*").alias("_c"))
    before = before.select("_range", (F.sum("_c").over(Window.orderBy("_range")) - F.col("_c")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return ranged.withColumn("_own", own).join(before, "_range").withColumn("n", F.col("_before") + F.col("_own")).drop("_range", "_own", "_before")


def grouped(nodes: DataFrame, radius: float = RADIUS_M) -> DataFrame:
    """nodes with their group g, the name in a cube whose points are all within the radius; null without coordinates."""
    c = cell(F.col("stop_lat"), F.col("stop_lon"), radius * 0.9999 / math.sqrt(3))
    return nodes.withColumn("_c", c).withColumn("g", F.when(F.col("_c").isNotNull(), F.concat_ws(":", "_c.x", "_c.y", "_c.z", "norm_name"))).drop("_c")


def matching_groups(nodes: DataFrame, radius: float = RADIUS_M) -> DataFrame:
    """JON-08: (g, h), each pair once, of different groups with matching names (FLT-06) that have cubes within reach of one another."""
    placed = grouped(nodes, radius).filter("g IS NOT NULL").groupBy("g").agg(F.first("norm_name").alias("name"), F.first("stop_lat").alias("lat"), F.first("stop_lon").alias("lon"))
    cube = cell(F.col("lat"), F.col("lon"), radius * 0.9999 / math.sqrt(3))
    groups = placed.select("g", "name", cube.alias("c")).withColumn("d", F.struct(*(F.floor(F.col(f"c.{x}") / 2).alias(x) for x in "xyz")))
    at = F.expr(f"sequence(1, length(name) - {PIECE - 1})")
    long = F.length("name") >= PIECE
    pieces = F.when(long, F.array_distinct(F.transform(at, lambda i: F.substring("name", i, F.lit(PIECE))))).otherwise(F.array().cast("array<string>"))
    groups = written(groups.withColumn("pieces", pieces), "groups")
    common = groups.select(F.explode("pieces").alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))
    rare = groups.select("g", F.explode("pieces").alias("piece")).join(common, "piece").groupBy("g").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"))
    # a name of under three letters looks up the empty piece, which every name has
    short = groups.join(rare, "g", "left").select(F.col("g").alias("g1"), F.col("name").alias("name1"), F.col("c").alias("c1"), F.coalesce("piece", F.lit("")).alias("piece"), F.explode(around(F.col("d"))).alias("d"))
    index = groups.select("g", "name", "c", F.explode(F.array_append("pieces", F.lit(""))).alias("piece"), "d")
    reach = functools.reduce(Column.__and__, [F.abs(F.col(f"c.{x}") - F.col(f"c1.{x}")) <= 2 for x in "xyz"])
    once = (F.length("name1") < F.length("name")) | (F.col("name1") == F.col("name")) & (F.col("g1") < F.col("g"))
    return short.join(index, ["piece", "d"]).filter(F.contains("name", F.col("name1")) & once & reach).select(F.col("g1").alias("g"), F.col("g").alias("h"))


def near_pairs(nodes: DataFrame, radius: float = RADIUS_M, block: int = BLOCK) -> DataFrame:
    """FLT-06, JON-08: (a, b, metres), a before b, of nodes within the radius with matching names.

    There are as many rows as pairs, which grow with the square of the stops in a place; what is shuffled and held grows with the stops. The
    stops of a group are parted into blocks, and each block meets the stops of the matching groups: a block is what a task holds of one
    side. Pairs are made by a fixed number of tasks, since bytes of stops, by which partitions would be merged, don't tell how many pairs they make.
    """
    spark = nodes.sparkSession
    placed = written(grouped(nodes, radius).filter("g IS NOT NULL").select("ord", "stop_lat", "stop_lon", "g"), "placed")
    sizes = placed.groupBy("g").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    links = matching_groups(nodes, radius).join(sizes.withColumnRenamed("g", "h"), "h")
    groups = sizes.select("g", F.col("g").alias("h"), "blocks").unionAll(links.select("g", "h", "blocks"))
    side = lambda p: [F.col("ord").alias(f"{p}_ord"), F.col("stop_lat").alias(f"{p}_lat"), F.col("stop_lon").alias(f"{p}_lon")]
    one = groups.join(placed.select("g", *side("p")), "g").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    other = placed.join(sizes, "g").select(F.col("g").alias("h"), *side("q"), F.pmod(F.xxhash64("ord"), F.col("blocks")).cast("int").alias("block"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    met = one.repartition(tasks, "h", "block").join(other, ["h", "block"]).filter("g <> h OR p_ord < q_ord")
    pairs = met.withColumn("metres", haversine_m(F.col("p_lat"), F.col("p_lon"), F.col("q_lat"), F.col("q_lon")))
    return pairs.filter(F.col("metres") <= radius).select(F.least("p_ord", "q_ord").alias("a"), F.greatest("p_ord", "q_ord").alias("b"), "metres")


def components(edges: DataFrame) -> DataFrame:
    """(v, component) of the vertices of edges (a, b), all longs: the component's smallest vertex.

    Tasks, no more than the edges' bytes ask for, first replace their own edges by stars. What several tasks saw is joined by labels that are handed to neighbours and to the
    labels' own vertices, and that jump to their label's label, so they settle in a number of rounds that is logarithmic in a path's length.
    """
    spark = edges.sparkSession
    ship(spark)

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def top(v: int) -> int:
            while (up := root.setdefault(v, v)) != v:
                root[v] = v = root[up]
            return v

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = top(a), top(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        part, vertices = TaskContext.get().partitionId(), list(root)
        for i in range(0, len(vertices), 1 << 16):
            some = vertices[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([top(v) for v in some], pa.int64()), pa.array([part] * len(some), pa.int32())], ["v", "f", "part"])

    local = written(edges.select("a", "b").hint("rebalance").mapInArrow(stars, "v long, f long, part int"), "stars")
    if local.agg(F.count_distinct("part")).first()[0] <= 1:
        return local.select("v", F.col("f").alias("component"))
    links = local.filter("v <> f").select(F.col("v").alias("a"), F.col("f").alias("b"))
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(local.groupBy("v").agg(F.min("f").alias("f")), "labels")
    while True:
        of = lambda v, f: labels.select(F.col("v").alias(v), F.col("f").alias(f))  # noqa: B023, E731
        told = both.join(of("a", "fa"), "a").join(of("b", "fb"), "b").filter("fa < fb")
        told = told.select(F.explode(F.array("b", "fb")).alias("v"), F.col("fa").alias("f"))
        hooked = written(labels.select("v", "f").unionAll(told).groupBy("v").agg(F.min("f").alias("f")), "hooked")
        jumped = hooked.join(hooked.select(F.col("v").alias("f"), F.col("f").alias("ff")), "f").select("v", F.col("ff").alias("f"))
        new = written(jumped.join(of("v", "was"), "v"), "labels")
        if not new.filter("f <> was").take(1):
            return new.select("v", F.col("f").alias("component"))
        labels = new


def in_order(rows: DataFrame, radius: float) -> DataFrame:
    """(ord, founder, how) of stops, whole components in each bucket, one by one in their order.

    rows: (bucket, ord, uic, stop_lat, stop_lon, g, h): stops, and with a null ord pairs of matching groups.
    """
    ship(rows.sparkSession)

    def near(a: tuple, b: tuple) -> bool:
        p, q = math.radians(a[1]), math.radians(b[1])
        h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return EARTH_M * 2.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h)) <= radius

    def decide(table: pa.Table) -> pa.Table:
        beside: dict[str, list[str]] = {}
        stops = []
        for ord_, uic, lat, lon, g, h in zip(*(table.column(c).to_pylist() for c in ("ord", "uic", "stop_lat", "stop_lon", "g", "h")), strict=True):
            if ord_ is None:
                beside.setdefault(g, []).append(h)
                beside.setdefault(h, []).append(g)
            else:
                stops.append((ord_, lat, lon, uic, g))
        codes: dict[str, int] = {}
        around_: dict[str, list[tuple]] = {}  # founders of a group and of those beside it, in their order
        out = []
        for s in sorted(stops):
            ord_, _, _, uic, g = s
            founder, how = codes.get(uic) if uic else None, "uic"
            if founder is None and g is not None:
                founder, how = next((f[0] for f in around_.get(g, ()) if f[4] == g or near(s, f)), None), "geo"
            if founder is None:
                founder, how = ord_, "founder"
                if uic:
                    codes[uic] = ord_
                if g is not None:
                    for x in (g, *beside.get(g, ())):
                        around_.setdefault(x, []).append(s)
            out.append((ord_, founder, how))
        return pa.table({"ord": pa.array([o[0] for o in out], pa.int64()), "founder": pa.array([o[1] for o in out], pa.int64()), "how": pa.array([o[2] for o in out], pa.string())})

    return rows.groupBy("bucket").applyInArrow(decide, "ord long, founder long, how string")


def in_rounds(stops: DataFrame, links: DataFrame, radius: float, max_rounds: int = 10_000) -> DataFrame:
    """(ord, founder, how) of stops (ord, uic, stop_lat, stop_lon, g), given the pairs of matching groups both ways."""
    open_, found = stops, []
    first = lambda key: open_.filter(f"{key} IS NOT NULL AND {key} <> ''").groupBy(key).agg(F.min("ord").alias("first"))
    d = haversine_m(F.col("stop_lat"), F.col("stop_lon"), F.col("lat"), F.col("lon"))
    for _ in range(max_rounds):
        if not open_.take(1):
            break
        groups, codes = first("g"), first("uic")
        blocked = groups.join(links, "g").join(groups.select(F.col("g").alias("h"), F.col("first").alias("other")), "h").filter("other < first").select(F.col("first").alias("ord"))
        later = lambda key, firsts: open_.join(firsts, key).filter("ord > first").select("ord")  # noqa: B023, E731
        fresh = written(open_.join(blocked.unionAll(later("g", groups)).unionAll(later("uic", codes)), "ord", "left_anti"), "fresh")
        there = fresh.select(F.col("g").alias("h"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))
        out = open_.join(links, "g").join(there, "h").filter(d <= radius).select("ord").unionAll(fresh.select("ord"))
        out = out.unionAll(open_.join(fresh.select("g"), "g", "left_semi").select("ord")).unionAll(open_.join(fresh.filter("uic <> ''").select("uic"), "uic", "left_semi").select("ord"))
        found.append(fresh)
        open_ = written(open_.join(out, "ord", "left_anti"), "open")
    else:
        raise RuntimeError(f"resolution did not settle in {max_rounds} rounds")
    founders = functools.reduce(DataFrame.unionAll, found)
    code = founders.filter("uic <> ''").select("uic", F.col("ord").alias("code_founder"))
    place = founders.filter("g IS NOT NULL").select(F.col("ord").alias("place_founder"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"), F.col("g").alias("h"))
    beside = links.unionAll(place.select(F.col("h").alias("g"), "h"))
    places = stops.join(beside, "g").join(place, "h").filter((F.col("place_founder") < F.col("ord")) & ((F.col("g") == F.col("h")) | (d <= radius))).groupBy("ord").agg(F.min("place_founder").alias("place_founder"))
    joined = stops.join(founders.select("ord", F.lit(True).alias("is_founder")), "ord", "left").join(places, "ord", "left").join(code, "uic", "left")
    how = F.when(F.col("is_founder"), "founder").when(F.col("code_founder") < F.col("ord"), "uic").otherwise("geo")
    founder = F.when(F.col("how") == "founder", F.col("ord")).when(F.col("how") == "uic", F.col("code_founder")).otherwise(F.col("place_founder"))
    return joined.withColumn("how", how).select("ord", founder.alias("founder"), "how")


def decided(raw: DataFrame, radius: float, last: int) -> DataFrame:
    """(ord, founder, how) of all stops."""
    stops = grouped(raw, radius).select("ord", "uic", "stop_lat", "stop_lon", "g")
    links = written(matching_groups(raw, radius), "links")
    # vertices are hashes of groups and codes: should two be the same, components are merged, which changes nothing
    group, code = F.xxhash64("g"), F.xxhash64("uic", F.lit(1))
    coded = stops.filter("g IS NOT NULL AND uic <> ''").select(group.alias("a"), code.alias("b")).distinct()
    graph = components(links.select(group.alias("a"), F.xxhash64("h").alias("b")).unionAll(coded))
    graph = graph.select(F.col("v").alias("_v"), "component")
    vertex = F.when(F.col("g").isNotNull(), group).when(F.col("uic") != "", code).otherwise(F.xxhash64("ord"))
    of = lambda df, v: df.withColumn("_v", v).join(graph, "_v", "left").withColumn("component", F.coalesce("component", "_v")).drop("_v")
    parted = written(of(stops, vertex), "parted")
    sizes = parted.groupBy("component").agg(F.count("*").alias("n"))
    n, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    some = most > last
    large = written(sizes.filter(F.col("n") > last).select("component"), "large") if some else None
    buckets = max(1, -(-n // LAST), min(n // 1000, int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    own = of(links, group)
    small, near = (df.join(large, "component", "left_anti") if some else df for df in (parted, own))
    bucket = F.pmod(F.xxhash64("component"), F.lit(buckets)).alias("bucket")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = small.select(bucket, "ord", "uic", "stop_lat", "stop_lon", "g", none("string", "h")).unionAll(near.select(bucket, none("long", "ord"), none("string", "uic"), none("double", "stop_lat"), none("double", "stop_lon"), "g", "h"))
    out = in_order(rows, radius)
    if some:
        links = own.join(large, "component", "left_semi").select("g", "h")
        both = written(links.unionAll(links.select(F.col("h").alias("g"), F.col("g").alias("h"))), "beside")
        out = out.unionByName(in_rounds(parted.join(large, "component", "left_semi").drop("component"), both, radius))
    return out


def resolve(raw: DataFrame, radius: float = RADIUS_M, last: int = LAST) -> DataFrame:
    """raw with founder (the founder's ord), canonical_id and how ('founder', 'uic' or 'geo')."""
    raw = written(raw, "raw")
    told = written(decided(raw, radius, last), "decided")
    found = raw.select("ord", "uic").join(told.filter("how = 'founder'").select("ord"), "ord")
    ids = numbered(found, "ord").select(F.col("ord").alias("founder"), F.when(F.col("uic") != "", F.concat(F.lit("CANONICAL_UIC_"), "uic")).otherwise(F.format_string("CANONICAL_STOP_%06d", "n")).alias("canonical_id"))
    return written(raw.join(told, "ord").join(ids, "founder"), "resolved")


def stop_map(resolved: DataFrame) -> DataFrame:
    """DED-04, AGG-08: (operator_id, raw_stop_id) -> canonical_id, the last one for an id that comes twice."""
    return resolved.groupBy("operator_id", "raw_stop_id").agg(F.max_by("canonical_id", "ord").alias("canonical_id"))


def canonical_stops(resolved: DataFrame) -> DataFrame:
    """DED-03, AGG-05, AGG-06: founders with the flags and the ordered source ids of all their stops."""
    flag = lambda name: F.max(F.when(F.upper("operator_id") == name, 1).otherwise(0)).cast("int").alias(name.lower())
    sources = F.collect_list(F.struct("ord", F.concat("operator_id", F.lit(":"), "raw_stop_id").alias("id")))
    members = resolved.groupBy("canonical_id").agg(flag("SNCF"), flag("EUROSTAR"), flag("RENFE"), F.transform(F.array_sort(sources), lambda s: s["id"]).alias("source_stop_ids"))
    own = resolved.filter("how = 'founder'").select(
        F.col("canonical_id").alias("stop_id"), F.col("raw_name").alias("stop_name"), F.col("raw_name").alias("parent_name"), F.lit("").alias("country"), "stop_lat", "stop_lon", "uic", "ord",
    )
    return own.join(members, own["stop_id"] == members["canonical_id"]).drop("canonical_id")


def report(resolved: DataFrame) -> DataFrame:
    """AGG-07: one row; every raw stop founds or merges once."""
    count = lambda how: F.count(F.when(F.col("how") == how, 1))
    return resolved.agg(F.count("*").alias("total_raw_stops"), count("founder").alias("unique_canonical_stops"), count("uic").alias("merges_uic"), count("geo").alias("merges_geoloc"))
