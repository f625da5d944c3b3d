from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from railweave.operators import resolve

NAMES = ["", "lyon", "lyon part dieu", "paris", "paris nord"]
SCHEMA = "ord long, operator_id string, raw_stop_id string, stop_code string, raw_name string, stop_lat double, stop_lon double, uic string, norm_name string"


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 6371000.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def one_by_one(stops):
    """The rules as they are stated: each stop against the founders so far."""
    found, out = [], {}
    for s in stops:
        hit = next((f for f in found if s[7] and f[7] == s[7]), None)
        how = "uic" if hit else "geo"
        if hit is None and s[5] is not None:
            hit = next((f for f in found if f[5] is not None and metres(s[5:7], f[5:7]) <= 100 and (s[8] in f[8] or f[8] in s[8])), None)
        if hit is None:
            found.append(s)
            hit, how = s, "founder"
        out[s[0]] = (hit[0], how, f"CANONICAL_UIC_{hit[7]}" if hit[7] else f"CANONICAL_STOP_{found.index(hit) + 1:06d}")
    return out


point = st.tuples(st.integers(0, 9), st.integers(0, 9))
stop = st.tuples(st.sampled_from(["", "", "87000001", "87000002", "87000003"]), st.one_of(st.none(), point), st.sampled_from(NAMES), st.sampled_from(["SNCF", "EUROSTAR", "Renfe"]))


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(stop, min_size=1, max_size=40), st.sampled_from([resolve.LAST, 3, 0]))
def test_same_as_one_by_one(spark, stops, last):
    rows = [(i, op, f"s{i}", "", name.title(), 48 + xy[0] * 4e-4 if xy else None, 2 + xy[1] * 6e-4 if xy else None, uic, name) for i, (uic, xy, name, op) in enumerate(stops)]
    got = resolve.resolve(spark.createDataFrame(rows, SCHEMA).repartition(3), last=last)
    assert {r["ord"]: (r["founder"], r["how"], r["canonical_id"]) for r in got.collect()} == one_by_one(rows)
    r = resolve.report(got).first()
    assert r["total_raw_stops"] == len(rows) == r["unique_canonical_stops"] + r["merges_uic"] + r["merges_geoloc"]
    stops_ = resolve.canonical_stops(got).collect()
    assert sorted(x for s in stops_ for x in s["source_stop_ids"]) == sorted(f"{r[1]}:{r[2]}" for r in rows)
    for s in stops_:
        assert s["sncf"] == any(x.startswith("SNCF:") for x in s["source_stop_ids"]) and s["renfe"] == any(x.startswith("Renfe:") for x in s["source_stop_ids"])


def test_numbering_over_ranges(spark):
    df = spark.range(0, 10).selectExpr("id * 50000 AS ord")
    assert [(r["ord"], r["n"]) for r in resolve.numbered(df, "ord").orderBy("ord").collect()] == [(i * 50000, i + 1) for i in range(10)]


def spread(n, seed, names, width, codes=0):
    """Stops at random points of a square of so many degrees."""
    r = random.Random(seed)
    return [(i, "SNCF", f"s{i}", "", "N", 48 + r.random() * width, 2 + r.random() * width, f"8700{r.randrange(codes):04d}" if codes and r.random() < 0.3 else "", r.choice(names)) for i in r.sample(range(3 * n), n)]


@pytest.mark.parametrize("last", [resolve.LAST, 40])
def test_crowds_of_many_names(spark, last):
    """Names that hold one another in all ways, short and empty ones among them, in a few crowded cells and over them."""
    r = random.Random(1)
    names = ["", "a", "b", "ab", *("".join(r.choice("ab c") for _ in range(r.randrange(1, 8))).strip() for _ in range(60))]
    for width, codes in ((0.0012, 0), (0.01, 12)):
        rows = spread(250, 2, names, width, codes)
        got = resolve.resolve(spark.createDataFrame(rows, SCHEMA).repartition(3), last=last)
        assert {x["ord"]: (x["founder"], x["how"], x["canonical_id"]) for x in got.collect()} == one_by_one(sorted(rows))
        near = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and metres(a[5:7], b[5:7]) <= 100 and (a[8] in b[8] or b[8] in a[8])}
        assert {(x["a"], x["b"]) for x in resolve.near_pairs(spark.createDataFrame(rows, SCHEMA)).collect()} == near


def test_a_crowd_on_one_square_metre(spark):
    """50,000 stops with as many names, a third of them the same: matching names cost, pairs of stops don't."""
    n = 50_000
    rows = [(i, "SNCF", f"s{i}", "", "N", 48 + i % 97 * 1e-8, 2 + i % 89 * 1e-8, "", "lyon" if i % 3 == 0 else f"stop {i}") for i in range(n)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    links = resolve.matching_groups(frame).count()
    assert links < 2 * n
    got = resolve.resolve(frame)
    assert got.filter("how = 'founder'").count() == 1 + sum(1 for i in range(n) if i % 3 and not any(int(str(i)[:k]) % 3 for k in range(1, len(str(i)))))


def test_a_chain_of_a_hundred_thousand(spark):
    """Each stop is near the one before it: one component, whose every second stop founds."""
    n = 100_000
    frame = spark.range(n).selectExpr("id AS ord", "'SNCF' AS operator_id", "CAST(id AS STRING) AS raw_stop_id", "'' AS stop_code", "'N' AS raw_name", "0D AS stop_lat", "id * 0.0008 AS stop_lon", "'' AS uic", "'halt' AS norm_name")
    got = resolve.resolve(frame)
    assert got.filter("how = 'founder'").count() == n // 2 and got.filter("ord - founder <> ord % 2").count() == 0


@pytest.mark.parametrize("n", [1, 2, 900])
def test_components(spark, n):
    """Paths, stars and a cycle that many tasks see in part."""
    r = random.Random(n)
    edges = [(i, i + 1) for i in range(n)] + [(5000, 5000 + i) for i in range(1, n)] + [(9000 + i, 9000 + (i + 1) % n) for i in range(n)]
    r.shuffle(edges)
    want = {}
    for lo, hi in ((0, n), (5000, 4999 + n), (9000, 8999 + n)):
        want |= {v: lo for v in range(lo, hi + 1) if any(v in e for e in edges)}
    frame = spark.createDataFrame(edges, "a long, b long")
    for parts in (1, 7):
        assert {x["v"]: x["component"] for x in resolve.components(frame.repartition(parts)).collect()} == want


def test_pairs_of_one_place_are_made_by_many_tasks(spark):
    """Few rows make many pairs: 300 stops in a group, in blocks or not, give each pair once, and no one task makes all."""
    r = random.Random(5)
    at = [(i, 48 + r.random() / 2000, 2 + r.random() / 2000, r.choice(["a", "a b", ""])) for i in range(300)] + [(300, None, 2.0, "a")]
    nodes = spark.createDataFrame(at, "ord long, stop_lat double, stop_lon double, norm_name string")
    got = resolve.near_pairs(nodes, block=7)
    pairs = sorted((x["a"], x["b"]) for x in got.collect())
    assert len(pairs) == len(set(pairs)) > 20_000 and pairs == sorted((x["a"], x["b"]) for x in resolve.near_pairs(nodes).collect())
    d = F.col("metres") <= 100
    x, y = (nodes.select(*(F.col(c).alias(f"{c}{i}") for c in nodes.columns)) for i in (1, 2))
    every = x.join(y, (F.col("ord1") < F.col("ord2")) & resolve.names_match(F.col("norm_name1"), F.col("norm_name2")))
    every = every.withColumn("metres", resolve.haversine_m(F.col("stop_lat1"), F.col("stop_lon1"), F.col("stop_lat2"), F.col("stop_lon2"))).filter(d)
    assert pairs == sorted((x["ord1"], x["ord2"]) for x in every.collect())
    tasks = sorted(x["count"] for x in got.groupBy(F.spark_partition_id()).count().collect())
    assert len(tasks) > 8 and tasks[-1] < len(pairs) / 3
