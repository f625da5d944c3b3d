from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from railweave.operators import lookups
from railweave.plans import ingest, sinks
from railweave.sources import feeds, landed
from railweave.streaming import landing


def archive(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(f"{name}.txt", text)
    return str(path)


@pytest.fixture(params=["archives", "landed"])
def three(tmp_path, request):
    a = archive(
        tmp_path / "a.zip",
        stops='stop_id,stop_name,stop_lat,stop_lon\nStopPoint:OCETrain TER-87686006,"Gare de Lyon, Paris",48.8443,2.3744\nStopPoint:bus-1,Lyon,45.76,4.86\nStopArea:x,NA,,\n',
        routes="route_id,agency_id\nr1,A\nr2,A\n",
        trips="route_id,service_id,trip_id,trip_headsign\nr1,s1,t1,h1\nr2,s2,t2,\n",
        stop_times="trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt1,08:00:00,08:05:00,StopPoint:bus-1,1\nt1,25:00:00,25:10:00,StopPoint:OCETrain TER-87686006,2\nt2,,,unknown, 1\n",
        calendar_dates="﻿service_id ,date,exception_type\ns1,20240115,1\ns2,20240401,1\ns1,20241399,2\n",
    )
    b = archive(
        tmp_path / "b.zip",
        stops="stop_id,stop_code,stop_name,stop_lat,stop_lon\np,87686006,Paris Lyon,48.8443,2.3744\nq,,Londres,51.53,-0.12\n",
        routes="route_id,agency_id\nr1,Thalys\nr2,\n",
        trips="route_id,service_id,trip_id,trip_headsign\nr1,s,EUROSTAR_9012-1,x\n",
        stop_times="trip_id,arrival_time,departure_time,stop_id,stop_sequence\nEUROSTAR_9012-1,10:00,10:00,q,1\n",
    )
    c = archive(
        tmp_path / "c.zip",
        stops="stop_id,stop_name,stop_lat,stop_lon\n12345,Madrid,40.4,-3.69\n12346,Madrid,40.4,-3.69\n",
        routes="route_id,route_short_name,route_long_name\nr1,AVE,\nr2,x,Costa\n",
        trips="route_id,service_id,trip_id,trip_short_name\nr1,s,t00123,00456\nr2,s,t9,\n",
        stop_times="trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt9,10:00,10:01,12346,1\n",
        calendar_dates="service_id,date\ns,20240116\n",
    )
    paths = {"SNCF": a, "EUROSTAR": b, "RENFE": c}
    if request.param == "landed":
        paths = landed.land(request.getfixturevalue("spark"), paths, str(tmp_path / "landed"), 64)
    return [(op, paths[op], types) for op, types in (("SNCF", ["Car TER"]), ("EUROSTAR", ["Eurostar"]), ("RENFE", ["AVE"]))]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_harmonized(spark, three, tmp_path):
    stations = tmp_path / "stations.csv"
    stations.write_text("id;name;parent_station_id;country;uic;city\n1;Paris Gare de Lyon;2;fr;8768600;\n2;Paris;;FRA;;\n3; ;;;1;\n")
    out = ingest.harmonized(spark, three, str(stations), today="2024-01-01")
    stops = {r["stop_id"]: r for r in out["stops"].collect()}
    assert set(stops) == {"CANONICAL_UIC_87686006", "CANONICAL_STOP_000002", "CANONICAL_STOP_000003", "CANONICAL_STOP_000004", "CANONICAL_UIC_7112345"}
    lyon = stops["CANONICAL_UIC_87686006"]
    assert (lyon["sncf"], lyon["eurostar"], lyon["renfe"], lyon["source_stop_ids"]) == (1, 1, 0, ["SNCF:StopPoint:OCETrain TER-87686006", "EUROSTAR:p"])
    assert stops["CANONICAL_STOP_000003"]["stop_name"] == "nan" and stops["CANONICAL_UIC_7112345"]["source_stop_ids"] == ["RENFE:12345", "RENFE:12346"]
    assert rows(out["routes"], "route_id", "train_type") == [("EUROSTAR_r1", "Eurostar (ex-Thalys)"), ("EUROSTAR_r2", "Eurostar"), ("RENFE_r1", "AVE"), ("RENFE_r2", "Costa"), ("SNCF_r1", "TER"), ("SNCF_r2", "Train SNCF")]
    assert rows(out["trips"], "trip_id", "trip_headsign") == [("EUROSTAR_EUROSTAR_9012-1", "9012"), ("RENFE_t00123", "456"), ("RENFE_t9", ""), ("SNCF_t1", "h1")]
    assert ("SNCF_t1", "CANONICAL_UIC_87686006", 2, 1510) in rows(out["stop_times"], "trip_id", "stop_id", "stop_sequence", "dep_min")
    assert ("SNCF_t2", "unknown", 1, 0) in rows(out["stop_times"], "trip_id", "stop_id", "stop_sequence", "dep_min")
    assert rows(out["calendar_dates"], "service_id", "date", "exception_type") == [("RENFE_s", "2024-01-16", 1), ("SNCF_s1", "2024-01-15", 1)]
    assert out["report"].first().asDict() == {"total_raw_stops": 7, "unique_canonical_stops": 5, "merges_uic": 1, "merges_geoloc": 1}
    paths = sinks.write_tables(out, str(tmp_path / "out"))
    back = spark.read.parquet(paths["stop_times"])
    assert back.count() == 5 and sinks.size_mib(paths["stops"]) > 0
    assert sinks.write_report(out["report"], str(tmp_path / "report.json")) == json.loads((tmp_path / "report.json").read_text())


def test_generic(spark, three, tmp_path):
    bad = ("BAD", str(tmp_path / "none.zip"), [])
    torn = tmp_path / "torn.zip"
    torn.write_bytes(b"PK not an archive")
    members = {"stops": "stop_id,stop_name,stop_lat,stop_lon\n1,A,1,2\n", "routes": "route_id\nr\n", "trips": "trip_id,route_id,service_id,trip_headsign\nt,r,s,h\n", "calendar_dates": "service_id,date,exception_type\ns,20240101,1\n"}
    lacking = archive(tmp_path / "lacking.zip", **members, stop_times="trip_id,stop_id\nt,1\n")
    worded = archive(tmp_path / "worded.zip", **members, stop_times="trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt,1:00,1:00,1,first\n")
    undated = archive(tmp_path / "undated.zip", **(members | {"calendar_dates": "service_id,date,exception_type\ns,soon,1\n"}))
    faulty = [("TORN", str(torn), []), ("LACKING", lacking, []), ("WORDED", worded, []), ("UNDATED", undated, [])]
    full = archive(
        tmp_path / "d.zip", stops="stop_id,stop_name,stop_lat,stop_lon\na12b3,A,x,2\n", routes="route_id,agency_id\nr,eurostar_channel\n", trips="trip_id,route_id,service_id,trip_headsign\nt,r,s,h\n",
        stop_times="trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt,1:00,1:00,a12b3,1\n", calendar_dates="service_id,date,exception_type\ns,20240101,2\n",
    )
    out = ingest.generic(spark, [("E", full, ["Train"]), ("SNCF", full, ["Car TER"]), bad, *faulty])
    with pytest.raises(ValueError, match="no feed"):
        ingest.generic(spark, [bad])
    assert rows(out["stops"], "stop_id", "stop_lat", "clean_uic") == [("E_a12b3", None, "12"), ("SNCF_a12b3", None, "12")]
    assert rows(out["trips"], "trip_id", "train_type") == [("E_t", "Eurostar"), ("SNCF_t", "Car TER")]
    assert rows(out["calendar_dates"], "service_id", "date", "exception_type") == [("E_s", "2024-01-01", 2), ("SNCF_s", "2024-01-01", 2)]
    one = ingest.single_feed(spark, full)
    assert rows(one["routes"], "route_id", "train_type") == [("r", "EUROSTAR CHANNEL")] and rows(one["stops"], "stop_id", "clean_uic") == [("a12b3", "12")]


def test_missing_members_and_columns(spark, tmp_path):
    path = archive(tmp_path / "x.zip", stops="stop_id\n1\n", routes="route_id\n")
    assert feeds.read_member(spark, path, "trips.txt", ["trip_id"]).count() == 0
    with pytest.raises(Exception, match="has no trips.txt"):
        feeds.read_member(spark, path, "trips.txt", ["trip_id"], missing="error").count()
    with pytest.raises(Exception, match="lacks stop_name"):
        feeds.read_member(spark, path, "stops.txt", ["stop_id", "stop_name"]).count()
    got = feeds.read_member(spark, path, "stops.txt", ["stop_id", "stop_name"], optional=["stop_name"]).collect()
    assert [tuple(r) for r in got] == [("1", None, 0)]
    assert feeds.read_member(spark, path, "routes.txt", ["route_id"]).count() == 0
    assert feeds.has_column(path, "stops.txt", "stop_id") and not feeds.has_column(path, "stops.txt", "stop_code")


def test_catalog(spark, tmp_path):
    p = tmp_path / "operators.json"
    p.write_text('[{"id": "A", "gtfs_url": "u"}, {"id": "B", "enabled": false, "gtfs_url": "u"}, {"id": "C", "enabled": true}]')
    catalog = feeds.read_catalog(spark, str(p))
    assert ingest.landed(catalog, {"A": "a.zip", "B": "b.zip"}) == [("A", "a.zip", ["Train"])]
    with pytest.raises(FileNotFoundError):
        feeds.read_catalog(spark, str(tmp_path / "no.json"))
    assert feeds.read_catalog(spark, str(tmp_path / "no.json"), feeds.DEFAULT_CATALOG).count() == 1
    assert feeds.read_stations(spark, str(tmp_path / "no.csv")) is None


def test_sinks(spark):
    df = spark.createDataFrame([(["a", 'é"'],), ([],)], "x array<string>")
    assert sorted(r[0] for r in df.select(sinks.json_list(F.col("x"))).collect()) == ['["a", "é\\""]', "[]"]
    with pytest.raises(ValueError, match="occurs 2 times"):
        lookups.assert_unique(spark.createDataFrame([("a",), ("a",), (None,), (None,)], "stop_id string"), "stop_id")


def test_tables_are_replaced_together(spark, three, tmp_path):
    folder = str(tmp_path / "out")
    out = ingest.harmonized(spark, three, today="2024-01-01")
    paths = sinks.write_tables(out, folder)
    assert set(paths) == {"stops", "routes", "trips", "stop_times", "stop_times_by_trip_id", "calendar_dates"}
    before = {n: rows(spark.read.parquet(p), *spark.read.parquet(p).columns) for n, p in paths.items()}
    fewer = {n: df.limit(1) for n, df in out.items() if n != "report"}
    with pytest.raises(ValueError, match="occurs 2 times"):
        sinks.write_tables(fewer | {"trips": out["trips"].unionAll(out["trips"])}, folder)
    with pytest.raises(Exception, match="(?i)divi"):
        sinks.write_tables(fewer | {"calendar_dates": fewer["calendar_dates"].withColumn("exception_type", F.expr("exception_type DIV 0"))}, folder)
    assert {n: rows(spark.read.parquet(p), *spark.read.parquet(p).columns) for n, p in paths.items()} == before
    sinks.write_tables(fewer, folder)
    assert spark.read.parquet(paths["stops"]).count() == 1
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("_")) == []
    sinks.write_tables(out, folder)
    assert sinks.compact(spark, folder, "stop_times") == 1 and rows(spark.read.parquet(paths["stop_times"]), "trip_id", "stop_id") == rows(out["stop_times"], "trip_id", "stop_id")


def test_parent_without_a_name(spark):
    table = spark.createDataFrame([(0, "1", "A", "2", None, None, "8700001"), (1, "2", None, None, None, None, None), (2, "3", "C", "9", None, "X", "8700002"), (3, "4", "D", "5", None, None, "8700003"), (4, "5", " ", None, None, None, None)], "_row long, id string, name string, parent_station_id string, parent_station_name string, city string, uic string")
    keys = lookups.station_keys(table.withColumns({c: F.lit(None).cast("string") for c in ("country", "uic8_sncf", "latitude", "longitude")}))
    assert rows(keys.filter("length(code) = 7"), "code", "parent_name") == [("8700001", None), ("8700002", "X"), ("8700003", "D")]
    assert lookups.key_count(keys).first()["n_keys"] == 6


def test_landing(spark, tmp_path):
    archive(tmp_path / "in1.zip", stops="stop_id\n1\n")
    seen = []
    for _ in range(2):
        landing.on_arrival(spark, str(tmp_path), str(tmp_path / "state"), lambda _s, paths: seen.append([p.rsplit("/", 1)[-1] for p in paths])).awaitTermination(60)
    assert seen == [["in1.zip"]]
