"""Landed feeds: many tasks read one member, and rows and their places are those of the archive."""

from __future__ import annotations

import gzip
import random
import threading
import zipfile

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from railweave.sources import feeds, landed

COLUMNS = ["trip_id", "stop_id", "note"]


def zipped(path, text, member="stop_times.txt"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, text)
    return str(path)


def seen(spark, path, **more):
    df = feeds.read_member(spark, path, "stop_times.txt", COLUMNS, optional=["note"], **more)
    return sorted(map(tuple, df.collect()), key=lambda r: r[-1])


def calls(n, seed=1, end="\n"):
    r = random.Random(seed)
    cell = lambda: r.choice(["", "x", '"a ""quoted"" word"', '"two\nlines"', '"comma, and\r\n break"', "NA", '""', "é" * 9])
    return end.join(["﻿trip_id ,stop_id,note", *(f"t{i // 5:05d},s{r.randrange(50)},{cell()}" for i in range(n))]) + r.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [1, 100, 1500, 1 << 20])
def test_same_rows_and_places(spark, tmp_path, size, end):
    text = calls(60 if size < 100 else 1500, size, end)
    path = zipped(tmp_path / "a.zip", text)
    n = landed.land_member(path, "stop_times.txt", str(tmp_path / "a"), size)
    assert gzip.open(tmp_path / "a/stop_times.txt.gz").read() == text.encode()
    assert n <= 2 if size == 1 << 20 else n > 10
    reader = feeds.FeedReader(feeds.member_schema(COLUMNS), {"path": str(tmp_path / "a"), "member": "stop_times.txt", "split_mib": "0.0001"})
    parts = reader.partitions()
    assert len(parts) <= 2 if size == 1 << 20 else len(parts) > 8
    rows = sorted((row for p in parts for b in reader.read(p) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: r[-1])
    want = seen(spark, path)
    assert rows == want == seen(spark, str(tmp_path / "a")) and [r[-1] for r in rows] == list(range(len(rows)))


@pytest.mark.parametrize("text", [
    "trip_id,stop_id,note\n", "trip_id,stop_id", "trip_id,stop_id,note\na,b,c", "trip_id,stop_id,note\n\na,b,c\n\n\nd,e,f\n\n",
    "trip_id,stop_id,note\n" + "a,b,c\n" * 30 + 'a,5" wheel,c\n' + 'x,y,"z"\n' * 30 + 'a,b"x,"c\nd"\n', "trip_id,stop_id,note\n" + 'a,"' + "\n" * 900 + '",c\nd,e,f\n',
])
def test_odd_members(spark, tmp_path, text):
    """Headers alone, blank lines, a cell longer than pieces, and quotes inside plain cells, after which a member is one piece."""
    path = zipped(tmp_path / "a.zip", text)
    landed.land_member(path, "stop_times.txt", str(tmp_path / "a"), 40)
    assert seen(spark, str(tmp_path / "a")) == seen(spark, path)


def test_rows_of_another_length_raise_when_they_are_read(spark, tmp_path):
    path = zipped(tmp_path / "a.zip", "trip_id,stop_id,note\n" + "a,b,c\n" * 30 + "a,b\n" + "a,b,c\n" * 30)
    landed.land_member(path, "stop_times.txt", str(tmp_path / "a"), 40)
    for p in (path, str(tmp_path / "a")):
        with pytest.raises(Exception, match="Expected 3 columns"):
            seen(spark, p)


def test_members_and_faults(spark, tmp_path):
    (tmp_path / "torn.zip").write_bytes(b"PK no archive")
    empty = zipped(tmp_path / "empty.zip", "of no use", "readme.md")
    good = zipped(tmp_path / "good.zip", calls(10))
    out = landed.land(spark, {"good": good, "torn": str(tmp_path / "torn.zip"), "none": str(tmp_path / "none.zip"), "empty": empty}, str(tmp_path / "landed"))
    assert sorted(out) == ["empty", "good"] and feeds.members(out["good"]) == ["stop_times.txt"] and feeds.members(out["empty"]) == []
    assert feeds.has_column(out["good"], "stop_times.txt", "note") and not feeds.has_column(out["good"], "stops.txt", "note")
    assert seen(spark, out["empty"]) == []
    with pytest.raises(Exception, match="has no"):
        seen(spark, out["empty"], missing="error")
    with pytest.raises(Exception, match="lacks"):
        feeds.read_member(spark, out["good"], "stop_times.txt", ["absent"]).collect()


def test_filters_reach_the_source(spark, tmp_path):
    path = zipped(tmp_path / "a.zip", calls(3000))
    landed.land_member(path, "stop_times.txt", str(tmp_path / "a"), 2000)
    for p in (path, str(tmp_path / "a")):
        df = feeds.read_member(spark, p, "stop_times.txt", COLUMNS)
        every = spark.createDataFrame([tuple(r) for r in df.collect()], df.schema)
        assert every.count() == 3000
        for condition in ("trip_id = 't00007'", "trip_id IN ('t00007', 't00599', 'x') AND stop_id > 's2'", "trip_id = 't00007' AND trip_id = 't00008'", "note = 'x' AND trip_id IN ('t00001', 't00300')", "trip_id = 'nowhere'"):
            wanted = df.filter(condition)
            plan = wanted._jdf.queryExecution().executedPlan().toString()
            assert "(trip_id#" not in plan  # no Filter of Spark's own on it
            assert sorted(map(tuple, wanted.collect()), key=lambda r: r[-1]) == sorted(map(tuple, every.filter(condition).collect()), key=lambda r: r[-1])
    reader = feeds.FeedReader(feeds.member_schema(COLUMNS), {"path": str(tmp_path / "a"), "member": "stop_times.txt", "split_mib": "0.001"})
    every = len(reader.partitions())
    assert list(reader.pushFilters([EqualTo(("trip_id",), "t00300"), In(("stop_id",), ("s1", "s2")), GreaterThan(("note",), "x"), EqualTo(("_row",), 3)])) == [GreaterThan(("note",), "x"), EqualTo(("_row",), 3)]
    assert every > 20 and len(reader.partitions()) <= 2


def test_one_member_is_read_by_many_tasks(spark, tmp_path):
    path = zipped(tmp_path / "a.zip", "trip_id,stop_id,note\n" + "".join(f"t{i // 20:07d},stop{i % 977},some words\n" for i in range(700_000)))
    landed.land_member(path, "stop_times.txt", str(tmp_path / "a"), 1 << 20)
    df = spark.read.format("gtfs").schema(feeds.member_schema(COLUMNS)).options(path=str(tmp_path / "a"), member="stop_times.txt", split_mib="2").load()
    assert df.rdd.getNumPartitions() >= 8
    assert df.selectExpr("count(*)", "count(DISTINCT _row)", "min(_row)", "max(_row)", "bool_and(trip_id = format_string('t%07d', _row div 20))").first() == (700_000, 700_000, 0, 699_999, True)


def test_pieces_are_compressed_at_once_and_kept_in_order(tmp_path, monkeypatch):
    """Two pieces are being pressed at the same time, which one after the other would never be, and the text stays as it was."""
    both, real = threading.Barrier(2), landed._told

    def told(*a):
        if both.n_waiting or not both.broken and not meetings:
            both.wait(20)
            meetings.append(1)
        return real(*a)

    meetings: list[int] = []
    monkeypatch.setattr(landed, "_told", told)
    text = calls(1500)
    assert landed.land_member(zipped(tmp_path / "a.zip", text), "stop_times.txt", str(tmp_path / "a"), 2000) > 4
    assert len(meetings) >= 2 and gzip.open(tmp_path / "a/stop_times.txt.gz").read() == text.encode()
