"""Archives that many tasks write: pieces become members that any tool reads."""

from __future__ import annotations

import random
import zipfile
import zlib

import pyarrow.fs
import pytest

from railweave.plans import feed_queries
from railweave.sources import zips

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sizes", [[], [0, 1], [5, 0, 70_000], [3] * 40])
def test_pieces_are_one_member(tmp_path, sizes):
    r, texts, pieces = random.Random(1), [], []
    for i, n in enumerate(sizes):
        press, text = zips.Press(), bytes(r.choices(b"ab,\n", k=n))
        (tmp_path / str(i)).write_bytes(b"before" + (data := press.put(text) + press.end()) + b"after")
        texts.append(text)
        pieces.append(zips.Piece(str(tmp_path / str(i)), 6, len(data), press.text, press.crc))
    members = [("a.txt", "héad\n", pieces), ("b.txt", "", []), ("c.txt", "x", pieces[::-1])]
    (tmp_path / "z.zip").write_bytes(b"".join(zips.put_together(pyarrow.fs.LocalFileSystem(), members)))
    with zipfile.ZipFile(tmp_path / "z.zip") as z:
        assert z.namelist() == ["a.txt", "b.txt", "c.txt"] and z.testzip() is None
        assert [z.read(n) for n in z.namelist()] == ["héad\n".encode() + b"".join(texts), b"", b"x" + b"".join(texts[::-1])]


def test_crc_of_both():
    for first, second in ((b"", b""), (b"abc", b""), (b"", b"abc"), (b"abc" * 99, b"\0" * 12345)):
        assert zips.crc_of_both(zlib.crc32(first), zlib.crc32(second), len(second)) == zlib.crc32(first + second)


@pytest.mark.parametrize("plain", [False, True])
def test_many_tasks_write_one_archive(spark, plain):
    """Pieces of 70 rows give the text that one piece gives, in the order of the rows, and nothing else is left."""
    read = lambda paths: {(op, n): z.read(n).decode("utf-8-sig") for op, p in paths.items() for z in [zipfile.ZipFile(p)] for n in z.namelist()}
    few = feed_queries.archives(spark, SF, plain, rows=70)
    assert (one := read(feed_queries.archives(spark, SF, plain))) == read(few)
    lines = [x for op in feed_queries.OPERATORS for x in one.get((op, "stop_times.txt"), "").splitlines()[1:]]
    assert len(lines) == (6000 if not plain else sum("EUROSTAR" not in x for x in lines)) and len(one) == (13 if plain else 15)
    keys = [(int(x.split('"')[1]), int(x.split('"')[-2])) for x in one["SNCF", "stop_times.txt"].splitlines()[1:]]
    assert keys == sorted(keys)
    folder = few["SNCF"].rsplit("/", 1)[0].removeprefix("file:")
    assert sorted(p.base_name for p in pyarrow.fs.LocalFileSystem().get_file_info(pyarrow.fs.FileSelector(folder))) == ["EUROSTAR.zip", "RENFE.zip", "SNCF.zip"]
