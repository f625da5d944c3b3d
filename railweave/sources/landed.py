"""Members of archives landed so that many tasks can read one (SRC-05, SRC-08).

A deflate stream can only be read from its start. Landing streams each member once and writes it as a gzip file, readable by any tool,
whose compressor is reset at row ends some megabytes apart; an index beside it holds these restart points: where each piece begins and
ends, how many rows come before it, and the least and greatest value of each id column in it. Readers plan their partitions from the
index: a task inflates its own pieces only, numbers its rows from the counts, and passes over pieces that a filter on an id rules out.
"""

from __future__ import annotations

import collections
import io
import json
import logging
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import SparkSession

from railweave import schemas
from railweave.sources import zips
from railweave.sources.csvs import blocks, names_of
from railweave.sources.session import ship

log = logging.getLogger("railweave")

#: Bytes of text between restart points.
PIECE = 8 << 20
#: Pieces of a member that are compressed at once.
THREADS = 3
INDEX = pa.schema([("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("rows", pa.int64()), ("before", pa.int64()), ("least", pa.string()), ("most", pa.string())])


def _row_end(text: np.ndarray, sep: int, at_end: bool) -> int | None:
    """Where the last whole row of text ends (0: nowhere), which begins with a row; None where quotes stand inside plain cells.

    A line end is a row's end if an even number of quotes comes before it, provided that quotes only open and close cells or are doubled.
    """
    quote = text == 34
    ends = np.flatnonzero(text == 10)
    if quote.any():
        at = np.flatnonzero(quote)
        opens, closes = at[0::2], at[1::2]
        border = np.zeros(257, bool)
        border[[sep, 10, 13, 34, 256]] = True
        padded = np.concatenate([[256], text, [256]]).astype(np.int16)
        if not border[padded[opens]].all() or not border[padded[closes + 2]].all():
            return None
        ends = ends[np.searchsorted(at, ends) % 2 == 0]
    return len(text) if at_end else int(ends[-1]) + 1 if len(ends) else 0


def _pieces(f, size: int, sep: int) -> Iterator[tuple[bytes, bool]]:
    """A member's rows in pieces of about so many bytes, each with whether its rows are whole; once they can't be told, blocks that are not."""
    held = b""
    while True:
        block = f.read(size)
        held += block
        if not held:
            return
        end = _row_end(np.frombuffer(held, np.uint8), sep, not block)
        if end is None:
            break
        if end:
            yield held[:end], True
            held = held[end:]
        if not block:
            return
    while held:
        yield held, False
        held = f.read(size)


def _told(piece: bytes, names: list[str], sep: str) -> tuple[int, str, str]:
    """Rows of a piece, and as JSON the least and the greatest value of each id column that has one."""
    ids, rows, least, most = [n for n in names if n.endswith("_id")], 0, {}, {}
    for b in blocks(io.BytesIO(piece), names, sep, ids or names[:1]):
        rows += len(b)
        for n in ids:
            if (seen := pc.min_max(b.column(n)).as_py())["min"] is not None:
                least[n], most[n] = min(least.get(n, seen["min"]), seen["min"]), max(most.get(n, seen["max"]), seen["max"])
    return rows, json.dumps(least), json.dumps(most)


def _ahead(f: Callable, items: Iterator[tuple]) -> Iterator:
    """f of each item, in their order, a few at once: inflating and cutting go on while pieces are compressed and counted."""
    with ThreadPoolExecutor(THREADS) as pool:
        waiting = collections.deque()
        for item in items:
            waiting.append(pool.submit(f, *item))
            if len(waiting) > THREADS:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def land_member(source: str, member: str, folder: str, size: int = PIECE, sep: str = ",") -> int | None:
    """Lands one member under folder; returns its number of pieces, or None where the archive does not have it."""
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    own = f"{at}/_new-{uuid.uuid4().hex}"
    from_fs, path = pyarrow.fs.FileSystem.from_uri(source)
    with from_fs.open_input_file(path) as raw, zipfile.ZipFile(raw) as z:
        if member not in z.namelist():
            return None
        fs.create_dir(own, recursive=True)
        try:
            with z.open(member) as f, fs.open_output_stream(f"{own}/text", compression=None) as out:
                rows, before, at_byte, crc, size_of_text = [], 0, 0, 0, 0

                def put(data: bytes) -> None:
                    nonlocal at_byte
                    out.write(data)
                    at_byte += len(data)

                def counted(press: zips.Press) -> None:
                    nonlocal crc, size_of_text
                    crc, size_of_text = zips.crc_of_both(crc, press.crc, press.text), size_of_text + press.text

                head = f.readline()
                names = names_of(head, sep)

                def pressed(text: bytes, is_whole: bool) -> tuple[tuple[int, str, str] | None, bytes, zips.Press]:
                    told, press = None, zips.Press()
                    if is_whole:
                        try:
                            told = _told(text, names, sep)
                        except pa.ArrowInvalid:  # the reader will say what is wrong with these rows
                            pass
                    return told, press.put(text) + press.end(), press

                put(zips.GZIP)
                _, data, press = pressed(head, False)
                put(data)
                counted(press)
                cut = True
                for told, data, press in _ahead(pressed, _pieces(f, size, ord(sep))):
                    if told and cut:
                        rows.append([at_byte, len(data), press.text, told[0], before, told[1], told[2]])
                        before += told[0]
                    elif cut:  # from here on the member is one piece
                        rows.append([at_byte, len(data), press.text, None, before, None, None])
                        cut = False
                    else:
                        rows[-1][1] += len(data)
                        rows[-1][2] += press.text
                    put(data)
                    counted(press)
                put(zips.LAST + struct.pack("<2L", crc, size_of_text & 0xFFFFFFFF))
            index = pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(INDEX.types)], schema=INDEX).replace_schema_metadata({"names": json.dumps(names)})
            pyarrow.parquet.write_table(index, f"{own}/index", filesystem=fs)
            fs.move(f"{own}/text", f"{at}/{member}.gz")
            fs.move(f"{own}/index", f"{at}/{member}.index")  # last: who sees it finds the text
        finally:
            fs.delete_dir(own)
    return len(rows)


def land(spark: SparkSession, archives: dict[str, str], folder: str, size: int = PIECE) -> dict[str, str]:
    """Lands the members of archives, a task for each; returns a folder for each archive, which is read as the archive itself would be.

    An archive with any fault is logged and left out.
    """
    ship(spark)
    folder = folder.rstrip("/")
    wanted = [(name, path, member) for name, path in archives.items() for member in schemas.MEMBERS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, path, member in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fault = None
                try:
                    land_member(path, member, f"{folder}/{name}", size)
                except (OSError, ValueError, EOFError, zipfile.BadZipFile, zlib.error, pa.ArrowInvalid) as e:
                    fault = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([fault], pa.string())], ["name", "fault"])

    frame = spark.createDataFrame(wanted, "name string, path string, member string").repartitionByRange(max(1, len(wanted)), "name", "member")
    faults = {r["name"]: r["fault"] for r in frame.mapInArrow(run, "name string, fault string").filter("fault IS NOT NULL").collect()}
    for name, fault in faults.items():
        log.error("feed %s not landed: %s", name, fault)
    for name in archives:
        if name not in faults:  # also for an archive without any member
            fs, at = pyarrow.fs.FileSystem.from_uri(f"{folder}/{name}")
            fs.create_dir(at, recursive=True)
    return {name: f"{folder}/{name}" for name in archives if name not in faults}


def is_landed(path: str) -> bool:
    """Whether path is a folder that `land` made rather than an archive."""
    fs, at = pyarrow.fs.FileSystem.from_uri(path)
    return fs.get_file_info(at).type == pyarrow.fs.FileType.Directory


def landed_members(path: str) -> list[str]:
    fs, at = pyarrow.fs.FileSystem.from_uri(path)
    return sorted(f.base_name.removesuffix(".index") for f in fs.get_file_info(pyarrow.fs.FileSelector(at)) if f.base_name.endswith(".index"))


def index_of(path: str, member: str) -> tuple[list[str], list[dict]] | None:
    """Column names and pieces of a landed member; None where there is none."""
    fs, at = pyarrow.fs.FileSystem.from_uri(path)
    if fs.get_file_info(f"{at}/{member}.index").type == pyarrow.fs.FileType.NotFound:
        return None
    table = pyarrow.parquet.read_table(f"{at}/{member}.index", filesystem=fs)
    return json.loads(table.schema.metadata[b"names"]), table.to_pylist()


class Inflated(io.RawIOBase):
    """The text of pieces that follow one another in a landed member."""

    def __init__(self, path: str, member: str, start: int, size: int):
        fs, at = pyarrow.fs.FileSystem.from_uri(path)
        self.raw, self.left, self.inflate, self.ready = fs.open_input_file(f"{at}/{member}.gz"), size, zlib.decompressobj(-15), b""
        self.raw.seek(start)

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.ready:
            more = self.inflate.unconsumed_tail
            if not more:
                if not self.left:
                    return 0
                more = self.raw.read(min(self.left, 1 << 20))
                self.left -= len(more)
            self.ready = self.inflate.decompress(more, 1 << 22)
        n = min(len(target), len(self.ready))
        target[:n], self.ready = self.ready[:n], self.ready[n:]
        return n

    def close(self) -> None:
        self.raw.close()
        super().close()
