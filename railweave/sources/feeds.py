"""Timetable feeds: the operator catalog, members of zip archives, and the station reference (SRC-01 to SRC-11)."""

from __future__ import annotations

import datetime
import io
import json
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull
from pyspark.sql.types import LongType, StringType, StructField, StructType

from railweave import schemas
from railweave.sources import landed
from railweave.sources.csvs import blocks, names_of
from railweave.sources.session import ship

#: The catalog that stands in for a missing file.
DEFAULT_CATALOG = [{"id": "SNCF", "enabled": True, "gtfs_url": "https://eu.ftp.opendatasoft.com/sncf/plandata/Export_OpenData_SNCF_GTFS_NewTripId.zip"}]
ROW = "_row"


def _open(uri: str):
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


class _Part(InputPartition):
    """An archive's member; of a landed one, bytes that begin at a restart point, their column names and the rows before them."""

    def __init__(self, uri: str, names: list[str] | None = None, start: int = 0, size: int = 0, before: int = 0):
        self.uri, self.names, self.start, self.size, self.before = uri, names, start, size, before


class FeedReader(DataSourceReader):
    """Rows stream out in blocks, so a member need not fit in memory. An archive is one partition; a landed feed has one for each
    split_mib MiB of a member's text. Equality, IN and IS NOT NULL filters are applied to each block, and to the index of landed pieces before."""

    def __init__(self, schema: StructType, options: dict):
        self.columns = [f.name for f in schema.fields if f.name != ROW]
        self.member, self.missing, self.sep = options["member"], options.get("missing", "empty"), options.get("sep", ",")
        self.uris = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.optional = set(json.loads(options.get("optional", "[]")))
        self.split = float(options.get("split_mib", 64)) * (1 << 20)
        self.wanted: dict[str, set[str]] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else []
            name = f.attribute[0] if (values or isinstance(f, IsNotNull)) and len(f.attribute) == 1 else None
            if name in self.columns and isinstance(f, IsNotNull):
                self.present.add(name)
            elif name in self.columns and all(isinstance(v, str) for v in values):
                self.wanted[name] = self.wanted.get(name, set(values)) & set(values)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        parts = [p for uri in self.uris for p in (self._splits(uri) if self.member and landed.is_landed(uri) else [_Part(uri)])]
        return parts or [_Part("", [])]  # one that is empty, where there is nothing to read

    def _splits(self, uri: str) -> list[_Part]:
        index = landed.index_of(uri, self.member)
        if index is None:
            if self.missing == "error":
                raise FileNotFoundError(f"{uri} has no {self.member}")
            return []
        names, pieces = index
        self._check(names)
        parts: list[_Part] = []
        text = 0
        for p in filter(self._may_have, pieces):
            if parts and parts[-1].start + parts[-1].size == p["start"] and text + p["bytes"] <= self.split:
                parts[-1].size += p["size"]
                text += p["bytes"]
            else:
                parts.append(_Part(uri, names, p["start"], p["size"], p["before"]))
                text = p["bytes"]
        return parts

    def _may_have(self, piece: dict) -> bool:
        """Whether a piece's least and greatest ids leave room for rows that the filters want."""
        if piece["least"] is None:
            return True
        least, most = json.loads(piece["least"]), json.loads(piece["most"])
        return all(any(least[n] <= v <= most[n] for v in values) for n, values in self.wanted.items() if n in least)

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if partition.names is not None and not partition.size:
            return
        if partition.names is not None:
            with io.BufferedReader(landed.Inflated(partition.uri, self.member, partition.start, partition.size), 1 << 20) as f:
                yield from self._rows(f, partition.names, partition.before)
        elif not self.member:
            with _open(partition.uri) as raw:
                f = io.BufferedReader(raw, 1 << 20)
                yield from self._rows(f, names_of(f.readline(), self.sep))
        else:
            with _open(partition.uri) as raw, zipfile.ZipFile(raw) as z:
                if self.member not in z.namelist():
                    if self.missing == "error":
                        raise FileNotFoundError(f"{partition.uri} has no {self.member}")
                    return
                with z.open(self.member) as f:
                    yield from self._rows(f, names_of(f.readline(), self.sep))

    def _check(self, names: list[str]) -> None:
        if absent := [c for c in self.columns if c not in names and c not in self.optional]:
            raise ValueError(f"{self.member} lacks {', '.join(absent)}")

    def _rows(self, f, names: list[str], at: int = 0) -> Iterator[pa.RecordBatch]:
        self._check(names)
        for b in blocks(f, names, self.sep, [c for c in self.columns if c in names] or names[:1]):
            columns = [b.column(c) if c in b.schema.names else pa.nulls(len(b), pa.string()) for c in self.columns]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(at, at + len(b), dtype=np.int64))], [*self.columns, ROW])
            at += len(b)
            for name in self.present - set(self.wanted):
                out = out.filter(out.column(name).is_valid())
            for name, values in self.wanted.items():
                out = out.filter(pc.is_in(out.column(name), pa.array(sorted(values), pa.string())))
            yield out


class FeedSource(DataSource):
    """spark.read.format("gtfs").schema(...).option("path", zip).option("member", "stops.txt"): all columns are strings, _row is the
    row's place in its member. The path is an archive or a folder that landed.land made of one. Options: paths (JSON list of these),
    missing ('empty' or 'error', for a missing member), optional (JSON list of columns that may be absent and are null then),
    split_mib (text of a landed member that one task reads)."""

    @classmethod
    def name(cls) -> str:
        return "gtfs"

    def schema(self) -> StructType:
        return member_schema(schemas.MEMBERS[self.options["member"]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return FeedReader(schema, dict(self.options))


def registered(spark: SparkSession) -> None:
    """Makes the "gtfs" format known to a session, which pushes filters down to it."""
    ship(spark)
    spark.dataSource.register(FeedSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def member_schema(columns: Sequence[str]) -> StructType:
    return StructType([*(StructField(c, StringType()) for c in columns), StructField(ROW, LongType())])


def read_member(spark: SparkSession, path: str, member: str, columns: Sequence[str], optional: Sequence[str] = (), missing: str = "empty") -> DataFrame:
    """SRC-04 to SRC-07: the named columns of one member, and _row; a column that is absent raises unless optional."""
    registered(spark)
    options = {"path": path, "member": member, "missing": missing, "optional": json.dumps(list(optional))}
    return spark.read.format("gtfs").schema(member_schema(columns)).options(**options).load()


def members(path: str) -> list[str]:
    """SRC-04: names of a feed's members; raises where there is no readable archive and no landed folder."""
    if landed.is_landed(path):
        return landed.landed_members(path)
    with _open(path) as raw, zipfile.ZipFile(raw) as z:
        return z.namelist()


def has_column(path: str, member: str, column: str) -> bool:
    """SRC-07: whether a member's header has a column."""
    if landed.is_landed(path):
        return column in (landed.index_of(path, member) or ([], []))[0]
    with _open(path) as raw, zipfile.ZipFile(raw) as z:
        if member not in z.namelist():
            return False
        with z.open(member) as f:
            return column in names_of(f.readline())


def read_catalog(spark: SparkSession, path: str | None, default: list[dict] | None = None) -> DataFrame:
    """SRC-01: the operator catalog, in file order (column op_idx); default stands in for a missing file, else that raises."""
    rows = default
    if path is not None:
        fs, at = pyarrow.fs.FileSystem.from_uri(path)
        if fs.get_file_info(at).type != pyarrow.fs.FileType.NotFound:
            with fs.open_input_stream(at) as f:
                rows = json.loads(f.read())
    if rows is None:
        raise FileNotFoundError(f"no operator catalog at {path}")
    full = [[i, *(r.get(f.name) for f in schemas.CATALOG.fields)] for i, r in enumerate(rows)]
    return spark.createDataFrame(full, StructType([StructField("op_idx", LongType()), *schemas.CATALOG.fields]))


def enabled(catalog: DataFrame) -> DataFrame:
    """SRC-02: operators that are on (the default) and have an address."""
    return catalog.filter(F.coalesce("enabled", F.lit(True)) & (F.length(F.coalesce("gtfs_url", F.lit(""))) > 0))


def download(url: str, path: str, timeout: float = 180) -> str:
    """SRC-03: lands a feed once under path; every later read is of that copy."""
    import urllib.request

    fs, at = pyarrow.fs.FileSystem.from_uri(path)
    with urllib.request.urlopen(url, timeout=timeout) as got, fs.open_output_stream(at) as out:  # noqa: S310
        while block := got.read(1 << 20):
            out.write(block)
    return path


def read_stations(spark: SparkSession, path: str | None) -> DataFrame | None:
    """SRC-09: the ';'-separated station table with a place for each row, or None where there is no file."""
    if path is None:
        return None
    fs, at = pyarrow.fs.FileSystem.from_uri(path)
    if fs.get_file_info(at).type == pyarrow.fs.FileType.NotFound:
        return None
    registered(spark)
    options = {"path": path, "member": "", "sep": ";", "optional": json.dumps(schemas.STATIONS)}
    return spark.read.format("gtfs").schema(member_schema(schemas.STATIONS)).options(**options).load()


def today() -> str:
    return datetime.date.today().isoformat()
