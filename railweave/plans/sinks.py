"""Sinks (SNK-01 to SNK-10): tables as sorted Parquet, statistics, and the counter report."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

import pyarrow.fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from railweave import schemas
from railweave.operators.lookups import assert_unique

#: SNK-05: what each table is sorted by, so that row groups can be skipped; (stop_id, dep_min) serves departures, and a
#: second copy of stop times by (trip_id, stop_sequence) serves itineraries.
LAYOUT = {
    "stops": ["uic", "parent_name", "country"],
    "routes": ["route_id"],
    "trips": ["route_id", "trip_id"],
    "stop_times": ["stop_id", "dep_min"],
    "calendar_dates": ["service_id", "date", "exception_type"],
}
SECOND = {"stop_times": ["trip_id", "stop_sequence"]}


def write_tables(tables: dict[str, DataFrame], folder: str, compression: str = "gzip", check_keys: bool = True) -> dict[str, str]:
    """Replaces all tables (SNK-04) under folder and returns their paths.

    All tables are written beside the old ones and their primary keys checked there (CHK-01) before any is replaced; if replacing
    fails, those replaced are put back. Each table is computed once: checks and second layouts read what was written.
    """
    folder, run = folder.rstrip("/"), uuid.uuid4().hex
    staged: list[str] = []

    def write(df: DataFrame, name: str, order: list[str]) -> DataFrame:
        order, path = [c for c in order if c in df.columns], f"{folder}/_new-{run}/{name}"
        df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("compression", compression).parquet(path)
        staged.append(name)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    try:
        for name, df in tables.items():
            if name == "report":
                continue
            back = write(df, name, LAYOUT[name])
            if check_keys and name in schemas.PRIMARY_KEYS:
                assert_unique(back, schemas.PRIMARY_KEYS[name])
            if name in SECOND:
                write(back, f"{name}_by_{SECOND[name][0]}", SECOND[name])
        _swap(folder, run, staged)
    finally:
        _delete(f"{folder}/_new-{run}")
    return {name: f"{folder}/{name}" for name in staged}


def _swap(folder: str, run: str, names: list[str]) -> None:
    """Puts the tables of _new-<run> in the place of those that folder has; all of them or, on a fault, none."""
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    old, moved = f"{at}/_old-{run}", []
    fs.create_dir(old, recursive=True)
    there = [n for n in names if fs.get_file_info(f"{at}/{n}").type != pyarrow.fs.FileType.NotFound]
    try:
        for source, target, which in ((at, old, there), (f"{at}/_new-{run}", at, names)):
            for n in which:
                fs.move(f"{source}/{n}", f"{target}/{n}")
                moved.append((f"{target}/{n}", f"{source}/{n}"))
    except BaseException:
        for now, before in reversed(moved):
            fs.move(now, before)
        raise
    finally:
        if not fs.get_file_info(pyarrow.fs.FileSelector(old)) or all(fs.get_file_info(f"{at}/{n}").type != pyarrow.fs.FileType.NotFound for n in names):
            fs.delete_dir(old)


def _delete(folder: str) -> None:
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    if fs.get_file_info(at).type != pyarrow.fs.FileType.NotFound:
        fs.delete_dir(at)


def compact(spark: SparkSession, folder: str, name: str, target_mib: int = 128, compression: str = "gzip") -> int:
    """SNK-06: a table's files written anew, of about target_mib each and in its layout, and swapped in; returns how many files."""
    order = next((keys for n, keys in SECOND.items() if name == f"{n}_by_{keys[0]}"), LAYOUT.get(name, []))
    folder, run = folder.rstrip("/"), uuid.uuid4().hex
    df, files = spark.read.parquet(f"{folder}/{name}"), max(1, math.ceil(size_mib(f"{folder}/{name}") / target_mib))
    order = [c for c in order if c in df.columns]
    try:
        df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.option("compression", compression).parquet(f"{folder}/_new-{run}/{name}")
        _swap(folder, run, [name])
    finally:
        _delete(f"{folder}/_new-{run}")
    return files


def save_bucketed(df: DataFrame, path: str, key: str, order: Sequence[str], buckets: int | None = None, name: str | None = None) -> str:
    """SNK-05: df as a table under path in buckets by key, sorted by key and order, one file a bucket; returns the table's name.

    Tables with as many buckets join, and one aggregates, by the key without a shuffle: it is done once, here.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *order).option("path", path).saveAsTable(name)
    return name


def publish(tables: dict[str, DataFrame], folder: str, compression: str = "gzip", check_keys: bool = True) -> int:
    """SNK-04: the tables as the folder's next snapshot; returns its version.

    Data files never replace others. A snapshot is there once its manifest is, which is one small file put in place as a whole: readers
    that resolve a manifest see all old or all new tables, at any moment. What a failed run wrote is deleted, and nothing refers to
    it. The counts in the manifest are observed by the writes themselves, which read nothing again but keys.
    """
    folder, run = folder.rstrip("/"), uuid.uuid4().hex
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    told: dict[str, dict] = {}
    try:
        for name, df in tables.items():
            order = [c for c in LAYOUT.get(name, []) if c in df.columns]
            key = schemas.PRIMARY_KEYS.get(name)
            laid = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
            seen = Observation()
            counted = laid.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull() if key else F.lit(False)).alias("null_keys"))
            path = f"_data/{run}/{name}"
            counted.write.option("compression", compression).parquet(f"{folder}/{path}")
            told[name] = {"path": path, "schema": df.schema.json()} | seen.get
            if check_keys and key:
                assert_unique(df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{path}"), key)
        version = max(_versions(folder), default=(0, ""))[0] + 1
        fs.create_dir(f"{at}/_manifests", recursive=True)
        with fs.open_output_stream(f"{at}/_manifests/_{run}") as out:
            out.write(json.dumps({"version": version, "tables": told}).encode())
        fs.move(f"{at}/_manifests/_{run}", f"{at}/_manifests/{version:012d}-{run}.json")
    except BaseException:
        _delete(f"{folder}/_data/{run}")
        raise
    return version


def _versions(folder: str) -> list[tuple[int, str]]:
    """Version and name of a folder's manifests; of two writers with the same version one comes last for all readers."""
    fs, at = pyarrow.fs.FileSystem.from_uri(f"{folder}/_manifests")
    files = fs.get_file_info(pyarrow.fs.FileSelector(at, allow_not_found=True))
    return sorted((int(f.base_name.partition("-")[0]), f.base_name) for f in files if f.base_name.endswith(".json"))


def manifest(folder: str, version: int | None = None) -> dict:
    """The newest snapshot's manifest, or that of a version."""
    folder = folder.rstrip("/")
    there = [v for v in _versions(folder) if version is None or v[0] == version]
    if not there:
        raise FileNotFoundError(f"no snapshot in {folder}")
    fs, at = pyarrow.fs.FileSystem.from_uri(f"{folder}/_manifests/{there[-1][1]}")
    with fs.open_input_stream(at) as f:
        return json.loads(f.read())


def snapshot(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of one snapshot, the newest unless a version is asked for, which later snapshots don't change."""
    folder = folder.rstrip("/")
    return {name: spark.read.schema(StructType.fromJson(json.loads(t["schema"]))).parquet(f"{folder}/{t['path']}") for name, t in manifest(folder, version)["tables"].items()}


def expire(folder: str, keep: int = 2) -> list[int]:
    """Deletes all snapshots but the newest ones, manifests first, and returns their versions. Running readers need theirs kept."""
    folder = folder.rstrip("/")
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    old = _versions(folder)[: -keep or None]
    for version, name in old:
        paths = {t["path"].rsplit("/", 1)[0] for t in manifest(folder, version)["tables"].values()}
        fs.delete_file(f"{at}/_manifests/{name}")
        for p in paths:
            _delete(f"{folder}/{p}")
    return [v for v, _ in old]


#: SNK-06: session settings under which the optimizer orders joins by the statistics of saved tables.
BY_COST = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true", "spark.sql.statistics.histogram.enabled": "true"}


def save_as_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str) -> None:
    """SNK-06: managed tables with statistics and histograms of all columns, by which plans under BY_COST order their joins."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    before = spark.conf.get("spark.sql.statistics.histogram.enabled")
    spark.conf.set("spark.sql.statistics.histogram.enabled", "true")
    try:
        for name, df in tables.items():
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
            columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
            spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    finally:
        spark.conf.set("spark.sql.statistics.histogram.enabled", before)


def json_list(c: Column) -> Column:
    """SNK-10: an array of strings as JSON text with ', ' between its items."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda s: F.regexp_extract(F.to_json(F.array(s)), r"^\[(.*)\]$", 1)), ", "), F.lit("]"))


def write_report(report: DataFrame, path: str) -> dict:
    """SNK-09: the one row of counters as a JSON file."""
    counters = report.first().asDict()
    fs, at = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_output_stream(at) as out:
        out.write(json.dumps(counters, indent=2, ensure_ascii=False).encode())
    return counters


def size_mib(folder: str) -> float:
    """SNK-08: what a sink has written; raises if there is nothing."""
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    files = [f for f in fs.get_file_info(pyarrow.fs.FileSelector(at, recursive=True)) if f.is_file]
    if not files:
        raise FileNotFoundError(folder)
    return sum(f.size for f in files) / (1 << 20)
