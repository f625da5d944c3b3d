"""Deterministic range shards and files in the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

#: Shards at most (a larger table has larger shards), and key ranges counted at once at most: what the driver sees is bounded by these.
MOST_SHARDS, RANGES = 1 << 14, 1 << 16


def borders(keys: DataFrame, key: str, rows_per_shard: int) -> np.ndarray:
    """First keys of all shards but the first: ranges of about rows_per_shard rows, the same for the same rows.

    Rows are counted by ranges of 2**shift keys; ranges that hold more than a shard are counted again, finer. The driver
    sees one number a range. Rows with one key are never parted.
    """
    low, high, total = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    rows = max(rows_per_shard, -(-total // MOST_SHARDS)) if total else 1
    if total <= rows:
        return np.zeros(0, np.int64)
    shift, room = 0, min(RANGES, 64 * -(-total // rows))
    while (high >> shift) - (low >> shift) >= room:
        shift += 1
    counted = {r[0] << shift: r[1] for r in _counts(keys, key, shift)}
    while shift and (heavy := sorted(k for k, c in counted.items() if c > rows)):
        finer = max(0, shift - max(1, (RANGES // len(heavy)).bit_length() - 1))
        some = keys.sparkSession.createDataFrame([(k >> shift,) for k in heavy], "_range long")
        inside = keys.select(key, F.shiftright(key, shift).alias("_range")).join(some, "_range", "left_semi")
        for k in heavy:
            del counted[k]
        counted |= {r[0] << finer: r[1] for r in _counts(inside, key, finer)}
        shift = finer
    out, size = [], 0
    for k, c in sorted(counted.items()):
        if size and size + c > rows:
            out.append(k)
            size = 0
        size += c
    return np.array(out, np.int64)


def _counts(keys: DataFrame, key: str, shift: int) -> list:
    return keys.filter(F.col(key).isNotNull()).groupBy(F.shiftright(key, shift).alias("range")).count().collect()


def sharded(df: DataFrame, key: str, rows_per_shard: int, ties: list[str] = (), of: DataFrame | None = None) -> DataFrame:
    """df with a column _shard: consecutive ranges of key (a long; null sorts first), one range a partition, sorted by key and ties.

    of: the table whose rows count, where df has other rows too.
    """
    first = borders((df if of is None else of).select(key), key, rows_per_shard)

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(first, keys, side="right"))

    # a null would turn the batch's keys into doubles
    return df.withColumn("_shard", shard(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))))).repartitionById(len(first) + 1, F.col("_shard")).sortWithinPartitions("_shard", key, *ties)


def put(uri: str, name: str, data: bytes) -> None:
    """Writes a file under a temporary name of its own and commits it by a rename; works on any store that pyarrow opens.

    Attempts of one task don't touch one another's temporary files. Where another attempt has committed the name and the store
    doesn't replace files, that file stays: names that attempts share must stand for the same bytes.
    """
    fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(path, recursive=True)
    own = f"{path}/_{name}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(own) as out:
        out.write(data)
    try:
        fs.move(own, f"{path}/{name}")
    except OSError:
        there = fs.get_file_info(f"{path}/{name}")
        if not there.is_file or there.size != len(data):
            raise
        fs.delete_file(own)


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else [0]
    yield from zip(edges[:-1], edges[1:], strict=True)
