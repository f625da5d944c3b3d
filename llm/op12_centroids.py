"""Centroid clustering: Lloyd's rounds over whole-number vectors, with distances skipped by Elkan's bounds.

Every vector of 64 finite components becomes integers floor(256 * x). The first centroids are the k vectors whose ids hash lowest; each
round assigns every vector to its nearest centroid (ties: smaller number) and moves each centroid to the floored mean of its vectors.

Method: a vector keeps, from round to round, an upper bound of the distance to its own centroid and a lower bound of the distance to
each of the k; both shift by how far the centroids moved. A centroid is skipped if the upper bound is below its lower bound, or
below half the distance between it and the vector's own one; a vector is skipped whole if the upper bound is below half the distance
from its centroid to the nearest other. Only strict comparisons skip and all bounds are rounded away from the truth, so no nearer
and no equally near centroid is ever skipped; whatever is compared is compared by exact integer distances.

Scale: a round is one pass over a table of vectors with their bounds, which is written to the shared folder and read by the next
round (the one before it is then deleted); nothing is shuffled but one row for each task and cluster, which holds the task's sums. A
cluster of a third of all vectors is therefore nothing special. The driver and the tasks hold k centroids only.

Vectors that are null, of another length, or with null or non-finite components are left out. Repeated rows and rows with an equal id
count each by itself; null ids come back null and found no centroid before others did. With fewer than k vectors there are as
many centroids as vectors. Other columns are ignored. Components of 2**27 and more (after scaling) raise, as squared distances
would not fit in a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import dropped, load, ship, written
from llm.textops import utf8

DIM, SCALE, K, ROUNDS = 64, 256, 40, 5
#: Components are smaller than this, so that squared distances fit in a long.
LARGEST = 1 << 27
STATE = "vec_id long, v binary, cluster int, upper float, lower binary"
F32 = np.float32


def whole(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an array column that count, and their integer components."""
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls read as NaN
    offsets = column.offsets.to_numpy()
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (np.diff(offsets) == dim))
    x = values[offsets[rows, None] + np.arange(dim)] if len(rows) else np.zeros((0, dim))
    fine = np.isfinite(x).all(1)
    x = np.floor(scale * x[fine])
    if (np.abs(x) >= LARGEST).any():
        raise ValueError(f"a component of {LARGEST // scale} or more has no distance that fits in a long")
    return rows[fine], x.astype(np.int64)


def matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of equal binary cells as a matrix."""
    return np.frombuffer(utf8(column)[0].tobytes(), kind).reshape(-1, width)


def cells(m: np.ndarray) -> pa.Array:
    m = np.ascontiguousarray(m)
    ends = np.arange(len(m) + 1, dtype=np.int32) * (m.itemsize * m.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(m)])


def above(x: np.ndarray) -> np.ndarray:
    """Single-precision numbers that are not below x."""
    return np.nextafter(np.asarray(x).astype(F32), F32(np.inf))


def below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x).astype(F32), F32(-np.inf))


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def halves(centers: np.ndarray) -> np.ndarray:
    """Half of the distances between centroids, rounded down; infinite on the diagonal."""
    d = np.stack([squares(centers, c) for c in centers])
    half = below(np.sqrt(d) / 2)
    np.fill_diagonal(half, np.inf)
    return half


def assigned(x: np.ndarray, centers: np.ndarray, half: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Elkan's step, in place: cluster becomes each vector's nearest centroid. Returns how many distances were computed."""
    if not len(x):
        return 0
    rows = np.flatnonzero(upper >= half.min(1)[cluster])
    own, best = cluster[rows], squares(x[rows], centers[cluster[rows]])
    high, low = above(np.sqrt(best)), lower[rows]
    low[np.arange(len(rows)), own] = below(np.sqrt(best))
    done = len(rows)
    for c in range(len(centers)):
        r = np.flatnonzero((own != c) & (high >= low[:, c]) & (high >= half[own, c]))
        if not len(r):
            continue
        d = squares(x[rows[r]], centers[c])
        done += len(r)
        low[r, c] = below(np.sqrt(d))
        nearer = (d < best[r]) | ((d == best[r]) & (c < own[r]))
        r, d = r[nearer], d[nearer]
        own[r], best[r], high[r] = c, d, above(np.sqrt(d))
    cluster[rows], upper[rows], lower[rows] = own, high, low
    return done


def shifted(cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bounds after centroids moved by so much (rounded up)."""
    return above(upper + moved[cluster]), below(lower - moved)


def _seeds(vectors: DataFrame, k: int, dim: int) -> np.ndarray:
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("v", key.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r["v"], "<i4") for r in rows], np.int64).reshape(len(rows), dim)


def _means(state: DataFrame, centers: np.ndarray) -> np.ndarray:
    """Centroids moved to the floored means of their vectors; each task hands over one row of sums a cluster."""
    k, dim = centers.shape
    names = [f"s{j}" for j in range(dim)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            cluster, x = b.column(0).to_numpy(), matrix(b.column(1), "<i4", dim)
            order = np.argsort(cluster, kind="stable")
            first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            if len(first):
                total[cluster[order[first]]] += np.add.reduceat(x[order].astype(np.int64), first)
            count += np.bincount(cluster, minlength=k)
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array(count[has]), *(pa.array(c) for c in total[has].T)], ["cluster", "n", *names])

    part = state.select("cluster", "v").mapInArrow(sums, f"cluster int, n long, {', '.join(f'{s} long' for s in names)}")
    out = centers.copy()
    for r in part.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in names)).collect():  # k rows at most
        out[r["cluster"]] = [int(r[s]) // r["n"] for s in names]
    return out


def centroids(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """Per vector (columns vec_id, embedding): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    ship(spark)

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = whole(b.column(1), dim, scale)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), cells(x.astype("<i4"))], ["vec_id", "v"])

    table = written(spark, vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(integers, "vec_id long, v binary"), "vectors")
    centers = _seeds(table, k, dim)
    last, moved = table, None
    for step in range(rounds + 1):
        state = written(spark, _assigned(last, centers, moved, final=step == rounds), "clusters")
        dropped(last)
        if step < rounds:
            new = _means(state, centers)
            moved, centers, last = above(np.sqrt(squares(new, centers))), new, state
    totals = {r["cluster"]: int(r["d"]) for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows at most
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    told = spark.createDataFrame([(c, d, sum(totals.values()), digest[c]) for c, d in totals.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _assigned(last: DataFrame, centers: np.ndarray, moved: np.ndarray | None, final: bool) -> DataFrame:
    """One round over a table of vectors, which has bounds if centroids have moved; the final one gives distances instead."""
    k, dim = centers.shape
    half = halves(centers) if k else np.zeros((0, 0), F32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1), "<i4", dim).astype(np.int64) if len(b) else np.zeros((0, dim), np.int64)
            if moved is None:
                cluster, upper, lower = np.zeros(len(x), np.int32), np.full(len(x), np.inf, F32), np.zeros((len(x), k), F32)
            else:
                cluster = b.column(2).to_numpy().copy()
                upper, lower = shifted(cluster, b.column(3).to_numpy(), matrix(b.column(4), "<f4", k), moved)
            assigned(x, centers, half, cluster, upper, lower)
            if final:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster), pa.array(squares(x, centers[cluster]))], ["vec_id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cluster), pa.array(upper), cells(lower)], ["vec_id", "v", "cluster", "upper", "lower"])

    return last.mapInArrow(run, "vec_id long, cluster int, distance long" if final else STATE)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _sql() -> str:
    """Each round written out: distances from dot products, which are exact in doubles for components this small."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, any_value(k.v) AS v, min(CAST(list_dot_product(k.v, k.v) - 2 * list_dot_product(k.v, c.v) + list_dot_product(c.v, c.v) AS BIGINT) * {K} + c) AS m FROM k CROSS JOIN c{i} c GROUP BY vec_id)""")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (SELECT m % {K} AS c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT m, unnest(v) AS x, unnest(range({DIM})) AS j FROM a{i}) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(w, c{i}.v) AS v FROM c{i} LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS w FROM s{i} GROUP BY c) USING (c))""")
    return f"""WITH k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND list_count(embedding) = {DIM} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIM}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM k ORDER BY sha256('2:' || vec_id) LIMIT {K}),
{', '.join(steps)},
f AS (SELECT vec_id, m % {K} AS c, m // {K} AS distance FROM a{ROUNDS})
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256 FROM f JOIN c{ROUNDS} USING (c)"""


ORACLE_SQL = _sql()
