"""Periodic runs, centroid clustering and stateful exact dedup against plain restatements."""

from __future__ import annotations

import hashlib
import math
import os
import pathlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from brute import sha, words

from llm import op11_periodic_runs as op11, op12_centroids as op12, op13_exact_dedup as op13

DOCS = "doc_id long, text string, lang string, distance string, kept string, n_runs string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", "r") for i, t in rows], DOCS)


def texts(n=150, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = [r.choice("aé b ccc".split()) for _ in range(r.choice([0, 1, 5, 40]))]
        if w and r.random() < 0.7:
            w = (w[: r.randrange(1, len(w) + 1)] * r.randrange(1, 12))[: r.randrange(1, 200)] + w
        out.append((i * 7 - 20, r.choice([" ", "\n", " \t "]).join(w)))
    return [*out, (5, None), (6, ""), (7, " \n"), (5, "u v " * 9), (None, "u v " * 9), (2**63 - 1, "q " * 50), (-(2**63), "q " * 6), (None, None), (9, "long " * 30_000)]


# ------------------------------------------------------------------------------------------------ op11


def runs_of(w):
    n, longest = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                longest.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in longest.items())


def periodic(rows):
    out = []
    for i, t in rows:
        w = words(t)
        n, h = len(w), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]
        found = runs_of(w) if n < 1000 else [(0, n, 1)]  # the long text is one word over and over
        gone = {k for s, m, q in found for k in range(s + q, s + m)}
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((i, len(found), *told, sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return sorted(out, key=str)


def test_periodic_runs(spark):
    rows = texts()
    assert any(op11.repeating(i, len(words(t))) for i, t in rows)
    got = op11.periodic_runs(docs_of(spark, rows).repartition(3))
    assert sorted((tuple(r[c] for c in op11.DIGEST) for r in got.collect()), key=str) == periodic(rows)
    assert all(r["collapsed_sha256"] == sha(r["collapsed"].encode()) for r in got.collect())


@pytest.mark.parametrize("grid", [1, 1 << 20])
def test_runs_of_small_alphabets(monkeypatch, grid):
    monkeypatch.setattr(op11, "GRID", grid)
    r = random.Random(8)
    for _ in range(300):
        several = []
        for _ in range(r.randrange(1, 4)):
            w = [r.randrange(r.choice([1, 2, 3])) for _ in range(r.randrange(50))]
            several.append((w[: r.randrange(1, 9)] * r.randrange(9))[: r.randrange(1, 90)] + w)
        begin = np.cumsum([0, *map(len, several)])
        want = [(s + b, n, q) for w, b in zip(several, begin, strict=False) for s, n, q in runs_of(w)]
        got = op11.runs(np.array(sum(several, []), np.int64), np.repeat(np.arange(len(several)), list(map(len, several))))
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_the_greatest_exponent_is_exact():
    n = 10**15  # as floating-point numbers the exponents would be equal
    assert op11._greatest([0, 1], [4 * n, 4 * n + 1], [n, n]) == 1
    assert op11._greatest([0, 1], [8, 4], [2, 1]) == 0


# ------------------------------------------------------------------------------------------------ op12


def clustered(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes())
    centers = [v for _, v in sorted(kept, key=key)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda: [min(range(len(centers)), key=lambda c: (far(v, centers[c]), c)) for _, v in kept]
    for _ in range(rounds):
        of = nearest()
        for c in range(len(centers)):
            if mine := [v for (_, v), o in zip(kept, of, strict=True) if o == c]:
                centers[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    of = nearest()
    d = [far(v, centers[o]) for (_, v), o in zip(kept, of, strict=True)]
    own = {c: sum(x for x, o in zip(d, of, strict=True) if o == c) for c in of}
    return sorted(((i, o, x, own[o], sum(d), sha(",".join(map(str, centers[o])).encode())) for (i, _), o, x in zip(kept, of, d, strict=True)), key=str)


def points(n=260, seed=2):
    r = random.Random(seed)
    homes = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(9)]
    out = [(i, [x + r.gauss(0, 0.2) for x in r.choice(homes)]) for i in range(n)]
    grid = [(1000 + i, [float(r.choice([0, 1]))] + [0.0] * 63) for i in range(60)]  # ties and copies
    odd = [(1, None), (2, [0.5] * 63), (3, [0.5] * 65), (4, [None] + [0.5] * 63), (5, [math.nan] + [0.5] * 63), (6, [math.inf] + [0.5] * 63), (None, homes[0]), (7, homes[1]), (7, homes[2]), (7, homes[1]), (8, [0.0] * 64)]
    return out + grid + odd


@pytest.mark.parametrize(("k", "rows"), [(40, points()), (5, points(90, 4)), (40, points()[-14:]), (1, points(30)), (40, [(1, None)])])
def test_centroids(spark, k, rows):
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance double").repartition(3)
    got = op12.centroids(frame, k)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == clustered(rows, k)


def test_bounds_hold_and_skip():
    """Bounds enclose the true distances in all rounds, ties go to the smaller number, and most distances are skipped in the end."""
    r = np.random.default_rng(0)
    homes = r.integers(-200, 200, (12, 64))
    x = homes[r.integers(0, 12, 4000)] + r.integers(-20, 20, (4000, 64))
    x[:50] = 0
    centers = x[r.permutation(4000)[:20]].copy()
    centers[7] = centers[3]
    cluster, upper, lower = np.zeros(4000, np.int32), np.full(4000, np.inf, np.float32), np.zeros((4000, 20), np.float32)
    for _ in range(6):
        done = op12.assigned(x, centers, op12.halves(centers), cluster, upper, lower)
        true = ((x[:, None] - centers) ** 2).sum(2)
        assert (cluster == true.argmin(1)).all()
        own = np.sqrt(true[np.arange(4000), cluster].astype(float))
        assert (upper >= own).all() and (lower <= np.sqrt(true.astype(float))).all()
        new = centers.copy()
        for c in np.unique(cluster):
            new[c] = x[cluster == c].sum(0) // (cluster == c).sum()
        moved = op12.above(np.sqrt(op12.squares(new, centers)))
        upper, lower = op12.shifted(cluster, upper, lower, moved)
        centers = new
    assert done < 4000 * 20 / 4


def test_too_large_components_raise(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="fits in a long"):
        op12.centroids(frame).collect()


# ------------------------------------------------------------------------------------------------ op13


def copies(rows):
    bare = lambda t: "".join(c for c in t or "" if c not in " \t\n\v\f\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(bare(t), []).append((-len(t or ""), i is None, i or 0, i))
    return sorted(((i, min(g)[3], len(g), sha(bare(t).encode())) for i, t in rows for g in [groups[bare(t)]]), key=str)


def saved(spark, rows, path, mode="append"):
    docs_of(spark, rows).repartition(3).write.mode(mode).parquet(path)
    return path


def check_copies(got, rows):
    seen = got.select("doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()
    assert sorted((tuple(r)[:4] for r in seen), key=str) == copies(rows)
    stays = {}
    for r in seen:
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"] and r["text_sha256"] not in stays
            stays[r["text_sha256"]] = r["keep_id"]
    assert len(stays) == len({r["text_sha256"] for r in seen})


def many(n=120):
    r = random.Random(6)
    base = [" ".join(r.choice("ab é \t x".split(" ")) for _ in range(r.randrange(1, 7))) for _ in range(25)]
    return [(i, r.choice(base) + r.choice(["", " ", "\n\n", " ", " "])) for i in range(n)] + texts(20)


def test_exact_dedup(spark, tmp_path):
    rows = many()
    check_copies(op13.exact_dedup(spark, saved(spark, rows, f"{tmp_path}/docs")), rows)


def test_exact_dedup_checks_bytes(spark, tmp_path):
    """With digests of two bits nearly all texts share one, and the bytes tell them apart, over several micro-batches."""
    rows = [(i, t) for i, t in many(60) if len(t or "") < 1000]
    weak = lambda text: bytes([hashlib.sha256(text).digest()[0] & 3])
    got = op13.exact_dedup(spark, saved(spark, rows, f"{tmp_path}/docs"), max_files=1, digest=weak)
    seen = sorted((tuple(r) for r in got.select("doc_id", "keep_id", "group_size").collect()), key=str)
    assert seen == sorted((x[:3] for x in copies(rows)), key=str)


def test_exact_dedup_goes_on(spark, tmp_path):
    """A second call with the same folder reads new files only and knows the texts of the first."""
    rows, state = many(), f"{tmp_path}/state"
    source = saved(spark, rows[:70], f"{tmp_path}/docs")
    check_copies(op13.exact_dedup(spark, source, state), rows[:70])
    before = {p.name for p in (tmp_path / "state/content").iterdir()}
    saved(spark, rows[70:], source)
    check_copies(op13.exact_dedup(spark, source, state), rows)
    assert before < {p.name for p in (tmp_path / "state/content").iterdir()}
    assert len(list((tmp_path / "state/slots").iterdir())) >= 2
    check_copies(op13.exact_dedup(spark, source, state), rows)  # nothing new


def test_exact_dedup_of_nothing(spark, tmp_path):
    assert op13.exact_dedup(spark, saved(spark, [], f"{tmp_path}/docs")).collect() == []


def test_exact_dedup_takes_no_disk_ahead_of_need(spark, tmp_path):
    """What the state's stores take on disk follows from what they hold: a store's manifest alone took 4 MB before."""
    local = pathlib.Path(os.environ.get("SPARK_LOCAL_DIRS", spark.conf.get("spark.local.dir")))
    stores = lambda: set(local.rglob("MANIFEST-*"))
    before, rows = stores(), many()
    check_copies(op13.exact_dedup(spark, saved(spark, rows, f"{tmp_path}/docs")), rows)
    new = stores() - before
    assert new and sum(512 * p.stat().st_blocks for p in new) < 1 << 20
