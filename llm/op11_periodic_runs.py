"""Periodic run detection: every maximal stretch of words that repeats itself at least four times, found by naming powers of two.

The words of a text are numbered from 0. For documents whose hash says so (`repeating`) a tail is first replaced by repetitions of a
piece of it, by contract. A run is a maximal stretch of words with smallest period q (words q apart are identical) and a length of at
least max(6, 4 * q). Collapsing a text drops each word that some run holds after the run's first q words.

Method: Karp, Miller and Rosenberg's naming. Words are named by their spelling; a stretch of 2**(k + 1) words is named by the names of its
two halves, so equal names are equal words, without hashes or suffix sorting. Names that occur once in their text are dropped at once and
naming ends with the level on which no name is left, so prose needs few levels and only repetitive texts many. A run of period q
holds a stretch of at least 3 * q places that equal the place q on; so of the grid of every 2 * q-th place, one has at least q such
places from it on, and equal names of the level of q's leading bit there and q on make it a candidate. Candidates are extended both
ways by descending through the levels (the longest common extension of places q apart), the first one of each run only. Of runs with the same
ends the smallest period stays: by Fine and Wilf's theorem a larger one is its multiple.

Scale: a text is worked on alone, so nothing is shuffled and no key can be hot: one pass over the documents, some megabytes of text at a
time, in which each text is named within itself. A text of n words takes n log n steps; candidates are looked at in pieces of GRID places.
A single text is one task's work, with 4 bytes a word and level: a text of 8 million words that repeats itself throughout takes 23 levels.

Null and empty texts have no runs. Rows are judged each by itself, whatever their ids; null ids come back null, and their texts are
not made to repeat. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import textops as T
from llm.common import load, ship

LEAST, TIMES = 6, 4
#: Bytes of text worked on at once; one longer text is worked on by itself.
SLICE = 1 << 20
#: Grid places looked at in one piece.
GRID = 1 << 20
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string"
DIGEST = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def repeating(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where a document of n words begins to repeat and with what period, if its hash makes it."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and names 0, 1, .. of these."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    alone = new.copy()
    alone[:-1] &= new[1:]
    kept = order[~alone]
    return kept, np.cumsum(new[~alone]) - 1


def names(words: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """By level, for each place the name of the 2**level words from it on, within its text; -1 where they occur once in it or leave it.

    words: numbers of the words; doc: the text of each word, ascending.
    """
    levels, n = [], len(words)
    at, name = _named(words * np.int64(doc[-1] + 1 if n else 1) + doc)  # a word is named with its text, so names of two texts differ
    size = 1
    while len(at):
        level = np.full(n, -1, np.int32)
        level[at] = name
        levels.append(level)
        both = at[at + size < n]
        both = both[(level[both + size] >= 0) & (doc[np.minimum(both + 2 * size, n) - 1] == doc[both]) & (both + 2 * size <= n)]
        kept, name = _named(level[both].astype(np.int64) * (n + 1) + level[both + size])
        at, size = both[kept], 2 * size
    return levels


def extension(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from places a and b on are the same."""
    n, far = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, x, y = levels[k], a + far, b + far
        inside = y < n
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        far += ((level[x] == level[y]) & (level[x] >= 0) & inside).astype(np.int64) << k
    return far


def extension_back(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before places a < b are the same."""
    far = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, x, y = levels[k], a - far - (1 << k), b - far - (1 << k)
        inside = x >= 0
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        far += ((level[x] == level[y]) & (level[x] >= 0) & inside).astype(np.int64) << k
    return far


def runs(words: np.ndarray, doc: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of all texts, by start and period."""
    n, levels = len(words), names(words, doc)
    found = [np.zeros((3, 0), np.int64)]
    top = min(n // times, (1 << len(levels)) - 1)  # a longer period would need a name of a level that has none
    q = 1
    while q <= top:
        # periods q .. to - 1, about GRID places of their grids together
        to, places = q, 0
        while to <= top and (to == q or places + n // (2 * to) < GRID) and (to == q or to & (to - 1)):
            places += n // (2 * to) + 1
            to += 1
        level = levels[q.bit_length() - 1]  # all periods of the piece have the same leading bit
        each = np.arange(q, to)
        count = np.maximum(-(-(n - each) // (2 * each)), 0)
        period = np.repeat(each, count)
        place = T.gather(np.zeros(len(each), np.int64), count) * 2 * period
        hit = level[place]
        hit = np.flatnonzero((hit >= 0) & (hit == level[place + period]))
        place, period = place[hit], period[hit]
        # where the 2 * q places before are like those q on, the grid place before this one is in the same run
        size, again = 1 << q.bit_length() - 1, place >= 2 * period
        for j in range(4):
            x = np.where(again, place - 2 * period + np.minimum(j * size, 2 * period - size), 0)
            again &= (level[x] >= 0) & (level[x] == level[x + period])
        place, period = place[~again], period[~again]
        start = place - extension_back(levels, place, place + period)
        length = place + period + extension(levels, place, place + period) - start
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([start[long], length[long], period[long]]))
        q = to
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _greatest(start: list[int], length: list[int], period: list[int]) -> int:
    """The run with the greatest exact length / period; the first of equal ones."""
    best = 0
    for i in range(1, len(start)):
        if length[i] * period[best] > length[best] * period[i]:
            best = i
    return best


def found_in(ids: list[int | None], buf: np.ndarray, offsets: np.ndarray, least: int = LEAST, times: int = TIMES, texts: bool = True) -> pa.RecordBatch:
    """The columns of SCHEMA for each text."""
    s, e, off = T.words(buf, offsets)
    source = np.arange(len(s))
    for i, doc_id in enumerate(ids):
        if shape := repeating(doc_id, int(off[i + 1] - off[i])):
            a, p = shape
            source[off[i] + a : off[i + 1]] = off[i] + a + np.arange(off[i + 1] - off[i] - a) % p
    words = T.spelled(buf, s, e).dictionary_encode().indices.to_numpy().astype(np.int64)[source]
    doc = np.repeat(np.arange(len(ids)), np.diff(off))
    start, length, period = runs(words, doc, least, times)
    change = np.zeros(len(s) + 1, np.int32)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    # kept words, each with a space after it
    of = source[kept]
    lengths = (e - s)[of] + 1
    index = T.gather(s[of], lengths)
    out = buf[np.minimum(index, max(len(buf) - 1, 0))] if len(index) else np.zeros(0, np.uint8)
    ends = np.cumsum(lengths)
    out[ends - 1] = 32
    at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(kept)])[off]]
    span = np.searchsorted(start, off)
    rows = []
    for i in range(len(ids)):
        lo, hi = span[i], span[i + 1]
        left = out[at[i] : max(at[i], at[i + 1] - 1)].tobytes()
        x, y, z = ((v[lo:hi] - base).tolist() for v, base in ((start, off[i]), (length, 0), (period, 0)))
        best = [None] * 4
        if x:
            b = _greatest(x, y, z)
            best = [x[b], y[b], z[b], 1000 * y[b] // z[b]]
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(x, y, z, strict=True))
        rows.append([ids[i], len(x), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest(), left.decode() if texts else None])
    kinds = [pa.int64()] * 6 + [pa.string()] * 3
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], [f.split()[0] for f in SCHEMA.split(", ")])


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, texts: bool = True) -> DataFrame:
    """Per document (columns doc_id, text): the number of runs, the greatest one, digests and, if texts, the collapsed text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            buf, offsets = T.utf8(b.column(1))
            for lo, hi in T.slices(offsets, SLICE):
                yield found_in(ids[lo:hi], buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], least, times, texts)
            T.release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(load(spark, sf_dir, "documents"), texts=False).select(*DIGEST)


#: Runs as islands: pairs of equal words of a text, by their distance. CRC-32 is computed bit by bit.
ORACLE_SQL = r"""
WITH b AS (SELECT doc_id, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS cs, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
t0 AS (SELECT list_transform(range(256), lambda x: CAST(x AS BIGINT)) AS t),
t AS (SELECT list_transform(t, lambda x: list_reduce(list_prepend(x, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), a >> 1) ELSE a >> 1 END)) AS t FROM t0),
h AS (SELECT b.*, len(ws) AS n, xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT), cs), lambda a, c: xor(t[(xor(a, c) & 255) + 1], a >> 8))) AS h FROM b, t),
g AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
w AS (SELECT doc_id, n, list_transform(range(n), lambda i: ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) AS ws FROM p),
x AS MATERIALIZED (SELECT doc_id, n, unnest(ws) AS x, unnest(range(n)) AS i FROM w),
e AS (SELECT u.doc_id, v.i - u.i AS q, u.i AS i FROM x u JOIN x v ON u.doc_id = v.doc_id AND u.x = v.x AND v.i > u.i AND v.i - u.i <= u.n // 4),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island),
r AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS q FROM s WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
m AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed FROM r GROUP BY doc_id),
z AS (SELECT doc_id, start, length, q FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) AS k FROM r) WHERE k = 1),
d AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM r),
c AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM x ANTI JOIN d USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, z.start, z.length, z.q AS period, 1000 * z.length // z.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w LEFT JOIN m USING (doc_id) LEFT JOIN z USING (doc_id) LEFT JOIN c USING (doc_id)
"""
