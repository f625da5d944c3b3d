"""Substring dedup: word passages that occur more than once anywhere are cut out.

Method: fixed-block anchors. Every document is cut into non-overlapping reference blocks of `block` words,
with 2 * block - 1 <= window, so that each window holds one whole block. Blocks are indexed by hash; every
rolling window of `block` words probes the index. Blocks that some probe hits at another position are
anchors, and hits are extended: the windows of `window` words around anchors are compared with one another,
and runs of equal windows are the maximal exact repeats, whose words go, the first occurrence included.

Scale: text moves once, compressed. The probes (truncated hashes) and the extension (64-bit hashes) move as
sorted lists, one entry per distinct hash and batch, so a passage in a third of all documents costs each
bucket one entry per batch. No pairs of occurrences are formed.

Null and empty texts have no words: they keep sha256 of "". Repeated rows, and rows with an equal doc_id, are documents of
their own and repeat each other; ids, null ones too, come back as they are. Extra columns are ignored. 64-bit hashes stand for
windows: chains of a bijective mixer, over which no text has structural collisions; among n windows one is taken for
repeated wrongly with probability n / 2**64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm import hashx, textops as T
from llm.common import load

WINDOW, BLOCK = 35, 18
#: Bits of a probe's hash. A filter only: its false hits are settled by the 64-bit windows.
PROBE_BITS = 44
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
DIGEST = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def _grams(buf, offsets, k):
    s, e, off = T.words(buf, offsets)
    hashes = T.word_hashes(buf, s, e)
    return s, e, off, hashes, *T.windows(hashes, off, k)


def substring_dedup(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, texts: bool = True) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256 and, if texts, the kept words joined by a space."""
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole block: 2 * block - 1 <= window")
    n, cut = hashx.spread(docs), np.uint64(64 - PROBE_BITS)

    def probes(buf, offsets):
        s, e, off, hashes, start, grams = _grams(buf, offsets, block)
        own, place, count = hashx.distinct((grams >> cut) << cut)
        before = np.repeat(off[:-1], np.diff(off))
        return s, e, off, hashes, start, before, own, place, count

    def ask_probes(batch, ids, buf, offsets):
        _, _, _, _, start, before, own, place, count = probes(buf, offsets)
        flags = (count > 1).astype(np.uint8)
        flags[place[(start - before[start]) % block == 0]] |= 2
        return hashx.ask_rows(batch, own, n, flags=flags)

    def reply_probes(requests):
        _, place = hashx.merged(requests)
        flags = np.concatenate([r["flags"] for r in requests])
        askers = np.bincount(place) + np.bincount(place, flags & 1)
        hit = (askers > 1) & (np.bincount(place, flags & 2) > 0)
        return [{"hit": hashx.bits(x)} for x in hashx.parted(hit[place], requests)]

    def candidates(buf, offsets, given):
        """Windows whose first whole block is an anchor."""
        s, e, off, hashes, start, before, own, place, _ = probes(buf, offsets)
        anchor = np.zeros(len(hashes) + block, bool)
        if len(start):
            anchor[start] = given["hit"][place] > 0
        begin, long = T.windows(hashes, off, window)
        base = before[begin] if len(begin) else begin
        first = base + -(-(begin - base) // block) * block
        keep = anchor[first]
        return s, e, off, begin[keep], *hashx.distinct(long[keep])

    def ask_windows(batch, ids, buf, offsets, given):
        *_, own, _, count = candidates(buf, offsets, given)
        return hashx.ask_rows(batch, own, n, many=hashx.bits(count > 1))

    def reply_windows(requests):
        _, place = hashx.merged(requests)
        many = np.concatenate([r["many"] for r in requests])
        hit = np.bincount(place) + np.bincount(place, many) > 1
        return [{"hit": hashx.bits(x)} for x in hashx.parted(hit[place], requests)]

    def result(ids, buf, offsets, given, given_windows):
        s, e, off, begin, own, place, _ = candidates(buf, offsets, given)
        repeats = begin[given_windows["hit"][place] > 0] if len(begin) else begin
        gone = T.covered(repeats, window, len(s))
        kept = ~gone
        # kept words, each with a space after it
        lengths = (e - s)[kept] + 1
        index = T.gather(s[kept], lengths)
        out = buf[np.minimum(index, max(len(buf) - 1, 0))].copy() if len(index) else np.zeros(0, np.uint8)
        ends = np.cumsum(lengths)
        out[ends - 1] = 32
        before = np.concatenate([[0], np.cumsum(kept)])
        at = np.concatenate([[0], ends])[before[off]]
        texts_out = [out[a : max(a, b - 1)].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.table({
            "doc_id": pa.array(ids), "n_words": pa.array(np.diff(off)), "n_removed": pa.array(np.diff(off) - np.diff(before[off])),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts_out]),
            "kept": pa.array(texts_out if texts else [None] * len(ids), pa.binary()).cast(pa.string()),
        })

    packed = hashx.pack(docs)
    hits = hashx.answer(hashx.ask(packed, ask_probes), reply_probes)
    repeats = hashx.answer(hashx.ask_again(packed, hits, ask_windows), reply_windows)
    return hashx.finish(packed, [hits, repeats], result, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(load(spark, sf_dir, "documents"), texts=False).select(*DIGEST)


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w),
h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+34], ' ')) AS g FROM p),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM h),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM c WHERE n > 1),
rl AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id),
k AS (SELECT w.doc_id, ws, coalesce(gone, []) AS gone FROM w LEFT JOIN rl USING (doc_id)),
e AS (SELECT doc_id, ws, len(gone) AS n_removed, unnest(range(1, len(ws) + 1)) AS i FROM k),
j AS (SELECT e.doc_id, string_agg(ws[e.i], ' ' ORDER BY e.i) AS kept FROM e ANTI JOIN r ON e.doc_id = r.doc_id AND e.i = r.i GROUP BY e.doc_id)
SELECT k.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM k LEFT JOIN j USING (doc_id)
"""
