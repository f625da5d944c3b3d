"""Suffix-array dedup: bytes covered by a string of 50 that also starts in an earlier document are cut out.

Method: hash-compared suffix sort, over the suffixes that can matter. The smallest 24-byte hash of each 50-byte
string is its anchor (leftmost and equal minima alike), so equal strings have equal anchors at equal offsets. Where a text repeats itself
after fewer than 24 bytes, anchors follow one another with the same bytes around: they are one anchor with an extent.
 1. Batches ask which anchors occur in several documents, and which whole texts (by their SHA-256). Whole copies need no more.
 2. The remaining common anchors move with their contexts: 26 bytes before, 50 from the anchor on. Each bucket
    merge-sorts the suffixes of the anchors, and likewise the reversed texts before them: prefix polynomial
    hashes (two primes) and binary search give the common extension of two suffixes in log(50) steps. The order and the common
    extensions of neighbours are verified on the bytes; if a hash misled the sort, the bytes are sorted themselves.
    A string at offset o equals another when both lie in one run of
    neighbours with >= 50 - o common bytes after, and one run with >= o common bytes before the anchor; its
    earliest document follows.
    An anchor with more than `many` different contexts in its batches (the edges of a passage that very many documents share) doesn't
    meet in one bucket: its strings are asked about one by one, dealt out by their own hashes, and compared on the bytes.
 3. Each batch marks the bytes of strings whose earliest document is an earlier one.

Hashes only bring strings together: whole texts are told apart by SHA-256, all else by its bytes, in batches and in buckets.

Scale: text moves once, compressed; equal contexts are merged in their batch and again in their bucket before
sorting, so a passage in a third of all documents is one context per batch. No pairs are formed. Long texts are hashed, and
contexts told apart, in pieces; a batch holds its text, numbers of its anchors (one in 14 bytes) and its distinct common contexts.

Null and empty texts keep nothing. Rows with an equal doc_id are not earlier than one another. Null ids stand last, behind any other,
and come back null. Extra columns are ignored, but for those named in carry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm import hashx, textops as T
from llm.common import load

LENGTH, GRAM = 50, 24
#: Contexts of one anchor, beyond one in each batch, from which on its strings are dealt out one by one.
MANY = 4096
#: Bits of an anchor's hash in the first round, a filter only.
PROBE_BITS = 44
CHUNK = 1 << 18
#: Anchors around which bytes are gathered at once.
PIECE = 1 << 16
#: Fixed primes and bases of the prefix hashes of suffix_sort.
PRIMES, BASES = (2147483647, 2147483629), (1103515245, 1812433253)
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept {}"
DIGEST = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _slide(a: np.ndarray, width: int, take) -> np.ndarray:
    """take over a[i : i + width] for each i, by doubling."""
    have = 1
    while 2 * have <= width:
        a = take(a[:-have], a[have:])
        have *= 2
    return take(a[: len(a) - (width - have)], a[width - have :]) if width > have else a


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the grams that are smallest in some string of `length` bytes of one text, and their extents.

    Of anchors less than a gram apart that follow one another with equal bytes around (a text that repeats itself), only the first is
    given; its extent is how far the last one is from it.
    """
    n, w = len(buf), length - gram + 1
    ends = np.zeros(n + 1, np.int32)  # strings that start near a text's end don't fit
    np.add.at(ends, np.maximum(offsets[:-1], offsets[1:] - (length - 1)), 1)
    np.add.at(ends, offsets[1:], -1)
    np.cumsum(ends, out=ends)
    fits = ends[:-1] == 0
    del ends
    out_p, out_h, out_x, before = [], [], [], None
    for a in range(0, n - gram + 1, CHUNK):
        b = min(a + CHUNK, n - gram + 1)
        lo, hi = max(0, a - w + 1), min(n - gram + 1, b + w - 1)
        count = hi - lo
        if count < w:
            continue
        g = T.gram_hashes(buf[lo : hi + gram - 1], gram) | T.U64(1)
        low = _slide(g, w, np.minimum)
        low[~fits[lo : lo + len(low)]] = 0
        padded = np.zeros(len(low) + 2 * (w - 1), T.U64)
        padded[w - 1 : w - 1 + len(low)] = low
        best = _slide(padded, w, np.maximum)[:count]
        p = np.flatnonzero(best == g)
        p = p[(p >= a - lo) & (p < b - lo)]
        h, p = g[p], p + lo
        if not len(p):
            continue
        again = _again(buf, offsets, p, h, before, length, gram)
        first = np.flatnonzero(~again)
        last = np.append(first[1:], len(p)) - 1
        if again[0]:  # goes on from the piece before
            out_x[-1][-1] += p[first[0] - 1 if len(first) else -1] - before[0]
        out_p.append(p[first])
        out_h.append(h[first])
        out_x.append(p[last] - p[first])
        if not len(first):  # the last anchor given keeps its place at the end of the lists
            for out in (out_p, out_h, out_x):
                out.pop()
        before = p[-1], h[-1]
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_p), np.concatenate(out_h), np.concatenate(out_x)) if out_p else (none, none.astype(T.U64), none)


def _again(buf: np.ndarray, offsets: np.ndarray, p: np.ndarray, h: np.ndarray, before: tuple | None, length: int, gram: int) -> np.ndarray:
    """Which anchors come less than a gram after one with the same hash and the same `length` bytes on either side, in one text."""
    from_, hash_ = (np.concatenate([[x], y[:-1]]) for x, y in zip(before or (-gram, h[0]), (p, h), strict=True))
    step = p - from_
    maybe = np.flatnonzero((step < gram) & (h == hash_))
    out = np.zeros(len(p), bool)
    if not len(maybe):
        return out
    doc = np.searchsorted(offsets, p[maybe], side="right") - 1
    maybe = maybe[(from_[maybe] - length >= offsets[doc]) & (p[maybe] + length <= offsets[doc + 1])]
    for d in np.unique(step[maybe]):
        at = maybe[step[maybe] == d]
        lo, hi = p[at[0]] - d - length, p[at[-1]] + length
        like = np.zeros(hi - d - lo + 1, np.int32)  # how many bytes before each are like those d on
        np.cumsum(buf[lo : hi - d] == buf[lo + d : hi], out=like[1:])
        out[at] = like[p[at] + length - d - lo] - like[p[at] - d - length - lo] == 2 * length
    return out


def _extension(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefix of rows a and b, by binary search over prefix hashes (n, length + 1)."""
    width = hashes.shape[1]
    flat, a, b = hashes.ravel(), a * width, b * width
    low = np.zeros(len(a), np.int64)
    step = 1 << (width - 1).bit_length() - 1
    while step:
        to = low + step
        ok = to < width
        to = np.where(ok, to, 0)
        low = np.where(ok & (flat[a + to] == flat[b + to]), to, low)
        step >>= 1
    return low


def suffix_sort(text: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge sort of the rows of text within groups (rows of a group adjacent, groups ascending).

    Returns the order and, for each place, the bytes in common with the row before it (0 at a group's start).
    Values are bytes + 1; 0 ends a row. Two rows are compared through their longest common extension.
    """
    n, width = text.shape
    hashes = np.zeros((n, width + 1), T.U64)
    for shift, p, base in zip((32, 0), map(T.U64, PRIMES), map(T.U64, BASES), strict=True):
        h = np.zeros(n, T.U64)
        for j in range(width):
            h = (h * base + text[:, j].astype(T.U64)) % p
            hashes[:, j + 1] |= h << T.U64(shift)
    padded = np.concatenate([text, np.zeros((n, 1), text.dtype)], axis=1).ravel()
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.append(start, n))
    order, begin, length = np.arange(n), np.repeat(start, size), np.repeat(size, size)

    def less(a, b):
        at = _extension(hashes, a, b)
        return padded[a * (width + 1) + at] < padded[b * (width + 1) + at]

    run = 1
    while run < size.max(initial=1):
        place = np.flatnonzero(length > run)
        base, own = begin[place], place - begin[place]
        left = (own // run) % 2 == 0
        other = np.where(left, own // run + 1, own // run - 1) * run
        lo = np.minimum(other, length[place])
        first, hi = lo.copy(), np.minimum(other + run, length[place])
        me = order[place]
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            them = order[base[open_] + mid]
            after = np.where(left[open_], less(them, me[open_]), ~less(me[open_], them))
            lo[open_] = np.where(after, mid + 1, lo[open_])
            hi[open_] = np.where(after, hi[open_], mid)
        pair = own // (2 * run) * (2 * run)
        order[base + pair + (own - own // run * run) + (lo - first)] = me
        run *= 2
    common = np.zeros(n, np.int64)
    if n < 2:
        return order, common

    def verified(a, b):
        """The bytes in common, from the bytes themselves, and whether rows of a group stand in order."""
        equal = (text[a] == text[b]) & (text[a] > 0)
        true = np.where(equal.all(1), width, np.argmin(equal, 1))
        within = group[1:] == group[:-1]  # groups keep their places
        return np.where(within, true, 0), bool((padded[a * (width + 1) + true] <= padded[b * (width + 1) + true])[within].all())

    common[1:], sorted_ = verified(order[:-1], order[1:])
    if not sorted_:  # unequal strings with equal hashes led the sort astray
        order = np.lexsort([*text.T[::-1], group])
        common[1:], _ = verified(order[:-1], order[1:])
    return order, common


def earliest(doc: np.ndarray, group: np.ndarray, before: np.ndarray, after: np.ndarray, length: int) -> np.ndarray:
    """Smallest doc that holds each string (row, offset before the anchor); rows are distinct contexts.

    before: texts before the anchor, reversed; after: texts from it on; both as byte + 1, 0 beyond the text.
    """
    n, offsets = len(doc), before.shape[1] + 1
    out = np.repeat(doc[:, None], offsets, 1)
    many = np.flatnonzero((np.r_[False, group[1:] == group[:-1]]) | (np.r_[group[1:] == group[:-1], False])) if n else []
    if not len(many):
        return out
    doc, group, before, after = doc[many], group[many], before[many], after[many]
    room_before, room_after = (before > 0).sum(1), (after > 0).sum(1)
    right, common_right = suffix_sort(after, group)
    left, common_left = suffix_sort(before, group)
    right_place, left_place = np.empty_like(right), np.empty_like(left)
    right_place[right], left_place[left] = np.arange(len(doc)), np.arange(len(doc))
    new = np.r_[True, group[1:] != group[:-1]]  # groups keep their places in either order
    for o in range(offsets):
        right_run = np.cumsum(new | (common_right < length - o))[right_place]
        left_run = np.cumsum(new | (common_left < o))[left_place]
        rows = np.flatnonzero((room_before >= o) & (room_after >= length - o))
        if not len(rows):
            continue
        key = right_run[rows].astype(np.int64) * (len(doc) + 1) + left_run[rows]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        least = np.minimum.reduceat(doc[rows][order], first)
        best = np.repeat(least, np.diff(np.append(first, len(rows))))
        out[many[rows[order]], o] = best
    return out


def _beginnings(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns (numbers or byte rows) differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        differs = c[1:] != c[:-1]
        new[1:] |= differs.any(1) if c.ndim > 1 else differs
    return new


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str | None = "binary", many: int = MANY, carry: Sequence[str] = ()) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256, and kept: the bytes left ("binary"), their whole characters ("string") or null.

    The columns named in carry follow as they are.
    """
    n, cut, back = hashx.spread(docs), T.U64(64 - PROBE_BITS), length - gram
    fine = 4 * n  # contexts are wide: smaller buckets
    if not 0 <= back < 32:
        raise ValueError("length - gram must be 0 to 31")

    def digests(buf, offsets):
        """Texts that are long enough to lose something, and their SHA-256 as four numbers."""
        able = np.flatnonzero(np.diff(offsets) >= length)
        raw = b"".join(hashlib.sha256(buf[offsets[i] : offsets[i + 1]]).digest() for i in able)
        return able, np.frombuffer(raw, "<u8").reshape(-1, 4)

    def classes(rank, buf, offsets):
        """Texts in order of digest and id, their digests, and which begin a new digest."""
        able, digest = digests(buf, offsets)
        order = np.lexsort((rank[able], *digest.T[::-1]))
        able, digest = able[order], digest[order]
        return able, digest, _beginnings(digest)

    def first(buf, offsets):
        """Anchors, their extents and documents, the sorted distinct (shortened) hashes, each anchor's place among these, and their numbers."""
        p, h, extent = anchors(buf, offsets, length, gram)
        return p, h, extent, np.searchsorted(offsets, p, side="right") - 1, *hashx.distinct((h >> cut) << cut)

    def around(buf, offsets, p, doc):
        """The bytes around anchors (0 beyond the text), and how many there are before and from the anchor on."""
        left, right = np.minimum(p - offsets[doc], back), np.minimum(offsets[doc + 1] - p, length)
        width = back + length
        begin = np.clip(p - back, 0, max(len(buf) - width, 0))
        rows = np.lib.stride_tricks.sliding_window_view(buf if len(buf) >= width else np.pad(buf, (0, width - len(buf))), width)[begin]
        edge = np.flatnonzero(begin != p - back)  # the window ends where the batch does
        rows[edge] = buf[np.clip(p[edge, None] + np.arange(-back, length), 0, max(len(buf) - 1, 0))]
        short = np.flatnonzero((left < back) | (right < length))
        column = np.arange(back + length)
        rows[short] *= (column >= back - left[short, None]) & (column < back + right[short, None])
        return rows, left.astype(np.uint8), right.astype(np.uint8)

    def context_keys(rows, left, right):
        return T.row_hashes(rows) ^ T.mix(left.astype(T.U64) * T.U64(64) + right)

    def keys_around(buf, offsets, p, doc):
        """context_keys of anchors, a piece at a time."""
        parts = [context_keys(*around(buf, offsets, p[i : i + PIECE], doc[i : i + PIECE])) for i in range(0, len(p), PIECE)]
        return np.concatenate([np.zeros(0, T.U64), *parts])

    def ask_first(batch, ids, buf, offsets):
        able, digest, new = classes(hashx.ranks(ids), buf, offsets)
        if len(able):
            for bucket, *row in hashx.ask_rows(batch, digest[new][:, 0], n, rest=digest[new][:, 1:], ids=ids[able[new]]):
                yield n + bucket, *row
        p, h, _, doc, own, place, count = first(buf, offsets)
        if not len(p):
            return
        order = np.argsort(place, kind="stable")
        ends = np.cumsum(count)
        several = doc[order[ends - count]] != doc[order[ends - 1]]
        different = np.ones(len(own), np.uint32)
        again = np.flatnonzero(count[place] > 1)
        if len(again):
            keys = keys_around(buf, offsets, p[again], doc[again]) + h[again]
            _, key_place, _ = hashx.distinct(keys)
            one = np.zeros(key_place.max() + 1, np.int64)
            one[key_place] = place[again]
            different = np.maximum(np.bincount(one, minlength=len(own)), 1).astype(np.uint32)
        yield from hashx.ask_rows(batch, own, n, several=hashx.bits(several), different=different)

    def reply_texts(requests):
        ids, rest, h = (np.concatenate([r[k] for r in requests]) for k in ("ids", "rest", "hash"))
        rank = hashx.ranks(ids)
        order = np.lexsort((rank, *rest.T[::-1], h))
        new = _beginnings(h[order], rest[order])
        least = np.empty(len(ids), np.int64)
        least[order] = rank[order][new][np.cumsum(new) - 1]
        return [{"copy": hashx.bits(x)} for x in hashx.parted(least < rank, requests)]

    def reply_first(requests):
        if "rest" in requests[0]:
            return reply_texts(requests)
        _, place = hashx.merged(requests)
        several = np.bincount(place) + np.bincount(place, np.concatenate([r["several"] for r in requests])) > 1
        different = np.concatenate([r["different"] for r in requests]).astype(np.int64)
        crowded = np.bincount(place, np.maximum(different - 1, 0)) > many
        return [{"hit": x.astype(np.uint8)} for x in hashx.parted((several * (1 + crowded))[place], requests)]

    def common_anchors(rank, buf, offsets, given):
        """Which texts are later copies; the common anchors of the others with their extents, and which of these are crowded."""
        able, _, new = classes(rank, buf, offsets)
        copy = np.zeros(len(rank), bool)
        if len(able):
            group = np.cumsum(new) - 1
            copy[able] = (given["copy"][group] > 0) | (rank[able] > rank[able[new]][group])
        p, h, extent, doc, _, place, _ = first(buf, offsets)
        if not len(p):
            return copy, p, h, extent, doc, np.zeros(0, bool)
        hit = given["hit"][place]
        kept = (hit > 0) & ~copy[doc]
        return copy, p[kept], h[kept], extent[kept], doc[kept], hit[kept] > 1

    def contexts(rank, buf, offsets, p, h, doc):
        """The order of occurrences by anchor, context and id, and which of them begin a new context."""
        order = np.lexsort((rank[doc], keys_around(buf, offsets, p, doc), h))
        p, h, doc = p[order], h[order], doc[order]
        new = np.ones(len(p), bool)
        for i in range(1, len(p), PIECE):  # bytes decide, a piece at a time, each with the row before it
            j = min(i + PIECE, len(p))
            new[i:j] = _beginnings(h[i - 1 : j], *around(buf, offsets, p[i - 1 : j], doc[i - 1 : j]))[1:]
        return order, new

    def strings(rank, buf, offsets, p, extent, doc):
        """The strings around crowded anchors, ordered by hash and id: starts, extents, documents, hashes, bytes, and which begin a new string."""
        before, after = p - offsets[doc], offsets[doc + 1] - p
        on = np.full(len(buf) + 1, -1, np.int32)
        for o in range(back + 1):
            there = (before >= o) & (after >= length - o)
            at = p[there] - o
            on[at] = np.maximum(on[at], extent[there])
        start = np.flatnonzero(on >= 0)
        h = [T.gram_hashes(buf[a : a + CHUNK + length - 1], length)[start[(start >= a) & (start < a + CHUNK)] - a] for a in range(0, len(buf), CHUNK)]
        h, doc = np.concatenate([np.zeros(0, T.U64), *h]), np.searchsorted(offsets, start, side="right") - 1
        order = np.lexsort((rank[doc], h))
        start, doc, h = start[order], doc[order], h[order]
        rows = np.lib.stride_tricks.sliding_window_view(buf, length)[start] if len(start) else np.zeros((0, length), np.uint8)
        return start, on[start], doc, h, rows, _beginnings(h, rows)

    def ask_contexts(batch, ids, buf, offsets, given):
        rank = hashx.ranks(ids)
        _, p, h, extent, doc, crowded = common_anchors(rank, buf, offsets, given)
        if crowded.any():
            _, _, of, hashes, rows, new = strings(rank, buf, offsets, p[crowded], extent[crowded], doc[crowded])
            for bucket, *row in hashx.ask_rows(batch, hashes[new], fine, doc=ids[of[new]], text=rows[new]):
                yield fine + bucket, *row
        if not crowded.all():
            p, h, doc = p[~crowded], h[~crowded], doc[~crowded]
            order, new = contexts(rank, buf, offsets, p, h, doc)
            p, h, doc = (x[order[new]] for x in (p, h, doc))
            rows, left, right = around(buf, offsets, p, doc)
            yield from hashx.ask_rows(batch, h, fine, doc=ids[doc], left=left, right=right, text=rows)

    def reply_strings(requests):
        h, doc, text = (np.concatenate([r[k] for r in requests]) for k in ("hash", "doc", "text"))
        doc = hashx.ranks(doc)
        spelled = np.ascontiguousarray(text).view(f"S{length}").ravel()  # equal hashes are told apart on the bytes
        order = np.lexsort((doc, spelled, h))
        new = _beginnings(h[order], text[order])
        least = np.empty(len(h), np.int64)
        least[order] = doc[order][new][np.cumsum(new) - 1]
        return [{"early": hashx.bits(x)} for x in hashx.parted(least < doc, requests)]

    def reply_contexts(requests):
        if "left" not in requests[0]:
            return reply_strings(requests)
        h, doc, left, right, text = (np.concatenate([r[k] for r in requests]) for k in ("hash", "doc", "left", "right", "text"))
        doc = hashx.ranks(doc)
        # equal contexts of several batches become one, with their earliest document
        key = context_keys(text, left, right)
        order = np.lexsort((doc, key, h))
        new = _beginnings(h[order], key[order], left[order], right[order], text[order])
        place = np.empty(len(h), np.int64)
        place[order] = np.cumsum(new) - 1
        rep = order[new]
        column = np.arange(back + length)
        there = (column >= back - left[rep].astype(int)[:, None]) & (column < back + right[rep].astype(int)[:, None])
        codes = np.where(there, text[rep].astype(np.int16) + 1, 0).astype(np.int16)
        least = earliest(doc[rep], h[rep], np.ascontiguousarray(codes[:, :back][:, ::-1]), np.ascontiguousarray(codes[:, back:]), length)
        mask = np.zeros(len(h), np.uint32)
        for o in range(back + 1):
            mask |= (least[place, o] < doc).astype(np.uint32) << np.uint32(o)
        return [{"mask": x} for x in hashx.parted(mask, requests)]

    def result(ids, buf, offsets, given, given_contexts):
        rank = hashx.ranks(ids)
        copy, p, h, extent, doc, crowded = common_anchors(rank, buf, offsets, given)
        change, on = np.zeros(len(buf) + 1, np.int32), np.zeros(len(buf), bool)

        def cut_out(start, more):
            """The strings that begin at start, and those up to `more` further on that repeat them."""
            on[start] = True
            start, more = start[more > 0], more[more > 0]
            np.add.at(change, start, 1)
            np.add.at(change, start + length + more, -1)

        if crowded.any():
            start, more, of, _, _, new = strings(rank, buf, offsets, p[crowded], extent[crowded], doc[crowded])
            place = np.cumsum(new) - 1
            gone = (rank[of] > rank[of[new]][place]) | (given_contexts["early"][place] > 0)
            cut_out(start[gone], more[gone])
        if not crowded.all():
            p, h, extent, doc = (x[~crowded] for x in (p, h, extent, doc))
            order, new = contexts(rank, buf, offsets, p, h, doc)
            p, extent, doc = p[order], extent[order], doc[order]
            place = np.cumsum(new) - 1
            left, right = p - offsets[doc], offsets[doc + 1] - p
            later = rank[doc] > rank[doc[new]][place]
            mask = np.where(later, np.uint32((1 << back + 1) - 1), given_contexts["mask"][place])
            for o in range(back + 1):
                gone = ((mask >> np.uint32(o)) & 1 > 0) & (left >= o) & (right >= length - o)
                cut_out(p[gone] - o, extent[gone])
        start = np.flatnonzero(on)
        change[start] += 1
        change[start + length] -= 1
        gone = np.cumsum(change[:-1], out=change[:-1]) > 0
        del change, on
        size = np.diff(offsets)
        for i in np.flatnonzero(copy):
            gone[offsets[i] : offsets[i + 1]] = True
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        inner = offsets[:-1][size > 0]
        edge[inner] = gone[inner]
        before = T.counts(~gone, offsets)
        out = buf[~gone]
        left_over = [out[a:b].tobytes() for a, b in zip(before[:-1], before[1:], strict=True)]
        kept = pa.nulls(len(ids), pa.binary())
        if keep == "binary":
            kept = pa.array(left_over, pa.binary())
        elif keep == "string":
            kept = pa.array([t.decode(errors="ignore") for t in left_over], pa.string())
        return pa.table({
            "doc_id": pa.array(ids[:, 1]), "n_bytes": pa.array(size), "n_removed": pa.array(size - np.diff(before)), "n_spans": pa.array(T.per_row(edge, offsets)),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in left_over]), "kept": kept,
        })

    packed = hashx.pack(docs, carry=carry)
    common = hashx.answer(hashx.ask(packed, ask_first, pairs=True), reply_first)
    masks = hashx.answer(hashx.ask_again(packed, common, ask_contexts, pairs=True), reply_contexts)
    return hashx.finish(packed, [common, masks], result, SCHEMA.format(keep or "binary"), [docs.schema[c] for c in carry], pairs=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(load(spark, sf_dir, "documents"), keep=None).select(*DIGEST)
