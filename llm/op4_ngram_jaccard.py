"""N-gram Jaccard join: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

Method: set-relation skipping over an exact prefix-filter index.
 1. Batches ask how many documents hold each shingle. A set of n shingles of which fewer than 0.8 n occur in
    another document can't have a partner. The rest are ordered rarest first, equal sets become one.
 2. Index: the tokens of a set's prefix (n - ceil(0.8 n) + 1 rarest) that occur elsewhere. A list is headed by its
    smallest document; lists with one head are relatives and are joined into one group, so that a set
    travels once per relative instead of once per token. Large groups are split into blocks, each with the head; then only
    members that are still apart from the head meet the other blocks.
 3. In a group, sets are ordered by size, and lists skip by position to the block of sizes that can match. The first
    set of a kind gets its answers (overlaps with all others) from the lists; those of a highly similar set are
    derived from them: |r & z| - |r - y| <= |y & z| <= |r & z| + |y - r|, and only what these bounds leave open, and
    what isn't connected yet, is counted. A group returns one edge for each set that it connects.
 4. Components by alternating stars.

Scale: text moves once, compressed; shingle counts as sorted hash lists, one entry per distinct shingle and batch.
Results and edges are linear in the documents. Null, empty and wordless texts have an empty set and no links. A
text of under five words is one shingle. Repeated rows are equal sets; rows with an equal doc_id share a component. Shingles are
compared as 64-bit hashes (chains of a bijective mixer, without structural collisions), in a group by 56 bits of them. Rows with a
null doc_id are returned and link with nothing. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm import hashx, textops as T
from llm.common import dropped, load, written
from llm.graph import components

WORDS = 5
PROBE_BITS = 44
#: Sets of a group, and shingles of them together, that one task takes at once; a larger group is split into blocks.
BLOCK, SHINGLES = 1500, 1_500_000
SETS = "doc_id long, n long, fp1 long, fp2 long, prefix array<long>, shingles binary"


def lowered(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each distinct shingle of each document, ordered by document and hash."""
    buf = lowered(buf)
    s, e, off = T.words(buf, offsets)
    hashes = T.word_hashes(buf, s, e)
    start, grams = T.windows(hashes, off, k)
    doc = np.searchsorted(off, start, side="right") - 1
    short = np.flatnonzero((np.diff(off) > 0) & (np.diff(off) < k))
    whole = T.chained(hashes, off[short], off[short + 1])
    doc, grams = np.concatenate([doc, short]), np.concatenate([grams, whole])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return doc[new], grams[new]


def shingled(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """A row of SETS per document; prefix and shingles only where a partner is possible."""
    n, cut = hashx.spread(docs), T.U64(64 - PROBE_BITS)

    def counted(buf, offsets):
        doc, grams = shingle_sets(buf, offsets, k)
        return doc, grams, *hashx.distinct((grams >> cut) << cut)

    def request(batch, ids, buf, offsets):
        _, _, own, _, count = counted(buf, offsets)
        return hashx.ask_rows(batch, own, n, count=count.astype(np.uint32))

    def reply(requests):
        _, place = hashx.merged(requests)
        df = np.bincount(place, np.concatenate([r["count"] for r in requests])).astype(np.int64)
        level = np.where(df < 2, 0, 1 + np.log2(np.maximum(df, 1)) * 4).astype(np.uint8)
        return [{"level": x} for x in hashx.parted(level[place], requests)]

    def result(ids, buf, offsets, given):
        doc, grams, own, place, _ = counted(buf, offsets)
        level = given["level"][place] if len(doc) else np.zeros(0, np.uint8)
        size = np.bincount(doc, minlength=len(ids))
        shared = np.bincount(doc[level > 0], minlength=len(ids))
        at = np.concatenate([[0], np.cumsum(size)])
        prints = np.zeros((len(ids), 2), np.int64)
        prefix, sets = [], []
        for i in range(len(ids)):
            if not size[i] or 5 * shared[i] < 4 * size[i]:
                prefix.append(None)
                sets.append(None)
                continue
            g, lv = grams[at[i] : at[i + 1]], level[at[i] : at[i + 1]]
            rare = np.lexsort((g, lv))[: size[i] - (4 * size[i] + 4) // 5 + 1]
            prefix.append(g[rare[lv[rare] > 0]].view(np.int64))
            prints[i] = np.frombuffer(xxhash.xxh3_128_digest(np.ascontiguousarray(g).tobytes()), np.int64)
            sets.append(hashx.dump(t=hashx.deltas(g >> T.U64(8))))
        return pa.table({
            "doc_id": pa.array(ids), "n": pa.array(size.astype(np.int64)), "fp1": pa.array(prints[:, 0]), "fp2": pa.array(prints[:, 1]),
            "prefix": pa.array(prefix, pa.list_(pa.int64())), "shingles": pa.array(sets, pa.binary()),
        })

    packed = hashx.pack(docs)
    levels = hashx.answer(hashx.ask(packed, request), reply)
    return hashx.finish(packed, [levels], result, SETS)


def group_edges(ids: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Edges that connect the sets of one group whose Jaccard similarity is 0.8 or more."""
    size = np.array([len(s) for s in sets])
    order = np.lexsort((ids, size))
    size, sets = size[order], [sets[i] for i in order]
    m = len(sets)
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    _, place, _ = hashx.distinct(token)
    by_token = np.argsort(place, kind="stable")  # a token's sets in order of size
    posted = owner[by_token]
    at = np.concatenate([[0], np.cumsum(size)])
    keys = place[by_token] * m + posted  # ascending: token, then the place of the set
    part = np.arange(m)  # what is connected so far
    pivots: list[tuple[int, int, np.ndarray]] = []  # a set, the first set it was counted against, the overlaps
    a, b = [], []

    def overlaps(y: int, lo: int, hi: int) -> np.ndarray:
        """|y & z| for sets lo <= z < hi; each list skips to that block of sizes."""
        mine = place[at[y] : at[y + 1]]
        start, end = np.searchsorted(keys, mine * m + lo), np.searchsorted(keys, mine * m + hi)
        return np.bincount(posted[T.gather(start, end - start)] - lo, minlength=hi - lo)

    def derived(y: int, lo: int, need: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """What the overlaps of a set that is highly similar to y say of y: surely linked, surely not."""
        for r, r_lo, found in reversed(pivots[-16:]):
            if r_lo <= lo and y - r_lo < len(found) and 9 * (ry := found[y - r_lo]) >= 4 * (size[r] + size[y]):
                rz = found[lo - r_lo : y - r_lo]
                return rz - (size[r] - ry) >= need, rz + (size[y] - ry) < need
        return None

    for y in range(m):
        lo = int(np.searchsorted(size, -(-4 * size[y] // 5)))
        need = -(-4 * (size[y] + size[lo:y]) // 9)
        known = derived(y, lo, need)
        if known is None:
            hi = int(np.searchsorted(size, size[y] * 5 // 4, side="right"))
            found = overlaps(y, lo, hi)
            pivots.append((y, lo, found))
            linked = found[: y - lo] >= need
        else:
            linked, never = known
            apart = part[lo:y] != part[y]
            if linked.any():  # these will be connected with y in any case
                apart &= ~np.isin(part[lo:y], part[lo:y][linked])
            if (apart & ~never).any():
                linked = overlaps(y, lo, y) >= need
        for z in np.flatnonzero(linked & (part[lo:y] != part[y])) + lo:
            if part[z] != part[y]:
                part[part == max(part[z], part[y])] = min(part[z], part[y])
                a.append(int(ids[order[y]]))
                b.append(int(ids[order[z]]))
    return a, b


def _edges(groups: DataFrame) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        sets = [np.cumsum(hashx.restore(x.as_py())["t"], dtype=T.U64) for x in table.column("shingles")]
        a, b = group_edges(table.column("doc_id").to_numpy(), sets)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return groups.groupBy("head", "i", "j").applyInArrow(run, "a long, b long")


def _blocks(block: int) -> Column:
    """How many blocks rows with n shingles each make."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("n") / SHINGLES)).cast("int")


def _between_blocks(large: DataFrame, found: DataFrame, sets_of: DataFrame, block: int) -> DataFrame:
    """Edges across the blocks of large groups: members that aren't connected with their group's head yet meet all blocks.

    The others need not meet one another, so that a large group of near copies costs as much as it has members.
    """
    part = found.select(F.col("id").alias("doc_id"), F.col("component_id").alias("part"))
    head_part = found.select(F.col("id").alias("head"), F.col("component_id").alias("head_part"))
    known = large.join(part, "doc_id", "left").join(head_part, "head", "left")
    known = known.withColumn("apart", F.coalesce("part", "doc_id") != F.coalesce("head_part", "head"))
    left = known.filter("apart").groupBy("head").agg(_blocks(block).alias("rest"))
    known = written(large.sparkSession, known.join(left, "head").withColumn("mine", F.pmod(F.xxhash64("doc_id", "own"), F.col("rest")).cast("int")), "apart")
    pairs = known.filter("apart").selectExpr("head", "doc_id", "mine AS i", "explode(sequence(0, blocks - 1)) AS j").unionAll(known.selectExpr("head", "doc_id", "explode(sequence(0, rest - 1)) AS i", "own AS j"))
    return _edges(pairs.distinct().join(sets_of, "doc_id"))


def jaccard_join(docs: DataFrame, k: int = WORDS, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id."""
    spark = docs.sparkSession
    sets = written(spark, shingled(docs, k), "sets")
    able = sets.filter("shingles IS NOT NULL")
    sizes = written(spark, sets.select("doc_id", "n"), "sizes")
    # written first, so that the join has an exchange on either side and a large class of copies can be split
    same = written(spark, able.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep")), "same")
    alike = written(spark, able.select("doc_id", "fp1", "fp2", "n").join(same, ["fp1", "fp2", "n"]).select("doc_id", "rep"), "alike")
    reps = able.join(alike.filter("doc_id = rep").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "fp1"])
    posted = reps.select("doc_id", "n", F.explode("prefix").alias("token"))
    heads = posted.groupBy("token").agg(F.min("doc_id").alias("head"), F.count("*").alias("c")).filter("c > 1").drop("c")
    members = posted.join(heads, "token").groupBy("head", "doc_id").agg(F.max("n").alias("n"))
    members = written(spark, members, "members")
    count = members.groupBy("head").agg(_blocks(block).alias("blocks"))
    members = members.join(count, "head").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    # first each block with the head of its group
    first = members.filter("doc_id <> head").selectExpr("head", "doc_id", "own AS i", "0 AS j").unionAll(members.filter("doc_id = head").selectExpr("head", "doc_id", "explode(sequence(0, blocks - 1)) AS i", "0 AS j"))
    sets_of = reps.select("doc_id", "shingles")
    links = written(spark, _edges(first.join(sets_of, "doc_id")), "links")
    edges = links.unionAll(alike.filter("doc_id <> rep").selectExpr("doc_id AS a", "rep AS b"))
    large = members.filter("blocks > 1")
    if large.take(1):
        edges = edges.unionAll(_between_blocks(large, components(spark, edges), sets_of, block))
    found = components(spark, edges)
    dropped(sets, same, alike, members, links)
    return sizes.select("doc_id", F.col("n").alias("n_shingles")).join(found, F.col("doc_id") == F.col("id"), "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(load(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS g FROM w)),
c AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, m) AS component_id FROM w LEFT JOIN c USING (doc_id) JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) ON a = w.doc_id
"""
