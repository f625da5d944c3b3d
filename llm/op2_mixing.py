"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share 150% of all words; a target stops at twice its
source's words and the excess is shared anew by weight (solved in one pass: sources reach their limit in order of limit / weight).
Quotas: the mix is cut into blocks of `block` words; for a source whose target is under FINE blocks they are halved until it is not
(or until a block is a word), so that a block more or less is under a hundredth of any target. Among sources with blocks of one
size the highest quotients target / (2k + 1) give blocks to sources, and again, by words, a source's blocks to its shards; nothing
gets more than twice its blocks, and what that denies it goes to the next quotients. All but the last few quotients are decided in
closed form, so a source with billions of blocks costs as much as one with ten.
Selection: in a shard, documents stand in a seeded order and their words are cut into blocks; of these every n/q-th is
taken, from a seeded start, so exactly q are taken and none more than twice. A document's share of them is a difference of two
closed-form counts; blocks are never listed.

Everything is DataFrame operations. A hot source is as many shards as its words need (`shard_words` each), and sources are few rows
on their way to ranking: one per distinct source. Empty and null texts have no words and take none. Repeated rows, and rows with
an equal or null doc_id, are mixed each by itself. Extra columns are ignored by `mixed` and kept by `taken_texts`, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from llm import textops as T
from llm.common import WORD_PATTERN, fresh, load, ship, with_row, written

WEIGHTS, FACTOR, LIMIT = (5, 2, 1), 1.5, 2
BLOCK, FINE, SHARD_WORDS, SEED = 64, 128, 1 << 19, 17


def number(text: Column, below: Column | int) -> Column:
    """A number under `below` from the md5 of text."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(below) if isinstance(below, int) else below)


def sized(docs: DataFrame, row: list[str]) -> DataFrame:
    """doc_id, source, key (a source's name that is never null), size in words, and the columns of row."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"), size.alias("size"), *row)


def targets(sizes: DataFrame, weights=WEIGHTS, factor: float = FACTOR, limit: int = LIMIT) -> DataFrame:
    """A row per source: key, place (0, 1, .. by code point, null last), source_size, target."""
    per = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))).withColumn("most", limit * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "place")
    upto, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("share", (factor * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(upto), F.lit(0))) / F.sum("weight").over(rest))
    rate = F.min(F.when(F.col("share") <= F.col("most") / F.col("weight"), F.struct(F.col("most") / F.col("weight"), "place", "share"))).over(whole)["share"]
    return per.select("key", "place", "source_size", F.least(F.col("most").cast("double"), rate * F.col("weight")).alias("target"))


def sainte_lague(df: DataFrame, group: list[str], weight: str, seats: str, place: str, most: str) -> DataFrame:
    """df with quota: seats (one number per group) given to the rows by the highest weight / (2k + 1), k < most; ties by place.

    With m rows in a group, seats are certain where the quotient beats that of a divisor total / (seats - m / 2), and
    impossible below that of total / (seats + m / 2), or, as a row's limit may deny it two seats, total / (seats + 5 m / 2).
    Only the about 4 m between are ranked.
    """
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    df = df.withColumns({"_w": F.sum(weight).over(w), "_m": F.count(F.lit(1)).over(w)})
    share = F.col(weight) / F.col("_w")
    sure = F.when(F.col("_w") > 0, F.greatest(F.floor(share * (F.col(seats) - F.col("_m") / 2) + 0.5) - 1, F.lit(0))).otherwise(0)
    last = F.when(F.col("_w") > 0, F.floor(share * (F.col(seats) + 2.5 * F.col("_m")) + 0.5) + 1).otherwise(0)
    df = df.withColumns({"_sure": F.least(sure.cast("long"), most), "_last": F.least(last.cast("long"), F.col(most) - 1)}).withColumn("_open", F.col(seats) - F.sum("_sure").over(w))
    keys = [*group, place]
    tried = df.filter((F.col(weight) > 0) & (F.col("_last") >= F.col("_sure"))).select(*keys, weight, "_open", F.explode(F.sequence("_sure", "_last")).alias("_k"))
    rank = F.row_number().over((Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy((F.col(weight) / (2 * F.col("_k") + 1)).desc(), place))
    won = tried.withColumn("_r", rank).filter("_r <= _open").groupBy(*keys).agg(F.count(F.lit(1)).alias("_won"))
    return df.join(won, keys, "left").withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0))).drop("_w", "_m", "_sure", "_last", "_open", "_won")


def block_size(block: int) -> str:
    """The words of a source's blocks, as SQL: block, halved until FINE blocks are not above its target."""
    sizes = [block >> i for i in range(block.bit_length())]
    return "CASE " + " ".join(f"WHEN target >= {FINE * x} THEN {x}" for x in sizes) + " ELSE 1 END"


def quotas(sizes: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per source and shard: key, shard, block (words in one), blocks (there), quota."""
    sources = sources.withColumn("block", F.expr(block_size(block)))
    sources = sources.withColumns({"seats": F.floor(F.sum("target").over(Window.partitionBy("block")) / F.col("block") + 0.5), "most": 2 * F.ceil(F.col("source_size") / F.col("block"))})
    given = sainte_lague(sources, ["block"], "target", "seats", "place", "most").select("key", "block", F.col("quota").alias("source_quota"))
    shards = sizes.groupBy("key", "shard").agg(F.sum("size").alias("words")).join(given, "key")
    shards = shards.withColumn("blocks", F.ceil(F.col("words") / F.col("block"))).withColumn("most", 2 * F.col("blocks"))
    return sainte_lague(shards, ["key"], "words", "source_quota", "shard", "most").select("key", "shard", "block", "blocks", "quota")


def placed(sizes: DataFrame, shares: DataFrame, seed: int, row: list[str]) -> DataFrame:
    """sizes with start (words before the document in its shard), block, blocks, quota and first (the seeded start)."""
    order = Window.partitionBy("key", "shard").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), "doc_id", "size", *row)
    at = sizes.withColumn("start", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    first = number(F.concat_ws(":", F.lit(str(seed)), F.col("key"), F.col("shard").cast("string")), F.greatest("blocks", F.lit(1)))
    return at.join(shares, ["key", "shard"]).withColumn("first", first)


def _upto(x: str) -> str:
    """Words taken of the first x words of a shard."""
    before = f"(({x} div block) * quota + first) div greatest(blocks, 1)"
    after = f"(({x} div block + 1) * quota + first) div greatest(blocks, 1)"
    return f"(({before}) * block + ({x} % block) * (({after}) - ({before})))"


def mixed(docs: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED, row: str | None = None) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken, and the block arithmetic (start, block, blocks, quota, first).

    row: a column that tells rows apart; it is kept.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = [row] if row else []
    sizes = written(spark, sized(docs, rows), "sizes")
    sources = written(spark, targets(sizes), "sources")
    shard = number(F.concat_ws(":", F.lit(str(seed)), F.lit("shard"), F.col("doc_id").cast("string")), F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)))
    sizes = sizes.join(sources.select("key", "source_size", "target"), "key").withColumn("shard", shard)
    shares = written(spark, quotas(sizes, sources, block), "quotas")
    return placed(sizes, shares, seed, rows).withColumn("taken", F.expr(f"{_upto('(start + size)')} - {_upto('start')}").cast("long"))


def taken_texts(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """docs as mixed, with their columns: up to two rows per document, with the words that the first and second taking of its
    blocks hold. Runs of taken words keep their spacing and are joined by a line break; n_chars is made anew.

    Rows are told apart by numbers of their own, so doc_id may be null or repeated. Documents of which nothing is taken go.
    """
    row, share = fresh(docs, "_row"), fresh(docs, "_share")
    numbered = with_row(docs, row)
    shares = mixed(numbered, block, row=row, **options).select(row, F.struct("start", "block", "blocks", "quota", "first").alias(share))
    joined = numbered.join(shares, row)
    names, schema = docs.columns, docs.schema
    text_at, chars_at = names.index("text"), names.index("n_chars")

    def run(batches):
        for b in batches:
            _, whole = T.utf8(b.column(text_at))
            for lo, hi in T.slices(whole):
                part = b.slice(lo, hi - lo)
                buf, offsets = T.utf8(part.column(text_at))
                s, e, off = T.words(buf, offsets)
                size = np.diff(off)
                start, block, blocks, quota, first = (np.repeat(c.to_numpy(), size) for c in part.columns[len(names) :])
                j = (start + T.gather(np.zeros(len(size), np.int64), size)) // block
                times = ((j + 1) * quota + first) // np.maximum(blocks, 1) - (j * quota + first) // np.maximum(blocks, 1)
                row = np.repeat(np.arange(len(size)), size)
                for copy in (1, 2):
                    on = times >= copy
                    if not on.any():
                        continue
                    begin, end = on.copy(), on.copy()
                    begin[1:] &= ~on[:-1] | (row[1:] != row[:-1])
                    end[:-1] &= ~on[1:] | (row[1:] != row[:-1])
                    a, z, of = s[begin], e[end], row[begin]
                    kept = np.unique(of)
                    # a text that is taken whole stays as it is
                    all_on = np.bincount(row, on, minlength=len(size)) == size
                    edges = np.searchsorted(of, kept)
                    texts = [
                        buf[offsets[r] : offsets[r + 1]].tobytes().decode() if all_on[r] else b"\n".join(buf[x:y].tobytes() for x, y in zip(a[i:k], z[i:k], strict=True)).decode()
                        for r, i, k in zip(kept, edges, np.append(edges[1:], len(of)), strict=True)
                    ]
                    columns = list(part.take(pa.array(kept)).columns[: len(names)])
                    columns[text_at], columns[chars_at] = pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())
                    yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*names, *(F.col(f"{share}.{c}").alias(f"{share}_{c}") for c in ("start", "block", "blocks", "quota", "first"))).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _sql_number(text: str, below: str) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % ({below}))"


def _sql_upto(x: str) -> str:
    before, after = f"((({x} // block) * quota + first) // greatest(blocks, 1))", f"((({x} // block + 1) * quota + first) // greatest(blocks, 1))"
    return f"({before} * block + ({x} % block) * ({after} - {before}))"


ORACLE_SQL = rf"""
WITH z AS (SELECT doc_id, source, coalesce('=' || source, '') AS key, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
p AS (SELECT key, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY key, source),
w AS (SELECT *, [5, 2, 1][place % 3 + 1] AS weight, 2 * source_size AS most FROM p),
s AS (SELECT *, CAST(most AS DOUBLE) / weight AS ratio, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY CAST(most AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY CAST(most AS DOUBLE) / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM w),
t AS (SELECT key, place, source_size, least(CAST(most AS DOUBLE), (SELECT arg_min(share, (ratio, place)) FROM s WHERE share <= ratio) * weight) AS target FROM s),
b AS (SELECT *, {block_size(BLOCK)} AS block FROM t),
n AS (SELECT block, CAST(floor(sum(target) / block + 0.5) AS BIGINT) AS seats FROM b GROUP BY block),
c AS (SELECT key, block, row_number() OVER (PARTITION BY block ORDER BY target / (2 * k + 1) DESC, place) AS r FROM (SELECT key, block, place, target, unnest(range(0, 2 * CAST(ceil(CAST(source_size AS DOUBLE) / block) AS BIGINT))) AS k FROM b WHERE target > 0)),
q AS (SELECT b.key, block, place, source_size, target, (SELECT count(*) FROM c, n WHERE c.key = b.key AND n.block = b.block AND r <= seats) AS source_quota FROM b),
d AS (SELECT z.doc_id, z.key, size, source_size, target, block, source_quota, {_sql_number(f"'{SEED}:shard:' || doc_id", f"greatest(CAST(ceil(CAST(source_size AS DOUBLE) / {SHARD_WORDS}) AS BIGINT), 1)")} AS shard FROM z JOIN q USING (key)),
h AS (SELECT key, shard, max(block) AS block, max(source_quota) AS source_quota, CAST(sum(size) AS BIGINT) AS words, CAST(ceil(CAST(sum(size) AS DOUBLE) / max(block)) AS BIGINT) AS blocks FROM d GROUP BY ALL),
hc AS (SELECT key, shard, source_quota, row_number() OVER (PARTITION BY key ORDER BY CAST(words AS DOUBLE) / (2 * k + 1) DESC, shard) AS r FROM (SELECT *, unnest(range(0, 2 * blocks)) AS k FROM h WHERE words > 0)),
hq AS (SELECT key, shard, blocks, (SELECT count(*) FROM hc WHERE hc.key = h.key AND hc.shard = h.shard AND r <= h.source_quota) AS quota FROM h),
o AS (SELECT d.*, blocks, quota, CAST(sum(size) OVER (PARTITION BY d.key, d.shard ORDER BY md5('{SEED}:' || doc_id), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start,
  {_sql_number(f"'{SEED}:' || d.key || ':' || d.shard", "greatest(blocks, 1)")} AS first FROM d JOIN hq ON d.key = hq.key AND d.shard = hq.shard)
SELECT doc_id, size, source_size, target, CAST({_sql_upto('(start + size)')} - {_sql_upto('start')} AS BIGINT) AS taken FROM o
"""
