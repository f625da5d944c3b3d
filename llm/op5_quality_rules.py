"""Quality rules: thresholds per language and source from mergeable quantile sketches.

Each document gets integer measures; base rules (n_words < 50, or more than half of the words repeated) are
fixed by contract. The other cutoffs are adaptive. Every (lang, source) keeps a sketch of each measure: counts
by bucket, where a bucket keeps the leading six bits of the value (relative error below 1/32). Such
sketches merge by adding counts, exactly and in any order, so runs agree, a hot source is pre-aggregated in the
map tasks, and a sketch has at most some hundred rows however large its source. Sources merge into languages.

A measure's limit is its source's median times a power of the language's reach: the ratio of the 90th percentile to the median, for
each source of `min_group` documents or more, and of these ratios the median over the language's sources. So a source's own level sets
its limit, up to half of its documents or of its language's sources being junk cannot move it, and heavy tails widen it. A source's
median counts as LEVEL times the language's at most; sources of fewer documents use the language's. Sketches hold ratios of counts with one
added to both, so that documents without a symbol differ by their length instead of being all zero; documents are judged by their
plain ratios, and limits are never below FLOOR. Mean word length has a lower limit too, by the 10th percentile. The limits (a row
for each lang and source, joined by Spark as their written size allows) then filter the documents.

Null text has no words and fails the base rules. Null lang and source are groups of their own. Repeated rows,
and rows with an equal or null doc_id are judged each by itself. Documents that fail the base rules do not enter sketches. Extra
columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as ST

from llm import textops as T
from llm.common import fresh, load, ship, written

#: Measure: power of the reach. Ratios are per 10,000; word length is in hundredths of a character.
POWER = {"symbols": 3, "dup_lines": 3, "repeats": 4, "length": 8}
#: How many times its language's median a source's may be.
LEVEL = 8
#: Measure: least limit of a ratio.
FLOOR = {"symbols": 1000, "dup_lines": 2500, "repeats": 2000, "length": 0}
#: Reach, per mille, of word length at least (and its inverse at most for the lower limit), and of all at most.
LEAST_REACH, MOST_REACH, MOST = 1030, 1_000_000, 1_000_000_000
MIN_GROUP = 30
#: Bytes of text measured at once; one longer text is measured by itself.
SLICE = 1 << 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def _alike(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """In order of key and row: the rows, and whether each equals the one before it in key and text."""
    order = np.argsort(keys, kind="stable")  # rows ascend by text, so equal keys of one text are neighbours
    same = np.zeros(len(keys), bool)
    same[1:] = (keys[order][1:] == keys[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return order, same


def measures(buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The COUNTS of each text. Lines and words are told apart by their spelling, not by hashes."""
    s, e, off = T.words(buf, offsets)
    n = len(offsets) - 1
    chars = T.per_row(~T.SPACE[buf] & ((buf & 0xC0) != 0x80), offsets)
    symbols = T.per_row(SYMBOL[buf], offsets)
    # lines
    first = np.zeros(len(buf), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    after = np.flatnonzero(buf == 10) + 1
    first[after[after < len(buf)]] = True
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(buf))
    full = np.searchsorted(s, end) > np.searchsorted(s, start) if len(start) else np.zeros(0, bool)
    size = end - start - (buf[end - 1] == 10) if len(start) else start
    spelled = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(buf[buf != 10])])
    # of lines that hold a word, one counts as a duplicate when an equal one came before it in its text
    line = spelled.dictionary_encode().indices.to_numpy()[full].astype(np.int64)
    line_doc = np.searchsorted(offsets, start[full], side="right") - 1
    order, again = _alike(line, line_doc)
    # words in windows of three that occur twice
    table = T.spelled(buf, s, e).dictionary_encode()
    place, distinct = table.indices.to_numpy().astype(np.int64), len(table.dictionary)
    begin = np.zeros(0, np.int64)
    if len(s) >= 3:
        last = np.repeat(off[1:], np.diff(off))[:-2]
        begin = np.flatnonzero(np.arange(len(s) - 2) + 3 <= last)
    if distinct < 1 << 21:
        grams = (place[begin] << 42) | (place[begin + 1] << 21) | place[begin + 2]
    else:  # of a text that large, pairs are numbered first
        pairs = np.unique(place[begin] * distinct + place[begin + 1], return_inverse=True)[1].ravel()
        grams = pairs * distinct + place[begin + 2]
    by_gram, same = _alike(grams, np.searchsorted(off, begin, side="right") - 1)
    twice = same.copy()
    twice[:-1] |= same[1:]
    repeated = T.covered(begin[by_gram[twice]], 3, len(s))
    return [np.diff(off), chars, symbols, np.bincount(line_doc[order[again]], minlength=n), T.per_row(repeated, off), np.bincount(line_doc, minlength=n)]


def measured(docs: DataFrame) -> DataFrame:
    """docs with the COUNTS; columns of those names that docs had are replaced."""
    ship(docs.sparkSession)
    docs = docs.drop(*COUNTS)
    names, text_at = docs.columns, docs.columns.index("text")
    schema = ST.StructType([*docs.schema.fields, *(ST.StructField(c, ST.LongType()) for c in COUNTS)])

    def run(batches):
        for b in batches:
            _, whole = T.utf8(b.column(text_at))
            for lo, hi in T.slices(whole, SLICE):
                part = b.slice(lo, hi - lo)
                counts = measures(*T.utf8(part.column(text_at)))
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c.astype(np.int64)) for c in counts)], [*names, *COUNTS])

    return docs.mapInArrow(run, schema)


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
MEASURES = {
    "symbols": "10000 * n_symbols div greatest(n_words, 1)",
    "dup_lines": "10000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "10000 * n_repeat_words div greatest(n_words, 1)",
    "length": "100 * word_chars div greatest(n_words, 1)",
}


#: What sketches hold.
SKETCHED = {
    "symbols": "greatest(10000 * (n_symbols + 1) div (n_words + 1), 1)",
    "dup_lines": "greatest(10000 * (n_dup_lines + 1) div (n_lines + 1), 1)",
    "repeats": "greatest(10000 * (n_repeat_words + 1) div (n_words + 1), 1)",
    "length": "greatest(100 * word_chars div greatest(n_words, 1), 1)",
}


def sketches(df: DataFrame) -> DataFrame:
    """Counts by (lang, source, measure, bucket)."""
    stack = ", ".join(f"'{m}', {value}" for m, value in SKETCHED.items())
    shift = "greatest(length(bin(value)) - 6, 0)"
    return (
        df.filter(f"NOT ({BASE_FAILED})").selectExpr("lang", "source", f"stack({len(SKETCHED)}, {stack}) AS (measure, value)")
        .selectExpr("lang", "source", "measure", f"(value >> {shift}) << {shift} AS bucket")
        .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))
    )


def _quantiles(counts: DataFrame, by: list[str], value: str, **tenths: int) -> DataFrame:
    """The count n and the named quantiles (in tenths) of a value by its counts n."""
    merged = counts.groupBy(*by, value).agg(F.sum("n").alias("n"))
    upto = f"PARTITION BY {', '.join(by)}"
    ranked = merged.selectExpr("*", f"sum(n) OVER ({upto} ORDER BY {value}) AS upto", f"sum(n) OVER ({upto}) AS total")
    return ranked.groupBy(*by).agg(F.max("total").alias("n"), *(F.min(F.expr(f"CASE WHEN 10 * upto >= {t} * total THEN {value} END")).alias(name) for name, t in tenths.items()))


def limits(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """A row (lang, source, hi_*, lo_length) for each language and source that has documents beyond the base rules."""
    tenths = {"low": 1, "mid": 5, "high": 9}
    own, whole = _quantiles(sketch, ["lang", "source", "measure"], "bucket", **tenths), _quantiles(sketch, ["lang", "measure"], "bucket", **tenths)
    ratios = own.filter(F.col("n") >= min_group).selectExpr("lang", "measure", "1000 * high div mid AS up", "1000 * low div mid AS down", "1L AS n")
    pooled = [_quantiles(ratios, ["lang", "measure"], c, **{c: 5}).drop("n") for c in ("up", "down")]
    key = lambda df, p: df.withColumnsRenamed({"lang": f"{p}_lang", "measure": f"{p}_measure"})
    on = lambda p: F.col("lang").eqNullSafe(F.col(f"{p}_lang")) & (F.col("measure") == F.col(f"{p}_measure"))
    of = own.join(key(whole.selectExpr("lang", "measure", "low AS l_low", "mid AS l_mid", "high AS l_high"), "l"), on("l")).join(key(pooled[0], "u"), on("u"), "left").join(key(pooled[1], "d"), on("d"), "left")
    of = of.withColumns({
        "up": F.expr(f"least(greatest(coalesce(up, 1000 * l_high div l_mid), IF(measure = 'length', {LEAST_REACH}, 1000)), {MOST_REACH})"),
        "down": F.expr(f"least(coalesce(down, 1000 * l_low div l_mid), 1000000 div {LEAST_REACH})"),
        "mid": F.when(F.col("n") < min_group, F.col("l_mid")).otherwise(F.least("mid", LEVEL * F.col("l_mid"))),
    })
    of = of.withColumns({"hi": F.col("mid"), "lo": F.col("mid")})
    for step in range(max(POWER.values())):  # whole numbers, so that all engines agree
        still = F.col("measure").isin([m for m, p in POWER.items() if p > step])
        of = of.withColumns({"hi": F.when(still, F.expr(f"least(hi * up div 1000, {MOST})")).otherwise(F.col("hi")), "lo": F.when(still, F.expr("lo * down div 1000")).otherwise(F.col("lo"))})
    floor = F.create_map(*[F.lit(x) for kv in FLOOR.items() for x in kv])
    of = of.withColumn("hi", F.greatest("hi", floor[F.col("measure")].cast("long")))
    return of.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == m, F.col("hi"))).alias(f"hi_{m}") for m in POWER), F.max(F.when(F.col("measure") == "length", F.col("lo"))).alias("lo_length"),
    )


def quality_rules(docs: DataFrame, min_group: int = MIN_GROUP, texts: bool = True) -> DataFrame:
    """docs (without text unless texts) with COUNTS, base_failed and kept, which replace columns of these names; all others stay.

    With texts, documents are measured once for the sketches and once more as they are judged: that takes less than to write all
    texts with their measures and to read them again, and leaves no copy of the corpus in the shared folder.
    """
    spark = docs.sparkSession
    ship(spark)
    seen = measured(docs) if texts else written(spark, measured(docs).drop("text"), "measures")
    cut = written(spark, limits(written(spark, sketches(seen), "sketches"), min_group), "limits")
    own, limit = (fresh(seen, name) for name in ("judged", "limit"))
    values = F.struct("lang", "source", *(F.expr(v).alias(m) for m, v in MEASURES.items()))
    df = seen.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn(own, values).join(
        cut.select(F.struct("*").alias(limit)), F.col(f"{own}.lang").eqNullSafe(F.col(f"{limit}.lang")) & F.col(f"{own}.source").eqNullSafe(F.col(f"{limit}.source")), "left"
    )
    good = ~F.col("base_failed")
    for w in [F.col(f"{own}.{m}") <= F.col(f"{limit}.hi_{m}") for m in MEASURES] + [F.col(f"{own}.length") >= F.col(f"{limit}.lo_length")]:
        good = good & F.coalesce(w, F.lit(True))
    return df.withColumn("kept", good).drop(own, limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules(docs, texts=False).select("doc_id", *COUNTS[:5], "base_failed", "kept")


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, lang, source, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM (SELECT doc_id, i, ws[i:i+2] AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM g WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_distinct FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols, coalesce(n_lines - n_distinct, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  10000 * n_symbols // greatest(n_words, 1) AS m1, 10000 * n_dup_lines // greatest(n_lines, 1) AS m2, 10000 * n_repeat_words // greatest(n_words, 1) AS m3, CAST(100 * word_chars AS BIGINT) // greatest(n_words, 1) AS m4 FROM b),
v AS (SELECT lang, source, unnest([1, 2, 3, 4]) AS k, unnest([10000 * (n_symbols + 1) // (n_words + 1), 10000 * (n_dup_lines + 1) // (n_lines + 1), 10000 * (n_repeat_words + 1) // (n_words + 1), m4]) AS v FROM m WHERE NOT base_failed),
s AS (SELECT lang, source, k, greatest(CAST(v AS BIGINT), 1) AS v, greatest(length(ltrim(CAST(greatest(CAST(v AS BIGINT), 1) AS BIT)::VARCHAR, '0')) - 6, 0) AS sh FROM v),
sk AS (SELECT lang, source, k, (v >> sh) << sh AS bucket, count(*) AS n FROM s GROUP BY ALL),
qs AS (SELECT lang, source, k, bucket, sum(n) OVER (PARTITION BY lang, source, k ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, k) AS total FROM sk),
q AS (SELECT lang, source, k, max(total) AS n, min(bucket) FILTER (WHERE 10 * upto >= total) AS low, min(bucket) FILTER (WHERE 2 * upto >= total) AS mid, min(bucket) FILTER (WHERE 10 * upto >= 9 * total) AS high FROM qs GROUP BY ALL),
ls AS (SELECT lang, k, bucket, sum(n) AS n FROM sk GROUP BY ALL),
lqs AS (SELECT lang, k, bucket, sum(n) OVER (PARTITION BY lang, k ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, k) AS total FROM ls),
lq AS (SELECT lang, k, min(bucket) FILTER (WHERE 10 * upto >= total) AS low, min(bucket) FILTER (WHERE 2 * upto >= total) AS mid, min(bucket) FILTER (WHERE 10 * upto >= 9 * total) AS high FROM lqs GROUP BY ALL),
ra AS (SELECT lang, k, 1000 * high // mid AS up, 1000 * low // mid AS down FROM q WHERE n >= 30),
rr AS (SELECT *, row_number() OVER (PARTITION BY lang, k ORDER BY up) AS iu, row_number() OVER (PARTITION BY lang, k ORDER BY down) AS id, count(*) OVER (PARTITION BY lang, k) AS c FROM ra),
rm AS (SELECT lang, k, min(up) FILTER (WHERE 2 * iu >= c) AS up, min(down) FILTER (WHERE 2 * id >= c) AS down FROM rr GROUP BY ALL),
c AS (SELECT q.lang, q.source, q.k, CASE WHEN n < 30 THEN lq.mid ELSE least(q.mid, 8 * lq.mid) END AS mid,
  least(greatest(coalesce(rm.up, 1000 * lq.high // lq.mid), CASE q.k WHEN 4 THEN 1030 ELSE 1000 END), 1000000) AS up, least(coalesce(rm.down, 1000 * lq.low // lq.mid), 1000000 // 1030) AS down
  FROM q JOIN lq ON lq.k = q.k AND lq.lang IS NOT DISTINCT FROM q.lang LEFT JOIN rm ON rm.k = q.k AND rm.lang IS NOT DISTINCT FROM q.lang),
d AS (SELECT lang, source, k, list_reduce(list_prepend(CAST(mid AS BIGINT), list_transform(range([3, 3, 4, 8][k]), lambda x: CAST(up AS BIGINT))), lambda a, r: least(a * r // 1000, 1000000000)) AS hi,
  list_reduce(list_prepend(CAST(mid AS BIGINT), list_transform(range([3, 3, 4, 8][k]), lambda x: CAST(down AS BIGINT))), lambda a, r: a * r // 1000) AS lo FROM c),
t AS (SELECT lang, source, max(greatest(hi, 1000)) FILTER (WHERE k = 1) AS h1, max(greatest(hi, 2500)) FILTER (WHERE k = 2) AS h2, max(greatest(hi, 2000)) FILTER (WHERE k = 3) AS h3, max(hi) FILTER (WHERE k = 4) AS h4, max(lo) FILTER (WHERE k = 4) AS l4 FROM d GROUP BY ALL)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(m1 <= h1, true) AND coalesce(m2 <= h2, true) AND coalesce(m3 <= h3, true) AND coalesce(m4 <= h4, true) AND coalesce(m4 >= l4, true) AS kept
FROM m LEFT JOIN t ON t.lang IS NOT DISTINCT FROM m.lang AND t.source IS NOT DISTINCT FROM m.source
"""
