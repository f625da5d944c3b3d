"""Language ID: the family first, then one-versus-one linear support vector machines within it.

Texts are lower-cased letters (as bytes) with single bytes of anything else as spaces; features are the frequencies of hashed
two- and three-byte runs over the whole text. One-versus-one machines tell language families apart, and in the family
that wins, one-versus-one machines tell its languages apart; most votes win, then the sum of margins. Signs beyond ASCII (Latin-1
signs, general punctuation and symbols, CJK punctuation) count as spaces; all other characters beyond ASCII count as letters.

Learning uses text and lang of documents whose crc32(doc_id as text) mod 4 is not 2, and of these at most `sample`
per language and per family (those with the smallest hashes of doc_id and text; copies count once), a documented bound. Only ids
and hashes are ranked; the few chosen texts are then fetched from the table. Each machine is fitted by a task of its own from at most
2 * `sample` vectors of DIM numbers; the driver receives the weights, 16 KB a machine, and never vectors or texts. Prediction runs
in the map tasks over all documents and shuffles nothing; machines within a family see that family's texts only.

Null texts and texts without a letter are `und` with score 0, as is everything when no row has a language. The score is
the product of the two levels' confidences (a logistic of the least margin of the winner). A language without a known
family is a family of its own. Repeated rows are predicted alike. A null doc_id is not held out and not learned from. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from llm import textops as T
from llm.common import dropped, load, ship, written

DIM, SAMPLE = 4096, 400
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
#: ISO 639-1 codes by language family.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg ms tl",
}

#: UTF-8 ranges of signs beyond ASCII, as the number of bytes and the first and last character.
SIGNS = [(2, "\u0080", "\u00a9"), (2, "\u00ab", "\u00b4"), (2, "\u00b6", "\u00b9"), (2, "\u00bb", "\u00bf"), (2, "×", "×"), (2, "÷", "÷"), (3, "\u2000", "\u206f"), (3, "\u20a0", "\u20cf"), (3, "\u2190", "\u2bff"), (3, "\u3000", "\u3004"), (3, "\u3008", "\u3020")]
LETTER = np.full(256, 32, np.uint8)
LETTER[65:91] = LETTER[97:123] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs.split()), f"only {lang}")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(buf: np.ndarray) -> np.ndarray:
    """Lower-cased letters, and spaces for all other bytes."""
    b = LETTER[buf]
    b[1:][(buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)] += 0x20  # Latin capitals
    for size, first, last in SIGNS:
        lead = np.flatnonzero((buf >= first.encode()[0]) & (buf <= last.encode()[0]))
        code = np.zeros(len(lead), np.int64)
        for j in range(size):
            code = code << 8 | buf[np.minimum(lead + j, len(buf) - 1)]
        sign = lead[(code >= int.from_bytes(first.encode())) & (code <= int.from_bytes(last.encode()))]
        for j in range(size):
            b[sign + j] = 32
    return b


def features(buf: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of two and of three bytes: the feature of each run, and how many runs there are before each text."""
    b = letters(buf).astype(np.uint32)
    out = []
    for k in (2, 3):
        code = np.zeros(max(0, len(b) - k + 1), np.uint32)
        for j in range(k):
            code = (code << np.uint32(8)) | b[j : len(b) - k + 1 + j]
        size = np.maximum(np.diff(offsets) - k + 1, 0)
        inside = T.gather(offsets[:-1], size)
        feature = ((code[inside] * np.uint32(2654435761)) >> np.uint32(21)) + np.uint32((k - 2) * DIM // 2)
        out.append((feature, np.concatenate([[0], np.cumsum(size)])))
    return out


def chosen(grams: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The features of some of the texts."""
    out = []
    for feature, at in grams:
        size = np.diff(at)[rows]
        out.append((feature[T.gather(at[rows], size)], np.concatenate([[0], np.cumsum(size)])))
    return out


def has_letter(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    found = T.per_row(ASCII_LETTER[buf], offsets) > 0
    for i in np.flatnonzero(~found & (T.per_row(buf >= 128, offsets) > 0)):
        found[i] = any(c.isalpha() for c in buf[offsets[i] : offsets[i + 1]].tobytes().decode())
    return found


def _vectors(docs: DataFrame) -> DataFrame:
    """lang, r and the feature frequencies of each text, as bytes of float32."""

    def run(batches):
        for b in batches:
            _, whole = T.utf8(b.column(2))
            for lo, hi in T.slices(whole):
                part = b.slice(lo, hi - lo)
                buf, offsets = T.utf8(part.column(2))
                x = np.zeros((hi - lo, DIM), np.float32)
                for feature, at in features(buf, offsets):
                    for i in range(hi - lo):
                        x[i] += np.bincount(feature[at[i] : at[i + 1]], minlength=DIM) / max(1, at[i + 1] - at[i])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "r", "x"])

    return docs.select("lang", "r", "text").mapInArrow(run, "lang string, r int, x binary")


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """(lang, r, text): for each language at most `sample` labelled texts, those with the smallest hashes of doc_id and text.

    Ids and hashes alone are ranked. Counts and the chosen ids are tables of a size that Spark knows, so the texts stay where they are.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)).alias("h"))
    counts = written(docs.sparkSession, known.groupBy("lang").agg(F.count(F.lit(1)).alias("c")), "counts")
    # four times the expected hash border of the sample: what is ranked is small however common a language is
    near = known.join(counts, "lang").filter(F.col("h") < 4.0 * sample / F.col("c") * (1 << 40)).select("doc_id", "lang", "h").distinct()
    few = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).filter(F.col("r") <= sample)
    few = written(docs.sparkSession, few, "chosen")
    return known.join(few, ["doc_id", "lang", "h"]).dropDuplicates(["doc_id", "lang", "h"]).select("lang", "r", "text")


def machine(x: np.ndarray, y: np.ndarray, rounds: int = 120, reg: float = 1e-3) -> tuple[np.ndarray, float]:
    """A linear support vector machine (hinge loss, averaged subgradient steps); y is +1 or -1, classes weigh alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, bias, mean_w, mean_b = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for t in range(1, rounds + 1):
        wrong = (y * (x @ w + bias) < 1) * weight * y
        step = 1.0 / (reg * (t + 100))
        w = (1 - step * reg) * w + step * (wrong @ x) * 0.01
        bias += 0.01 * step * wrong.sum() * 0.1
        if t > rounds // 2:
            mean_w, mean_b = mean_w + w, mean_b + bias
    return mean_w / (rounds - rounds // 2), mean_b / (rounds - rounds // 2)


def fitted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """A machine on features scaled to equal spread, its weights given for the features as they are."""
    mean, spread = x.mean(0), x.std(0) + 1e-4
    w, bias = machine((x - mean) / spread / math.sqrt(x.shape[1]), y)
    w = w / spread / math.sqrt(x.shape[1])
    return w.astype(np.float32), bias - float(w @ mean)


def fit(docs: DataFrame, sample: int) -> dict:
    """Families with their languages, and a machine (weights, bias) for each pair of families and of languages in one."""
    spark = docs.sparkSession
    texts = written(spark, sampled(docs, sample), "sample")
    groups: dict[str, list[str]] = {}
    for lang in sorted(r[0] for r in texts.select("lang").distinct().collect()):
        groups.setdefault(family(lang), []).append(lang)
    # a row for each pair and each language that one of its sides has
    sides = [("", a, b, lang, y) for a, b in itertools.combinations(sorted(groups), 2) for name, y in ((a, 1), (b, -1)) for lang in groups[name]]
    sides += [(f, a, b, lang, y) for f, langs in groups.items() for a, b in itertools.combinations(langs, 2) for lang, y in ((a, 1), (b, -1))]
    if not sides:
        return {"families": groups, "pairs": {}}
    sizes = {lang: len(langs) for langs in groups.values() for lang in langs}
    # a family's languages share its part of the sample
    rows = [(*side, sample if side[0] else -(-sample // sizes[side[3]])) for side in sides]
    pairs = spark.createDataFrame(rows, "level string, a string, b string, lang string, y int, most int")
    vectors = written(spark, _vectors(texts), "vectors")

    def one(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("r", "ascending")])
        w, bias = fitted(np.stack([np.frombuffer(v.as_py(), np.float32) for v in table.column("x")]).astype(np.float64), table.column("y").to_numpy().astype(np.float64))
        return pa.table({"a": [key[1].as_py()], "b": [key[2].as_py()], "w": [w.tobytes()], "bias": [bias]})

    dealt = vectors.join(pairs, "lang").filter("r <= most").select("level", "a", "b", "lang", "r", "y", "x")
    found = dealt.groupBy("level", "a", "b").applyInArrow(one, "a string, b string, w binary, bias double").collect()
    dropped(texts, vectors)
    return {"families": groups, "pairs": {(r["a"], r["b"]): (np.frombuffer(bytes(r["w"]), np.float32).astype(np.float64), r["bias"]) for r in found}}


def _choose(names: list[str], pairs: dict, grams: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner among names and its confidence, for each text."""
    n = len(grams[0][1]) - 1
    votes, sums = np.zeros((len(names), n)), np.zeros((len(names), n))
    least = np.full((len(names), n), np.inf)
    for (i, a), (j, b) in itertools.combinations(enumerate(names), 2):
        w, bias = pairs[a, b]
        m = np.full(n, bias)
        for feature, at in grams:
            m += np.diff(np.concatenate([[0.0], np.cumsum(w[feature])])[at]) / np.maximum(np.diff(at), 1)
        votes[i] += m >= 0
        votes[j] += m < 0
        sums[i], sums[j] = sums[i] + m, sums[j] - m
        least[i], least[j] = np.minimum(least[i], m), np.minimum(least[j], -m)
    best = np.lexsort((sums, votes), axis=0)[-1]
    picked = least[best, np.arange(n)]
    return best, 1 / (1 + np.exp(-np.clip(12 * picked, -30, 30)))


def predict(model: dict, buf: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    n, names = len(offsets) - 1, sorted(model["families"])
    if not names:
        return ["und"] * n, np.zeros(n)
    grams, lettered = features(buf, offsets), has_letter(buf, offsets)
    which, sure = _choose(names, model["pairs"], grams)
    lang = np.full(n, "und", object)
    for i, f in enumerate(names):
        rows = np.flatnonzero((which == i) & lettered)
        if len(rows):
            inner, inner_sure = _choose(model["families"][f], model["pairs"], chosen(grams, rows))
            lang[rows] = np.array(model["families"][f], object)[inner]
            sure[rows] *= inner_sure
    return list(lang), np.where(lettered, sure, 0.0)


def language_id(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    ship(docs.sparkSession)
    model = fit(docs, sample)

    def run(batches):
        for b in batches:
            _, whole = T.utf8(b.column(2))
            for lo, hi in T.slices(whole):
                part = b.slice(lo, hi - lo)
                langs, score = predict(model, *T.utf8(part.column(2)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(load(spark, sf_dir, "documents"))
