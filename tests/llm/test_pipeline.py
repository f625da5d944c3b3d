from __future__ import annotations

import random

import numpy as np
import pytest
from brute import bytes_left, jaccard, kept_by_rules, mixture, sha, tokens, words

from pyspark.sql import functions as F

import corpus_pipeline
from llm import hashx, op2_mixing, op3_bpe
from llm.common import load


def test_against_brute_force(spark):
    """All five stages, one after another, over the small tables."""
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in load(spark, sf, "documents").collect()]
    rows = [r for r, good in zip(rows, kept_by_rules([r[1:] for r in rows]), strict=True) if good]
    first = {i for i, _, c in jaccard([r[:2] for r in rows]) if i == c}
    rows = [r for r in rows if r[0] in first]
    left = {i: (bytes(x for j, x in enumerate(b) if j not in gone).decode(errors="ignore"), gone) for i, b, gone in bytes_left([r[:2] for r in rows])}
    rows = [(i, left[i][0], lang, source) for i, _, lang, source in rows if not left[i][1] or words(left[i][0])]
    t, want = op3_bpe._tokenizer(op3_bpe.default_path()), []
    for i, text in mixture([(i, text, source) for i, text, _, source in rows]):
        ids = tokens(t, text)
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == sorted(want) and len(want) > 100


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_tables(spark, name, stage):
    """Empty tables; nulls in any column, ties, repeated rows, long texts, extra columns with clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = stage(spark, spark.createDataFrame([], schema), "")
    assert empty.count() == 0 and (name == "encode" or empty.columns == corpus_pipeline.COLUMNS)
    long = " ".join(f"w{i}" for i in range(120_000))
    data = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n ", None, "a", None), (3, long, "en", None, 0), (3, long, "en", None, 0), (None, long + " more", None, "b", 0), (4, "é" * 200, "fr", "b", 0)]
    clash = {c: F.lit(1) for c in ("row", "group", "kept", "start", "quota", "block", "batch", "limit", "id", "_row", "size", "key", "bucket")}
    docs = spark.createDataFrame(data, schema).withColumns(clash).repartition(2)
    out = stage(spark, docs, "").collect()
    ids = sorted((r["doc_id"] for r in out), key=str)
    if name == "encode":
        assert ids == sorted((r[0] for r in data), key=str) and [r["n_tokens"] for r in out if r["doc_id"] in (1, 2)] == [0, 0]
        return
    if name in ("repeated_passages", "mix"):
        assert all(r["n_chars"] == len(r["text"]) for r in out)
    if name == "quality":
        assert ids == [3, 3, None] and not any(r["doc_id"] is None and r["text"] is None for r in out)
    if name == "near_duplicates":  # of the three that are alike those with the smallest id stay
        assert ids == [1, 2, 3, 3, 4, None]
    if name == "repeated_passages":  # a row with the same id is not an earlier one; null ids stand last
        assert ids == [1, 2, 3, 3, 4, None, None] and [len(r["text"]) for r in out if r["doc_id"] == 3] == [len(long)] * 2
    if name == "mix":
        assert set(ids) <= {3, 4, None} and sum(len(words(r["text"])) for r in out) == pytest.approx(1.5 * (3 * 120_000 + 2), rel=0.01)


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = load(spark, sf, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(path := f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(path)
        if name != "encode":
            assert docs.columns == corpus_pipeline.COLUMNS
            assert docs.filter("n_chars <> length(text)").count() == 0
        if name == "near_duplicates":
            want = {i for i, _, c in jaccard([(r["doc_id"], r["text"]) for r in before.collect()]) if i == c}
            assert {r["doc_id"] for r in docs.collect()} == want
    assert docs.count() > 50 and docs.filter("n_tokens <> size(ids)").count() == 0


def test_null_and_repeated_ids(spark, tmp_path):
    r = random.Random(4)
    text = lambda n=80: " ".join("".join(r.choices("abcdefghijklmnop", k=7)) for _ in range(n))
    near = text()
    big = 2**53 + 1
    # ids: repeated with equal and with other texts, null, and large; one null is a near copy, two are near copies of one another
    twin, other = text(), text()
    ids = [(5, twin), (5, twin), (5, text()), (None, text()), (None, text()), (big, near), (None, near + " end"), (None, other), (None, other + " end")]
    docs = spark.createDataFrame([(i, t, "xx", f"s{k % 2}", len(t)) for k, (i, t) in enumerate(ids)], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    want = sorted(ids[:6], key=str)
    rows = lambda df: [(x["doc_id"], x["text"]) for x in df.collect()]

    assert sorted(rows(corpus_pipeline.quality(spark, docs, "")), key=str) == sorted(ids, key=str)
    found = rows(corpus_pipeline.near_duplicates(spark, docs, ""))
    assert sorted((x for x in found if not x[1].startswith(other)), key=str) == want and len(found) == 7

    seven = docs.filter(~docs.text.endswith(" end"))
    cut = corpus_pipeline.repeated_passages(spark, seven, "")
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, seven.collect()), key=str)

    mixed = corpus_pipeline.mix(spark, seven, "")
    words = sum(len(t.split()) for _, t in rows(mixed))
    assert words == sum(x["taken"] for x in op2_mixing.mixed(seven).collect()) and any(i is None for i, _ in rows(mixed))

    out = corpus_pipeline.encode(spark, docs, "").collect()
    assert sorted((x["doc_id"] for x in out), key=str) == sorted((i for i, _ in ids), key=str) and len({x["ids_sha256"] for x in out}) == len({t for _, t in ids})
    assert sorted(i for row in hashx.pack(docs).collect() for i in hashx.unpack(bytes(row["blob"]))[0].tolist()) == sorted(hashx.NO_ID if i is None else i for i, _ in ids)
