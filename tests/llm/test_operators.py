from __future__ import annotations

import base64
import hashlib
import importlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from brute import bytes_dedup, crc, jaccard, kept_by_rules, language, quality, sha, tokens, vectors, water, words_dedup
from pyspark.sql import functions as F

from llm import hashx, op1_nn_descent, op2_mixing, op3_bpe, op4_ngram_jaccard, op5_quality_rules, op6_token_output, op7_language_id, op8_suffix_dedup, op9_substring_dedup, op10_warc, registry, shards
from llm import textops as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def alternating(n, letters="ab"):
    """A string that never repeats a piece three times in a row; with its complement it defeats sums of powers modulo 2**64."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def hard():
    """Rows with equal, null and very large ids, and texts whose polynomial hashes modulo 2**64 would be equal."""
    a, b = alternating(1024), alternating(1024, "ba")
    u, v = (" ".join(alternating(1024, x)) for x in ("cd", "dc"))
    lines = f"{a}\n{b}\n{a}\nend"
    far = " ".join(f"w{i}" for i in range(60))
    return [(1, a), (2, b), (3, u), (4, v), (5, lines), (6, a + " and " + b), (7, far), (7, far + " x"), (7, far), (None, far), (None, None), (None, b), (2**60 + 1, far), (2**53 + 1, "once"), (-5, far + " y")]


def corpus(n=90, seed=5):
    """Texts that share passages at changing offsets, near copies, copies, hot passages, and odd ones."""
    r = random.Random(seed)
    vocabulary = [a + b for a in "ka lo mi tu é sö".split() for b in "na ri pe do ß x".split()]
    say = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    hot, passages, out = say(60), [say(r.choice([34, 35, 36, 50, 90])) for _ in range(6)], []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.15:
            t = r.choice(out)
        elif out and kind < 0.4:
            w = (r.choice(out) or "a").split(" ")
            w[r.randrange(len(w))] = "changed"
            t = " ".join(w)
        else:
            t = say(r.choice([1, 4, 20, 80])) + r.choice([" ", "\n", "  "]) + r.choice([*passages, hot, hot, hot]) + r.choice([" ", "\t", "\n\n"]) + say(r.choice([0, 3, 40]))
        out.append(t)
    out += [None, "", " \n\t ", "a", "a b c d", "A B C D", "é" * 200, "Und " * 300, "ab" * 80, hot + " " + hot, say(6000)]
    return [(i * 3 % 1000 + 7, t) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    r = random.Random(1)
    return spark.createDataFrame([(i, t, r.choice(["en", "de", None]), r.choice(["a", "a", "b", None]), len(t or "")) for i, t in rows], DOCS).withColumns({"kept": F.lit("x"), "batch": F.lit(1), "_shard": F.lit(2)}).repartition(3)


def got(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


KEY = lambda r: tuple((x is not None, x) for x in r)
LAST = 2**63 - 1  # null ids stand last


def same(df, columns, want):
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=KEY) == sorted(((None if w[0] == LAST else w[0], *w[1:]) for w in want), key=KEY)


@pytest.fixture(scope="module")
def hard_docs(spark):
    return spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in hard()], DOCS).coalesce(1)


def last_if_null(rows):
    return [(LAST if i is None else i, t) for i, t in rows]


def test_suffix_dedup_hard(hard_docs):
    for many in (4096, -1):
        same(op8_suffix_dedup.suffix_dedup(hard_docs, many=many), op8_suffix_dedup.DIGEST, bytes_dedup(last_if_null(hard())))
    # texts without a common string lose nothing
    two = hard_docs.filter("doc_id IN (3, 4)")
    assert bytes_dedup([r for r in hard() if r[0] in (3, 4)])[1][2] > 0  # these share windows
    for x, y in ((alternating(49), alternating(49, "ba")), ("é" * 30, "è" * 30)):
        out = op8_suffix_dedup.suffix_dedup(two.sparkSession.createDataFrame([(1, x * 2), (2, y)], "doc_id long, text string"))
        assert got(out, *op8_suffix_dedup.DIGEST) == bytes_dedup([(1, x * 2), (2, y)])


def test_suffix_dedup_carries_columns(docs, rows):
    out = op8_suffix_dedup.suffix_dedup(docs, keep="string", carry=["lang", "source", "batch"])
    assert got(out, "doc_id", "n_removed") == [(i, n) for i, _, n, *_ in bytes_dedup(rows)] and {r["batch"] for r in out.select("batch").collect()} == {1}
    assert sorted(map(KEY, got_any(out, "doc_id", "lang", "source"))) == sorted(map(KEY, got_any(docs, "doc_id", "lang", "source")))


def got_any(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_substring_dedup_hard(hard_docs):
    same(op9_substring_dedup.substring_dedup(hard_docs), op9_substring_dedup.DIGEST, words_dedup(last_if_null(hard())))


def test_bpe_hard(hard_docs):
    t = op3_bpe._tokenizer(op3_bpe.default_path())
    want = [(i, len(ids := tokens(t, x)), sha(np.array(ids, "<u4").tobytes()), sha(t.decode(ids, skip_special_tokens=False).encode())) for i, x in last_if_null(hard())]
    same(op3_bpe.bpe(hard_docs), op3_bpe.DIGEST, want)


def test_jaccard_hard(hard_docs):
    some = [r for r in hard() if r[0] not in (7, None)]
    want = {i: (n, c) for i, n, c in jaccard(some)}
    out = [tuple(r) for r in op4_ngram_jaccard.jaccard_join(hard_docs).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(r for r in out if r[0] not in (7, None)) == sorted((i, n, c) for i, (n, c) in want.items())
    # rows with an equal id share a component; rows without an id come back and link with nothing
    assert sorted(r for r in out if r[0] == 7) == [(7, 56, -5), (7, 56, -5), (7, 57, -5)] and sorted(r[1:] for r in out if r[0] is None) == [(0, None), (1, None), (56, None)]


def test_quality_hard(hard_docs):
    out = op5_quality_rules.measured(hard_docs)
    same(out, ["doc_id", *op5_quality_rules.COUNTS], [(i, *quality(t)) for i, t in last_if_null(hard())])


@pytest.mark.parametrize("many", [4096, 2, -1])
def test_suffix_dedup(docs, rows, many):
    assert got(op8_suffix_dedup.suffix_dedup(docs, many=many), *op8_suffix_dedup.DIGEST) == bytes_dedup(rows)


def repetitive(seed=4):
    """Texts that repeat themselves after few bytes, alone and between others, with borders of all kinds."""
    r = random.Random(seed)
    units = [" ", "a", "ab", "aab", "abcabd", "-=", "é", "0123456789abcdefghijklm", "0123456789abcdefghijklmn", "one line of a table | 0.00 |\n"]
    out = []
    for i in range(120):
        t = "".join((r.choice(units) * 400)[: r.choice([5, 49, 50, 51, 75, 99, 100, 101, 130, 400])] + r.choice(["", "x", f"<{i}>", "the same words between them all, more than fifty bytes of them"]) for _ in range(r.randrange(1, 6)))
        out.append((r.randrange(90), t))
    return out


@pytest.mark.parametrize("many", [4096, 2, -1])
def test_suffix_dedup_of_repetitive_texts(spark, monkeypatch, many):
    rows = repetitive()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(op8_suffix_dedup.suffix_dedup(frame, many=many), *op8_suffix_dedup.DIGEST) == bytes_dedup(rows)


@pytest.mark.parametrize("chunk", [64, 200, 1 << 18])
def test_anchors_with_extents_stand_for_all(monkeypatch, chunk):
    """Every string of a text has an anchor, or repeats one that has and that the extent reaches."""
    monkeypatch.setattr(op8_suffix_dedup, "CHUNK", chunk)
    enc = [t.encode() for _, t in repetitive(9)[:40]]
    buf, off = np.frombuffer(b"".join(enc), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in enc])])
    p, h, extent = op8_suffix_dedup.anchors(buf, off, 50, 24)
    assert (np.diff(p) > 0).all() and len(p) == len(h) == len(extent) and extent.max() > 200
    reached = np.zeros(len(buf) + 1, bool)
    for a, x in zip(p, extent, strict=True):
        lo, hi = max(0, a - 26), a + x + 1
        reached[lo:hi] = True
        assert x == 0 or all(len(set(buf[k::d][: x // d].tolist())) == 1 for d in [next(d for d in range(1, 24) if (buf[a - 50 : a + x + 50 - d] == buf[a - 50 + d : a + x + 50]).all())] for k in range(a, a + d))
    for lo, hi in zip(off[:-1], off[1:], strict=True):
        assert reached[lo : max(lo, hi - 49)].all()


@pytest.mark.parametrize("unit", [" ", "ab", "0123456789abcdefghijklm"])
def test_suffix_dedup_of_long_repetitive_texts(spark, unit):
    """16 MB that repeat a few bytes: anchors are few, and a worker holds some tens of bytes for each byte at most."""
    n = 16 << 20
    long = (unit * (n // len(unit) + 1))[:n]
    tracemalloc.start()
    p, _, extent = op8_suffix_dedup.anchors(np.frombuffer(long.encode(), np.uint8), np.array([0, n]), 50, 24)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(p) < 300 and extent.max() > n - 300 and peak < 300 << 20
    rows = [(1, long[: n // 4]), (2, "<" + long[: n // 8] + ">"), (3, "no"), (4, long[: n // 4] + "!")]
    out = {r["doc_id"]: r for r in op8_suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep=None).collect()}
    assert [out[i]["n_removed"] for i in (1, 2, 3, 4)] == [0, n // 8, 0, n // 4]
    assert out[2]["kept_sha256"] == sha(b"<>") and out[4]["kept_sha256"] == sha(b"!")


def test_suffix_dedup_of_reserved_ids(spark):
    """The largest and the smallest id are ids like others; null stands behind them."""
    far = " ".join(f"w{i}" for i in range(60))
    rows = [(2**63 - 1, far), (None, far + "!"), (None, far + "?"), (-(2**63), "x" + far[:99]), (5, "w")]
    for many in (4096, -1):
        out = op8_suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep="string", many=many)
        seen = {(r["doc_id"], r["kept"]) for r in out.collect()}
        assert seen == {(-(2**63), "x" + far[:99]), (2**63 - 1, far[99:]), (None, "!"), (None, "?"), (5, "w")}


def test_suffix_sort_verifies(monkeypatch):
    """With hashes that are all equal the sort goes astray, which the bytes show."""
    r = np.random.default_rng(1)
    text, group = (r.integers(0, 3, (200, 12)) + 1).astype(np.int16), np.sort(r.integers(0, 9, 200))
    monkeypatch.setattr(op8_suffix_dedup, "PRIMES", (1, 1))
    order, common = op8_suffix_dedup.suffix_sort(text, group)
    keys = [(group[i], tuple(text[i])) for i in order]
    assert keys == sorted(keys) and common.max() > 1


def test_suffix_sort():
    r = np.random.default_rng(0)
    text = (r.integers(0, 3, (300, 12)) + 1).astype(np.int16)
    for i, n in enumerate(r.integers(0, 13, 300)):
        text[i, n:] = 0
    group = np.sort(r.integers(0, 20, 300))
    order, common = op8_suffix_dedup.suffix_sort(text, group)
    keys = [(group[i], tuple(text[i])) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(300))
    for k in range(1, 300):
        a, b = text[order[k - 1]], text[order[k]]
        true = next((j for j in range(12) if a[j] != b[j] or not a[j]), 12)
        assert common[k] == (true if group[order[k]] == group[order[k - 1]] else 0)


def test_substring_dedup(docs, rows):
    assert got(op9_substring_dedup.substring_dedup(docs), *op9_substring_dedup.DIGEST) == words_dedup(rows)


@pytest.mark.parametrize("block", [1500, 4])
def test_jaccard(docs, rows, block):
    assert got(op4_ngram_jaccard.jaccard_join(docs, block=block), "doc_id", "n_shingles", "component_id") == jaccard(rows)


def test_jaccard_group():
    r = np.random.default_rng(3)
    base = [r.choice(5000, 60, replace=False) for _ in range(5)]
    sets = [np.unique(np.concatenate([b[r.random(60) > p], r.choice(9000, 3)])).astype(np.uint64) for b in base for p in (0, 0.02, 0.05, 0.1, 0.1, 0.2, 0.3)]
    a, b = op4_ngram_jaccard.group_edges(np.arange(len(sets)), sets)
    from brute import parts

    true = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    assert parts(range(len(sets)), zip(a, b, strict=True)) == parts(range(len(sets)), true)


def test_bpe(docs, rows):
    t = op3_bpe._tokenizer(op3_bpe.default_path())
    odd = [(9001, 'x <|endoftext|>y'), (9002, "it's  ΣΑΣ x y　z İ ß ﬁ 𝔘 1²"), (9003, "́ a")]
    more = docs.select("doc_id", "text").unionAll(docs.sparkSession.createDataFrame(odd, "doc_id long, text string"))
    want = []
    for i, x in [*rows, *odd]:
        ids = tokens(t, x)
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.decode(ids, skip_special_tokens=False).encode())))
    assert got(op3_bpe.bpe(more), *op3_bpe.DIGEST) == sorted(want)


@pytest.mark.parametrize("options", [{}, {"docs_per_shard": 10, "file_bytes": 600, "bits": 5}])
def test_token_files(docs, rows, options):
    t = op3_bpe._tokenizer(op6_token_output.default_path())
    odd = [(9001, "a <|endoftext|>b  <|endoftext|> "), (9002, "it's  ΣΑΣ x y　z İ ß ﬁ 𝔘 1²"), (9003, " a \n\n b\t c  ")]
    more = docs.select("doc_id", "text").unionAll(docs.sparkSession.createDataFrame(odd, "doc_id long, text string"))
    want, at = [], 0
    for i, x in sorted([*rows, *odd]):
        ids = tokens(t, x, 2)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert got(op6_token_output.read_tokens(docs.sparkSession, *op6_token_output.write_tokens(more, **options)), "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_token_file_access():
    ids = np.random.default_rng(1).integers(0, 50257, 5000).astype(np.int32)
    ids[::3] %= 50
    for bits in (4, 8, 12):
        data = op6_token_output.write_codes(np.array([1]), ids, np.array([5000]), bits)
        f = op6_token_output.TokenFile(data)
        f.verify()
        where = np.random.default_rng(2).integers(0, 5000, 700)
        assert (f.all() == ids).all() and (f.take(where) == ids[where]).all()
        with pytest.raises(ValueError, match="damaged"):
            op6_token_output.TokenFile(data[:-1] + bytes([data[-1] ^ 1])).verify()


def test_long_runs(spark):
    """A million blanks, line breaks or equal signs, and a long text of odd pieces."""
    t, r = op3_bpe._tokenizer(op6_token_output.default_path()), random.Random(3)
    long = "".join(r.choice(["word ", "it's ", "1 ", " ", "\n", "é x ", "a b ", "<|endoftext|>", "x"]) for _ in range(200_000))
    data = [(1, " " * 1_000_001 + "a"), (2, "\n" * 1_000_001), (3, "=" * 1_000_001), (4, long), (5, None), (6, ""), (7, "x " + long), (None, "b")]
    want, at = [], 0
    for i, x in sorted(data, key=KEY):
        ids = tokens(t, x, 2)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    same(op6_token_output.read_tokens(spark, *op6_token_output.write_tokens(df)), ["doc_id", "start", "n_tokens", "ids_crc32"], want)


def test_both_tokenizers_agree():
    t, (fast, special) = op3_bpe._tokenizer(op6_token_output.default_path()), op6_token_output._ranked(op6_token_output.default_path())
    r = random.Random(2)
    letters = "abcTHE  \n\t'sdlv019.,!?*#<>|éÉßñ×÷ÿ-_" + "".join(map(chr, range(0x20, 0x7F)))
    for _ in range(2000):
        x = "".join(r.choice(letters) for _ in range(r.randrange(60))) + r.choice(["", "<|endoftext|>", " <|endoftext|> x"])
        assert tokens(t, x) == list(fast.encode(x, allowed_special=special)), x


def test_pieces_are_where_the_tokenizer_cuts():
    """Texts of few signs, white space of all kinds among them, encoded in pieces and whole."""
    t, path, r = op3_bpe._tokenizer(op6_token_output.default_path()), op6_token_output.default_path(), random.Random(5)
    signs = ["a", "B", "é", "ß", "1", ".", "'s", "'", " ", " ", " ", "\n", "\t", "\r", "\u00a0", "\u3000", "\u0085", "\u2028", "\x1c", "\x00", "—", "ж", "語", "<|endoftext|>", "𝔘", "\u0301"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(25))) for _ in range(4000)]
    raw = [x.encode() for x in texts]
    buf, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    ids, ends = op6_token_output.encode(buf, offsets, path, 2)
    assert len(op6_token_output.pieces(buf, offsets, path)) > 1.2 * len(texts) and op6_token_output.plain_rows(buf, offsets).sum() > 100
    alone, before = op6_token_output._by_pieces(buf, offsets, path)
    assert [alone[a:b].tolist() for a, b in zip(before[:-1], before[1:], strict=True)] == [tokens(t, x) for x in texts]
    assert [ids[a:b].tolist() for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)] == [tokens(t, x, 2) for x in texts]


@pytest.mark.parametrize("spread", [1, 1 << 40, 1 << 61])
def test_borders(spark, spread):
    r = random.Random(7)
    keys = [r.randrange(-3, 3) * spread + r.randrange(5) for _ in range(900)] + [None] * 5 + [17] * 100
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    first = shards.borders(df, "k", 50)
    assert list(first) == sorted(set(first)) == list(shards.borders(df.repartition(5), "k", 50))
    known = sorted(k for k in keys if k is not None)
    parts = np.bincount(np.searchsorted(first, known, side="right"), minlength=len(first) + 1)
    most = max(known.count(k) for k in set(known))
    assert parts.sum() == 1000 and parts.max() <= max(50, most) and len(first) <= 64


def test_quality_counts(docs, rows):
    more = ["x\nx\n\n x\nx", "*** # a|b <b>\n*** # a|b <b>", "a b c a b c", "a b c \x1c d", "\n\na\n"]
    extra = docs.sparkSession.createDataFrame([(9000 + i, x, None, None, 0) for i, x in enumerate(more)], DOCS)
    out = op5_quality_rules.measured(docs.select("doc_id", "text", "lang", "source", "n_chars").unionAll(extra))
    want = sorted((i, *quality(x)) for i, x in [*rows, *((9000 + i, x) for i, x in enumerate(more))])
    assert got(out, "doc_id", *op5_quality_rules.COUNTS) == want


def test_quality_verdict(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    junk = " ".join(f"w{i}***" for i in range(80))
    data = [(i, clean.replace("word", "w" * (3 + i % 3)), "en", "a", 0) for i in range(60)] + [(100, junk, "en", "a", 0), (101, "short", "en", "a", 0), (102, "x y z " * 30, "en", "a", 0), (103, None, None, None, 0), (104, clean, None, "b", 0)]
    clashing = {"limit_lang": 1, "limit": 2, "judged": 3, "hi_symbols": 4, "m_symbols": 5, "lo_length": 6, "measure": 7, "kept": 8, "n_words": 9}
    out = op5_quality_rules.quality_rules(spark.createDataFrame(data, DOCS).withColumns({k: F.lit(v) for k, v in clashing.items()}))
    assert all([r[k] for k in list(clashing)[:7]] == list(range(1, 8)) for r in out.collect())
    verdict = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in out.collect()}
    assert all(verdict[i] == (False, True) for i in range(60)) and verdict[104] == (False, True)
    assert verdict[100] == (False, False) and all(verdict[i] == (True, False) for i in (101, 102, 103))


def test_limits_adapt(spark):
    """Sources of one language with other levels get other limits; junk in a source does not raise its own; floors stand below."""
    r = random.Random(7)

    def say(symbols, wide=5):
        return " ".join("".join(r.choices("abcdef", k=r.randrange(wide - 2, wide + 3))) + ("#" if r.random() < symbols else "") for _ in range(r.randrange(60, 240)))

    sources = {"prose": lambda: say(0), "code": lambda: say(r.choice([0.04, 0.08, 0.12]), 7), "posts": lambda: say(r.choice([0, 0.02, 0.3])), "junk": lambda: say(0) if r.random() < 0.7 else "### " * 30 + say(2)}
    data = [(k * 1000 + i, make(), "en", name, 0) for k, (name, make) in enumerate(sources.items()) for i in range(70)] + [(9000 + i, say(0.4), "en", "small", 0) for i in range(5)] + [(9100, say(0), None, None, 0)]
    docs = spark.createDataFrame(data, DOCS)
    cut = {x["source"]: x for x in op5_quality_rules.limits(op5_quality_rules.sketches(op5_quality_rules.measured(docs))).collect()}
    assert cut["code"]["hi_symbols"] > 2 * cut["prose"]["hi_symbols"] and cut["prose"]["hi_symbols"] == op5_quality_rules.FLOOR["symbols"] == cut["junk"]["hi_symbols"]
    assert cut["code"]["hi_length"] > cut["prose"]["hi_length"]
    kept = {x["doc_id"]: x["kept"] for x in op5_quality_rules.quality_rules(docs, texts=False).collect()}
    assert kept == {d[0]: k for d, k in zip(data, kept_by_rules([d[1:4] for d in data]), strict=True)}
    assert all(kept[i] for i in range(70)) and all(kept[1000 + i] for i in range(70)) and all(kept[3000 + i] == (not d[1].startswith("#")) for i, d in enumerate(data[210:280]))


def test_mixing(spark, docs, rows):
    out = op2_mixing.mixed(docs, block=4, shard_words=500).collect()
    sizes = {}
    for r, s in [(r, r["source_size"]) for r in out]:
        sizes[r["key"]] = s
    target = water({None if k == "" else k[1:]: v for k, v in sizes.items()})
    for key, size in sizes.items():
        mine = [r for r in out if r["key"] == key]
        assert sum(r["size"] for r in mine) == size
        assert mine[0]["target"] == pytest.approx(target[None if key == "" else key[1:]])
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 0.02 * size + 1
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in mine)
    again = op2_mixing.mixed(docs.repartition(5), block=4, shard_words=500)
    assert got(again, "doc_id", "taken") == sorted((r["doc_id"], r["taken"]) for r in out)
    text = op2_mixing.taken_texts(docs.select("doc_id", "text", "lang", "source", "n_chars"), block=4, shard_words=500)
    count = text.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n"))
    assert got(count, "doc_id", "n") == sorted((r["doc_id"], r["taken"]) for r in out if r["taken"])


def test_mixing_small_sources(spark):
    """Twelve sources of 20 words and one of 4,000; clashing columns; rows with equal and null ids."""
    say = lambda n, k: " ".join(f"w{k}x{i}" for i in range(n))
    data = [(i, say(20, i), "en", f"s{i:02d}", 0) for i in range(12)] + [(k % 7 if k else None, say(400, 100 + k), "en", "big", 0) for k in range(10)]
    df = spark.createDataFrame(data, DOCS).withColumns({c: F.lit(7) for c in ("start", "block", "blocks", "quota", "first", "_row", "_share", "key", "size", "shard", "row")})
    out = op2_mixing.mixed(df).collect()
    taken, target = {}, {}
    for r in out:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(water({k: 4000 if k == "big" else 20 for k in taken}))
    assert all(abs(taken[k] - target[k]) <= max(1, 0.02 * target[k]) for k in taken) and len(out) == 22
    text = op2_mixing.taken_texts(df)
    assert text.columns == df.columns and text.filter("start <> 7 OR _row <> 7 OR quota <> 7 OR _share <> 7").count() == 0
    words = [w for r in text.collect() for w in r["text"].split()]
    assert len(words) == sum(taken.values()) and max(words.count(w) for w in set(words)) <= 2


def test_sainte_lague(spark):
    r = random.Random(4)
    for seats in (0, 1, 7, 100, 1003):
        votes = [(i, float(r.randrange(0, 1000)), seats) for i in range(9)]
        total = sum(v for _, v, _ in votes)
        votes = [(*v, max(1, int(v[1] * seats / total) + r.choice([0, 1, 50]))) for v in votes]
        given = dict.fromkeys(range(9), 0)
        for _ in range(seats):
            best = max((i for i in range(9) if given[i] < votes[i][3]), key=lambda i: (votes[i][1] / (2 * given[i] + 1), -i))
            given[best] += 1
        out = op2_mixing.sainte_lague(spark.createDataFrame(votes, "place int, v double, seats int, most long"), [], "v", "seats", "place", "most")
        assert {x["place"]: x["quota"] for x in out.collect()} == given


def test_language(spark):
    r = random.Random(6)
    stock = {"en": "the of and to in that is was he for".split(), "de": "der die und das nicht ein ich ist zu den".split(), "fr": "le de un être et à il avoir ne je".split(), "es": "el la de que y a en un ser se".split()}
    data = [(i, " ".join(r.choice(stock[k]) for _ in range(30)).title(), k) for i in range(400) for k in [r.choice(list(stock))]] + [(1000, None, "en"), (1001, "", None), (1002, "123 !!", "de"), (1003, "é", None)]
    out = {x["doc_id"]: x for x in op7_language_id.language_id(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    held = [(i, k) for i, _, k in data if zlib.crc32(str(i).encode()) % 4 == 2 and i < 1000]
    assert all(out[i]["held_out"] for i, _ in held) and sum(out[i]["lang_pred"] == k for i, k in held) >= 0.97 * len(held)
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (1000, 1001, 1002)) and out[1003]["lang_pred"] in stock
    assert all(0 <= x["score"] <= 1 for x in out.values())
    none = op7_language_id.language_id(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).first()
    assert (none["lang_pred"], none["score"]) == ("und", 0)


def test_language_prediction():
    """Features, votes and scores against one text and one pair at a time."""
    r = np.random.default_rng(11)
    groups = {"a": ["a1", "a2", "a3"], "b": ["b1"], "c": ["c1", "c2"]}
    pairs = [p for names in [list(groups), *groups.values()] for p in itertools.combinations(names, 2)]
    model = {"families": groups, "pairs": {p: (r.normal(size=4096), r.normal() * 0.1) for p in pairs}}
    pool = ["a", "B", "É", "ß", "×", "÷", "ÿ", "“x”", " — ", "…", "€", "ª", "¿que", "語", "、", "1", "\n", "zq", "ΣΑΣ", "→", "ж", "\u00ad", "𝔘"]
    texts = ["".join(r.choice(pool, r.integers(0, 30))) for _ in range(300)] + ["", "1 2", "×", "a", "é"]
    raw = [t.encode() for t in texts]
    langs, score = op7_language_id.predict(model, np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
    want = [language(model, t) for t in texts]
    assert langs == [w[0] for w in want] and score == pytest.approx([w[1] for w in want]) and len(set(langs)) == 7


def test_language_sample(spark):
    """At most `sample` texts a language, the same for any partitioning; copies count once; all of a small language are taken."""
    data = [(i, f"text {i}", "en") for i in range(300)] + [(5, "text 5", "en")] * 200 + [(1000 + i, f"texte {i}", "fr") for i in range(9)] + [(None, "x", "fr"), (2000, None, "fr"), (2001, "y", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    found = [got(op7_language_id.sampled(d, 20), "lang", "text") for d in (df.repartition(3), df.repartition(5))]
    assert found[0] == found[1] and [x for x, _ in found[0]].count("en") == 20 and len(set(found[0])) == len(found[0])
    learned = {i for i, _, k in data if k == "fr" and i and zlib.crc32(str(i).encode()) % 4 != 2 and i != 2000}
    assert [x for x, _ in found[0]].count("fr") == len(learned)


@pytest.mark.parametrize("local", [op1_nn_descent.LOCAL, 0])
def test_vectors_without_ids(spark, local):
    v = [[1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.01, 0.0], [0.0, 0.0, 1.0]]
    data = [(7, v[0], 1), (None, v[1], 1), (7, v[2], 1), (None, v[4], 1), (9, v[3], 1), (None, v[4], 1), (None, None, 1), (3, v[0], 2), (4, v[1], 2), (2**60 + 1, v[0], None)]
    out = op1_nn_descent.near_dedup(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").coalesce(1), local=local)
    want = [(7, 2, 7, True), (None, 2, 7, False), (7, 0, 7, True), (None, 1, None, False), (9, 2, 7, False), (None, 1, None, False), (None, 0, None, False), (3, 1, 3, True), (4, 1, 3, False), (2**60 + 1, 0, 2**60 + 1, True)]
    assert sorted(map(KEY, got_any(out, "vec_id", "n_links", "component_id", "kept"))) == sorted(map(KEY, want))


@pytest.mark.parametrize("local", [op1_nn_descent.LOCAL, 0])
def test_vectors(spark, local):
    r = np.random.default_rng(8)
    centres = r.normal(size=(12, 16))
    data = [(i, [float(x) for x in centres[k] + r.normal(size=16) * s], int(k % 3)) for i in range(240) for k, s in [(r.integers(12), r.choice([0.05, 0.1, 0.2, 1.0]))]]
    data += [(500 + i, data[0][1], data[0][2]) for i in range(90)] + [(700, None, 0), (701, [0.0] * 16, 0), (702, [float("nan")] * 16, 0), (703, [None] + [1.0] * 15, 0), (704, data[0][1], None), (705, [], 1), (706, [1e300] * 16, 1), (707, [1.0] * 16, 1), (708, [1.0] * 8, 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").withColumn("unit", F.lit(1)).repartition(3)
    assert got(op1_nn_descent.near_dedup(df, local=local), "vec_id", "n_links", "component_id", "kept") == vectors(data)


def leaning(spark, n=3000, isolated=120, group=600):
    """Vectors with a common direction (mean cosine 0.7), isolated pairs of cosine 0.985 and a group of near copies."""
    r = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(np.sqrt(0.7) * unit(r.normal(size=64)) + np.sqrt(0.3) * unit(r.normal(size=(n, 64))))
    off = r.normal(size=(isolated, 64))
    off = unit(off - (off * x[:isolated]).sum(1, keepdims=True) * x[:isolated])
    x[isolated : 2 * isolated] = 0.985 * x[:isolated] + np.sqrt(1 - 0.985**2) * off
    x[n - group :] = unit(x[-1] + 0.02 * unit(r.normal(size=(group, 64))))
    hit = (x @ x.T >= 0.98) & ~np.eye(n, dtype=bool)
    return x, hit, spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(3)


def test_vectors_of_a_parted_label(spark):
    """Six groups of 512 nodes: the audit lets one link in a hundred go."""
    x, hit, df = leaning(spark)
    out = {r["vec_id"]: r for r in op1_nn_descent.near_dedup(df, local=0).collect()}
    linked = np.array([out[i]["n_links"] for i in range(len(x))])
    assert (linked <= hit.sum(1)).all() and (linked == hit.sum(1))[hit.any(1)].mean() >= 0.99
    assert len({out[i]["component_id"] for i in range(2400, 3000)}) == 1


@pytest.mark.parametrize("options", [{}, {"growths": 0}, {"local": 64 * 2000}, {"local": 0, "growths": 0}])
def test_vectors_with_a_common_direction(spark, options):
    x, hit, df = leaning(spark)
    out = {r["vec_id"]: r for r in op1_nn_descent.near_dedup(df, **options).collect()}
    assert [out[i]["n_links"] for i in range(len(x))] == hit.sum(1).tolist()
    assert all(out[i]["component_id"] == out[i + 120]["component_id"] == i for i in range(120))
    assert len({out[i]["component_id"] for i in range(2400, 3000)}) == 1


def test_crowded_leaves_and_audit(spark, monkeypatch):
    x, hit, df = leaning(spark, 1500, 60, 500)
    monkeypatch.setattr(op1_nn_descent, "LEAF", 20)
    out = {r["vec_id"]: r["n_links"] for r in op1_nn_descent.near_dedup(df, local=0).collect()}
    assert [out[i] for i in range(len(x))] == hit.sum(1).tolist()
    nodes = spark.createDataFrame([(i, 0, 64, bytes(v.tobytes())) for i, v in enumerate(x)], "id long, label int, dim int, unit binary")
    parts = spark.createDataFrame([(i, 1000) for i in range(1000, 1500)], "id long, component_id long")
    # all pairs outside the group are missing: the group must not hide it
    small, large = op1_nn_descent.audit(nodes, parts)
    assert small[0] >= 40 and small[1] == 0 and large[0] == large[1] > 0


def test_audit_within_a_label():
    """Isolated pairs that are all missing fail the audit, whatever a large group holds; lists alone find nearly all links."""
    r = np.random.default_rng(2)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(r.normal(size=(1500, 32)))
    x[1:600:2] = unit(x[0:600:2] + 0.02 * r.normal(size=(300, 32)))
    x[900:] = unit(x[900] + 0.01 * r.normal(size=(600, 32)))
    parts = np.arange(1500)
    parts[900:] = 900
    assert not op1_nn_descent._in_components(x, parts)
    parts[1:600:2] = parts[0:600:2]
    assert op1_nn_descent._in_components(x, parts)
    part, linked = op1_nn_descent.solved(np.arange(1500), x, np.ones(1500, np.int64), op1_nn_descent.TREES, op1_nn_descent.ROUNDS, op1_nn_descent.GROWTHS)
    hit = (x @ x.T >= 0.98) & ~np.eye(1500, dtype=bool)
    assert linked.tolist() == hit.sum(1).tolist() and len(set(part[900:])) == 1


def test_counted_in_blocks(spark):
    r = np.random.default_rng(9)
    x = r.normal(size=8) + r.normal(size=(70, 8)) * 0.07
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, bytes(v.tobytes()), 1 + i % 3) for i, v in enumerate(x)], "id long, unit binary, weight long")
    hit = (x @ x.T >= 0.98) & ~np.eye(70, dtype=bool)
    out = op1_nn_descent.counted(nodes, nodes.selectExpr("id", "0L AS component_id"), block=16)
    assert got(out, "id", "linked") == [(i, int(hit[i] @ (1 + np.arange(70) % 3))) for i in range(70)]


def test_warc(spark):
    data = [(i, f"http://x/{i} y\r\nz" if i % 5 else None, t) for i, t in enumerate(["a", None, "", "é" * 300, "a", "b\r\n\r\nc", "a", None] + [f"page {i % 7}" * 50 for i in range(40)])] + [(5, "dup", "a"), (None, "u", "a")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("kind", F.lit("k")).repartition(3)
    last = {}
    for i, _, t in data:
        if i is not None:
            last[t or ""] = max(i, last.get(t or "", i))
    want = []
    for i, _, t in data:
        b = (t or "").encode()
        target = last[t or ""] if i is not None and i != last[t or ""] else None
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if target is None else "revisit", target))
    key = lambda r: tuple((x is not None, x) for x in r)
    for options in ({}, {"pages_per_shard": 7, "file_bytes": 500}):
        folder, manifest = op10_warc.write_warc(pages, **options)
        back = op10_warc.read_warc(spark, folder, manifest)
        assert sorted((tuple(r) for r in back.select(*op10_warc.DIGEST).collect()), key=key) == sorted(want, key=key)
        assert {bytes(r["payload"]) for r in back.filter("record_type = 'response'").collect()} == {(t or "").encode() for _, _, t in data}
    again, listed = op10_warc.write_warc(pages.repartition(2), **options)
    content = lambda f: sorted((r["path"].rsplit("/", 1)[-1], hashlib.sha1(r["content"]).hexdigest()) for r in spark.read.format("binaryFile").load(f).collect())
    assert content(folder) == content(again) and listed.count() > 3
    mixed_sizes = [b"", b"x" * 3_000_000, b"y", np.random.default_rng(0).bytes(200_000), b"z" * 5000]
    data = b"".join(op10_warc.record(k, "u", p, None, op10_warc.DATE) for k, p in enumerate(mixed_sizes))
    assert [p for _, _, p in op10_warc.records(data)] == mixed_sizes
    with pytest.raises(ValueError):
        list(op10_warc.records(op10_warc.record(1, "u", b"abc", None, op10_warc.DATE)[:-9]))


EMPTY = {"documents": DOCS, "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>, label int"}


@pytest.mark.parametrize("name", sorted(registry.MODULES))
def test_empty_tables(spark, tmp_path, name):
    for table, schema in EMPTY.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    out = registry.MODULES[name].query(spark, str(tmp_path))
    assert out.count() == 0 and out.columns


def test_exchange_encoding():
    r = np.random.default_rng(0)
    for a in (np.zeros(0, np.uint64), r.integers(0, 2**63, 1000).astype(np.uint64), r.integers(0, 9, (30, 7)).astype(np.uint8), np.array([5], np.int16)):
        back = hashx.restore(hashx.dump(a=a))["a"]
        assert back.dtype == a.dtype and back.shape == a.shape and (back == a).all()
    h = np.sort(r.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2))
    at = hashx.bounds(h, 7)
    assert at[0] == 0 and at[-1] == 500 and all((int(x) * 7) >> 64 == b for b in range(7) for x in h[at[b] : at[b + 1]])


@pytest.mark.parametrize("limit", [1, 5000, 1 << 20])
def test_combined_rows_come_apart(spark, monkeypatch, limit):
    """Rows of a task are one for each key, as far as the limit goes; all come back, empty ones too."""
    monkeypatch.setattr(hashx, "COMBINE", limit)
    rows = [(i % 7, 2**40 + i, bytes([i % 251]) * (i % 90)) for i in range(400)]
    frame = spark.createDataFrame(rows, hashx.ASKED).repartition(3)
    out = hashx.combined(frame).toArrow()
    back = sorted((k, *x) for k, p in zip(out.column(0).to_pylist(), out.column(1), strict=True) for x in hashx.apart([p]))
    assert back == sorted(rows) and (len(out) == 21 if limit > 1 << 16 else len(out) > 21)


def test_a_task_of_a_round_has_one_worker(spark):
    """No Python step receives what another one of the same task has made, and the texts are packed once for all rounds."""
    docs = spark.createDataFrame([(i, f"{'a passage that all of these have in common, and more of it ' * 4}{i} {i * 7}") for i in range(40)], "doc_id long, text string")
    for out in (op8_suffix_dedup.suffix_dedup(docs), op9_substring_dedup.substring_dedup(docs)):
        assert len(out.collect()) == 40
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        above, steps = [], 0
        for line in plan.strip().splitlines():
            if (word := re.search(r"[A-Za-z]\w+", line)) is None:
                continue
            while above and above[-1][0] >= word.start():
                above.pop()
            python, busy = "InArrow" in word[0], bool(above) and above[-1][1]
            assert not (python and busy), plan
            steps += python
            above.append((word.start(), (python or busy) and "Exchange" not in word[0]))
        assert steps >= 6 and plan.count("MapInArrow packed(") == 1, plan


def test_words_and_slices():
    texts = ["a  b", "", " ", "é c\n", "d"]
    enc = [t.encode() for t in texts]
    buf, off = np.frombuffer(b"".join(enc), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in enc])])
    s, e, at = T.words(buf, off)
    assert [[buf[a:b].tobytes().decode() for a, b in zip(s[x:y], e[x:y], strict=True)] for x, y in zip(at[:-1], at[1:], strict=True)] == [t.split() for t in texts]
    assert list(T.slices(off, 4)) == [(0, 2), (2, 3), (3, 4), (4, 5)] or [b - a for a, b in T.slices(off, 4)]


def test_modules_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.MODULES) == list(range(1, 14))
    for name in registry.MODULES:
        importlib.import_module(f"llm.{name}")
