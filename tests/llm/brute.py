"""Plain restatements of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
words = lambda t: WORD.findall(t or "")
sha = lambda b: hashlib.sha256(b).hexdigest()


def parts(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def jaccard(rows):
    sets = []
    for i, t in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    links = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[:n] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    of = parts([i for i, _ in sets], links)
    return sorted((i, len(s), of[i]) for i, s in sets)


def bytes_left(rows, n=50):
    """(id, bytes, positions removed) of each text."""
    enc, first = [(i, (t or "").encode()) for i, t in rows], {}
    for i, b in enc:
        for j in range(len(b) - n + 1):
            first[b[j : j + n]] = min(i, first.get(b[j : j + n], i))
    for i, b in enc:
        gone = set()
        for j in range(len(b) - n + 1):
            if first[b[j : j + n]] < i:
                gone.update(range(j, j + n))
        yield i, b, gone


def bytes_dedup(rows, n=50):
    return sorted((i, len(b), len(gone), sum(j - 1 not in gone for j in gone), sha(bytes(x for j, x in enumerate(b) if j not in gone))) for i, b, gone in bytes_left(rows, n))


def words_dedup(rows, n=35):
    split = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[j : j + n]) for _, w in split for j in range(len(w) - n + 1))
    out = []
    for i, w in split:
        gone = {k for j in range(len(w) - n + 1) if seen[tuple(w[j : j + n])] > 1 for k in range(j, j + n)}
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone).encode())))
    return sorted(out)


def quality(t):
    w = words(t)
    grams = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
    repeated = {k for j in range(len(w) - 2) if grams[tuple(w[j : j + 3])] > 1 for k in range(j, j + 3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeated), len(lines)


def kept_by_rules(rows, power={"s": 3, "d": 3, "r": 4, "l": 8}, floor={"s": 1000, "d": 2500, "r": 2000, "l": 0}, min_group=30):  # noqa: B006
    """Verdict for each row (text, lang, source)."""
    measured, values = [], defaultdict(lambda: defaultdict(list))
    for t, lang, source in rows:
        n, chars, symbols, dup, rep, lines = quality(t)
        m = {"s": 10000 * symbols // max(n, 1), "d": 10000 * dup // max(lines, 1), "r": 10000 * rep // max(n, 1), "l": 100 * chars // max(n, 1)}
        failed = n < 50 or 100 * rep > 50 * n
        measured.append((failed, m, lang, source))
        if not failed:
            smooth = {"s": 10000 * (symbols + 1) // (n + 1), "d": 10000 * (dup + 1) // (lines + 1), "r": 10000 * (rep + 1) // (n + 1), "l": m["l"]}
            for k, v in smooth.items():
                v = max(v, 1)
                for of in ((lang, source), (lang,)):
                    values[of][k].append(v >> max(v.bit_length() - 6, 0) << max(v.bit_length() - 6, 0))

    def quantile(xs, tenths):
        return sorted(xs)[-(-len(xs) * tenths // 10) - 1]

    def reach(lang, k, tenths):
        ratios = [1000 * quantile(v[k], tenths) // quantile(v[k], 5) for of, v in values.items() if len(of) == 2 and of[0] == lang and len(v[k]) >= min_group]
        own = values[lang,][k]
        return quantile(ratios, 5) if ratios else 1000 * quantile(own, tenths) // quantile(own, 5)

    out, known = [], {}
    for failed, m, lang, source in measured:
        good = not failed
        for k in power if good else ():
            if (lang, source, k) not in known:
                own, whole = values[lang, source][k], quantile(values[lang,][k], 5)
                hi = lo = min(quantile(own, 5), 8 * whole) if len(own) >= min_group else whole
                up, down = min(max(reach(lang, k, 9), 1030 if k == "l" else 1000), 10**6), min(reach(lang, k, 1), 10**6 // 1030)
                for _ in range(power[k]):
                    hi, lo = min(hi * up // 1000, 10**9), lo * down // 1000
                known[lang, source, k] = lo, max(hi, floor[k])
            lo, hi = known[lang, source, k]
            good &= m[k] <= hi and (k != "l" or m[k] >= lo)
        out.append(good)
    return out


def mixture(rows, block=64, fine=128, shard_words=1 << 19, seed=17):
    """(doc_id, text) of each taking of each row (doc_id, text, source), one block at a time."""
    number = lambda t, below: int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % below
    key = lambda s: "" if s is None else "=" + s
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    target = water(sizes)
    places = sorted(sizes, key=lambda s: (s is None, s or ""))
    unit = {s: next((x for x in (block >> i for i in range(block.bit_length())) if target[s] >= fine * x), 1) for s in places}

    def apportion(names, votes, seats, most):
        given = dict.fromkeys(names, 0)
        for _ in range(seats):
            able = [x for x in names if given[x] < most[x] and votes[x] > 0]
            if not able:
                break
            given[max(able, key=lambda x: (votes[x] / (2 * given[x] + 1), -names.index(x)))] += 1
        return given

    out = []
    for size in set(unit.values()):
        names = [s for s in places if unit[s] == size]
        quota = apportion(names, target, int(sum(target[s] for s in names) / size + 0.5), {s: 2 * -(-sizes[s] // size) for s in names})
        for s in names:
            shards = defaultdict(list)
            for i, t, x in rows:
                if x == s:
                    shards[number(f"{seed}:shard:{i}", max(1, -(-sizes[s] // shard_words)))].append((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i, len(words(t)), t))
            held = {k: sum(r[2] for r in v) for k, v in shards.items()}
            parts = apportion(sorted(held), held, quota[s], {k: 2 * -(-n // size) for k, n in held.items()})
            for k, docs in shards.items():
                blocks, at = -(-held[k] // size), 0
                first = number(f"{seed}:{key(s)}:{k}", max(1, blocks))
                for _, i, n, t in sorted(docs):
                    times = [((x // size + 1) * parts[k] + first) // blocks - (x // size * parts[k] + first) // blocks for x in range(at, at + n)]
                    at += n
                    spans = [m.span() for m in WORD.finditer(t or "")]
                    for copy in (1, 2):
                        on = [x >= copy for x in times]
                        if n and all(on):
                            out.append((i, t))
                        elif any(on):
                            starts = [j for j in range(n) if on[j] and (j == 0 or not on[j - 1])]
                            ends = [j for j in range(n) if on[j] and (j == n - 1 or not on[j + 1])]
                            out.append((i, "\n".join(t[spans[a][0] : spans[b][1]] for a, b in zip(starts, ends, strict=True))))
    return out


def water(sizes, weights=(5, 2, 1), factor=1.5, limit=2):
    """Targets by sharing excess again and again."""
    keys = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, total = {k: weights[i % 3] for i, k in enumerate(keys)}, factor * sum(sizes.values())
    full, share = set(), {}
    while True:
        rest = [k for k in keys if k not in full]
        left = total - sum(limit * sizes[k] for k in full)
        share = {k: limit * sizes[k] if k in full else left * weight[k] / sum(weight[x] for x in rest) for k in keys}
        over = {k for k in rest if share[k] > limit * sizes[k]}
        if not over:
            return share
        full |= over


def tokens(tokenizer, t, end=None):
    return tokenizer.encode(t or "", add_special_tokens=False).ids + ([] if end is None else [end])


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def vectors(rows, threshold=0.98):
    import numpy as np

    unit = {}
    for k, (_, v, label) in enumerate(rows):
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) / np.abs(v).max() if ok else None
        unit[k] = x / np.linalg.norm(x) if ok else None
    links = defaultdict(int)
    pairs = []
    for a in unit:
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                pairs.append((rows[a][0], rows[b][0]))
    of = parts([r[0] for r in rows], pairs)
    return sorted((r[0], links[k], of[r[0]], r[0] == of[r[0]]) for k, r in enumerate(rows))


def language(model, text, dim=4096):
    """One text's prediction, feature by feature and pair by pair."""
    import itertools
    import math

    if not any(c.isalpha() for c in text or "") or not model["families"]:
        return "und", 0.0
    out = b""
    for c in text:
        n = ord(c)
        if n < 128:
            out += c.lower().encode() if c.isalpha() else b" "
        elif 0xC0 <= n <= 0xDE and n != 0xD7:
            out += chr(n + 32).encode()
        elif n < 0xC0 and c not in "ªµº" or c in "×÷" or 0x2000 <= n <= 0x206F or 0x20A0 <= n <= 0x20CF or 0x2190 <= n <= 0x2BFF or 0x3000 <= n <= 0x3004 or 0x3008 <= n <= 0x3020:
            out += b" " * len(c.encode())
        else:
            out += c.encode()

    def margin(pair):
        w, total = model["pairs"][pair][0], model["pairs"][pair][1]
        for k in (2, 3):
            runs = [out[i : i + k] for i in range(len(out) - k + 1)]
            if runs:
                total += sum(w[(int.from_bytes(x) * 2654435761 % 2**32 >> 21) + (k - 2) * dim // 2] for x in runs) / len(runs)
        return total

    def choose(names):
        votes, sums, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, math.inf)
        for a, b in itertools.combinations(names, 2):
            m = margin((a, b))
            votes[a if m >= 0 else b] += 1
            for x, s in ((a, m), (b, -m)):
                sums[x] += s
                least[x] = min(least[x], s)
        best = max(names, key=lambda x: (votes[x], sums[x], names.index(x)))
        return best, 1 / (1 + math.exp(-max(-30, min(30, 12 * least[best]))))

    family, sure = choose(sorted(model["families"]))
    lang, inner = choose(model["families"][family])
    return lang, sure * inner
