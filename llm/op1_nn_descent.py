"""Embedding near-dedup by NN-descent.

Vectors of one label (and length) whose cosine is 0.98 or more, in double precision, are linked.
 1. Equal directions (by a 128-bit hash of the unit vector) become one node with a weight.
 2. A random-projection forest gives first neighbours: the nodes of a leaf are compared with one another.
 3. NN-descent: nodes are compared with the neighbours of their neighbours (and of those whose neighbour they are), round after round,
    until no further node gets a link. A node keeps its K best neighbours whatever their cosine; if all K may be links the list is
    saturated and doubles. Forest and rounds compare in low precision; a pair that this leaves open (SLACK) is compared in
    double precision before it is a link.
 4. Links give components. All links of a node lie in its component, so what lists leave out in dense components is
    counted exactly there: components are compared with themselves in blocks; only counts leave a task.
 5. Audit, by node: samples of the nodes of small components (and alone) and of large ones are compared with all nodes.
    If of either fewer than RECALL have all their links in their component, more trees are
    grown and the rounds go on; if that doesn't help, the label is compared with itself in pairs of blocks, exactly.

Links never cross labels. A label of up to LOCAL numbers (nodes times length) is one group: its vectors move once and a task does all
steps on them. A larger label is parted into groups of that size, PARTINGS times anew, by planes through its centre (crowded
groups by further planes through their own); a task grows the lists of its group by steps 2 and 3, and lists are merged. If the audit
is not content, lists go on through joins across groups, and the label is parted PARTINGS times more. Components, counts, audit and
exact comparison of such labels are Spark jobs over tables in the shared folder. Either way no pairs of a group are emitted beyond
the lists. Counting in a component takes time in the square of its distinct vectors, which the number of links itself may have;
copies cost nothing.

Vectors that are null, empty, zero, or hold null or non-finite components, and those with a null label, link with nothing. Rows
with equal ids are vectors of their own, each with the component of its own links. A row without an id links like any other, stands
last, and names no component: one without any id has a null component_id. Rows without an id are not kept. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from llm import textops as T
from llm.common import dropped, load, ship, written
from llm.graph import components

THRESHOLD, SLACK = 0.98, 0.0015
MAYBE = THRESHOLD - SLACK
TREES, LEAF, NEIGHBOURS, WALK, ROUNDS = 8, 256, 12, 4, 4
#: How often a large label is parted before each audit, and how often Spark splits a crowded group anew; beyond that its task does.
PARTINGS, SPLITS = 6, 8
AUDIT, AUDIT_MOST, ENOUGH, SMALL, RECALL, GROWTHS = 512, 8192, 64, 64, 0.99, 3
BLOCK = 2048
#: Numbers (nodes times length) of the largest label that is one group.
LOCAL = 1 << 21
NODE = "id long, label int, dim int, unit binary"


#: What a null id counts as.
NO_ID = np.iinfo(np.int64).max


def units(vectors: DataFrame) -> DataFrame:
    """NODE and a 128-bit hash of the unit vector (bytes of float64); null where a vector can't link."""

    def run(batches):
        for b in batches:
            ids, labels, out, dims = b.column(0).fill_null(NO_ID), b.column(2), [], []
            prints = np.zeros((len(b), 2), np.int64)
            for k, (label, v) in enumerate(zip(labels.to_pylist(), b.column(1), strict=True)):
                x = None
                if label is not None and v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    with np.errstate(over="ignore", invalid="ignore"):
                        x = x / np.abs(x).max() if np.isfinite(x).all() and x.any() else None
                        x = None if x is None else x / np.sqrt(x @ x)
                dims.append(0 if x is None else len(x))
                out.append(None if x is None else (x + 0.0).tobytes())
                if x is not None:
                    prints[k] = np.frombuffer(xxhash.xxh3_128_digest(out[-1]), np.int64)
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(dims, pa.int32()), pa.array(out, pa.binary()), pa.array(prints[:, 0]), pa.array(prints[:, 1])], ["id", "label", "dim", "unit", "h1", "h2"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("int")).mapInArrow(run, f"{NODE}, h1 long, h2 long")


def _matrix(column, kind=np.float64) -> np.ndarray:
    """Equally long binary values as the rows of a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(values):
        return np.zeros((0, 0), kind)
    offsets = np.frombuffer(values.buffers()[1], np.int64 if pa.types.is_large_binary(values.type) else np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind).reshape(len(values), -1)


def _pairs(ids: np.ndarray, x: np.ndarray, most: int) -> pa.Table:
    """For each row its `most` best partners that may be links and its WALK best whatever their cosine, each pair once."""
    sims = x @ x.T
    np.fill_diagonal(sims, -2)

    def best(k: int) -> np.ndarray:
        return sims >= (np.partition(sims, len(x) - k, axis=1)[:, len(x) - k, None] if len(x) > k else -1.5)

    good = (best(most) & (sims >= MAYBE)) | best(WALK)
    np.fill_diagonal(good, False)
    i, j = np.nonzero(np.triu(good | good.T, 1))
    a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
    keep = a != b
    return pa.table({"a": a[keep], "b": b[keep], "sim": sims[i, j][keep].astype(np.float64)})


PAIRS = "a long, b long, sim double"
LEAVES = ["label", "dim", "tree", "code"]
PLACED = "id long, label int, dim int, tree int, code long"


def coarsened(nodes: DataFrame) -> DataFrame:
    """id, label, dim and the unit vector in half precision, whose cosines are off by less than SLACK."""

    def run(batches):
        for b in batches:
            halves = pa.array([np.frombuffer(v.as_py(), np.float64).astype(np.float16).tobytes() for v in b.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], halves], ["id", "label", "dim", "half"])

    return nodes.select("id", "label", "dim", "unit").mapInArrow(run, "id long, label int, dim int, half binary")


def centres(inside: DataFrame, keys: list[str]) -> DataFrame:
    """keys, c (rows) and the mean of the vectors (column half) of each group, from sums that tasks make of their own rows."""
    kinds = ", ".join(f"{k} {dict(inside.dtypes)[k]}" for k in keys)

    def partial(batches):
        sums: dict[tuple, list] = {}
        for b in batches:
            for *key, v in zip(*(b.column(i).to_pylist() for i in range(len(keys) + 1)), strict=True):
                x = np.frombuffer(v, np.float16)
                held = sums.setdefault(tuple(key), [np.zeros(len(x)), 0])
                held[0] += x
                held[1] += 1
            if len(sums) > 1000:
                yield table(sums)
                sums = {}
        if sums:
            yield table(sums)

    def table(sums: dict) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in sums], pa.int64() if keys[i] == "code" else pa.int32()) for i in range(len(keys))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([v[0].tobytes() for v in sums.values()], pa.binary()), pa.array([v[1] for v in sums.values()], pa.int64())], [*keys, "total", "c"])

    def whole(t: pa.Table) -> pa.Table:
        n = sum(t.column("c").to_pylist())
        mean = (_matrix(t.column("total")).sum(0) / n).tobytes()
        return t.slice(0, 1).select(keys).append_column("c", pa.array([n], pa.int64())).append_column("centre", pa.array([mean], pa.binary()))

    return inside.select(*keys, "half").mapInArrow(partial, f"{kinds}, total binary, c long").groupBy(*keys).applyInArrow(whole, f"{kinds}, c long, centre binary")


def _sides(x: np.ndarray, centre: np.ndarray, count: int, seed: list[int]) -> np.ndarray:
    """A number for the sides of `count` planes through centre that the rows of x are on."""
    bits = min(count, 40)
    planes = np.random.default_rng(seed).normal(size=(x.shape[1], 40))[:, :bits]
    return ((x - centre) @ planes > 0).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def halved(x: np.ndarray, most: int, seed: list[int]) -> list[np.ndarray]:
    """Rows of x in parts of at most `most`, halved by random planes through the parts' own medians."""
    out, open_, rng = [], [np.arange(len(x))], np.random.default_rng(seed)
    while open_:
        rows = open_.pop()
        if len(rows) <= most:
            out.append(rows)
        else:
            order = np.argsort(x[rows] @ rng.normal(size=x.shape[1]), kind="stable")
            open_ += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def group_size(dim: int, local: int) -> int:
    """Nodes of one group at most."""
    return max(2 * LEAF, local // dim)


def placed(spark: SparkSession, coarse: DataFrame, trees: range, local: int) -> DataFrame:
    """A row of PLACED per node and parting: sides of planes through the label's centre; in crowded groups, of planes through their own."""
    first, last = trees.start, trees.stop

    def plant(batches):
        for b in batches:
            ids, labels, dims, counts = (b.column(i).to_numpy() for i in (0, 1, 2, 4))
            for at in (np.flatnonzero((labels == label) & (dims == dim)) for label, dim in sorted(set(zip(labels.tolist(), dims.tolist(), strict=True)))):
                x, centre = _matrix(b.column(3).take(pa.array(at)), np.float16).astype(np.float64), np.frombuffer(b.column(5)[int(at[0])].as_py(), np.float64)
                count = max(0, int(np.ceil(np.log2(2 * counts[at[0]] / group_size(x.shape[1], local)))))
                for t in range(first, last):
                    code = _sides(x, centre, count, [t, x.shape[1]])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(labels[at]), pa.array(dims[at]), pa.array(np.full(len(at), t, np.int32)), pa.array(code)], ["id", *LEAVES])

    middle = written(spark, centres(coarse, ["label", "dim"]), "centres")
    leaves = written(spark, coarse.join(middle, ["label", "dim"]).select("id", "label", "dim", "half", "c", "centre").mapInArrow(plant, PLACED), "leaves")

    for level in range(1, SPLITS + 1):
        crowded = written(spark, leaves.groupBy(*LEAVES).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > F.greatest(F.lit(2 * LEAF), F.floor(F.lit(local) / F.col("dim")))).drop("c"), "crowded")
        if not crowded.take(1):
            break

        def split(batches, level=level):
            for b in batches:
                ids, labels, dims, trees_, codes, counts = (b.column(i).to_numpy() for i in (0, 1, 2, 3, 4, 6))
                keys = np.stack([labels, dims, trees_, codes]).astype(np.int64)
                groups, of = np.unique(keys, axis=1, return_inverse=True)
                for g in range(groups.shape[1]):
                    at = np.flatnonzero(of.ravel() == g)
                    x, centre = _matrix(b.column(5).take(pa.array(at)), np.float16).astype(np.float64), np.frombuffer(b.column(7)[int(at[0])].as_py(), np.float64)
                    side = _sides(x, centre, max(1, int(np.ceil(np.log2(2 * counts[at[0]] / group_size(x.shape[1], local))))), [int(trees_[at[0]]), x.shape[1], level])
                    code = T.mix(codes[at].view(T.U64) * T.U64(0x9E3779B97F4A7C15) ^ T.mix(side.view(T.U64) + T.U64(level))).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(labels[at]), pa.array(dims[at]), pa.array(trees_[at]), pa.array(code)], ["id", *LEAVES])

        inside = leaves.join(crowded, LEAVES).join(coarse.select("id", "half"), "id").select("id", *LEAVES, "half")
        middle = written(spark, centres(inside, LEAVES), "centres")
        anew = inside.join(middle, LEAVES).select("id", *LEAVES, "half", "c", "centre").mapInArrow(split, PLACED)
        leaves = written(spark, leaves.join(crowded, LEAVES, "left_anti").select("id", *LEAVES).unionAll(anew), "leaves")
    return leaves


def forest(spark: SparkSession, coarse: DataFrame, partings: range, trees: int, rounds: int, local: int) -> DataFrame:
    """PAIRS of the lists that groups of nodes grow, each group in a task: what may be links, and each node's WALK best."""

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _matrix(table.column("half"), np.float16).astype(np.float32)
        order = np.argsort(ids, kind="stable")
        ids, x, seed, out = ids[order], x[order], [key[2].as_py(), key[3].as_py() & (1 << 62) - 1], []
        for rows in halved(x, group_size(x.shape[1], local), seed):
            rows = np.sort(rows)
            lists = Lists(x[rows])
            lists.grow(trees, rounds, seed)
            good = (lists.near >= 0) & ((lists.sims >= MAYBE) | (np.arange(lists.near.shape[1]) < WALK))
            i, k = np.nonzero(good)
            a, b = ids[rows[i]], ids[rows[lists.near[i, k]]]
            out.append(pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "sim": lists.sims[i, k].astype(np.float64)}))
        return pa.concat_tables(out)

    dealt = placed(spark, coarse, partings, local).join(coarse.select("id", "half"), "id")
    return dealt.groupBy(*LEAVES).applyInArrow(grow, PAIRS).groupBy("a", "b").agg(F.max("sim").alias("sim"))


def lists(pairs: DataFrame, growth: int) -> DataFrame:
    """(src, dst): each node's best neighbours. A list doubles, up to `growth` times, while all of it may be links."""
    both = pairs.selectExpr("a AS src", "b AS dst", "sim").unionAll(pairs.selectExpr("b AS src", "a AS dst", "sim"))
    w = Window.partitionBy("src")
    full = F.sum((F.col("sim") >= MAYBE).cast("int")).over(w)
    doubled = F.when(full < NEIGHBOURS, 0).otherwise(F.least(F.lit(growth), 1 + F.floor(F.log2(full / NEIGHBOURS))))
    ranked = both.withColumns({"rank": F.row_number().over(w.orderBy(F.col("sim").desc(), "dst")), "room": NEIGHBOURS * F.pow(F.lit(2), doubled)})
    return ranked.filter("rank <= room").select("src", "dst")


def descend(coarse: DataFrame, pairs: DataFrame, growth: int) -> DataFrame:
    """pairs and those of nodes that share a neighbour."""
    near = lists(pairs, growth)
    members = near.selectExpr("src AS centre", "dst AS id").unionAll(near.selectExpr("src AS centre", "src AS id")).distinct()
    most = NEIGHBOURS * 2**growth

    def compare(table: pa.Table) -> pa.Table:
        return _pairs(table.column("id").to_numpy(), _matrix(table.column("half"), np.float16).astype(np.float32), most)

    found = members.join(coarse.select("id", "half"), "id").groupBy("centre").applyInArrow(compare, PAIRS)
    return pairs.unionAll(found).groupBy("a", "b").agg(F.max("sim").alias("sim"))


def links(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): pairs that are links; those that half precision leaves open are compared in double precision."""
    sure = pairs.filter(F.col("sim") >= THRESHOLD + SLACK).select("a", "b")
    # a table of known size: where these are few, they travel to the vectors and not the vectors to them
    near = written(nodes.sparkSession, pairs.filter((F.col("sim") >= MAYBE) & (F.col("sim") < THRESHOLD + SLACK)).select("a", "b"), "near")
    ends = [nodes.select(F.col("id").alias(k), F.col("unit").alias(f"unit_{k}")) for k in "ab"]

    def run(batches):
        for t in batches:
            if t.num_rows:
                hit = [np.frombuffer(x.as_py(), np.float64) @ np.frombuffer(y.as_py(), np.float64) >= THRESHOLD for x, y in zip(t.column(2), t.column(3), strict=True)]
                yield pa.RecordBatch.from_arrays(t.columns[:2], ["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return sure.unionAll(near.join(ends[0], "a").join(ends[1], "b").select("a", "b", "unit_a", "unit_b").mapInArrow(run, "a long, b long"))


def exhaustive(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect all linked nodes, from comparing each label with itself in pairs of blocks."""
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = (
        nodes.select("id", "label", "dim", "unit").join(sizes, ["label", "dim"]).selectExpr("*", "CAST(pmod(xxhash64(id), blocks) AS INT) AS own").selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr("id", "label", "dim", "unit", "least(own, other) AS i", "greatest(own, other) AS j")
    )

    def compare(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _matrix(table.column("unit"))
        left, a, b = np.ones(len(ids), bool), [], []
        for seed in range(len(ids)):
            # all that the seed reaches; each node is compared with the others once
            front = np.array([seed]) if left[seed] else np.zeros(0, np.int64)
            left[seed] = False
            while len(front):
                hit = np.zeros(len(ids), bool)
                for lo in range(0, len(front), 256):
                    hit |= (x[front[lo : lo + 256]] @ x.T >= THRESHOLD).any(0)
                front = np.flatnonzero(hit & left)
                left[front] = False
                a.append(np.full(len(front), ids[seed]))
                b.append(ids[front])
        return pa.table({"a": np.concatenate([np.zeros(0, np.int64), *a]), "b": np.concatenate([np.zeros(0, np.int64), *b])})

    return dealt.groupBy("label", "dim", "i", "j").applyInArrow(compare, "a long, b long")


def counted(nodes: DataFrame, parts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, linked): the weight of all nodes in a node's component that it links with."""
    inside = parts.join(nodes.select("id", "unit", "weight"), "id")
    sizes = parts.groupBy("component_id").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = (
        inside.join(sizes, "component_id").selectExpr("*", "CAST(pmod(xxhash64(id), blocks) AS INT) AS own").selectExpr("*", "explode(sequence(0, blocks - 1)) AS other")
        .selectExpr("component_id", "id", "unit", "weight", "own", "least(own, other) AS i", "greatest(own, other) AS j")
    )

    def count(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        ids, x, weight, own = table.column("id").to_numpy(), _matrix(table.column("unit")), table.column("weight").to_numpy(), table.column("own").to_numpy()
        linked = np.zeros(len(ids), np.int64)
        for lo in range(0, len(ids), 512):
            hit = x[lo : lo + 512] @ x.T >= THRESHOLD
            hit[np.arange(len(hit)), np.arange(lo, lo + len(hit))] = False
            if i != j:
                hit &= own[lo : lo + 512, None] != own[None, :]
            linked[lo : lo + 512] = hit @ weight
        return pa.table({"id": ids, "linked": linked})

    return dealt.groupBy("component_id", "i", "j").applyInArrow(count, "id long, linked long").groupBy("id").agg(F.sum("linked").alias("linked"))


def audit(nodes: DataFrame, parts: DataFrame) -> list[tuple[int, int]]:
    """For nodes of components of up to SMALL nodes (and alone), and of others: how many sampled nodes have links, and of how
    many of these all links lie in their component. Samples grow until ENOUGH nodes with links are seen, AUDIT_MOST at most."""
    every = nodes.join(parts, "id", "left").select("id", "label", "dim", "unit", F.coalesce("component_id", "id").alias("component"))
    large = parts.groupBy("component_id").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > SMALL).select(F.col("component_id").alias("component"))
    out = []
    for pool in (every.join(large, "component", "left_anti"), every.join(large, "component", "left_semi")):
        size = AUDIT
        while True:
            asked = pool.orderBy(F.xxhash64("id"), "id").limit(size).select("id", "label", "dim", "unit", "component").collect()
            found = _audited(every, asked)
            if len(found) >= ENOUGH or len(asked) < size or size >= AUDIT_MOST:
                break
            size *= 4
        out.append((len(found), sum(linked == joined for linked, joined in found)))
    return out


def _reached(pairs: DataFrame) -> int:
    """How many nodes have a partner that may be a link."""
    near = pairs.filter(F.col("sim") >= MAYBE)
    return near.select("a").unionAll(near.select("b")).distinct().count()


def _audited(every: DataFrame, asked: list) -> list[tuple[int, int]]:
    """Links, and links within the component, of each asked node that has links."""
    kinds: dict[tuple, list] = {}
    for k, r in enumerate(asked):
        kinds.setdefault((r.label, r.dim), []).append((k, r.id, r.component, bytes(r.unit)))
    kinds = {kind: (np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), b"".join(r[3] for r in rows)) for kind, rows in kinds.items()}

    def run(batches):
        linked, joined = np.zeros(len(asked_range), np.int64), np.zeros(len(asked_range), np.int64)
        for b in batches:
            ids, labels, dims, component = (b.column(c).to_numpy() for c in (0, 1, 2, 4))
            for (label, dim), (k, own_id, own, units_) in kinds.items():
                rows = np.flatnonzero((labels == label) & (dims == dim))
                y = np.frombuffer(units_, np.float64).reshape(len(k), dim)
                for lo in range(0, len(rows), 1024):
                    at = rows[lo : lo + 1024]
                    hit = (_matrix(b.column(3).take(pa.array(at))) @ y.T >= THRESHOLD) & (ids[at][:, None] != own_id[None, :])
                    linked[k] += hit.sum(0)
                    joined[k] += (hit & (component[at][:, None] == own[None, :])).sum(0)
        k = np.flatnonzero(linked)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(linked[k]), pa.array(joined[k])], ["k", "linked", "joined"])

    asked_range = range(len(asked))
    rows = every.select("id", "label", "dim", "unit", "component").mapInArrow(run, "k long, linked long, joined long").groupBy("k").agg(F.sum("linked").alias("linked"), F.sum("joined").alias("joined")).collect()
    return [(r.linked, r.joined) for r in rows]


class Lists:
    """Neighbour lists of the rows of x: `near` (places, -1 where there is none) and `sims`, best first."""

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        self.near, self.sims = np.full((n, NEIGHBOURS), -1), np.full((n, NEIGHBOURS), -2, np.float32)

    def offer(self, rows: np.ndarray, others: np.ndarray, sims: np.ndarray) -> None:
        """Candidates (a row of places for each row) enter the lists where they are better."""
        others, sims = np.concatenate([self.near[rows], others], 1), np.concatenate([self.sims[rows], sims], 1)
        sims = np.where((others < 0) | (others == rows[:, None]), np.float32(-2), sims)
        by_place = np.argsort(others, axis=1, kind="stable")
        others, sims = np.take_along_axis(others, by_place, 1), np.take_along_axis(sims, by_place, 1)
        sims[:, 1:][others[:, 1:] == others[:, :-1]] = -2
        best = np.argsort(-sims, axis=1, kind="stable")[:, : self.near.shape[1]]
        self.sims[rows] = np.take_along_axis(sims, best, 1)
        self.near[rows] = np.where(self.sims[rows] > -2, np.take_along_axis(others, best, 1), -1)

    def leaf(self, rows: np.ndarray) -> None:
        """All rows of a leaf are compared with one another."""
        sims = self.x[rows] @ self.x[rows].T
        np.fill_diagonal(sims, -2)
        k = min(self.near.shape[1], len(rows) - 1)
        if k > 0:
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            self.offer(rows, rows[best], np.take_along_axis(sims, best, 1))

    def reverse(self) -> np.ndarray:
        """For each row up to NEIGHBOURS of the rows in whose lists it is, the nearest ones."""
        source, target, sims = np.repeat(np.arange(len(self.x)), self.near.shape[1]), self.near.ravel(), self.sims.ravel()
        order = np.lexsort((source, -sims, target))
        order = order[target[order] >= 0]
        target = target[order]
        place = np.arange(len(target)) - np.searchsorted(target, target)
        out = np.full((len(self.x), NEIGHBOURS), -1)
        near = place < NEIGHBOURS
        out[target[near], place[near]] = source[order[near]]
        return out

    def walk(self) -> None:
        """Each row is compared with the nearest neighbours of its nearest neighbours, either way."""
        first = np.concatenate([self.near[:, :NEIGHBOURS], self.reverse()], 1)
        step = max(1, (1 << 22) // (2 * NEIGHBOURS * NEIGHBOURS * self.x.shape[1]))
        for lo in range(0, len(self.x), step):
            rows = np.arange(lo, min(lo + step, len(self.x)))
            over = first[rows]
            others = np.where(over[:, :, None] < 0, -1, first[over][:, :, :NEIGHBOURS]).reshape(len(rows), -1)
            self.offer(rows, others, np.einsum("md,mcd->mc", self.x[rows], self.x[others]))

    def widen(self, growth: int) -> None:
        """Lists double while one that may still grow holds links only."""
        n, k = self.near.shape
        if k < NEIGHBOURS << growth and (self.sims[:, -1] >= MAYBE).any():
            self.near, self.sims = np.concatenate([self.near, np.full((n, k), -1)], 1), np.concatenate([self.sims, np.full((n, k), -2, np.float32)], 1)

    def grow(self, trees: int, rounds: int, seed: list[int]) -> None:
        """A forest, and rounds until no further row gets a link."""
        for t in range(trees):
            for rows in halved(self.x, 2 * LEAF, [*seed, t]):
                self.leaf(np.sort(rows))
        before = -1
        for _ in range(rounds):
            self.widen(2)
            if (now := int((self.sims >= MAYBE).sum())) == before:
                break
            before = now
            self.walk()


def _merged(parts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """parts (each row's smallest place reachable) after rows a and b are linked."""
    while True:
        low = np.minimum(parts[a], parts[b])
        new = parts.copy()
        np.minimum.at(new, parts[a], low)
        np.minimum.at(new, parts[b], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[parts]
        if (new == parts).all():
            return parts
        parts = new


def _at_once(n: int) -> int:
    """Rows that are compared with n others at once."""
    return max(1, min(512, (1 << 21) // max(1, n)))


def solved(ids: np.ndarray, x: np.ndarray, weight: np.ndarray, trees: int, rounds: int, growths: int) -> tuple[np.ndarray, np.ndarray]:
    """component_id and the weight of all links of each node of a label, by steps 2 to 5 on its vectors (float64, ids ascending)."""
    n, lists = len(ids), Lists(x.astype(np.float32))
    parts = np.arange(n)
    for grown in range(growths):
        lists.grow(trees, rounds, [grown, x.shape[1]])
        a, k = np.nonzero(lists.sims >= MAYBE)
        b = lists.near[a, k]
        true = np.concatenate([np.zeros(0, bool), *(np.einsum("md,md->m", x[a[i : i + 65536]], x[b[i : i + 65536]]) >= THRESHOLD for i in range(0, len(a), 65536))])
        parts = _merged(np.arange(n), a[true], b[true])
        if _in_components(x, parts):
            break
    else:
        for lo in range(0, n, step := _at_once(n)):  # exactly
            a, b = np.nonzero(x[lo : lo + step] @ x.T >= THRESHOLD)
            parts = _merged(parts, a + lo, b)
    linked = np.zeros(n, np.int64)
    order = np.argsort(parts, kind="stable")
    ends = np.flatnonzero(np.r_[parts[order][1:] != parts[order][:-1], True]) + 1 if n else []
    for lo, hi in zip(np.r_[0, ends[:-1]].astype(int), ends, strict=True):
        rows = order[lo:hi]
        for at in range(0, len(rows) if len(rows) > 1 else 0, step := _at_once(len(rows))):
            hit = x[rows[at : at + step]] @ x[rows].T >= THRESHOLD
            hit[np.arange(len(hit)), np.arange(at, at + len(hit))] = False
            linked[rows[at : at + step]] = hit @ weight[rows]
    return ids[parts], linked


def _in_components(x: np.ndarray, parts: np.ndarray) -> bool:
    """The audit within a label: of nodes of small and of large components, RECALL have all their links in their component."""
    size, rng = np.bincount(parts, minlength=len(parts))[parts], np.random.default_rng(7)
    for pool in (np.flatnonzero(size <= SMALL), np.flatnonzero(size > SMALL)):
        pool, seen, whole = rng.permutation(pool), 0, 0
        for lo in range(0, min(len(pool), AUDIT_MOST), step := _at_once(len(x))):
            asked = pool[lo : lo + step]
            hit = x[asked] @ x.T >= THRESHOLD
            hit[np.arange(len(asked)), asked] = False
            some = hit.any(1)
            seen += some.sum()
            whole += (some & ~(hit & (parts[asked][:, None] != parts[None, :])).any(1)).sum()
            if seen >= ENOUGH:
                break
        if whole < RECALL * seen:
            return False
    return True


FOUND = "label int, dim int, h1 long, h2 long, weight long, component_id long, linked long"


def within_labels(nodes: DataFrame, trees: int, rounds: int, growths: int) -> DataFrame:
    """FOUND of nodes whose labels are one group each."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        part, linked = solved(ids[order], _matrix(table.column("unit"))[order], table.column("weight").to_numpy()[order], trees, rounds, growths)
        out = table.select(["label", "dim", "h1", "h2", "weight"]).take(pa.array(order))
        return out.append_column("component_id", pa.array(part)).append_column("linked", pa.array(linked))

    return nodes.groupBy("label", "dim").applyInArrow(run, FOUND)


def across_tasks(nodes: DataFrame, trees: int, rounds: int, growths: int, local: int) -> DataFrame:
    """FOUND of nodes of large labels, whose graphs grow by joins."""
    spark = nodes.sparkSession
    # nodes are told apart by numbers of their own: rows without an id, or with equal ones, may be several nodes
    nodes = written(spark, nodes.withColumnRenamed("id", "vec").withColumn("id", F.monotonically_increasing_id()), "numbered")
    coarse = written(spark, coarsened(nodes), "coarse")
    pairs, parts = None, None
    for grown in range(growths):
        old, pairs = pairs, forest(spark, coarse, range(grown * PARTINGS, (grown + 1) * PARTINGS), trees, rounds, local)
        pairs = written(spark, pairs if old is None else pairs.unionAll(old).groupBy("a", "b").agg(F.max("sim").alias("sim")), "pairs")
        reached = _reached(pairs) if grown else 0
        for r in range(1, rounds + 1 if grown else 1):  # across groups
            old, pairs = pairs, written(spark, descend(coarse, pairs, min(r, 2)), "pairs")
            dropped(old)
            before, reached = reached, _reached(pairs)
            if reached == before:
                break
        parts = written(spark, components(spark, links(nodes, pairs)), "parts")
        if all(whole >= RECALL * linked for linked, whole in audit(nodes, parts)):
            break
    else:
        parts = written(spark, components(spark, exhaustive(nodes)), "parts")
    tally = counted(nodes, parts)
    found = nodes.join(parts, "id", "left").join(tally, "id", "left").withColumn("c", F.coalesce("component_id", "id"))
    found = written(spark, found.select("label", "dim", "h1", "h2", "weight", "vec", "c", F.coalesce("linked", F.lit(0)).alias("linked")), "found")
    return found.join(found.groupBy("c").agg(F.min("vec").alias("component_id")), "c").select("label", "dim", "h1", "h2", "weight", "component_id", "linked")


def near_dedup(vectors: DataFrame, trees: int = TREES, rounds: int = ROUNDS, growths: int = GROWTHS, local: int = LOCAL) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    ship(spark)
    node = ["label", "dim", "h1", "h2"]
    every = units(vectors)
    grouped = every.filter("unit IS NOT NULL").groupBy(*node).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.any_value("unit").alias("unit"))
    nodes = written(spark, grouped, "nodes")
    sizes = written(spark, nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("c")).withColumn("large", F.col("c") * F.col("dim") > local), "sizes")
    large = sizes.filter("large").select("label", "dim")
    found = within_labels(nodes.join(sizes.filter("NOT large").select("label", "dim"), ["label", "dim"], "left_semi"), trees, rounds, growths)
    if large.take(1):
        found = found.unionAll(across_tasks(nodes.join(large, ["label", "dim"], "left_semi"), trees, rounds, growths, local))
    own = every.select("id", F.coalesce("label", F.lit(0)).alias("label"), "dim", "h1", "h2")
    component = F.coalesce("component_id", "id")
    return own.join(found, node, "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("vec_id"), F.coalesce(F.col("linked") + F.col("weight") - 1, F.lit(0)).alias("n_links"),
        F.when(component != NO_ID, component).alias("component_id"), ((F.col("id") == component) & (F.col("id") != NO_ID)).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(load(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
