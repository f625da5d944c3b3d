"""An exchange of sorted hash lists between batches of documents and hash buckets.

Documents are packed once into compressed batches of a few MB and dealt out by batch; every round reads
that same exchange. In a round each batch asks, per bucket of the hash space, about its own distinct
hashes (sorted, as byte planes of their differences, compressed); the bucket's task sees all askers of a
hash together and answers each batch with one value per hash, in the order asked. A hash that is common in
the corpus is asked about once per batch, never once per occurrence, so no key grows hot. Nothing
passes through the driver but one number, the bytes of text, from which the number of buckets follows: what a bucket
holds at once stays the same however large the corpus. Before questions leave a task they are put together by bucket, and answers by
batch, COMBINE bytes at a time: a round moves a row for each task and bucket, or bucket's task and batch, not one for each batch and
bucket. Rows shrink by the batches that a task reads, so large input partitions pay; beyond some TB, batches (and with them
executors' memory) should grow too (batch_bytes). Asking, answering and putting together are steps of one function, so that a task of a
round has one Python worker and not a second one that receives all that the first has made.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from llm.common import ship
from llm.textops import U64, release, utf8

#: Bytes of text after which a batch is closed; one longer text is a batch of its own.
BATCH_BYTES = 4 << 20

#: Bytes of text for which there is one hash bucket, at least.
BUCKET_BYTES = 4 << 20

#: Bytes of questions or answers that a task puts together before it sends them on.
COMBINE = 32 << 20

#: A batch's number is never null, and Spark is told so: else a join by it filters its side's rows, which no other round could reuse.
PACKED = "batch long not null, docs long, blob binary"
ASKED = "bucket int, batch long, payload binary"
ANSWERED = "batch long not null, bucket int, payload binary"


def spread(docs: DataFrame, text_col: str = "text") -> int:
    """Number of hash buckets of an exchange: by the bytes of text, and twice the shuffle partitions that the user has sized at least."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def dump(**arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes: the high bytes of small numbers cost next to nothing."""
    head, body, press = [], [], zstandard.ZstdCompressor(level=1)
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), -1).T if a.size and a.dtype.itemsize > 1 else a.view(np.uint8)
        body.append(press.compress(np.ascontiguousarray(planes).tobytes()))
        head.append([name, a.dtype.str, list(a.shape), len(body[-1])])
    text = json.dumps(head).encode()
    return struct.pack("<I", len(text)) + text + b"".join(body)


def restore(data: bytes) -> dict[str, np.ndarray]:
    n = struct.unpack_from("<I", data)[0]
    out, at, press = {}, 4 + n, zstandard.ZstdDecompressor()
    for name, kind, shape, size in json.loads(data[4:at]):
        raw = np.frombuffer(press.decompress(data[at : at + size]), np.uint8)
        at += size
        kind = np.dtype(kind)
        if raw.size and kind.itemsize > 1:
            raw = np.ascontiguousarray(raw.reshape(-1, shape[0]).T)
        out[name] = raw.view(kind).reshape(shape)
    return out


#: What stands in the place of a null id. finish gives it back as null; who compares ids asks for pairs (see unpack).
NO_ID = np.iinfo(np.int64).max


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, carry: Sequence[str] = ()) -> DataFrame:
    """Rows (batch, docs, blob), dealt out by batch. Null texts count as empty. Columns in carry come back from finish as they were."""
    ship(docs.sparkSession)

    def packed(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            ids, lengths, null = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3))
            text, carried = b"".join(h[2] for h in held), b""
            if carry:
                sink, more = pa.BufferOutputStream(), pa.Table.from_batches([h[4] for h in held])
                with pa.ipc.new_stream(sink, more.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(more)
                carried = sink.getvalue().to_pybytes()
            head = dump(ids=ids, lengths=lengths, null=null)
            blob = struct.pack("<II", len(head), len(carried)) + head + carried + zstandard.ZstdCompressor(level=3).compress(text)
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) | no]), pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())], ["batch", "docs", "blob"])

        for table in tables:
            column = table.column(0).cast(pa.int64())  # nulls are filled first: through floats, ids above 2**53 would change
            ids, null = column.fill_null(NO_ID).to_numpy(zero_copy_only=False), bits(column.is_null().to_numpy(zero_copy_only=False))
            more = pa.RecordBatch.from_arrays(table.columns[2:], list(carry))
            buf, offsets = utf8(table.column(1))
            at = 0
            while at < len(ids):
                to = int(np.searchsorted(offsets, offsets[at] + batch_bytes - size, side="right")) - 1
                to = min(max(to, at + (not held)), len(ids))
                if to > at:
                    held.append((ids[at:to], np.diff(offsets[at : to + 1]), buf[offsets[at] : offsets[to]].tobytes(), null[at:to], more.slice(at, to - at)))
                    size += int(offsets[to] - offsets[at])
                    at = to
                if at < len(ids) or size >= batch_bytes:
                    yield close()
                    held, size, no = [], 0, no + 1
        if held:
            yield close()

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *(F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry))).mapInArrow(packed, PACKED).repartition("batch")


def _head(blob: bytes) -> tuple[dict[str, np.ndarray], bytes, int]:
    """Numbers of a batch's documents, their carried columns, and where the text begins."""
    n, m = struct.unpack_from("<II", blob)
    return restore(blob[8 : 8 + n]), blob[8 + n : 8 + n + m], 8 + n + m


def unpack(blob: bytes, pairs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bytes and offsets of a batch's documents. With pairs, an id is a row (1 where it is null else 0, id): no id is reserved."""
    head, _, at = _head(blob)
    text = zstandard.ZstdDecompressor().decompress(blob[at:]) if head["lengths"].sum() else b""
    ids = np.stack([head["null"].astype(np.int64), head["ids"]], axis=1) if pairs else head["ids"]
    return ids, np.frombuffer(text, np.uint8), np.concatenate([[0], np.cumsum(head["lengths"])]).astype(np.int64)


def bounds(sorted_hashes: np.ndarray, n: int) -> np.ndarray:
    """Where the buckets of a sorted hash list begin and end (n + 1 values)."""
    edges = np.array([-(-(b << 64) // n) for b in range(1, n)], U64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


def deltas(sorted_hashes: np.ndarray) -> np.ndarray:
    out = sorted_hashes.copy()
    out[1:] -= sorted_hashes[:-1]
    return out


def ask_rows(batch: int, hashes: np.ndarray, n: int, **more: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Requests of one batch about sorted hashes; more: arrays with a row for each hash."""
    at = bounds(hashes, n)
    for b in np.flatnonzero(np.diff(at)):
        lo, hi = at[b], at[b + 1]
        yield int(b), batch, dump(hash=deltas(hashes[lo:hi]), **{k: v[lo:hi] for k, v in more.items()})


def _table(rows, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split()[:2] for f in schema.split(", ")]
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [f for f, _ in fields])


def ranks(pairs: np.ndarray) -> np.ndarray:
    """Numbers in the order of ids given as pairs, null ones last; equal ids have equal numbers."""
    if not len(pairs):
        return np.zeros(0, np.int64)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    new = np.zeros(len(order), np.int64)
    new[1:] = (pairs[order][1:] != pairs[order][:-1]).any(1)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def combined(rows: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, made: str | None = None) -> DataFrame:
    """Rows (key, other, payload) of a task with equal keys as rows (key, payload), where `apart` finds them again.

    step: makes those rows, with the columns `made`, from what is in rows, in the same worker.
    """
    first = (StructType.fromDDL(made) if made else rows.schema)[0]
    key = first.name

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def sent() -> pa.RecordBatch:
            blobs = []
            for some in held.values():
                head = np.array([(o, len(x)) for o, x in some], np.int64)
                blobs.append(struct.pack("<I", len(some)) + head.tobytes() + b"".join(x for _, x in some))
            return pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(blobs, pa.binary())], [key, "payload"])

        for t in step(tables) if step else tables:
            kind = t.schema.field(0).type
            for k, other, x in zip(*(c.to_pylist() for c in t.columns), strict=True):
                held.setdefault(k, []).append((other, x))
                size += len(x)
                if size >= COMBINE:
                    yield sent()
                    held, size = {}, 0
        if held:
            yield sent()
        release()

    return rows.mapInArrow(run, StructType([first, StructField("payload", BinaryType())]))


def apart(payloads) -> list[tuple[int, bytes]]:
    """The (other, payload) of combined rows."""
    out = []
    for blob in payloads:
        blob = blob.as_py()
        n = struct.unpack_from("<I", blob)[0]
        head = np.frombuffer(blob, np.int64, 2 * n, 4).reshape(n, 2)
        ends = 4 + 16 * n + np.cumsum(head[:, 1])
        out += [(int(o), blob[e - size : e]) for (o, size), e in zip(head.tolist(), ends.tolist(), strict=True)]
    return out


def ask(packed: DataFrame, request: Callable[[int, np.ndarray, np.ndarray, np.ndarray], Iterator], pairs: bool = False) -> DataFrame:
    """First round: request(batch, ids, buf, offsets) yields rows of ASKED, which leave combined."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for batch, blob in zip(table.column(0).to_pylist(), table.column(2), strict=True):
                release()
                yield _table(request(batch, *unpack(blob.as_py(), pairs)), ASKED)

    return combined(packed, run, ASKED)


def gathered(tables: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Of combined rows in the order of their keys, each key and all its (other, payload), which the receiver may empty."""
    key, held = None, []
    for t in tables:
        for k, blob in zip(t.column(0).to_pylist(), t.column(1), strict=True):
            if held and k != key:
                yield key, held
                held = []
            key = k
            held += apart([blob])
    if held:
        yield key, held


def answer(asked: DataFrame, reply: Callable[[list[dict[str, np.ndarray]]], list[dict[str, np.ndarray]]]) -> DataFrame:
    """reply(requests of one bucket, each with its hashes, if sent, restored) returns the arrays for each asker."""

    def own(bucket: int, asked_by: list[tuple[int, bytes]]) -> pa.RecordBatch:
        batches, requests = [b for b, _ in asked_by], [restore(x) for _, x in asked_by]
        asked_by.clear()
        for r in requests:
            if "hash" in r:
                r["hash"] = np.cumsum(r["hash"], dtype=U64)
        return _table([(b, bucket, dump(**a)) for b, a in zip(batches, reply(requests), strict=True)], ANSWERED)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, asked_by in gathered(tables):
            release()
            yield own(bucket, asked_by)

    return combined(asked.repartition("bucket").sortWithinPartitions("bucket"), run, ANSWERED).repartition("batch")


def answered(payloads) -> dict[str, np.ndarray]:
    """Answers to one batch, in the order in which it asked."""
    parts = [restore(x) for _, x in sorted(apart(payloads), key=lambda p: p[0])]
    return {k: np.concatenate([p[k] for p in parts if k in p]) for k in dict.fromkeys(k for p in parts for k in p)}


def ask_again(packed: DataFrame, answers: DataFrame, request: Callable[..., Iterator], pairs: bool = False) -> DataFrame:
    """A later round: request(batch, ids, buf, offsets, answers so far) yields rows of ASKED."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables:
            for batch, blob, given in zip(t.column("batch").to_pylist(), t.column("blob"), t.column("given"), strict=True):
                release()
                yield _table(request(batch, *unpack(blob.as_py(), pairs), answered(given.values if given.is_valid else [])), ASKED)

    given = answers.groupBy("batch").agg(F.collect_list("payload").alias("given"))
    return combined(packed.join(given, "batch", "left"), run, ASKED)


def finish(packed: DataFrame, rounds: list[DataFrame], result: Callable[..., pa.Table], schema: str, carried: Sequence[StructField] = (), pairs: bool = False) -> DataFrame:
    """result(ids, buf, offsets, answers of each round) makes a row for each document of a batch, with the columns of schema.

    The first column is the id, null where it was; the carried columns follow those of schema.
    """
    tagged, count = None, len(rounds)
    for i, r in enumerate(rounds):
        r = r.selectExpr("batch", "payload", f"{i} AS round")
        tagged = r if tagged is None else tagged.unionAll(r)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        rounds_no = right.column("round").to_numpy()
        given = [answered(right.filter(pa.array(rounds_no == i)).column("payload")) for i in range(count)]
        return pa.concat_tables([own(b.as_py(), given) for b in left.column("blob")])

    def own(blob: bytes, given: list) -> pa.Table:
        head, more, _ = _head(blob)
        out = result(*unpack(blob, pairs), *given)
        if head["null"].any():
            out = out.set_column(0, out.column_names[0], pa.array(head["ids"], mask=head["null"] > 0))
        if more:
            for name, column in zip(names, pa.ipc.open_stream(more).read_all().columns, strict=True):
                out = out.append_column(name, column)
        return out

    names = [f.name for f in carried]
    return packed.groupBy("batch").cogroup(tagged.groupBy("batch")).applyInArrow(run, StructType([*StructType.fromDDL(schema).fields, *carried]))


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, for each given hash its place among them, and how often each was given."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(ordered), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ordered[first], place, np.diff(np.append(first, len(ordered)))


def merged(requests: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all requests end to end, and for each its place among the distinct ones."""
    all_hashes = np.concatenate([r["hash"] for r in requests])
    return all_hashes, distinct(all_hashes)[1]


def parted(values: np.ndarray, requests: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
    return np.split(values, np.cumsum([len(r["hash"]) for r in requests])[:-1])


def bits(flags: np.ndarray) -> np.ndarray:
    return flags.astype(np.uint8)
