"""Exact dedup as a stateful stream: a keyed state on disk knows every text seen so far, and bytes decide.

Texts are equal when they are identical after all characters of [\\x20\\x09-\\x0D] are deleted. Of equal texts the row with the most code
points in its original text stays, then the one with the smallest doc_id.

Method, in micro-batches over a growing folder of Parquet:
 1. Landing, a stateless stream: tasks normalise their texts, append each text that is new to a slice of some megabytes to a content file of
    their own, and give a row (a slot) for it: digest (SHA-256), locator (file, place, size) and the slice's documents of that text.
 2. State, a streaming aggregation keyed by digest in RocksDB, without watermark or expiry: it retains a digest's stable identifier (the
    number of its first slot, which no later batch can change) and that slot's locator. Copies are combined before they are dealt out.
 3. Bytes: each slot that hit an earlier one is compared with the content that the state's locator names, byte by byte. Where texts differ
    under one digest, the slot is landed again under (digest, 1), (digest, 2), ..: open addressing, so the state comes to hold every text.
 4. Slots know their text's key now; counts and the row that stays are aggregated by key and joined back to the slots.

A folder that is given again goes on where it stopped: only new files are landed and compared, against the same state.

Scale: texts are never shuffled; they are written once, compressed, and read again only where a digest comes again. Slots are what is dealt
out: a text of which a third of all rows are copies is one slot a slice, combined again in the state's map side. State is one short row a
distinct text, on the executors' disks and in the checkpoint folder. Every step is a table or a checkpointed stream: a lost executor's
tasks run again under new content files, and unreferenced ones are never read. The driver holds nothing.

Null texts count as empty; all empty and blank texts are one group. Repeated rows, and rows with an equal doc_id, are documents of their own;
exactly one row of a group stays (the first landed among rows alike in length and doc_id). Null ids stand last and come back null.
Extra columns are ignored.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import textops as T
from llm.common import scratch, ship, written

#: Bytes of text within which equal texts are one slot; one longer text is a slice by itself.
SLICE = 4 << 20
MEMBER = "struct<id: bigint, chars: bigint, row: int>"
LANDED = f"digest binary, file string, place long, size long, n long, best {MEMBER}, members array<{MEMBER}>"
SLOT = f"{LANDED}, batch long, seq long, alt int"
CLASS = "digest binary, alt int, first struct<batch: bigint, seq: bigint, file: string, place: bigint, size: bigint>"
#: Session settings of the stateful stream: state on disk, with its memory bounded for all of an executor's stores together. A store, one a
#: shuffle partition, takes 4 MB for its manifest ahead of need unless told not to, whatever it holds.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def digest_of(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def normalised(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts without white space, and their offsets."""
    inside = ~T.SPACE[buf]
    return buf[inside], T.counts(inside, offsets)


def landing(folder: str, digest=digest_of):
    """Slots of a task's texts, whose contents go to a file of the task's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pyarrow.fs.FileSystem.from_uri(f"{folder}/content")
        name, out, place, press = uuid.uuid4().hex, None, 0, zstandard.ZstdCompressor(level=1)
        member = pa.struct([("id", pa.int64()), ("chars", pa.int64()), ("row", pa.int32())])
        try:
            for b in batches:
                ids = b.column(0).to_pylist()
                buf, offsets = T.utf8(b.column(1))
                for lo, hi in T.slices(offsets, SLICE):
                    part, own = buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                    chars = T.per_row((part & 0xC0) != 0x80, own).tolist()
                    text, ends = normalised(part, own)
                    slots: dict[bytes, list[dict]] = {}
                    for i in range(hi - lo):
                        slots.setdefault(text[ends[i] : ends[i + 1]].tobytes(), []).append({"id": ids[lo + i], "chars": chars[i], "row": i})
                    rows = []
                    for content, members in slots.items():
                        if out is None:
                            out = fs.open_output_stream(f"{at}/{name}")
                        frame = press.compress(content)
                        out.write(frame)
                        best = min(members, key=lambda m: (-m["chars"], m["id"] is None, m["id"], m["row"]))
                        rows.append((digest(content), name, place, len(frame), len(members), best, members))
                        place += len(frame)
                    kinds = [pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64(), member, pa.list_(member)]
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], ["digest", "file", "place", "size", "n", "best", "members"])
                T.release()
        finally:
            if out is not None:
                out.close()

    return run


def differing(folder: str):
    """Of rows (batch, seq, locator, the state's locator) those whose contents are not the same bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pyarrow.fs.FileSystem.from_uri(f"{folder}/content")
        opened = functools.lru_cache(32)(lambda name: fs.open_input_file(f"{at}/{name}"))
        frame = lambda name, place, size: opened(name).read_at(size, place)
        kept = functools.lru_cache(4)(frame)  # rows of one text follow one another
        press = zstandard.ZstdDecompressor()
        for b in batches:
            bad = []
            for i, (*mine, name, place, size) in enumerate(zip(*(c.to_pylist() for c in b.columns[2:]), strict=True)):
                x, y = frame(*mine), kept(name, place, size)
                if x != y and press.decompress(x) != press.decompress(y):
                    bad.append(i)
            yield b.select(["batch", "seq"]).take(pa.array(bad, pa.int64()))

    return run


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _drained(stream, folder: str, name: str, sink) -> None:
    """Runs a stream over all that is there, from its checkpoint on."""
    stream.foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint-{name}").trigger(availableNow=True).start().awaitTermination()


def land(spark: SparkSession, source: str, folder: str, max_files: int | None = None, digest=digest_of) -> None:
    """New files of source, as slots."""
    source = source.rstrip("/")
    stream = spark.readStream.schema(spark.read.parquet(source).schema)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    matched = f"{source[:-1]}[{source[-1]}]"  # a pattern, since a stream takes a path without one for a folder
    rows = stream.parquet(matched).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(landing(folder, digest), LANDED)

    def sink(df: DataFrame, batch: int) -> None:
        numbered = df.withColumns({"batch": F.lit(batch).cast("long"), "seq": F.monotonically_increasing_id(), "alt": F.lit(0)})
        numbered.write.mode("overwrite").parquet(f"{folder}/slots/b{batch}")

    _drained(rows.writeStream, folder, "land", sink)


def _slots(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SLOT).option("recursiveFileLookup", True).parquet(f"{folder}/slots")


def classify(spark: SparkSession, folder: str) -> None:
    """Brings the state up to date with all slots; what it holds of their keys is added to the table of classes."""
    slots = spark.readStream.schema(SLOT).option("recursiveFileLookup", True).parquet(f"{folder}/slots")
    state = slots.groupBy("digest", "alt").agg(F.min(F.struct("batch", "seq", "file", "place", "size")).alias("first"))
    with settings(spark, STATE):
        _drained(state.writeStream.outputMode("update"), folder, "state", lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/classes/b{n}"))


def settle(spark: SparkSession, folder: str) -> None:
    """Classifies, compares the bytes of hits that no earlier call compared, and lands those that differ again, until none does."""
    while True:
        classify(spark, folder)
        classes = spark.read.schema(CLASS).option("recursiveFileLookup", True).parquet(f"{folder}/classes")
        firsts = written(spark, classes.groupBy("digest", "alt").agg(F.min("first").alias("first")), "firsts")
        seen = spark.read.schema("batch long, seq long, alt int").option("recursiveFileLookup", True).parquet(f"{folder}/compared")
        new = written(spark, _slots(spark, folder).select("digest", "alt", "batch", "seq", "file", "place", "size").join(seen, ["batch", "seq", "alt"], "left_anti"), "new")
        hits = new.join(firsts, ["digest", "alt"]).filter("batch <> first.batch OR seq <> first.seq")
        pairs = hits.select("batch", "seq", "file", "place", "size", F.col("first.file").alias("of"), F.col("first.place").alias("of_place"), F.col("first.size").alias("of_size"))
        bad = written(spark, pairs.mapInArrow(differing(folder), "batch long, seq long"), "differing")
        again = bad.take(1)
        run = uuid.uuid4().hex
        if again:
            last = _slots(spark, folder).join(bad, ["batch", "seq"]).groupBy("batch", "seq").agg(F.max("alt").alias("alt"))
            _slots(spark, folder).join(last, ["batch", "seq", "alt"]).withColumn("alt", (F.col("alt") + 1).cast("int")).select(*_slots(spark, folder).columns).write.parquet(f"{folder}/slots/again-{run}")
        new.select("batch", "seq", "alt").write.parquet(f"{folder}/compared/{run}")
        if not again:
            return


def exact_dedup(spark: SparkSession, source: str, folder: str | None = None, max_files: int | None = None, digest=digest_of) -> DataFrame:
    """Per row of the Parquet folder or file `source` (columns doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    folder: where state and contents stay for later calls; without it they are deleted. max_files: files of a micro-batch.
    """
    ship(spark)
    lasting, folder = folder is not None, (folder or scratch(spark, "copies")).rstrip("/")
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    for name in ("content", "slots", "classes", "compared"):
        fs.create_dir(f"{at}/{name}", recursive=True)
    land(spark, source, folder, max_files, digest)
    settle(spark, folder)
    slots = _slots(spark, folder)
    if any(f.base_name.startswith("again-") for f in fs.get_file_info(pyarrow.fs.FileSelector(f"{at}/slots"))):
        last = slots.groupBy("batch", "seq").agg(F.max("alt").alias("alt"))
        slots = slots.join(last, ["batch", "seq", "alt"])
    order = F.struct((-F.col("best.chars")).alias("less"), F.col("best.id").isNull().alias("none"), "best.id", "batch", "seq", "best.row")
    groups = written(spark, slots.groupBy("digest", "alt").agg(F.min(order).alias("keep"), F.sum("n").alias("group_size")), "groups")
    told = slots.join(groups, ["digest", "alt"]).select("digest", "keep", "group_size", "batch", "seq", F.explode("members").alias("m"))
    stays = (F.col("batch") == F.col("keep.batch")) & (F.col("seq") == F.col("keep.seq")) & (F.col("m.row") == F.col("keep.row"))
    if not lasting:
        for name in ("content", "classes", "compared", "checkpoint-land", "checkpoint-state"):
            fs.delete_dir(f"{at}/{name}")
    return told.select(F.col("m.id").alias("doc_id"), F.col("keep.id").alias("keep_id"), "group_size", stays.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""
