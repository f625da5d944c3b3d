"""Token-ID output as directly addressable codes.

Method: ids are split into chunks of `bits` bits. Level 0 holds the lowest chunk of every id; a bit per entry says whether the
id goes on in the next level, which holds entries only for those. A rank directory over each bitmap (one count
per 512 bits) gives an entry's place in the next level, so any token is read in a few steps without decoding others.

Documents are dealt out in ranges of doc_id, sorted, encoded and written in files of at most FILE_BYTES of text each
(one longer text is a file of its own); a manifest lists the files whose tasks succeeded. The reader takes files through Spark's binaryFile source and keeps what
the manifest lists; first positions are running sums over the manifest.

Ids are those of the tokenizers library. Byte-level BPE always cuts before a space or line break that a visible sign follows, and
between that line break and the sign, unless the sign begins a special token. So texts are cut there and each distinct piece of
some MB of text is encoded once, and not again while a worker remembers it. A text, or a part of one, without such a place goes whole.
Texts of ASCII and Latin letters only, on whose character classes no library differs, and without a piece of over LONGEST
bytes (long runs of one sign or of white space, on which the other library fails or slows down), are merged by tiktoken with the
ranks of the same file, several times faster. Tests hold one against the other.

Null and empty texts consist of the end id alone. Rows with equal ids are all written, in an order given by their text. Null ids sort
first and come back null. Extra columns are ignored. An empty table gives no files and no rows.
"""

from __future__ import annotations

import functools
import itertools
import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from llm import textops as T
from llm.common import load, scratch, ship, written
from llm.op3_bpe import _tokenizer
from llm.shards import put, runs, sharded

END_ID, BITS, DOCS_PER_SHARD, FILE_BYTES = 2, 8, 2048, 16 << 20
MAGIC = b"DACTOKEN"
RANK = 512
MANIFEST = "shard int, part int, file string, docs long, tokens long"
#: Bytes of text whose pieces are encoded together; pieces of up to SHORT characters that a worker remembers between tasks, at most.
SLICE, SHORT, KNOWN = 8 << 20, 64, 1 << 19
_known: dict[str, dict[str, list[int]]] = {}
#: Bytes of the longest piece of a text that tiktoken gets.
LONGEST = 1000
#: Fixed value: the pattern by which byte-level BPE cuts texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII_PLAIN = np.zeros(256, bool)
ASCII_PLAIN[0x20:0x7F] = True
ASCII_PLAIN[[9, 10, 13]] = True

def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(2)
def _ranked(path: str):
    """The file's merges as byte ranks, and its special tokens; None if the file isn't byte-level BPE with the usual pattern."""
    import tiktoken

    with open(path) as f:
        spec = json.load(f)
    cut = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from U+0100
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), set(special)


def plain_rows(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts of printable ASCII, tab, line breaks and U+00C0 to U+00FF only."""
    plain = ASCII_PLAIN[buf]
    if len(buf) > 1:
        latin = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] < 0xC0)
        plain[:-1] |= latin
        plain[1:] |= latin
    return T.per_row(~plain, offsets) == 0


def pieces(buf: np.ndarray, offsets: np.ndarray, path: str) -> np.ndarray:
    """Where the pieces of texts begin, and the end of the last one."""
    on, visible = np.zeros(len(buf) + 1, bool), _visible(path)
    if visible is not None and len(buf) > 1:
        follows, ends = visible[buf[1:]], offsets[(offsets > 0) & (offsets < len(buf))]
        follows[ends - 1] = False  # nothing follows a text's last byte
        on[:-2] = ((buf[:-1] == 32) | (buf[:-1] == 10)) & follows
        on[1:-1] |= (buf[:-1] == 10) & follows
    on[offsets] = True
    return np.flatnonzero(on)


@functools.lru_cache(2)
def _visible(path: str) -> np.ndarray | None:
    """Bytes with which neither white space nor a special token begins: printable ASCII, and the lead bytes of U+00C0 to U+07FF.

    None if the file isn't byte-level BPE by the usual pattern, or changes texts first.
    """
    with open(path) as f:
        spec = json.load(f)
    cut = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space"):
        return None
    if any(" " in t["content"] or "\n" in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return None
    out = np.zeros(256, bool)
    out[0x21:0x7F] = out[0xC3:0xE0] = True
    out[[t["content"].encode()[0] for t in spec["added_tokens"]]] = False
    return out


def _ids(distinct: list[str], path: str) -> list[list[int]]:
    """The library's ids of each piece; a piece that a worker has met of late is not encoded again."""
    known = _known.setdefault(path, {})
    new, long = [p for p in distinct if p not in known], {}
    for i in range(0, len(new), 4096):
        some = new[i : i + 4096]
        for p, e in zip(some, _tokenizer(path).encode_batch_fast(some, add_special_tokens=False), strict=True):
            (known if len(p) <= SHORT else long)[p] = e.ids
    out = [known[p] if p in known else long[p] for p in distinct]
    if len(known) > KNOWN:
        _known[path] = {p: known[p] for p in distinct[:KNOWN] if p in known}
    return out


def encode(buf: np.ndarray, offsets: np.ndarray, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, each with end_id after it, and the end of each text."""
    n, cut, ranked = len(offsets) - 1, pieces(buf, offsets, path), _ranked(path)
    coded = [np.zeros(0, np.int32)] * n
    plain = plain_rows(buf, offsets) if ranked else np.zeros(n, bool)
    plain[np.searchsorted(offsets, cut[:-1][np.diff(cut) > LONGEST], side="right") - 1] = False
    for i in np.flatnonzero(plain):
        coded[i] = ranked[0].encode_to_numpy(buf[offsets[i] : offsets[i + 1]].tobytes().decode(), allowed_special=ranked[1])
    rest = np.flatnonzero(~plain)
    if len(rest):
        size = np.diff(offsets)[rest]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids, before = _by_pieces(np.concatenate([buf[offsets[i] : offsets[i + 1]] for i in rest]), ends, path)
        for i, a, b in zip(rest, before[:-1], before[1:], strict=True):
            coded[i] = ids[a:b]
    out_ends = np.cumsum([len(c) + 1 for c in coded]).astype(np.int64)
    out = np.full(int(out_ends[-1]) if n else 0, end_id, np.int32)
    for c, end in zip(coded, out_ends, strict=True):
        out[end - 1 - len(c) : end - 1] = c
    return out, out_ends


def _by_pieces(buf: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end by the tokenizers library, and how many there are before each text."""
    cut, coded, counts = pieces(buf, offsets, path), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for lo, hi in T.slices(cut, SLICE):
        part = pa.Array.from_buffers(pa.large_string(), hi - lo, [None, pa.py_buffer(np.ascontiguousarray(cut[lo : hi + 1] - cut[lo])), pa.py_buffer(np.ascontiguousarray(buf[cut[lo] : cut[hi]]))])
        table = part.dictionary_encode()
        place, distinct = table.indices.to_numpy(), table.dictionary.to_pylist()
        ids = _ids(distinct, path)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(count.sum()))
        coded.append(flat[T.gather((np.cumsum(count) - count)[place], count[place])])
        counts.append(count[place])
    before = np.concatenate([[0], np.cumsum(np.concatenate(counts))])[np.searchsorted(cut, offsets)]
    return np.concatenate(coded), before


def write_codes(doc_ids: np.ndarray, ids: np.ndarray, ends: np.ndarray, bits: int = BITS) -> bytes:
    """A file: MAGIC, length of a JSON header, the header, and the sections that it places."""
    sections, rest, level = {"doc_ids": doc_ids.astype("<i8"), "ends": ends.astype("<i8")}, ids.astype(np.uint32), 0
    kind = "<u1" if bits <= 8 else "<u2"
    while level == 0 or len(rest):
        more = rest >> bits
        on = more > 0
        packed = np.packbits(on, bitorder="little")
        packed = np.pad(packed, (0, -len(packed) % (RANK // 8)))
        counts = np.bitwise_count(packed).reshape(-1, RANK // 8).sum(1) if len(packed) else np.zeros(0, np.int64)
        sections |= {f"chunks{level}": (rest & ((1 << bits) - 1)).astype(kind), f"more{level}": packed, f"rank{level}": np.concatenate([[0], np.cumsum(counts)]).astype("<u4")}
        rest, level = more[on], level + 1
    at, head = 0, {"bits": bits, "levels": level, "tokens": len(ids), "docs": len(doc_ids), "sections": {}}
    for name, a in sections.items():
        head["sections"][name] = [at, a.dtype.str, len(a)]
        at += a.nbytes
    body = b"".join(a.tobytes() for a in sections.values())
    head["crc32"] = zlib.crc32(body)
    text = json.dumps(head).encode()
    return MAGIC + struct.pack("<Q", len(text)) + text + body


class TokenFile:
    """Random access to a file's tokens."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack_from("<Q", data, 8)[0]
        self.head = json.loads(data[16 : 16 + size])
        self._at, self._data = 16 + size, data

    def __len__(self) -> int:
        return self.head["tokens"]

    def section(self, name: str) -> np.ndarray:
        at, kind, n = self.head["sections"][name]
        return np.frombuffer(self._data, kind, n, self._at + at)

    def verify(self) -> None:
        if zlib.crc32(memoryview(self._data)[self._at :]) != self.head["crc32"]:
            raise ValueError("token file is damaged")

    def take(self, i) -> np.ndarray:
        """Tokens at positions i, each read through its own chunks only."""
        i = np.asarray(i, np.int64)
        out, live = np.zeros(len(i), np.uint32), np.arange(len(i))
        for level in range(self.head["levels"]):
            out[live] |= self.section(f"chunks{level}")[i].astype(np.uint32) << np.uint32(level * self.head["bits"])
            bitmap, rank = self.section(f"more{level}"), self.section(f"rank{level}")
            on = (bitmap[i >> 3] >> (i & 7).astype(np.uint8)) & 1 > 0
            i, live = i[on], live[on]
            if not len(i):
                break
            block = i // RANK
            within = i % RANK
            words = bitmap.reshape(-1, RANK // 8)[block]
            whole = np.arange(RANK // 8)[None, :]
            count = np.bitwise_count(np.where(whole < (within >> 3)[:, None], words, 0)).sum(1)
            tail = words[np.arange(len(i)), within >> 3] & ((1 << (within & 7)) - 1).astype(np.uint8)
            i = rank[block].astype(np.int64) + count.astype(np.int64) + np.bitwise_count(tail).astype(np.int64)
        return out

    def all(self) -> np.ndarray:
        """All tokens, by levels from the highest down."""
        out = None
        for level in reversed(range(self.head["levels"])):
            chunks = self.section(f"chunks{level}").astype(np.uint32)
            if out is not None:
                on = np.unpackbits(self.section(f"more{level}"), count=len(chunks), bitorder="little").view(bool)
                chunks[on] |= out << np.uint32(self.head["bits"])
            out = chunks
        return out


def write_tokens(docs: DataFrame, path: str | None = None, end_id: int = END_ID, bits: int = BITS, docs_per_shard: int = DOCS_PER_SHARD, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Writes all documents; returns the folder and the manifest (MANIFEST)."""
    path = path or default_path()
    ship(docs.sparkSession)
    folder = scratch(docs.sparkSession, "tokens")

    def run(batches):
        attempt, held, size, shard, part = TaskContext.get().taskAttemptId(), [], 0, None, 0

        def close():
            doc_ids, text = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            offsets = np.concatenate([[0], np.cumsum(np.concatenate([h[2] for h in held]))])
            ids, ends = encode(text, offsets, path, end_id)
            name = f"{shard:08d}-{part:05d}-{attempt}.dac"
            put(folder, name, write_codes(doc_ids, ids, ends, bits))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([name]), pa.array([len(doc_ids)]), pa.array([len(ids)])], ["shard", "part", "file", "docs", "tokens"])

        for b in batches:
            doc_ids = b.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            buf, offsets = T.utf8(b.column(1))
            for lo, hi in runs(b.column(2).to_numpy()):
                if shard is not None and b.column(2)[int(lo)].as_py() != shard:
                    if held:
                        yield close()
                    held, size, part = [], 0, 0
                shard = b.column(2)[int(lo)].as_py()
                for x, y in T.slices(offsets[lo : hi + 1], file_bytes):
                    x, y = x + lo, y + lo
                    grown = int(offsets[y] - offsets[x])
                    if held and size + grown > file_bytes:
                        yield close()
                        held, size, part = [], 0, part + 1
                    held.append((doc_ids[x:y], buf[offsets[x] : offsets[y]].copy(), np.diff(offsets[x : y + 1])))
                    size += grown
        if held:
            yield close()

    rows = sharded(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id", docs_per_shard, ["text"])
    return folder, written(docs.sparkSession, rows.mapInArrow(run, MANIFEST), "manifest")



def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, from the files that the manifest lists."""
    ship(spark)
    schema = "file string, doc_id long, inside long, n_tokens long, ids_crc32 long"

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                f = TokenFile(content.as_py())
                f.verify()
                raw, ends = f.all().astype("<u4"), f.section("ends")
                start = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                crc = [zlib.crc32(raw[a:z]) for a, z in zip(start, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([name.rsplit("/", 1)[-1]] * len(ends)), pa.array(f.section("doc_ids")), pa.array(start), pa.array(ends - start), pa.array(crc, pa.int64())], ["file", "doc_id", "inside", "n_tokens", "ids_crc32"])

    if not manifest.take(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder).select("path", "content")
    # one row for each file: a running sum over the manifest
    before = manifest.select("file", (F.sum("tokens").over(Window.orderBy("shard", "part")) - F.col("tokens")).alias("before"))
    null_id = F.lit(int(np.iinfo(np.int64).min))
    return (
        files.mapInArrow(run, schema).join(before, "file")
        .select(F.when(F.col("doc_id") != null_id, F.col("doc_id")).alias("doc_id"), (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(spark, *write_tokens(load(spark, sf_dir, "documents")))
