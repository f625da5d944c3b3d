"""BPE encoding and decoding through a table of distinct words.

Method: batches split their texts at ASCII white space (which this kind of tokenizer drops, so a text's encoding is
that of its words end to end) and send their distinct words, with the positions these take in the batch's own list,
to word buckets. A bucket encodes each distinct word of the corpus once and sends the ids back; the batch joins
them to its words by position. Decoding joins ids to the vocabulary's pieces, a table of fixed size (one row per
vocabulary entry, held as an array indexed by id), once per distinct word; a text's pieces are those of its words.

Valid for tokenizers without a decoder whose pieces never span white space: the decoded text is then
the pieces joined by a space. Scale: text moves once, compressed; words move once per batch that has them, so no
word is hot; buckets hold distinct words only.

Null and empty texts have no tokens and decode to "". Special-token strings in a text become their ids, as in the
library. Repeated rows, and rows with an equal doc_id, are encoded each by itself; ids, null ones too, come back as they are. Hashes
only deal words out: batches and buckets tell them apart by spelling. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm import hashx, textops as T
from llm.common import load

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string"
#: Larger batches than usual: the more text in one, the fewer of its words are new.
BATCH_BYTES = 8 << 20
#: Bytes of text whose ids and pieces are put together at once.
SLICE = 1 << 20
DIGEST = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core

    return Tokenizer.from_file(path)


@functools.lru_cache(2)
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces, each with a space after it, in order of id, and n + 1 offsets."""
    t = _tokenizer(path)
    pieces = [(t.id_to_token(i) or "").encode() + b" " for i in range(max(t.get_vocab(True).values()) + 1)]
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([0, *map(len, pieces)])


def _words(buf: np.ndarray, offsets: np.ndarray):
    """Distinct words, told apart by their spelling, in order of hash; for each word of the texts its place among them."""
    s, e, off = T.words(buf, offsets)
    table = T.spelled(buf, s, e).dictionary_encode()
    text, ends = T.utf8(table.dictionary)
    hashes = T.word_hashes(text, ends[:-1], ends[1:])
    order = np.argsort(hashes, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    size = np.diff(ends)[order]
    return off, hashes[order], place[table.indices.to_numpy()], text[T.gather(ends[:-1][order], size)], size


def bpe(docs: DataFrame, path: str | None = None, keep_ids: bool = True, keep_text: bool = True) -> DataFrame:
    """Per document: n_tokens, digests and, if kept, the ids and the decoded text (else null)."""
    path, n = path or default_path(), hashx.spread(docs)

    def request(batch, ids, buf, offsets):
        _, own, _, text, size = _words(buf, offsets)
        at, ends = hashx.bounds(own, n), np.concatenate([[0], np.cumsum(size)])
        for b in np.flatnonzero(np.diff(at)):
            lo, hi = at[b], at[b + 1]
            yield int(b), batch, hashx.dump(size=size[lo:hi].astype(np.uint32), text=text[ends[lo] : ends[hi]])

    def reply(requests):
        tokenizer = _tokenizer(path)
        text = np.concatenate([r["text"] for r in requests])
        size = np.concatenate([r["size"] for r in requests]).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        spelled = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(text))])
        table = spelled.dictionary_encode()  # by spelling, so that no hash decides
        place, distinct = table.indices.to_numpy(), table.dictionary.to_pylist()
        coded = [x.ids for i in range(0, len(distinct), 4096) for x in tokenizer.encode_batch_fast(distinct[i : i + 4096], add_special_tokens=False)]
        count = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.fromiter((i for c in coded for i in c), np.int32, int(count.sum()))
        start = np.cumsum(count) - count
        out, at = [], 0
        for r in requests:
            mine = place[at : at + len(r["size"])]
            at += len(mine)
            out.append({"count": count[mine].astype(np.uint16 if count.max(initial=0) < 65536 else np.uint32), "ids": ids[T.gather(start[mine], count[mine])]})
        return out

    def result(ids, buf, offsets, given):
        off, own, place, _, _ = _words(buf, offsets)
        count = given["count"].astype(np.int64) if len(own) else np.zeros(0, np.int64)
        start, coded = np.cumsum(count) - count, given["ids"] if len(own) else np.zeros(0, np.int32)
        piece, at = _pieces(path)
        out = [coded_rows(off, place, count, start, coded, piece, at, lo, hi) for lo, hi in T.slices(offsets, SLICE)]
        return pa.concat_tables(out).add_column(0, "doc_id", pa.array(ids)) if out else pa.table({"doc_id": pa.array(ids)})

    def coded_rows(off, place, count, start, coded, piece, at, lo, hi):
        """Rows lo to hi: what a text holds per byte (indices, pieces) is made for some texts at once."""
        mine = place[off[lo] : off[hi]]
        token = coded[T.gather(start[mine], count[mine])]
        ends = np.concatenate([[0], np.cumsum(count[mine])])[off[lo : hi + 1] - off[lo]]
        size = np.diff(at)[token]
        spelled = piece[T.gather(at[token], size)]
        text_ends = np.concatenate([[0], np.cumsum(size)])[ends]
        raw, n = token.astype("<u4"), hi - lo
        spans = zip(text_ends[:-1], text_ends[1:], strict=True)
        decoded = [spelled[a : max(a, b - 1)] for a, b in spans]
        return pa.table({
            "n_tokens": pa.array(np.diff(ends)), "ids_sha256": pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in decoded], pa.string()),
            "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(token, pa.int32())) if keep_ids else pa.nulls(n, pa.list_(pa.int32())),
            "decoded": pa.array([t.tobytes() for t in decoded], pa.binary()).cast(pa.string()) if keep_text else pa.nulls(n, pa.string()),
        })

    packed = hashx.pack(docs, batch_bytes=BATCH_BYTES)
    words = hashx.answer(hashx.ask(packed, request), reply)
    return hashx.finish(packed, [words], result, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(load(spark, sf_dir, "documents"), keep_ids=False, keep_text=False).select(*DIGEST)
