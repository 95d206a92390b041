"""Token-ID output in patched frame-of-reference blocks.

Documents are range-partitioned by id, tokenized, and written as segments.  A segment is a
self-contained byte string (the file format below) held in one row of a Parquet container,
so that Spark's commit protocol makes the write safe against lost and repeated tasks on any
file system.  Reading decodes a segment alone, or single blocks of it through its index.

Segment format (little-endian):

    magic "PFB1" | u32 documents | u64 values | u32 length-stream bytes | length stream | value stream

where both streams (document lengths, token ids) have the form

    u64 values | u32 blocks | u64 block start [blocks] | blocks

and a block of up to 128 values is

    u32 minimum | u8 width | u8 exceptions | packed (value - minimum) low bits, 128 x width bits
    | u8 position [exceptions] | u32 (value - minimum) >> width [exceptions]

``width`` is the bit length that the given percentile of the block's values fits in; the
rest are exceptions.
"""

from __future__ import annotations

import itertools
import string
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.shared import give_back, slim, stash, text_bytes

BLOCK = 128
PERCENTILE = 0.9
END_ID = 2
#: Tokens after which a segment is closed (at a document's end).
SEGMENT_TOKENS = 1 << 20
TOKENIZER = "word_bpe_49k.json"


# --- blocks ----------------------------------------------------------------------------------


def _bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits of unsigned 32-bit values."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def encode_blocks(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """A stream of patched frame-of-reference blocks of unsigned 32-bit values."""
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return struct.pack("<QI", 0, 0)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[:n] = values
    padded[n:] = values[-1]
    rows = padded.reshape(blocks, BLOCK)
    low = rows.min(1)
    rest = rows - low[:, None]
    bits = _bit_lengths(rest)
    at = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    width = np.partition(bits, at, axis=1)[:, at]
    over = bits > width[:, None]
    exceptions = over.sum(1)
    sizes = 6 + width.astype(np.int64) * (BLOCK // 8) + 5 * exceptions
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    heads = starts[:-1]
    out[heads[:, None] + np.arange(4)] = low.astype("<u4")[:, None].view(np.uint8)
    out[heads + 4] = width
    out[heads + 5] = exceptions
    for w in np.unique(width):
        if w == 0:
            continue
        mine = np.flatnonzero(width == w)
        planes = np.unpackbits(rest[mine].astype("<u4")[:, :, None].view(np.uint8), axis=2, bitorder="little", count=int(w))
        packed = np.packbits(planes.reshape(len(mine), -1), axis=1, bitorder="little")
        out[heads[mine][:, None] + 6 + np.arange(packed.shape[1])] = packed
    row, position = np.nonzero(over)
    if len(row):
        rank = np.arange(len(row)) - (np.cumsum(exceptions) - exceptions)[row]
        base = heads[row] + 6 + width[row].astype(np.int64) * (BLOCK // 8)
        out[base + rank] = position
        high = (rest[row, position].astype(np.uint64) >> width[row].astype(np.uint64)).astype("<u4")
        out[(base + exceptions[row] + 4 * rank)[:, None] + np.arange(4)] = high[:, None].view(np.uint8)
    return struct.pack("<QI", n, blocks) + heads.astype("<u8").tobytes() + out.tobytes()


def decode_blocks(stream: bytes | memoryview, first: int = 0, last: int | None = None) -> np.ndarray:
    """Values of blocks [first, last) of a stream (all by default), found through the block index."""
    n, blocks = struct.unpack_from("<QI", stream)
    last = blocks if last is None else min(last, blocks)
    if last <= first:
        return np.zeros(0, np.uint32)
    heads = np.frombuffer(stream, "<u8", blocks, 12)[first:last].astype(np.int64)
    body = np.frombuffer(stream, np.uint8, offset=12 + 8 * blocks)
    low = body[heads[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width, exceptions = body[heads + 4], body[heads + 5].astype(np.int64)
    rows = np.zeros((len(heads), BLOCK), np.uint32)
    for w in np.unique(width):
        if w == 0:
            continue
        mine = np.flatnonzero(width == w)
        packed = body[heads[mine][:, None] + 6 + np.arange(int(w) * (BLOCK // 8))]
        planes = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(mine), BLOCK, int(w))
        wide = np.zeros((len(mine), BLOCK, 4), np.uint8)
        got = np.packbits(planes, axis=2, bitorder="little")
        wide[:, :, : got.shape[2]] = got
        rows[mine] = wide.view("<u4")[:, :, 0]
    total = int(exceptions.sum())
    if total:
        row = np.repeat(np.arange(len(heads)), exceptions)
        rank = np.arange(total) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        base = heads[row] + 6 + width[row].astype(np.int64) * (BLOCK // 8)
        position = body[base + rank]
        high = body[(base + exceptions[row] + 4 * rank)[:, None] + np.arange(4)].copy().view("<u4").ravel()
        rows[row, position] |= high << width[row].astype(np.uint32)
    values = (rows + low[:, None]).ravel()
    return values[: n - first * BLOCK] if last == blocks else values


def encode_segment(lengths: np.ndarray, values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    lead = encode_blocks(np.asarray(lengths, np.uint32), percentile)
    return struct.pack("<4sIQI", b"PFB1", len(lengths), len(values), len(lead)) + lead + encode_blocks(np.asarray(values, np.uint32), percentile)


def decode_segment(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(document lengths, values) of a segment."""
    magic, _, _, lead = struct.unpack_from("<4sIQI", payload)
    if magic != b"PFB1":
        raise ValueError("not a PFB1 segment")
    view = memoryview(payload)
    return decode_blocks(view[20 : 20 + lead]), decode_blocks(view[20 + lead :])


# --- tokenization ----------------------------------------------------------------------------


_PUNCTUATION = string.punctuation.encode()
#: Byte-level tokenizers write a byte as a printable letter: itself, or the next free code point from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: b if b in _PRINTABLE else 256 + sum(c not in _PRINTABLE for c in range(b)) for b in range(256)}


class Encoder(dict):
    """Ids of whole texts with a ``tokenizers`` file whose pre-tokenizer never crosses white space.

    What stands between ASCII white space always has the same ids, so each worker keeps those
    of the words it has met (this dictionary) and encodes only new ones.  The store has two
    generations of at most ``remember`` words: when the young one is full it becomes the old
    one, and old words move back as they are met.

    ASCII capitals are lowered first, which the tokenizer's own normalizer does anyway; texts
    with combining marks, where lowering could change what composes, are left as they are.
    """

    #: First byte of U+0300..U+033F, the marks that compose with ASCII letters.
    MARKS = b"\xcc"
    _by_path: dict[str, Encoder] = {}

    def __init__(self, path: str, remember: int = 500_000, lower: bool = True):
        import os

        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.old: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}
        self.remember, self.lower = remember, lower

    @classmethod
    def of(cls, path: str, remember: int = 500_000) -> Encoder:
        """The worker's own encoder of that file."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path, remember)
        return cls._by_path[path]

    def forget(self) -> None:
        """Gives up all words met."""
        for store in (self, self.old, self.cores, self.tails):
            store.clear()
        give_back()

    def whole(self, text: bytes) -> bytes:
        """Ids by the tokenizer itself."""
        (encoding,) = self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)
        return struct.pack(f"<{len(encoding.ids)}I", *encoding.ids)

    def __missing__(self, word: bytes) -> bytes:
        """A new word.  A lower-case word with ASCII punctuation behind it is two pre-tokens, of which the
        first goes straight to the merge model; all others go through the whole tokenizer."""
        ids = self.old.get(word)
        if ids is None:
            core = word.rstrip(_PUNCTUATION)
            ids = self.cores.get(core)
            if ids is None and (ids := self._merge(core)) is not None:
                self.cores[core] = ids
            if ids is None:
                ids = self.whole(word)
            elif len(core) < len(word):
                tail = word[len(core) :]
                if tail not in self.tails:
                    self.tails[tail] = self.whole(tail)
                ids += self.tails[tail]
        self[word] = ids
        return ids

    def _merge(self, core: bytes) -> bytes | None:
        """Ids of one lower-case word of letters; None for anything else."""
        if core.isalpha():
            if not core.islower():
                return None
            seen = core.decode("ascii")
        elif not core:
            return b""
        else:
            text = core.decode("utf-8", "replace")
            if not text.isalpha() or text != text.lower() or not unicodedata.is_normalized("NFC", text):
                return None
            seen = core.decode("latin-1").translate(_BYTE_LETTERS)
        found = [t.id for t in self.model.tokenize(seen)]
        return struct.pack(f"<{len(found)}I", *found)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers, without an end id."""
        out: list[bytes] = []
        get = self.__getitem__
        for text in texts:
            if len(self) > self.remember:
                self.old = dict(self)
                self.clear()
            if len(self.cores) > self.remember:
                self.cores.clear()
            if len(self.tails) > self.remember:
                self.tails.clear()
            out.append(b"".join(map(get, (text.lower() if self.lower and self.MARKS not in text else text).split())))
        return out


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _segments(path: str | None, end_id: int, segment_tokens: int, percentile: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(path or tokenizer_path())
    shard = TaskContext.get().partitionId()
    end = np.asarray([end_id], "<u4").tobytes()
    ids: list = []
    parts: list[bytes] = []
    held = start = seq = 0

    def close() -> pa.RecordBatch:
        values = np.frombuffer(b"".join(parts), "<u4")
        lengths = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts))
        payload = encode_segment(lengths, values, percentile)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([seq], pa.int64()), pa.array([start], pa.int64()), pa.array([len(values)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
            names=["shard", "seq", "start_in_shard", "n_values", "doc_ids", "payload"],
        )

    for batch in batches:
        column = batch.column("doc_id").to_pylist()
        data, offsets = text_bytes(batch.column("text"))
        for at in range(0, len(column), 256):
            spans = offsets[at : at + 257].tolist()
            texts = [data[s:e].tobytes() for s, e in itertools.pairwise(spans)]
            for doc_id, got in zip(column[at : at + 256], encoder.encode(texts), strict=True):
                ids.append(doc_id)
                parts.append(got + end)
                held += len(got) // 4 + 1
                if held >= segment_tokens:
                    yield close()
                    start, seq, held, ids, parts = start + held, seq + 1, 0, [], []
    if parts:
        yield close()


def write_token_files(documents: DataFrame, path: str | None = None, end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS, percentile: float = PERCENTILE, to: str | None = None) -> DataFrame:
    """Encodes every whole text and writes the segments in ascending doc_id order; returns the written table.

    Null and empty texts hold only the end id.  Equal ids stand beside each other in the order
    of their texts' hashes; null ids come first.  Other columns are ignored.  With ``to`` the
    table is kept there, else in the shared folder.
    """
    rows = slim(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    segments = ordered.mapInArrow(lambda b: _segments(path, end_id, segment_tokens, percentile, b), "shard int, seq long, start_in_shard long, n_values long, doc_ids array<long>, payload binary")
    if to is None:
        return stash(segments, "tokens")
    segments.write.option("compression", "none").parquet(to)
    return documents.sparkSession.read.parquet(to)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            lengths, values = decode_segment(batch.column("payload")[k].as_py())
            values = values.astype("<u4", copy=False)
            ends = np.cumsum(lengths.astype(np.int64))
            begins = ends - lengths
            start = batch.column("start")[k].as_py()
            crcs = [zlib.crc32(values[b:e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[k].values, pa.array(begins + start, pa.int64()), pa.array(lengths.astype(np.int64)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )


def read_token_files(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the written segments.

    ``start`` is exact: a running sum over shards plus the place in the shard.  The sums are
    broadcast: one row per shard, of which there are as many as partitions were written.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = segments.groupBy("shard").agg(F.sum("n_values").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = segments.join(F.broadcast(shards), "shard").select("doc_ids", "payload", (F.col("base") + F.col("start_in_shard")).alias("start"))
    return placed.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
