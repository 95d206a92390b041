"""Storage, batching and byte-level primitives used by the operators of this subpackage."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at once inside a Python worker (a longer document is worked on alone).
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch (a larger row is a batch of its own).
BATCH_BYTES = 16 << 20
#: Bytes of ids or removals that may be broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20


# --- storage ---------------------------------------------------------------------------------

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; a temporary one of ours only where that is unset and all runs on one machine (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set; executors need a folder that all of them see")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="pagewright-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._pagewright_path = path
    if _scopes:
        _scopes[-1].append(back)
    return back


_scopes: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stashed inside are deleted at the end, but for those given to the function it yields.

    What leaves such a block must be a kept table or be computed already.
    """
    mine: list[DataFrame] = []
    kept: list[DataFrame] = []
    _scopes.append(mine)
    try:
        yield lambda df: kept.append(df) or df
    finally:
        _scopes.pop()
        unstash(*[t for t in mine if not any(t is k for k in kept)])
        if _scopes:
            _scopes[-1].extend(kept)


def unstash(*tables: DataFrame) -> None:
    """Deletes stashed tables that no later plan reads."""
    for df in tables:
        path = getattr(df, "_pagewright_path", None)
        if path:
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each changed until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def map_rows(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` over whole rows that keeps the schema, whatever the columns are called; in small batches."""
    odd = [c for c in df.columns if not c.isidentifier()]
    plain = dict(zip(odd, fresh(df, *[f"column_{k}" for k in range(len(odd))]), strict=True))
    rows = small_batches(df).toDF(*[plain.get(c, c) for c in df.columns])
    return rows.mapInArrow(work, rows.schema).toDF(*df.columns)


def document_key(doc_id: Column, text_hash: Column) -> Column:
    """A 64-bit key of a document; with the doc_id, which it includes, it tells documents apart."""
    return F.xxhash64(doc_id, text_hash)


def crc_mod3(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 3: the fold of a document."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 3


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds the bytes of an Arrow batch, and so a Python worker's memory, however long the texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def slim(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input can't clash with ours; in small batches."""
    return small_batches(df).select(*[F.col(f"`{n}`") for n in names])


# --- batches ---------------------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n + 1 offsets) of a string column, without a copy where Arrow allows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    width = np.int64 if large else np.int32
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents [lo, hi) of at most ``limit`` bytes, or one document."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi
    give_back()


def give_back() -> None:
    """Hands freed memory back to the system, where the C library can: workers live on between stages."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


# --- hashing ---------------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """n + 1 prefix sums of values[i] * base**i modulo 2**64, from which any span's hash follows."""
    up, _ = _power_tables(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal spans have equal hashes wherever they stand."""
    _, down = _power_tables(len(sums))
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


# --- words -----------------------------------------------------------------------------------

#: Lower-cases A-Z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words in lower-cased text: 0-9, a-z and all bytes of non-ASCII characters.
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


class Words:
    """Words of some documents: byte spans, 64-bit hashes, and the range of words of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        offsets = offsets - offsets[0]
        lowered = LOWER[data]
        inside = IN_WORD[lowered]
        before = np.empty(len(inside), bool)
        before[1:] = inside[:-1]
        after = np.empty(len(inside), bool)
        after[:-1] = inside[1:]
        if len(inside):
            edges = offsets[:-1][offsets[:-1] < len(inside)]
            before[edges] = False
            after[edges[edges > 0] - 1] = False
            after[-1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.lowered = lowered
        #: first[d]:first[d + 1] are the words of document d
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = span_hashes(prefix_sums(lowered), self.starts, self.ends) if len(self.starts) else np.zeros(0, np.uint64)
        self.counts = np.diff(self.first)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first): of the k-word shingles; a text of fewer words than k, but not none, is one shingle."""
        n = len(self.hashes)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(len(self.first), np.int64)
        sums = prefix_sums(self.hashes)
        counts = np.where(self.counts >= k, self.counts - k + 1, np.minimum(self.counts, 1))
        first = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=first[1:])
        doc = np.repeat(np.arange(len(counts)), counts)
        starts = self.first[doc] + np.arange(first[-1]) - first[doc]
        return span_hashes(sums, starts, np.minimum(starts + k, self.first[doc + 1])), first

    def sequence_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each document's whole word sequence."""
        low, high = self.first[:-1], self.first[1:]
        if not len(self.hashes):
            return (np.zeros(len(low), np.uint64),) * 2
        one = span_hashes(prefix_sums(self.hashes), low, high)
        two = span_hashes(prefix_sums(mix(self.hashes ^ np.uint64(0xA0761D6478BD642F))), low, high)
        return one, two
