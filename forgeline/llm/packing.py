"""Packing documents into sequences along a space-filling curve.

Each document gets a hashed vector of its byte 4-grams, a fixed random projection of it to three
dimensions, and the place of that point on a Hilbert curve. Spark deals the documents out by range of that
key, between quantiles of one document in sixteen, and each task cuts its stretch of the curve into sequences: neighbours on the curve share
them. Documents are cut wherever a sequence ends. What is left at the end of a task's stretch is
cut into lengths that are powers of two, which need no padding, so tasks need not know of each
other and nothing is ever padded.
"""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed
from .tokens import REMEMBERED, encoder

LENGTH = 1024
END_ID = 0
DIMENSIONS = 3
#: Bits per dimension on the curve.
BITS = 10
#: Pieces sent back at a time.
ROWS = 1024
#: Places of the hashed vector.
PLACES = 256
#: One in so many documents has a say in where the ranges of the curve end; all are packed.
BORDERS_OF = 16
#: Bits of a hash by which documents at one point of the curve are told apart.
TIES = 22
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows of ``bits``-bit coordinates), after
    Skilling, 2004: undo the excess work of the Gray code from the top bit down, then interleave."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _projection() -> np.ndarray:
    return np.random.default_rng(8).choice([-1.0, 1.0], (PLACES, DIMENSIONS)) * np.sqrt(3.0)


def _curve_keys() -> Callable[[pa.Array], np.ndarray]:
    """Places on the curve of whole texts' hashed vectors; null and empty texts lie in the middle of the cube."""
    projection = _projection()

    def keys(texts: pa.Array) -> np.ndarray:
        n = len(texts)
        if not n:
            return np.zeros(0, np.int64)
        texts = texts.cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        points = np.zeros((n, DIMENSIONS))
        for i in range(n):
            body = data[ends[i] : ends[i + 1]]
            if len(body) < 4:
                continue
            counts = np.zeros(PLACES)
            for first in range(0, len(body) - 3, 1 << 20):
                part = body[first : first + (1 << 20) + 3].astype(np.uint32)
                gram = part[:-3] | part[1:-2] << 8 | part[2:-1] << 16 | part[3:] << 24
                counts += np.bincount((gram * np.uint32(0x9E3779B1)) >> np.uint32(24), minlength=PLACES)
            vector = np.sqrt(counts) - np.sqrt(counts).mean()
            points[i] = vector @ projection / max(float(np.linalg.norm(vector)), 1e-9)
        # A normal variable's rank is nearly uniform, which fills the cube evenly.
        level = 1 / (1 + np.exp(-1.7 * points))
        return hilbert(np.minimum(level * (1 << BITS), (1 << BITS) - 1).astype(np.int64), BITS)

    return keys


def curve_key(text: Column) -> Column:
    """Place on the curve of a whole text."""
    keys = _curve_keys()
    return F.arrow_udf(lambda texts: pa.array(keys(texts)), "bigint")(text)


def _ranged(docs: DataFrame) -> DataFrame:
    """The rows (id, text), with ``curve``, in ranges of the curve of about equal numbers of documents, as many as
    the session's shuffles are wide. Copies, which share a point, are dealt out by a hash."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    length = F.length("text")
    tie = F.pmod(F.xxhash64("id", length), F.lit(1 << TIES))
    some = docs.where(F.pmod(F.xxhash64("id", length, F.lit("border")), F.lit(BORDERS_OF)) == 0)
    some = some.select((curve_key(F.col("text")) * (1 << TIES) + tie).alias("place"))
    borders = some.agg(F.percentile_approx("place", [k / width for k in range(1, width)] or [1.0], 10 * width)).first()[0]
    borders, keys = np.array(borders or [], np.int64), _curve_keys()
    kind = pa.struct([("curve", pa.int64()), ("part", pa.int32())])

    def ranges(texts: pa.Array, ties: pa.Array) -> pa.Array:  # both in one function, so that a task needs one process
        curve = keys(texts)
        part = np.searchsorted(borders, (curve << TIES) + ties.to_numpy(zero_copy_only=False), "right")
        return pa.StructArray.from_arrays([pa.array(curve), pa.array(part % width, pa.int32())], fields=list(kind))

    along = docs.withColumn("at", F.arrow_udf(ranges, "curve bigint, part int")("text", tie))
    return along.select("id", "text", "at.*").repartitionById(width, F.col("part"))


class _Cutter:
    """Cuts a stretch of documents into sequences, holding back the one that is open."""

    def __init__(self, task: int):
        self.next_id = task << 40
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.filled = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            piece = ids[start : start + LENGTH - self.filled]
            self.open.append((doc_id, start, piece, len(ids)))
            start += len(piece)
            self.filled += len(piece)
            if self.filled == LENGTH:
                yield from self._closed([LENGTH])

    def _closed(self, lengths: list[int]) -> Iterator[tuple]:
        """The open pieces in sequences of the given lengths, which add up to what is held."""
        pieces, self.open, self.filled = self.open[::-1], [], 0
        for length in lengths:
            offset = 0
            while offset < length:
                doc_id, start, ids, total = pieces.pop()
                if len(ids) > length - offset:
                    pieces.append((doc_id, start + length - offset, ids[length - offset :], total))
                    ids = ids[: length - offset]
                body = ids.astype("<u4").tobytes()
                yield doc_id, start, len(ids), zlib.crc32(body), total, self.next_id, offset, body
                offset += len(ids)
            self.next_id += 1

    def finish(self) -> Iterator[tuple]:
        yield from self._closed([1 << b for b in range(LENGTH.bit_length() - 1, -1, -1) if self.filled >> b & 1])


def _return_memory() -> None:
    """Gives back what this process, which Spark uses again and again, held for earlier tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # only glibc has it
        pass


def pack(
    docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", remembered: int = REMEMBERED
) -> DataFrame:
    """One row per piece of a document, with its ids as little-endian unsigned 32-bit integers.
    A process remembers the ids of ``remembered`` words, which trades memory for speed.

    Null and empty texts are the end id alone. Rows that repeat an id, or have none, are packed as
    documents of their own. An empty table gives no rows; other columns play no part.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        _return_memory()
        encode, cutter = encoder(tokenizer, remembered), _Cutter(TaskContext.get().partitionId())
        schema = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in PIECES.split(", ")])

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

        held: list[tuple] = []
        for batch in batches:
            for doc, ids in zip(batch.column("id"), encode.column(batch.column("text"))):
                held += cutter.add(doc.as_py(), np.append(ids, ids.dtype.type(END_ID)))
                if len(held) >= ROWS:
                    yield rows(held)
                    held = []
        held += cutter.finish()
        if held:
            yield rows(held)

    base = packed(docs, id=f"{doc_id}:bigint", text=text).drop("row")
    return _ranged(base).sortWithinPartitions("curve", "id").select("id", "text").mapInArrow(cut, PIECES)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8(docs: DataFrame) -> DataFrame:
    return pack(docs, tokenizer_path()).drop("ids")
