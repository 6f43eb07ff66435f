"""Passages that repeat across and within documents, found by level-wise doubling.

Windows of a short length are looked at first, and only at sampled places: those whose hash is the least of
some stretch that fits into a window of the length asked for. The choice depends on the words alone, so
two equal windows of the full length agree in it. Places whose short window repeats are extended to
twice that length, to the left and to the right, and those that repeat again are extended further. At
the length asked for, every window around a place that is left is compared with all others. Levels
end early when no candidates survive.

Texts move only where they hold candidates, and documents with nothing repeated are done in the
first scan. Copies of a whole text take no part in the levels: all but the first are removed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, temporary_work, work_dir
from .common import SLICE_CHARS, packed, tidy

WINDOW = 20
#: Words of the first level's windows; doubled until WINDOW is reached.
SHORTEST = 10
#: Rows sent back at a time.
ROWS = 65_536
#: Stands for a missing id: rows without one come after all others.
LAST = (1 << 63) - 1
NOTHING = hashlib.sha256(b"").hexdigest()
IDENTITY = ["id", "t"]

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(13)
#: Two independent sets of byte values and odd bases for polynomial hashes modulo 2^64.
_BYTES = _RANDOM.integers(1, 1 << 63, (2, 256), np.uint64)
_BASES = [(int(x) | 1) for x in _RANDOM.integers(1 << 40, 1 << 63, 4)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])


def _stretches(values: np.ndarray, first: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[first:end], the same wherever the stretch lies. An odd base has an
    inverse modulo 2^64, which takes the place out of a difference of two prefix sums."""
    sums = _sums(values * _powers(base, len(values))[:-1])
    back = _powers(pow(base, -1, 1 << 64), int(first.max(initial=0)))
    return (sums[end] - sums[first]) * back[first]


class Words:
    """The words of some texts laid end to end: where each text's words begin, and hashes of windows."""

    def __init__(self, bodies: list[bytes]):
        data = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
        gap = _GAP[data]
        inside = np.concatenate([[False], ~gap])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.first, self.end = edges[::2], edges[1::2]
        self.data = data
        ends = np.cumsum([len(b) + 1 for b in bodies])
        #: Word numbers at which the texts begin, and the total at the end.
        self.starts = np.searchsorted(self.first, np.concatenate([[0], ends]))
        self.values: list[np.ndarray] = []

    def _words(self, k: int) -> np.ndarray:
        while len(self.values) <= k:
            n = len(self.values)
            own = _stretches(_BYTES[n][self.data], self.first, self.end, _BASES[n])
            self.values.append(_mixed(own + (self.end - self.first).astype(np.uint64)))
        return self.values[k]

    def hashes(self, at: np.ndarray, length: int, k: int = 0) -> np.ndarray:
        """The k-th hash of the windows of ``length`` words that start at the words ``at``."""
        return _mixed(_stretches(self._words(k), at, at + length, _BASES[2 + k]))

    def windows(self, length: int) -> np.ndarray:
        """Words at which a window of ``length`` words of one text starts."""
        last = np.repeat(self.starts[1:], np.diff(self.starts)) - length
        at = np.arange(len(self.first))
        return at[at <= last]

    def sampled(self, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of sampled windows of ``length``: at least one in any ``window`` words, by
        the least hash in it (all of them, where several are least)."""
        at = self.windows(length)
        if not len(at):
            return at, np.zeros(0, np.uint64)
        value = np.full(len(self.first) + window, (1 << 64) - 1, np.uint64)
        value[at] = self.hashes(at, length)
        whole = self.windows(window)
        offsets = range(window - length + 1)
        least = value[whole]
        for d in offsets:
            least = np.minimum(least, value[whole + d])
        chosen = np.zeros(len(value), bool)
        for d in offsets:
            chosen[whole + d] |= value[whole + d] == least
        at = np.flatnonzero(chosen)
        return at, value[at]


def _slices(names: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with their texts as UTF-8, in slices of about SLICE_CHARS."""
    texts = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    first, size, held = 0, 0, []
    for k, value in enumerate(texts):
        held.append(value.as_py())
        size += len(held[-1])
        if size >= SLICE_CHARS // 4 or k + 1 == len(texts):
            yield names.slice(first, k + 1 - first), held
            first, size, held = k + 1, 0, []


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def _scanned(docs: DataFrame, window: int, length: int) -> DataFrame:
    """Each document's identity, number of words, hash of all its words, and its sampled windows."""
    schema = "id bigint, t bigint, u bigint, n_words bigint, whole string, hashes array<bigint>, places array<int>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, bodies in _slices(batch.select(["id", "t", "u"]), batch.column("text")):
                words = Words(bodies)
                at, value = words.sampled(length, window)
                cut = np.searchsorted(at, words.starts)
                place = at - np.repeat(words.starts[:-1], np.diff(cut))
                whole = [hashlib.sha256(b" ".join(b.split())).hexdigest() for b in bodies]
                columns = [*rows.columns, pa.array(np.diff(words.starts), pa.int64()), pa.array(whole)]
                columns += [_lists(value.view(np.int64), cut, pa.int64()), _lists(place, cut, pa.int32())]
                names = ["id", "t", "u", "n_words", "whole", "hashes", "places"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(scan, schema)


def _repeated(windows: DataFrame) -> DataFrame:
    """Hashes of windows that start at two places or more; copies of a text count as one place."""
    place = F.xxhash64("t", "place")
    found = windows.groupBy("h").agg(F.min(place).alias("least"), F.max(place).alias("most"))
    return materialize(found.where("least <> most").select("h"), "substrings-repeated")


def _candidates(windows: DataFrame, repeated: DataFrame, originals: DataFrame) -> DataFrame:
    """Per document the places whose window repeats, for first copies of a text only."""
    places = windows.join(repeated, "h").groupBy(*IDENTITY).agg(F.collect_set("place").alias("places"))
    return places.join(originals, IDENTITY, "left_semi")


def _extended(texts: DataFrame, length: int) -> DataFrame:
    """The two windows of twice the ``length`` that begin or end with each candidate, by hash."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, places, owner in _with_places(batches):
            at = np.concatenate([places, places - length])
            who = np.concatenate([owner, owner])
            inside = (at >= words.starts[who]) & (at + 2 * length <= words.starts[who + 1])
            who, at = np.unique(np.stack([who[inside], at[inside]]), axis=1)
            yield from _flat(rows, who, at - words.starts[who], {"h": words.hashes(at, 2 * length)})

    return texts.mapInArrow(extend, "id bigint, t bigint, place int, h bigint")


def _around(texts: DataFrame, length: int, window: int) -> DataFrame:
    """All windows of the full length that hold a candidate of ``length``, by 96 bits of hash."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, places, owner in _with_places(batches):
            marks = np.zeros(len(words.first) + 2, np.int64)
            np.add.at(marks, np.maximum(places - (window - length), words.starts[owner]), 1)
            np.add.at(marks, places + 1, -1)
            at = words.windows(window)
            at = at[np.cumsum(marks)[at] > 0]
            who = np.searchsorted(words.starts, at, "right") - 1
            both = {"h": words.hashes(at, window), "g": words.hashes(at, window, 1).astype(np.uint32)}
            yield from _flat(rows, who, at - words.starts[who], both)

    return texts.mapInArrow(emit, "id bigint, t bigint, place int, h bigint, g int")


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]]:
    """Rows, their words, the candidate places as word numbers of the slice, and the row of each place."""
    for batch in batches:
        done = 0
        for rows, bodies in _slices(batch.select(IDENTITY), batch.column("text")):
            words = Words(bodies)
            lists = batch.column("places").slice(done, len(bodies))
            done += len(bodies)
            owner = np.repeat(np.arange(len(bodies)), lists.value_lengths().to_numpy(zero_copy_only=False))
            places = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + words.starts[owner]
            yield rows, words, places, owner


def _flat(rows: pa.RecordBatch, who: np.ndarray, place: np.ndarray, hashes: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    ids = [rows.column(k).to_numpy() for k in (0, 1)]
    for first in range(0, len(who), ROWS):
        part = slice(first, first + ROWS)
        columns = [pa.array(x[who[part]], pa.int64()) for x in ids] + [pa.array(place[part], pa.int32())]
        columns += [pa.array(x[part].view(x.dtype.str.replace("u", "i"))) for x in hashes.values()]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "t", "place", *hashes])


def _removed(texts: DataFrame, window: int) -> DataFrame:
    """Words covered by the windows at ``places``: how many, and the hash of the others."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, places in zip(batch.column("text"), batch.column("places")):
                found = body.as_py().encode().split()
                marks = np.zeros(len(found) + 1, np.int64)
                at = np.array(places.as_py(), np.int64)
                np.add.at(marks, at, 1)
                np.add.at(marks, at + window, -1)
                covered = np.cumsum(marks)[:-1] > 0
                kept = b" ".join([w for w, c in zip(found, covered.tolist()) if not c])
                out.append((int(covered.sum()), hashlib.sha256(kept).hexdigest()))
            columns = [*batch.select(IDENTITY).columns, pa.array([n for n, _ in out], pa.int64()), pa.array([s for _, s in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "t", "n_covered", "rest"])

    return texts.mapInArrow(cut, "id bigint, t bigint, n_covered bigint, rest string")


def _text_keys(text: Column) -> tuple[Column, Column]:
    """Two hashes of a whole text."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(13), text)


def deduplicated(
    docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed and kept_sha256 once every word is removed that a
    window of ``window`` words covers whose words also start earlier, in a document of smaller id or
    earlier in the same one. ``shortest`` times a power of two is ``window``.

    A null text has no words; a null id counts as larger than any other. Different texts under one
    id come in the order of a hash of theirs; rows equal in id and text are one document and have one
    result. An empty table gives no rows; other columns play no part. Windows are told
    apart by 96 bits of hash.
    """
    lengths = [shortest]
    while lengths[-1] < window:
        lengths.append(lengths[-1] * 2)
    if lengths[-1] != window or len(lengths) < 2:
        raise ValueError("window must be shortest times a power of two")
    tidy(docs.sparkSession)
    base = packed(docs, id=f"{doc_id}:bigint", text=text).drop("row")
    t, u = _text_keys(F.col("text"))
    base = base.select(F.coalesce("id", F.lit(LAST)).alias("id"), t.alias("t"), u.alias("u"), "text", F.col("id").alias("own"))
    scanned = materialize(_scanned(base.select("id", "t", "u", "text"), window, shortest), "substrings-documents")
    originals = scanned.groupBy("t", "u").agg(F.min("id").alias("id")).select("id", "t", "u")
    originals = materialize(originals, "substrings-originals")

    pairs = F.explode(F.arrays_zip("hashes", "places")).alias("w")
    windows = scanned.select(*IDENTITY, pairs).select(*IDENTITY, F.col("w.places").alias("place"), F.col("w.hashes").alias("h"))
    texts = base.select(*IDENTITY, "text")
    path = work_dir(docs.sparkSession, "substrings-removed")
    with temporary_work(docs.sparkSession):
        for length in lengths[:-1]:
            candidates = materialize(_candidates(windows, _repeated(windows), originals), "substrings-candidates")
            # The texts of documents with candidates: each level has fewer of them.
            texts = materialize(texts.join(candidates, IDENTITY), "substrings-texts")
            if 2 * length < window:
                windows = materialize(_extended(texts, length), "substrings-windows")
                texts = texts.drop("places")
        # Hashed anew where they are used: that takes less than storing them.
        longest = _around(texts, lengths[-2], window)
        place = F.struct("id", "t", "place")
        earliest = longest.groupBy("h", "g").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        earliest = materialize(earliest.where("n > 1").select("h", "g", "first"), "substrings-repeated")
        later = longest.join(earliest, ["h", "g"]).where(place > F.col("first"))
        later = later.groupBy(*IDENTITY).agg(F.collect_set("place").alias("places"))
        cut = _removed(texts.drop("places").join(later, IDENTITY), window)
        cut.dropDuplicates(IDENTITY).write.parquet(path)
    cut = docs.sparkSession.read.schema(cut.schema).parquet(path)

    heads = originals.select(*IDENTITY, F.lit(True).alias("original"))
    rows = scanned.select(*IDENTITY, "n_words", "whole").join(heads, IDENTITY, "left").join(cut, IDENTITY, "left")
    copy = F.col("original").isNull() & (F.col("n_words") >= window)
    return rows.select(
        F.when(F.col("id") != LAST, F.col("id")).alias("id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_covered", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("rest", "whole")).alias("kept_sha256"),
    )


def op13(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).withColumnRenamed("id", "doc_id")
