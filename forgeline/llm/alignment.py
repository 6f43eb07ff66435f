"""Alignment of two tokenizers' tokens: groups that cover the same bytes, and how often tokens end together.

Both tokenizers cut the same bytes, so the ends of their tokens are two ascending lists. A slice of
documents is merged as one: diagonals at equal distances divide the merge path of the two lists, a binary
search on each finds where the path crosses it, and the pieces between are merged independently of
each other, each of the same size whatever document it lies in. A piece emits the pairs of tokens that
end together; a pair cut by a diagonal is found at the border; the pairs in order cut the tokens into groups.

A text is encoded in chunks that neither tokenizer's tokens can cross, and the ids of a chunk are remembered.

How often pairs of ids are linked is counted over all documents. The HEAD most frequent pairs go
to all tasks, which is a fixed number, and the others are joined to the documents that hold them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, temporary_work, work_dir
from .common import packed, tidy
from .tokens import ODD

#: Merged ends per piece.
WORK = 1 << 14
#: Characters merged at a time; a longer text is a slice of its own.
SLICE = 1_000_000
#: Pairs whose counts every task gets.
HEAD = 1 << 19
#: White space and what follows it. Between two chunks no token of either kind reaches across.
CHUNK = re.compile(r"\s*\S+|\s+")
#: Texts with other white space than this are encoded whole, as the tokenizers differ in it.
WHOLE = set(ODD) | set("\r\x0b\x0c")
#: Chunks remembered per process, in two generations; about 250 bytes each.
REMEMBERED = 150_000
NOTHING = {"n_a": 0, "n_b": 0, "n_links": 0, "groups_sha256": "", "groups": ""}


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many elements of ``a`` are among the first d of the merged lists, for each diagonal d;
    of equal elements that of ``a`` comes first. One binary search per diagonal, all in step."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = np.zeros(len(diagonals), bool)
        first[open_] = a[middle[open_]] <= b[diagonals[open_] - 1 - middle[open_]]
        low = np.where(open_ & first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    return low


def ends_together(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places i, j with a[i] == b[j], for two strictly ascending lists."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, work), total)
    i = crossings(a, b, diagonals)
    j = diagonals - i
    found = [_piece(a, b, *at) for at in zip(i[:-1], i[1:], j[:-1], j[1:])]
    # An end of a is the last before a diagonal, and its partner the first behind it.
    k = np.flatnonzero((i > 0) & (j < len(b)))
    k = k[a[i[k] - 1] == b[j[k]]]
    left = np.concatenate([i[k] - 1, *(x for x, _ in found)])
    right = np.concatenate([j[k], *(y for _, y in found)])
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def _piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray]:
    own, other = a[i0:i1], b[j0:j1]
    at = np.searchsorted(other, own)
    inside = np.flatnonzero(at < len(other))
    hit = inside[other[at[inside]] == own[inside]]
    return hit + i0, at[hit] + j0


def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    return {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(hidden)}


class Pair:
    """The two tokenizers, the bytes of their tokens, and the chunks met before."""

    def __init__(self, a_path: str, b_path: str, remembered: int):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        known = {i: token for token, i in self.a.get_vocab().items()}
        spell = lambda token: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.a_bytes = [spell(known.get(i, "")) for i in range(max(known) + 1)]
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]
        self.space = self.b.piece_to_id("▁")
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        small = max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16
        #: Type of an id, and type of a pair and its shift.
        self.kind = np.dtype("<u2" if small else "<u4")
        self.pair_kind, self.shift = (np.dtype("<u4"), 16) if small else (np.dtype("<u8"), 32)
        self.names = max(len(self.a_bytes), len(self.b_bytes))
        #: Every id as text, followed by what comes after it within and at the end of A's and B's part of a group.
        self.text = np.array([f"{i}{mark}" for mark in ",|;" for i in range(self.names)], object)
        self.remembered = remembered
        self.new: dict[str, tuple[bytes, bytes] | None] = {}
        self.old: dict[str, tuple[bytes, bytes] | None] = {}
        # Chunks are safe only if no token of B goes on across white space.
        self.chunked = not any(re.search(r"[^▁]▁|.[ \t\n]|[ \t\n].", p) for p, _ in pieces)

    def encoded(self, chunks: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both kinds, as bytes, of chunks as they stand in a text; None where tokens spell other bytes."""
        ours = self.a.encode_batch_fast(chunks, add_special_tokens=False)
        # B puts a space before what it encodes: the chunk's own, or one that is taken away again.
        theirs = self.b.encode([c[1:] if c.startswith(" ") else c for c in chunks], num_threads=1)
        out: list[tuple[bytes, bytes] | None] = []
        for chunk, x, y in zip(chunks, ours, theirs):
            body, ids = chunk.encode(), x.ids
            if chunk == " ":  # encoded as nothing without its own space
                y = [self.space]
            elif not chunk.startswith(" "):
                y = y[1:] if y and self.b_bytes[y[0]] == b" " else [0]
            same = b"".join([self.a_bytes[i] for i in ids]) == body and b"".join([self.b_bytes[i] for i in y]) == body
            out.append((np.array(ids, self.kind).tobytes(), np.array(y, self.kind).tobytes()) if same else None)
        return out

    def ids(self, text: str) -> tuple[bytes, bytes] | None:
        """Ids of both kinds of a space and the text; None where they spell other bytes."""
        if not text:
            return None
        text = " " + text
        if not self.chunked or (not text.isascii() and any(c in text for c in WHOLE)) or any(c in text for c in "\r\x0b\x0c\x1c\x1d\x1e\x1f"):
            return self.encoded([text])[0]
        chunks = CHUNK.findall(text)
        new, old = self.new, self.old
        missing = []
        for chunk in set(chunks).difference(new):
            if chunk in old:
                new[chunk] = old[chunk]
            else:
                missing.append(chunk)
        if missing:
            new.update(zip(missing, self.encoded(missing)))
        found = [new[c] for c in chunks]
        if len(new) > self.remembered:
            self.old, self.new = new, {}
        if None in found:
            return None
        return b"".join([x for x, _ in found]), b"".join([y for _, y in found])


@lru_cache(maxsize=2)
def pair(a_path: str, b_path: str, remembered: int = REMEMBERED) -> Pair:
    """One per process, kept between tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a process per core
    return Pair(a_path, b_path, remembered)


def aligned_texts(texts: list[str], both: Pair, work: int = WORK) -> list[dict]:
    """Per text n_a, n_b, n_links, the links as pairs of ids in ``links`` (bytes), and the groups as text."""
    found = [both.ids(text) or (b"", b"") for text in texts]
    a = np.frombuffer(b"".join([x for x, _ in found]), both.kind).astype(np.int64)
    b = np.frombuffer(b"".join([y for _, y in found]), both.kind).astype(np.int64)
    size = both.kind.itemsize
    a_from = np.cumsum([0, *(len(x) // size for x, _ in found)])
    b_from = np.cumsum([0, *(len(y) // size for _, y in found)])
    left, right = ends_together(np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b]), work)
    links = ((a[left] << both.shift) | b[right]).astype(both.pair_kind)
    at = np.searchsorted(left, a_from)
    # Where each token goes when the groups are written one after the other, A's part before B's.
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[left] = 1
    b_last[right] = 1
    b_start = np.append(0, right + 1)
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + b_start[np.cumsum(a_last) - a_last]] = a + a_last * both.names
    order[np.arange(len(b)) + (left + 1)[np.cumsum(b_last) - b_last]] = b + b_last * 2 * both.names
    out = []
    for k in range(len(texts)):
        if a_from[k] == a_from[k + 1]:
            out.append(NOTHING | {"links": b""})
            continue
        groups = "".join(both.text[order[a_from[k] + b_from[k] : a_from[k + 1] + b_from[k + 1]]].tolist())[:-1]
        row = {"n_a": int(a_from[k + 1] - a_from[k]), "n_b": int(b_from[k + 1] - b_from[k]), "n_links": int(at[k + 1] - at[k])}
        row |= {"groups": groups, "groups_sha256": hashlib.sha256(groups.encode()).hexdigest(), "links": links[at[k] : at[k + 1]].tobytes()}
        out.append(row)
    return out


def _text_slices(texts: pa.Array) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for value in texts:
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", with_groups: bool = False) -> DataFrame:
    """Per row of ``docs``: id, n_a, n_b, n_links, links (bytes of pairs of ids) and groups_sha256, with
    ``groups`` as text if asked for.

    A null or empty text, and one whose tokens spell other bytes than a space and the text, has no tokens.
    Rows that repeat an id, or have none, are aligned on their own. An empty table gives no rows; other
    columns play no part.
    """
    names = ["n_a", "n_b", "n_links", "links", "groups_sha256"] + ["groups"] * with_groups
    kinds = {"links": ("binary", pa.binary()), "groups_sha256": ("string", pa.string()), "groups": ("string", pa.string())}

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        for batch in batches:
            done = 0
            for texts in _text_slices(batch.column("text")):
                rows = aligned_texts(texts, both)
                own = batch.column("id").slice(done, len(texts))
                done += len(texts)
                columns = [pa.array([r[c] for r in rows], kinds.get(c, ("", pa.int64()))[1]) for c in names]
                yield pa.RecordBatch.from_arrays([own, *columns], names=["id", *names])

    base = packed(docs, id=f"{doc_id}:bigint", text=text).drop("row")
    return base.mapInArrow(align, "id bigint, " + ", ".join(f"{c} {kinds.get(c, ('bigint',))[0]}" for c in names))


def link_counts(rows: DataFrame, kind: np.dtype, shift: int) -> DataFrame:
    """pair, n, best: how many links of all rows hold a pair of ids, and whether no other pair with its B
    id has more. Tasks add up what they read before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate([np.zeros(0, kind), *held]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for batch in batches:
            for body in batch.column("links"):
                held.append(np.frombuffer(body.as_py(), kind))
                size += len(held[-1])
                if size > 4_000_000:
                    yield out()
                    held, size = [], 0
        yield out()

    counts = rows.select("links").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    same_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << shift) - 1))  # as many rows as A has ids at most
    return counts.withColumn("best", F.col("n") == F.max("n").over(same_b))


def with_counts(rows: DataFrame, kind: np.dtype, shift: int, head: int = HEAD) -> DataFrame:
    """``rows`` of a stored table with n_best (links whose pair is the most frequent one of its B id) and count_sum
    (of the links' counts) in place of their links."""
    spark = rows.sparkSession
    counts = materialize(link_counts(rows, kind, shift), "alignment-counts")
    top = counts.orderBy(F.desc("n"), "pair").limit(head).toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))
    kept = [f for f in rows.schema if f.name != "links"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            sums, bests, rest, times = [], [], [], []
            for body in batch.column("links"):
                own = np.frombuffer(body.as_py(), kind).astype(np.int64)
                at = np.searchsorted(pairs, own)
                hit = at < len(pairs)
                hit[hit] = pairs[at[hit]] == own[hit]
                at = at[hit]
                sums.append(int(n[at].sum()))
                bests.append(int(best[at].sum()))
                left, often = np.unique(own[~hit], return_counts=True)
                rest.append(left)
                times.append(often)
            ints = pa.list_(pa.int64())
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(sums, pa.int64()), pa.array(bests, pa.int64()), pa.array(rest, ints), pa.array(times, ints)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + ["sums", "bests", "rest", "times"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    found = rows.mapInArrow(look_up, schema + ", sums bigint, bests bigint, rest array<bigint>, times array<bigint>")
    # The number of a row is written with it and does not change when it is read again.
    found = materialize(found.withColumn("number", F.monotonically_increasing_id()), "alignment-looked-up")
    each = F.explode(F.arrays_zip("rest", "times")).alias("w")
    others = found.select("number", each).select("number", F.col("w.rest").alias("pair"), F.col("w.times").alias("times"))
    others = others.join(counts, "pair").groupBy("number")
    others = others.agg(F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    both = found.join(others, "number", "left")
    return both.select(
        *[f.name for f in kept],
        (F.col("bests") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("sums") + F.coalesce("more", F.lit(0))).alias("count_sum"),
    )


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    tidy(spark)
    paths = tokenizer_paths()
    both = pair(*paths)
    path = work_dir(spark, "alignment")
    with temporary_work(spark):
        rows = materialize(aligned(docs, *paths), "alignment-links")
        result = with_counts(rows, both.pair_kind, both.shift).select(
            F.col("id").alias("doc_id"),
            "n_a",
            "n_b",
            F.col("n_links").alias("n_groups"),
            "n_links",
            "n_best",
            "count_sum",
            "groups_sha256",
        )
        result.write.parquet(path)
    return spark.read.schema(result.schema).parquet(path)
