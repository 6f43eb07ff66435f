"""Token ids in compressed files: Re-Pair grammars, one per block, decoded at any place.

A block holds the ids of neighbouring documents. The most frequent pairs of neighbouring symbols
are replaced by nonterminals, again and again; rules, expansion lengths of the rules, the
remaining symbols and the documents' ends are stored as one row of a Parquet file. Prefix sums of
expansion lengths lead to any position without decoding what lies before it.

Rows go to files by range of document id, so files and the blocks in them are in ascending order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .common import packed
from .tokens import encoder

END_ID = 1
#: A block is closed when it has this many ids; a longer document is a block of its own.
BLOCK = 1 << 20
#: Rounds of replacement, pairs per round, and how often a pair occurs at least to be replaced.
ROUNDS = 4
PAIRS = 4096
LEAST = 8
#: Slots of the hashed count of pairs that picks which ones are counted exactly.
SLOTS = 1 << 20
BLOCKS = (
    "part int, block int, first_id bigint, n_ids bigint, terminals bigint, rules binary, lengths binary, symbols binary, "
    "doc_ids array<bigint>, doc_ends array<bigint>"
)


@dataclass(frozen=True)
class Grammar:
    """Symbols below ``terminals`` are ids; ``terminals + r`` expands to the two symbols of rules[r]."""

    terminals: int
    rules: np.ndarray  #: pairs
    lengths: np.ndarray  #: ids that a rule expands to
    symbols: np.ndarray

    def symbol_lengths(self) -> np.ndarray:
        out = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.terminals
        out[rule] = self.lengths[self.symbols[rule] - self.terminals]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols: every rule is opened once per level of nesting."""
        symbols = symbols.astype(np.int64)
        while True:
            rule = symbols >= self.terminals
            if not rule.any():
                return symbols
            size = np.where(rule, 2, 1)
            at = np.cumsum(size) - size
            out = np.empty(int(size.sum()), np.int64)
            out[at[~rule]] = symbols[~rule]
            pairs = self.rules[symbols[rule] - self.terminals]
            out[at[rule]], out[at[rule] + 1] = pairs[:, 0], pairs[:, 1]
            symbols = out

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids start to end, opening only the symbols that reach into them."""
        ends = np.cumsum(self.symbol_lengths())
        first, last = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, end, "left"))
        before = int(ends[first - 1]) if first else 0
        return self.expand(self.symbols[first : last + 1])[start - before : end - before]


def compress(ids: np.ndarray, terminals: int) -> Grammar:
    """The grammar of a block. Each round replaces up to PAIRS of its most frequent pairs; where
    occurrences overlap, the more frequent pair goes first and the others wait for the next round."""
    symbols = ids.astype(np.int64)
    rules, lengths = [], [np.zeros(0, np.int64)]
    total = 0
    for _ in range(ROUNDS):
        if len(symbols) < 2:
            break
        key = symbols[:-1] << 32 | symbols[1:]
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        count = np.bincount(slot, minlength=SLOTS)
        busy = np.sort(count)[-PAIRS]
        asked = np.flatnonzero(count[slot] >= max(LEAST, busy))
        pairs, inverse, often = np.unique(key[asked], return_inverse=True, return_counts=True)
        order = np.lexsort((pairs, -often))
        chosen = order[: int(min(PAIRS, (often >= LEAST).sum()))]
        if not len(chosen):
            break
        rank_of = np.full(len(pairs), -1, np.int64)
        rank_of[chosen] = np.arange(len(chosen))
        rank = np.full(len(symbols) + 1, PAIRS, np.int64)  # by place + 1; PAIRS where nothing is replaced
        ranks = rank_of[inverse]
        rank[asked[ranks >= 0] + 1] = ranks[ranks >= 0]
        here, before, after = rank[1:-1], rank[:-2], rank[2:]
        at = np.flatnonzero((here < PAIRS) & (here < before) & (here <= after))
        new = np.stack([pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF], 1)
        known = np.concatenate(lengths)
        side = [np.where(new[:, k] < terminals, 1, known[np.maximum(new[:, k] - terminals, 0)] if len(known) else 1) for k in (0, 1)]
        rules.append(new)
        lengths.append(side[0] + side[1])
        symbols[at] = terminals + total + here[at]
        symbols = np.delete(symbols, at + 1)
        total += len(new)
    empty = np.zeros((0, 2), np.int64)
    return Grammar(terminals, np.concatenate([empty, *rules]), np.concatenate(lengths), symbols)


def write(docs: DataFrame, tokenizer: str, path: str, text: str = "text", doc_id: str = "doc_id") -> None:
    """Write the ids of all documents, each with the end id, in ascending order of id.

    Null and empty texts are the end id alone. Rows without an id come first, rows that repeat
    one follow each other. An empty table gives files without rows. Other columns play no part.
    """
    base = packed(docs, id=f"{doc_id}:bigint", text=text).drop("row")
    ordered = base.repartitionByRange("id").sortWithinPartitions("id")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        terminals = max(encode.tokenizer.get_vocab_size(), END_ID + 1)
        names, ids, held = [], [], 0

        def block() -> pa.RecordBatch:
            whole = np.concatenate(ids).astype(np.int64)
            made = compress(whole, terminals)
            row = {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([number], pa.int32()),
                "first_id": pa.array([names[0]], pa.int64()),
                "n_ids": pa.array([len(whole)], pa.int64()),
                "terminals": pa.array([terminals], pa.int64()),
                "rules": pa.array([made.rules.astype("<u4").tobytes()], pa.binary()),
                "lengths": pa.array([made.lengths.astype("<u4").tobytes()], pa.binary()),
                "symbols": pa.array([made.symbols.astype("<u4").tobytes()], pa.binary()),
                "doc_ids": pa.array([names], pa.list_(pa.int64())),
                "doc_ends": pa.array([np.cumsum([len(x) for x in ids])], pa.list_(pa.int64())),
            }
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for name, found in zip(batch.column("id"), encode.column(batch.column("text"))):
                names.append(name.as_py())
                ids.append(np.append(found, found.dtype.type(END_ID)))
                held += len(ids[-1])
                if held >= BLOCK:
                    yield block()
                    names, ids, held, number = [], [], 0, number + 1
        if names:
            yield block()

    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(path)


def grammar(row: dict) -> Grammar:
    values = {c: np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("rules", "lengths", "symbols")}
    return Grammar(row["terminals"], values["rules"].reshape(-1, 2), values["lengths"], values["symbols"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (little-endian unsigned 32-bit): the
    documents back from the files, in blocks that are decoded independently of each other.

    Starts come from the blocks' sizes: those of one file are summed by a window over its
    blocks, and the files' sums, one row each, by a window over the files.
    """
    stored = spark.read.schema(BLOCKS).parquet(path)
    sizes = stored.select("part", "block", "n_ids")
    files = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    files = files.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("file_start"))
    inside = Window.partitionBy("part").orderBy("block")
    starts = sizes.withColumn("inside", F.sum("n_ids").over(inside) - F.col("n_ids"))
    starts = starts.join(files, F.col("part") == F.col("p")).select(
        F.col("part").alias("p"), F.col("block").alias("b"), (F.col("file_start") + F.col("inside")).alias("block_start")
    )
    rows = stored.join(starts, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b"))).drop("p", "b")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                made = grammar(row)
                whole = made.expand(made.symbols).astype("<u4")
                ends = row["doc_ends"]
                bodies = [whole[a:b].tobytes() for a, b in zip([0, *ends], ends)]
                starts = row["block_start"] + np.array([0, *ends[:-1]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(bodies, pa.binary())],
                    names=["doc_id", "start", "ids"],
                )

    return rows.mapInArrow(documents, "doc_id bigint, start bigint, ids binary")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = work_dir(spark, "token-ids")
    write(docs, tokenizer_path(), path)
    rows = read(spark, path)
    return rows.select(
        "doc_id", "start", F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
