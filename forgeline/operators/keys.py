"""Surrogate keys: existing id of a transactional id, else the next free one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import join_to_groups

# Sequence numbers per numbering block.
BLOCK = 65_536


def number_rows(rows: DataFrame, seq: str, tie: list[str], name: str = "rank", block: int = BLOCK) -> DataFrame:
    """Number rows 1..n in the order of ``seq`` (a non-negative integer), then ``tie``.

    Blocks of consecutive sequence numbers are numbered in parallel and shifted by the
    row counts of the blocks before them. Blocks are a function of ``seq``, so a repeated
    task numbers alike, and no task sees more than one block. The running total over the
    blocks is taken in two levels for the same reason: the last step, the only one
    on one task, has one row per ``block**2`` sequence numbers.
    """
    blocked = rows.withColumn("_b1", F.floor(F.col(seq) / F.lit(block)).cast("long")).withColumn(
        "_b2", F.floor(F.col("_b1") / F.lit(block)).cast("long")
    )
    keys = ["_b2", "_b1"]
    inner = blocked.groupBy(*keys).agg(F.count("*").alias("_n"))
    outer = inner.groupBy("_b2").agg(F.sum("_n").alias("_n"))
    shift_inner = inner.select(
        *keys,
        F.coalesce(
            F.sum("_n").over(
                Window.partitionBy("_b2").orderBy("_b1").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_s1"),
    )
    shift_outer = outer.select(
        "_b2",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_b2").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_s2"),
    )
    numbered = blocked.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(seq, *tie)))
    return (
        numbered.join(shift_inner, keys)
        .join(shift_outer, "_b2")
        .withColumn(name, (F.col("_rn") + F.col("_s1") + F.col("_s2")).cast("bigint"))
        .drop("_b1", "_b2", "_rn", "_s1", "_s2")
    )


def number_in_order(rows: DataFrame, order: list[str], name: str, first: int = 0) -> DataFrame:
    """Number rows from ``first`` on in the order of the columns ``order``, which tell all rows apart.

    Rows are dealt out by range of these columns, so however many share a value of the first of them,
    tasks have about as many rows each. They are stored with their place in the range; the only step on
    one task adds up one row per range. Result, stored: the rows and ``name``.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # Upper bits: the range; lower 33: the place in it.
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "in-order")
    sizes = placed.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), F.shiftright("_at", 33) == F.col("_range")).withColumn(
        name, F.lit(first) + F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    return numbered.drop("_at", "_range", "_start")


def known_keys(dim: DataFrame, trsc: str, key: str) -> DataFrame:
    """One id per transactional id of a table that may hold several versions of it."""
    return dim.filter(F.col(trsc).isNotNull()).groupBy(trsc).agg(F.min(key).alias(key))


def key_bucket(trsc: str, buckets: int) -> Column:
    """The bucket of the key index that a transactional id belongs to."""
    return F.pmod(F.xxhash64(trsc), F.lit(buckets)).cast("int")


def first_seen(seen: DataFrame, trsc: str) -> DataFrame:
    """Each transactional id in ``seen`` (columns ``trsc``, ``seq``) with its first use and number of uses, stored."""
    first = (
        seen.filter(F.col(trsc).isNotNull())
        .groupBy(trsc)
        .agg(F.min("seq").alias("seq"), F.count("*").alias("_rows"))
    )
    return materialize(first, "first-seen")


def assign_surrogate_keys(known: DataFrame, seen: DataFrame, trsc: str, key: str) -> DataFrame:
    """The id of every transactional id in ``seen`` (columns ``trsc``, ``seq``), see `assign_ids`."""
    highest = known.select(F.coalesce(F.max(key), F.lit(0))).scalar()
    return assign_ids(known, first_seen(seen, trsc), trsc, key, highest)


def assign_ids(known: DataFrame, first: DataFrame, trsc: str, key: str, highest: int | Column) -> DataFrame:
    """The id of every transactional id of `first_seen`; ``highest`` is the highest id given so far.

    Known ids stay; unknown ones are numbered above the highest known id in the order they
    were first seen, so the result does not depend on how the stream was cut into batches.
    Two unknown ids never share a number, and an id of a deleted row is not used again as
    long as ``known`` keeps it. Result, stored: ``trsc``, ``key``, ``isNew`` and ``_rows``, the
    times the id was seen.
    """
    # The known ids are only looked through for the few that are asked for: while those fit a
    # broadcast, the known ones are not shuffled.
    found = materialize(known.select(trsc, key).join(first.select(trsc), trsc), "known")
    # Numbering reads its input several times.
    looked_up = materialize(first.join(found, trsc, "left"), "keys")
    old = looked_up.filter(F.col(key).isNotNull())
    new = number_rows(looked_up.filter(F.col(key).isNull()).drop(key), "seq", [trsc]).withColumn(
        key, (F.col("rank") + highest).cast("bigint")
    )
    ids = old.select(trsc, key, F.lit(False).alias("isNew"), "_rows").unionByName(
        new.select(trsc, key, F.lit(True).alias("isNew"), "_rows")
    )
    return materialize(ids, "ids")


def lookup_surrogate(rows: DataFrame, key_map: DataFrame, trsc: str, key: str, how: str = "inner") -> DataFrame:
    """Rows with the id of their transactional id, from `assign_surrogate_keys`."""
    ids = key_map.select(trsc, key, "_rows")
    return join_to_groups(rows, ids, [trsc], "_rows", ["seq"], how, stored=True)
