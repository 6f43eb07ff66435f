"""Equi-joins that survive a hot key.

A join of two plain inputs is left to Catalyst: it broadcasts below the size threshold and
otherwise sort-merges, where AQE splits skewed partitions. AQE cannot do that when one side
is an aggregate sitting on its own shuffle, which is the common case here (rows joined back
to a count or a total of their group). `join_to_groups` covers that case explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Rows of one key which a single task may take before the key is split.
ROWS_PER_SPLIT = 4_000_000


def join_to_groups(
    rows: DataFrame,
    groups: DataFrame,
    on: list[str],
    weight: str,
    spread: list[str],
    how: str = "inner",
    rows_per_split: int = ROWS_PER_SPLIT,
    stored: bool = False,
) -> DataFrame:
    """Join ``rows`` to ``groups``, which has one row per key and says in ``weight`` how many
    rows carry that key (an estimate will do). ``weight`` itself is not in the result.

    The groups are written out first (unless ``stored`` says they come from a table), as they
    are read more than once; the planner then knows their size and, when they are small, broadcasts them instead of shuffling the
    rows. A key heavier than ``rows_per_split`` is cut into several: its group row is
    repeated per piece, and ``rows`` pick a piece by a hash of the ``spread`` columns, which
    have to tell apart the rows of a key. The list of heavy keys is broadcast; it has at most
    ``total rows / rows_per_split`` entries (250,000 for 10^12 rows), so its size is
    bounded however the keys are distributed.
    """
    if not stored:
        groups = materialize(groups, "groups")
    heavy = groups.filter(F.col(weight) > rows_per_split)
    if heavy.isEmpty():
        return rows.join(groups.drop(weight), on, how)
    pieces = (F.col(weight) / F.lit(rows_per_split)).cast("int") + 1
    # A piece depends on the row's values alone, so a task run again picks the same one.
    picked = (
        rows.join(F.broadcast(heavy.select(*on, pieces.alias("_pieces"))), on, "left")
        .withColumn(
            "_piece",
            F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(*spread), F.col("_pieces").cast("long")).cast("int")
            ),
        )
        .drop("_pieces")
    )
    last = F.when(F.col(weight) > rows_per_split, pieces - 1).otherwise(F.lit(0))
    repeated = groups.withColumn("_piece", F.explode(F.sequence(F.lit(0), last))).drop(weight)
    return picked.join(repeated, [*on, "_piece"], how).drop("_piece")


def join_log_parts(log: DataFrame, bridge: DataFrame) -> DataFrame:
    """Machine log rows with the part information of the same part and machine: one row per
    material of the part."""
    parts = bridge.select("partId", "machineId", "materialId", "defaultPrice")
    return log.join(parts, ["partId", "machineId"], "inner")


def join_quotes_same_year(rows: DataFrame, quotes: DataFrame, date: str = "timeOfProduction") -> DataFrame:
    """Rows with every price quote of their material in the year of ``date``."""
    priced = quotes.select(
        "materialId",
        F.year("date").alias("_year"),
        F.col("price").alias("materialPrice"),
        F.col("date").alias("materialPriceDate"),
    )
    return (
        rows.withColumn("_year", F.year(date)).join(priced, ["materialId", "_year"], "inner").drop("_year")
    )


def keep_known(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in the dimension. A semi join, so that a dimension holding a
    key twice cannot multiply rows."""
    return rows.join(dim.select(key), [key], "left_semi")


def orphans(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key is missing from the dimension (NULL keys included)."""
    return rows.join(dim.select(key), [key], "left_anti")


def lookup_rows(table: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """Point reads as one set: the table rows for a list of keys."""
    return table.join(wanted.select(*on).distinct(), on, "left_semi")


def delete_by_key(table: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows left after deleting every listed key. A NULL key matches nothing, as in SQL.

    The keys are written out first, each once: the planner then knows their true size and the table is not shuffled
    while they fit a broadcast, and beyond that the join has two plain scans below it, whose skewed partitions AQE splits."""
    return table.join(materialize(deletes.select(*keys).distinct(), "deleted"), keys, "left_anti")
