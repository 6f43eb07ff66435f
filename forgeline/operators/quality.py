"""Key and reference checks. Each returns the violations as rows; `enforce` raises."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column that holds NULLs: (column, nulls)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return counts.select(F.inline(pairs)).filter("nulls > 0")


def check_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key value that occurs more than once: (keys, copies)."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def key_violations(df: DataFrame, required: list[str], key: list[str] | None = None) -> DataFrame:
    """(check, key, rows): columns of ``required`` with NULLs and how many, and the values of ``key`` that
    repeat and how often. A key with a NULL in it repeats nothing, as in SQL."""
    nulls = check_not_null(df, required).select(
        F.lit("not null").alias("check"), F.col("column").alias("key"), F.col("nulls").alias("rows")
    )
    if not key:
        return nulls
    whole = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]))
    repeated = check_unique_key(whole, key)
    name = F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in key])
    return nulls.unionByName(repeated.select(F.lit("unique").alias("check"), name.alias("key"), F.col("copies").alias("rows")))


def check_foreign_keys(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows per reference whose key is missing in its dimension: (key, orphans)."""
    from .joins import orphans

    parts = [
        orphans(fact, dim, key).agg(F.count("*").alias("orphans")).select(F.lit(key).alias("key"), "orphans")
        for key, dim in dims.items()
    ]
    return reduce(DataFrame.unionByName, parts).filter("orphans > 0")


def enforce(violations: DataFrame, what: str) -> None:
    """Raise when there is any violation, naming a few of them."""
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{what}: {[row.asDict() for row in found]}")
