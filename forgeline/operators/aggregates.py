"""Grouped counts, sums and row selection. All use map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import exact_sum
from ..functions.dates import epoch_to_date, time_id
from .joins import join_to_groups

# Rows which a task of `distinct_rows` takes, about.
ROWS_PER_TASK = 1_000_000


def order_part_stats(log: DataFrame, unit: str = "ms") -> DataFrame:
    """Per (order, part): how many were made and the latest year of production."""
    return log.groupBy("order", "partId").agg(
        F.count("*").alias("quantity"),
        F.max(F.year(epoch_to_date("timeOfProduction", unit))).alias("maxYear"),
    )


def part_prices(bridge: DataFrame, dedupe_parts: bool = False) -> DataFrame:
    """One price per part. The bridge repeats a part per material and machine; the plain form
    adds the price up over the repeats, ``dedupe_parts`` counts it once."""
    if dedupe_parts:
        priced = bridge.groupBy("partId").agg(F.max("defaultPrice").alias("unitPrice"))
    else:
        priced = bridge.groupBy("partId").agg(exact_sum("defaultPrice").alias("unitPrice"))
    return priced


def order_cash(quantities: DataFrame, bridge: DataFrame, dedupe_parts: bool = False, weight: str | None = None) -> DataFrame:
    """Cash per order, from a stored table of the parts of each order; with ``weight`` also in how many
    of its rows an order has a priced part. Orders of a part that is in very many go to several tasks."""
    prices = part_prices(bridge, dedupe_parts).join(quantities.groupBy("partId").agg(F.count("*").alias("_rows")), "partId")
    totals = join_to_groups(quantities, prices, ["partId"], "_rows", ["order"]).groupBy("order")
    cash = exact_sum(F.col("unitPrice") * F.col("quantity")).alias("cash")
    return totals.agg(cash, F.count("*").alias(weight)) if weight else totals.agg(cash)


def distinct_rows(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Each row of a stored table's columns once, for columns that nearly tell its rows apart. The width of the shuffle
    follows the rows, so that what a task holds does not grow with them: combining such rows ahead of the shuffle
    saves little and takes memory for all the rows of a scan's task."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(width, rows.count() // rows_per_task + 1), *rows.columns).distinct()


def count_by(rows: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Non-null count of ``column`` per key."""
    return rows.groupBy(*keys).agg(F.count(column).alias(name))


def count_machine_day(fact: DataFrame) -> DataFrame:
    return count_by(fact, ["timeId", "machineId"], "timeOfProduction", "CountProductionMachine")


def count_part_day(fact: DataFrame) -> DataFrame:
    return count_by(fact, ["timeId", "partId"], "timeOfProduction", "CountProductionPart")


def count_garbage_day(fact: DataFrame) -> DataFrame:
    return count_by(filter_damaged(fact), ["timeId"], "timeOfProduction", "GarbageProduction")


def filter_damaged(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("isDamaged") == 1)


def count_purchased_day(sales: DataFrame) -> DataFrame:
    """Sold parts per sale day. The key is a DATE first, so the result cannot outgrow the
    calendar."""
    per_day = count_by(sales.filter(F.col("date").isNotNull()), ["date"], "partId", "PartPurchasedPerDay")
    return per_day.select(time_id("date").alias("timeId"), "PartPurchasedPerDay")


def sum_material_cost(fact: DataFrame) -> DataFrame:
    """Sum of the distinct material prices per quote date."""
    return (
        fact.select("materialId", "materialPriceDate", "materialPrice")
        .distinct()
        .groupBy("materialPriceDate")
        .agg(exact_sum("materialPrice").alias("CostMaterialPricePerDay"))
    )


def sum_part_cost(fact: DataFrame) -> DataFrame:
    """Sum of the part prices per production day, over all fact rows."""
    return fact.groupBy("timeId").agg(exact_sum("partDefaultPrice").alias("CostPartPricePerDay"))


def max_plus_one(table: DataFrame, column: str) -> DataFrame:
    """The next free id of a table; 1 when it is empty."""
    return table.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("bigint").alias("nextId"))


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key, newest by ``order``."""
    ranking: Column = F.struct(*order)
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), ranking).alias("_row"))
        .select(*keys, "_row.*")
        .select(*rows.columns)
    )
