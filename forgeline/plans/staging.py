"""Raw inputs to the operational star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cells, dates
from ..operators import aggregates, joins
from ..session import materialize

# The calendar's first and last day.
CALENDAR_START = "1920-01-01"
CALENDAR_END = "2099-01-01"
# Fixed value: steps of the month-wise calendar.
CALENDAR_MONTH_STEPS = 365 * 179 + 44


def build_material_price(materials: DataFrame, run_ts: Column, fmt: str = "MM-dd-yyyy") -> DataFrame:
    """One row per price quote. Materials without a price list drop out; a quote with a bad
    date stays, with a NULL date."""
    quotes = materials.select(
        F.col("id").alias("materialId"), "name", F.explode(cells.parse_price_history("prices")).alias("quote")
    )
    return quotes.select(
        "name",
        F.col("quote.price").alias("price"),
        dates.parse_date("quote.d", fmt).alias("date"),
        "materialId",
    ).select(
        cells.stable_row_id("materialId", "date", "price").alias("id"),
        "name",
        "price",
        "date",
        "materialId",
        run_ts.alias("lastUpdate"),
    )


def build_part_bridge(parts: DataFrame, run_ts: Column) -> DataFrame:
    """One row per part, material and machine. A sheet of few files has long cells: its rows are dealt out first, so
    that all tasks take part in reading these."""
    width = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        parts.repartition(width, "id", "machine").select(
            F.col("id").alias("partId"),
            "timeToProduce",
            "defaultPrice",
            F.explode(cells.parse_int_list("meterials")).alias("materialId"),
            "machine",
        )
        .withColumn("machineId", F.explode(cells.parse_int_list("machine")))
        .select("partId", "timeToProduce", "defaultPrice", "materialId", "machineId", run_ts.alias("lastUpdate"))
    )


def build_dim_machine(bridge: DataFrame, run_ts: Column) -> DataFrame:
    """The machines some part is made on, each once. Sorted where it is shown or written,
    not here."""
    return bridge.select("machineId").distinct().select("machineId", run_ts.alias("lastUpdate"))


def build_sales(log: DataFrame, bridge: DataFrame, run_ts: Column, dedupe_parts: bool = False) -> DataFrame:
    """One row per part of an order, with the cash of the whole order."""
    # Read three times below; a scan of it costs less than aggregating the log again.
    stats = materialize(aggregates.order_part_stats(log), "order-parts")
    cash = aggregates.order_cash(stats, bridge, dedupe_parts, weight="_rows")
    # An order none of whose parts is known has no cash and no sale.
    priced = joins.join_to_groups(stats, cash, ["order"], "_rows", ["partId"])
    seed = F.col("order") * 31 + F.col("partId") * 17
    return priced.select(
        F.col("order").alias("contractId"),
        "partId",
        cells.prefixed("CLIENT NO_", "order").alias("clientName"),
        "cash",
        dates.date_in_year("maxYear", seed).alias("date"),
        run_ts.alias("lastUpdate"),
    )


def build_dim_contract(sales: DataFrame, run_ts: Column) -> DataFrame:
    return sales.select("contractId", "clientName").distinct().withColumn("lastUpdate", run_ts)


def build_fact_sales(sales: DataFrame) -> DataFrame:
    return sales.select("partId", "contractId", "cash", "date", "lastUpdate")


def build_dim_material(materials: DataFrame, run_ts: Column) -> DataFrame:
    return materials.select(F.col("id").alias("materialId"), "name", run_ts.alias("lastUpdate"))


def build_dim_part(parts: DataFrame, run_ts: Column) -> DataFrame:
    """A part may take several rows of the reference, one per bucket of machines."""
    return parts.select(F.col("id").alias("partId"), "timeToProduce").distinct().withColumn("lastUpdate", run_ts)


def date_spine(spark: SparkSession, start: str, steps: int, step: str = "day") -> DataFrame:
    """``steps`` dates from ``start`` on, by day or by month."""
    i = F.col("id").cast("int")
    first = F.lit(start).cast("date")
    date = F.add_months(first, i) if step == "month" else F.date_add(first, i)
    return spark.range(steps).select(date.alias("date"))


def calendar_columns(spine: DataFrame) -> DataFrame:
    return spine.select(
        dates.time_id("date").alias("timeId"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        dates.semester(F.quarter("date")).alias("semester"),
        F.quarter("date").alias("quarter"),
    )


def build_dim_time(spark: SparkSession, step: str = "day") -> DataFrame:
    """The calendar: every day from first to last, both included. ``step='month'`` walks by
    month for as many rows as the day count of the original definition."""
    if step == "month":
        return calendar_columns(date_spine(spark, CALENDAR_START, CALENDAR_MONTH_STEPS, "month"))
    first, last = F.lit(CALENDAR_START).cast("date"), F.lit(CALENDAR_END).cast("date")
    return calendar_columns(spark.range(1).select(F.explode(F.sequence(first, last)).alias("date")))


def production_days(log: DataFrame, unit: str = "ms") -> DataFrame:
    """The log with its epoch as a day and as a calendar key."""
    day = log.withColumn("timeOfProduction", dates.epoch_to_date("timeOfProduction", unit))
    return day.withColumn("timeId", dates.time_id("timeOfProduction"))


def build_fact_supply_chain(
    log: DataFrame, bridge: DataFrame, quotes: DataFrame, machines: DataFrame, run_ts: Column, unit: str = "ms"
) -> DataFrame:
    """One row per log row, material of its part and price quote of the year."""
    slim = production_days(log.select("partId", "machineId", "timeOfProduction", "var5"), unit)
    made = joins.keep_known(joins.join_log_parts(slim, bridge), machines, "machineId")
    return joins.join_quotes_same_year(made, quotes).select(
        "machineId",
        "partId",
        "materialId",
        "timeOfProduction",
        "materialPrice",
        "timeId",
        "materialPriceDate",
        F.col("defaultPrice").alias("partDefaultPrice"),
        F.col("var5").alias("isDamaged"),
        run_ts.alias("lastUpdate"),
    )
