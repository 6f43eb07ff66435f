"""Composed tables: staging builds and reporting marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import marts, staging
from .registry import Inputs, query


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query(
    "build_dim_material_price",
    "SELECT name, price, date, materialId, run_ts AS lastUpdate FROM v_quotes, v_run",
)
def build_dim_material_price(i: Inputs) -> DataFrame:
    return i.quotes.drop("id")


@query(
    "build_part_bridge",
    "SELECT partId, timeToProduce, defaultPrice, materialId, machineId, run_ts AS lastUpdate FROM v_bridge, v_run",
)
def build_part_bridge(i: Inputs) -> DataFrame:
    return i.bridge


@query("build_dim_machine", "SELECT machineId, run_ts AS lastUpdate FROM v_machines, v_run")
def build_dim_machine(i: Inputs) -> DataFrame:
    return i.machines


_SALES = "SELECT contractId, partId, clientName, round(cash, 2) AS cash, date, run_ts AS lastUpdate FROM {}, v_run"


@query("build_fact_sales_ods", _SALES.format("v_sales"))
def build_fact_sales_ods(i: Inputs) -> DataFrame:
    return rounded(i.sales, "cash")


@query(
    "build_fact_sales_ods_deduped",
    """SELECT s.contractId, s.partId, s.clientName, round(c.cash, 2) AS cash, s.date, run_ts AS lastUpdate
FROM v_sales s JOIN (SELECT o."order", sum(p.p_retailprice * o.quantity) AS cash
  FROM v_order_parts o JOIN part p ON o.partId = p.p_partkey
  WHERE p.p_partkey IN (SELECT partId FROM v_bridge) GROUP BY o."order") c ON c."order" = s.contractId, v_run""",
)
def build_fact_sales_ods_deduped(i: Inputs) -> DataFrame:
    """Each part's price counted once, not once per material and machine."""
    return rounded(staging.build_sales(i.log, i.bridge, i.run_ts, dedupe_parts=True), "cash")


_CALENDAR = """SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS timeId, date, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CASE WHEN quarter(date) IN (1, 2) THEN 1 ELSE 2 END AS semester, CAST(quarter(date) AS INTEGER) AS quarter
FROM {}"""


def _calendar_sql(spine: str, counts: str) -> str:
    return _CALENDAR.format(spine).replace("FROM", ", coalesce(n, 0) AS rowsOfDay FROM", 1) + f" LEFT JOIN ({counts}) USING (date)"


def with_row_counts(calendar: DataFrame, rows: DataFrame, date: str) -> DataFrame:
    """The calendar with the number of rows of each day, days without any included."""
    counts = rows.groupBy(F.col(date).alias("date")).agg(F.count("*").alias("n"))
    return calendar.join(counts, "date", "left").select(
        *calendar.columns, F.coalesce("n", F.lit(0)).alias("rowsOfDay")
    )


_LOG_COUNTS = "SELECT timeOfProduction AS date, count(*) AS n FROM v_log_days GROUP BY 1"


@query("build_dim_time", _calendar_sql("v_calendar", _LOG_COUNTS))
def build_dim_time(i: Inputs) -> DataFrame:
    """The whole calendar, with the log rows of each day."""
    log = staging.production_days(i.log)
    return with_row_counts(staging.build_dim_time(i.spark), log, "timeOfProduction")


@query(
    "build_dim_time_monthly",
    _calendar_sql(
        "(SELECT CAST(DATE '1920-01-01' + to_months(CAST(n AS INTEGER)) AS DATE) AS date FROM range(65379) AS t(n))",
        _LOG_COUNTS,
    ),
)
def build_dim_time_monthly(i: Inputs) -> DataFrame:
    log = staging.production_days(i.log)
    return with_row_counts(staging.build_dim_time(i.spark, step="month"), log, "timeOfProduction")


@query("mart_dim_time", _calendar_sql("v_calendar", "SELECT date, count(*) AS n FROM v_sales GROUP BY 1"))
def mart_dim_time(i: Inputs) -> DataFrame:
    """The reporting calendar, with the sales of each day."""
    return with_row_counts(marts.project_dim(i.ods("dim_time"), "dim_time"), i.ods("fact_sales"), "date")


@query(
    "date_spine",
    """SELECT s.date, coalesce(c.n, 0) AS rowsOfDay FROM (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders) s
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1) c USING (date)""",
)
def date_spine(i: Inputs) -> DataFrame:
    """Every day between the first and the last order, with its orders."""
    orders = i.table("orders").select(F.col("o_orderdate").cast("date").alias("day"))
    span = orders.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return with_row_counts(span.select(F.explode(F.sequence("a", "b")).alias("date")), orders, "day")


@query("build_dim_material", "SELECT CAST(n_nationkey AS BIGINT) AS materialId, n_name AS name, run_ts AS lastUpdate FROM nation, v_run")
def build_dim_material(i: Inputs) -> DataFrame:
    return staging.build_dim_material(i.material_raw, i.run_ts)


@query("build_dim_part", "SELECT p_partkey AS partId, CAST(p_size AS DOUBLE) AS timeToProduce, run_ts AS lastUpdate FROM part, v_run")
def build_dim_part(i: Inputs) -> DataFrame:
    return staging.build_dim_part(i.part_raw, i.run_ts)


@query("build_dim_contract", "SELECT DISTINCT contractId, clientName, run_ts AS lastUpdate FROM v_sales, v_run")
def build_dim_contract(i: Inputs) -> DataFrame:
    return staging.build_dim_contract(i.sales, i.run_ts)


@query("build_fact_supply_chain_ods", "SELECT f.*, run_ts AS lastUpdate FROM v_fact f, v_run")
def build_fact_supply_chain_ods(i: Inputs) -> DataFrame:
    return staging.build_fact_supply_chain(i.log, i.bridge, i.quotes, i.machines, i.run_ts)


@query("mart_fact_supply_chain", "SELECT * FROM v_mart_supply")
def mart_fact_supply_chain(i: Inputs) -> DataFrame:
    return marts.fact_supply_chain(i.ods("fact_supply_chain"))


@query("mart_fact_supply_chain_all_days", "SELECT * FROM v_mart_supply_all")
def mart_fact_supply_chain_all_days(i: Inputs) -> DataFrame:
    """Days without a damaged unit kept, with a count of 0."""
    return marts.fact_supply_chain(i.ods("fact_supply_chain"), keep_undamaged=True)


@query(
    "mart_fact_supply_chain_units",
    """SELECT * FROM (SELECT DISTINCT machineId, partId, materialId, timeId, materialPrice, materialPriceDate, partDefaultPrice,
  (SELECT count(*) FROM v_log_days u WHERE u.timeId = f.timeId AND u.machineId = f.machineId) AS CountProductionMachine,
  (SELECT count(*) FROM v_log_days u WHERE u.timeId = f.timeId AND u.partId = f.partId) AS CountProductionPart,
  (SELECT count(*) FROM v_log_days u WHERE u.timeId = f.timeId AND u.var5 = 1) AS GarbageProduction
FROM v_fact f) WHERE GarbageProduction > 0""",
)
def mart_fact_supply_chain_units(i: Inputs) -> DataFrame:
    """Counts of produced units, taken before a unit is repeated per material and quote."""
    units = staging.production_days(i.log).withColumnRenamed("var5", "isDamaged")
    return marts.fact_supply_chain(i.ods("fact_supply_chain"), unit_log=units)


@query(
    "mart_fact_sales",
    """SELECT partId, contractId, timeId, round(cash, 2) AS cash, date, PartPurchasedPerDay,
  round(cash - (CostMaterialPricePerDay + CostPartPricePerDay), 2) AS MarginPerDay FROM v_margin_inputs""",
)
def mart_fact_sales(i: Inputs) -> DataFrame:
    return rounded(marts.fact_sales(i.ods("fact_sales"), i.ods("fact_supply_chain")), "cash")
