"""Joins, aggregates, sorts and checks over the staged and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, joins, quality
from ..operators.keys import number_rows
from ..plans import marts, staging
from ..session import materialize
from .registry import Inputs, query

# -- joins ---------------------------------------------------------------------------------


@query(
    "join_log_parts",
    """SELECT l."order", l.partId, l.machineId, l.timeOfProduction, l.var5, b.materialId, b.defaultPrice
FROM v_log l JOIN v_bridge b ON l.partId = b.partId AND l.machineId = b.machineId""",
)
def join_log_parts(i: Inputs) -> DataFrame:
    return joins.join_log_parts(i.log, i.bridge)


@query(
    "join_quotes_same_year",
    """SELECT o.o_orderkey, o.materialId, CAST(o.o_orderdate AS DATE) AS day, q.price AS materialPrice,
  q.date AS materialPriceDate
FROM (SELECT *, o_custkey % 25 AS materialId FROM orders) o JOIN v_quotes q
  ON q.materialId = o.materialId AND year(q.date) = year(o.o_orderdate)""",
)
def join_quotes_same_year(i: Inputs) -> DataFrame:
    rows = i.table("orders").select(
        "o_orderkey", (F.col("o_custkey") % 25).alias("materialId"), F.col("o_orderdate").cast("date").alias("day")
    )
    return joins.join_quotes_same_year(rows, i.quotes, "day")


@query("join_machine_dim", "SELECT * FROM v_log WHERE machineId IN (SELECT machineId FROM v_machines)")
def join_machine_dim(i: Inputs) -> DataFrame:
    return joins.keep_known(i.log, i.ods("dim_machine"), "machineId").select(i.log.columns)


@query(
    "orphan_rows",
    """SELECT * FROM v_log WHERE (partId, machineId) NOT IN (SELECT (part1, machine) FROM v_msg WHERE topic = 'supply_chain')""",
)
def orphan_rows(i: Inputs) -> DataFrame:
    """Log rows whose machine is not among those that the supply-chain messages name for their part."""
    links = i.supply_rows.select(F.struct(F.col("trscPartId").alias("partId"), F.col("trscMachineId").alias("machineId")).alias("link"))
    rows = i.log.withColumn("link", F.struct("partId", "machineId"))
    return joins.orphans(rows, links, "link").select(i.log.columns)


@query(
    "check_foreign_keys",
    """SELECT 'machineId' AS key, count(*) AS orphans FROM v_msg WHERE topic = 'machine'
  AND user_id NOT IN (SELECT machineId FROM v_machines) HAVING count(*) > 0
UNION ALL SELECT 'partId', count(*) FROM v_msg WHERE topic = 'machine'
  AND user_id NOT IN (SELECT p_partkey FROM part) HAVING count(*) > 0
UNION ALL SELECT 'materialId', count(*) FROM v_msg WHERE topic = 'machine'
  AND user_id NOT IN (SELECT n_nationkey FROM nation) HAVING count(*) > 0""",
)
def check_foreign_keys(i: Inputs) -> DataFrame:
    """The ids of the machine messages held against three dimensions."""
    ids = i.parsed["machine"].select(*[F.col("id").alias(k) for k in ("machineId", "partId", "materialId")])
    dims = {
        "machineId": i.ods("dim_machine"),
        "partId": i.ods("dim_part_information"),
        "materialId": i.ods("dim_material"),
    }
    return quality.check_foreign_keys(ids, dims)


@query(
    "join_quantity_parts",
    """SELECT o."order", o.partId, o.quantity, b.materialId, b.machineId, b.defaultPrice
FROM v_order_parts o JOIN v_bridge b ON o.partId = b.partId""",
)
def join_quantity_parts(i: Inputs) -> DataFrame:
    quantities = aggregates.order_part_stats(i.log).drop("maxYear")
    return quantities.join(i.bridge.drop("timeToProduce", "lastUpdate"), "partId")


@query(
    "join_using_order",
    """SELECT "order", o.partId, o.maxYear, round(c.cash, 2) AS cash
FROM (SELECT * REPLACE (CAST(maxYear AS INTEGER) AS maxYear) FROM v_order_parts) o JOIN v_order_cash c USING ("order")""",
)
def join_using_order(i: Inputs) -> DataFrame:
    stats = materialize(aggregates.order_part_stats(i.log), "order-parts")
    cash = aggregates.order_cash(stats, i.bridge, weight="_rows")
    joined = joins.join_to_groups(stats, cash, ["order"], "_rows", ["partId"])
    return joined.select("order", "partId", "maxYear", F.round("cash", 2).alias("cash"))


@query(
    "join_daily_counts",
    "SELECT DISTINCT machineId, partId, timeId, CountProductionMachine, CountProductionPart, GarbageProduction FROM v_mart_supply",
)
def join_daily_counts(i: Inputs) -> DataFrame:
    fact = i.ods("fact_supply_chain")
    return marts.join_daily_counts(fact.select("machineId", "partId", "timeId").distinct(), counted=fact)


@query(
    "join_margin_inputs",
    """SELECT partId, contractId, timeId, round(cash, 2) AS cash, date, PartPurchasedPerDay, materialPriceDate,
  round(CostMaterialPricePerDay, 2) AS CostMaterialPricePerDay, round(CostPartPricePerDay, 2) AS CostPartPricePerDay
FROM v_margin_inputs""",
)
def join_margin_inputs(i: Inputs) -> DataFrame:
    i.ods_with("fact_sales", "fact_supply_chain")
    joined = marts.join_margin_inputs(i.ods("fact_sales"), i.ods("fact_supply_chain"))
    money = ["cash", "CostMaterialPricePerDay", "CostPartPricePerDay"]
    return joined.drop("trscPartId", "trscContractId", "lastUpdate").withColumns({c: F.round(c, 2) for c in money})


@query(
    "lookup_rows",
    "SELECT DISTINCT id AS partId, timeToProduce FROM v_part_raw WHERE id IN (SELECT user_id FROM v_msg WHERE topic = 'part_information')",
)
def lookup_rows(i: Inputs) -> DataFrame:
    wanted = i.parsed["part_information"].select(F.col("id").alias("trscPartId"))
    found = joins.lookup_rows(i.ods("dim_part_information"), wanted, ["trscPartId"])
    return found.select("partId", "timeToProduce")


# -- aggregates --------------------------------------------------------------------------------


@query("count_order_part", 'SELECT "order", partId, quantity FROM v_order_parts')
def count_order_part(i: Inputs) -> DataFrame:
    return aggregates.order_part_stats(i.log).select("order", "partId", "quantity")


@query("max_year_order_part", 'SELECT "order", partId, CAST(maxYear AS INTEGER) AS maxYear FROM v_order_parts')
def max_year_order_part(i: Inputs) -> DataFrame:
    return aggregates.order_part_stats(i.log).select("order", "partId", "maxYear")


@query("sum_order_cash", 'SELECT "order", round(cash, 2) AS cash FROM v_order_cash')
def sum_order_cash(i: Inputs) -> DataFrame:
    cash = aggregates.order_cash(materialize(aggregates.order_part_stats(i.log), "order-parts"), i.bridge)
    return cash.withColumn("cash", F.round("cash", 2))


@query(
    "sum_order_cash_deduped",
    """SELECT o."order", round(sum(p.p_retailprice * o.quantity), 2) AS cash
FROM v_order_parts o JOIN part p ON o.partId = p.p_partkey
WHERE p.p_partkey IN (SELECT partId FROM v_bridge) GROUP BY o."order\"""",
)
def sum_order_cash_deduped(i: Inputs) -> DataFrame:
    stats = materialize(aggregates.order_part_stats(i.log), "order-parts")
    cash = aggregates.order_cash(stats, i.bridge, dedupe_parts=True)
    return cash.withColumn("cash", F.round("cash", 2))


@query(
    "count_machine_day",
    "SELECT timeId, machineId, count(timeOfProduction) AS CountProductionMachine FROM v_fact GROUP BY ALL",
)
def count_machine_day(i: Inputs) -> DataFrame:
    return aggregates.count_machine_day(i.ods("fact_supply_chain"))


@query(
    "count_part_day", "SELECT timeId, partId, count(timeOfProduction) AS CountProductionPart FROM v_fact GROUP BY ALL"
)
def count_part_day(i: Inputs) -> DataFrame:
    return aggregates.count_part_day(i.ods("fact_supply_chain"))


@query(
    "count_garbage_day",
    "SELECT timeId, count(timeOfProduction) AS GarbageProduction FROM v_fact WHERE isDamaged = 1 GROUP BY ALL",
)
def count_garbage_day(i: Inputs) -> DataFrame:
    return aggregates.count_garbage_day(i.ods("fact_supply_chain"))


@query(
    "count_purchased_day",
    "SELECT DISTINCT timeId, PartPurchasedPerDay FROM v_sale_days",
)
def count_purchased_day(i: Inputs) -> DataFrame:
    return aggregates.count_purchased_day(i.ods("fact_sales"))


@query(
    "sum_material_cost",
    "SELECT * REPLACE (round(CostMaterialPricePerDay, 2) AS CostMaterialPricePerDay) FROM v_quote_cost",
)
def sum_material_cost(i: Inputs) -> DataFrame:
    cost = aggregates.sum_material_cost(i.ods("fact_supply_chain"))
    return cost.withColumn("CostMaterialPricePerDay", F.round("CostMaterialPricePerDay", 2))


@query(
    "sum_part_cost",
    "SELECT * REPLACE (round(CostPartPricePerDay, 2) AS CostPartPricePerDay) FROM v_part_cost",
)
def sum_part_cost(i: Inputs) -> DataFrame:
    cost = aggregates.sum_part_cost(i.ods("fact_supply_chain"))
    return cost.withColumn("CostPartPricePerDay", F.round("CostPartPricePerDay", 2))


_QUOTE = "materialId, materialPrice, materialPriceDate, partDefaultPrice"


@query("distinct_rows", f"SELECT DISTINCT partId, {_QUOTE} FROM v_fact")
def distinct_rows(i: Inputs) -> DataFrame:
    return aggregates.distinct_rows(i.ods("fact_supply_chain").select("partId", *_QUOTE.split(", ")))


@query("drop_duplicates_machine", "SELECT machineId, run_ts AS lastUpdate FROM v_machines, v_run")
def drop_duplicates_machine(i: Inputs) -> DataFrame:
    return i.bridge.select("machineId", "lastUpdate").dropDuplicates(["machineId"])


@query("max_plus_one", "SELECT CAST(max(p_partkey) + 1 AS BIGINT) AS nextId FROM part")
def max_plus_one(i: Inputs) -> DataFrame:
    return aggregates.max_plus_one(i.ods("dim_part_information"), "partId")


@query(
    "latest_by_key",
    """SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_by_key(i: Inputs) -> DataFrame:
    events = i.table("events").select("user_id", "event_id", "ts", "event_type", "value")
    return aggregates.latest_by_key(events, ["user_id"], ["ts", "event_id"])


# -- sorts -----------------------------------------------------------------------------------------


@query("sort_machine", "SELECT machineId FROM v_machines ORDER BY machineId")
def sort_machine(i: Inputs) -> DataFrame:
    return i.ods("dim_machine").select("machineId").orderBy("machineId")


@query("sort_fact_supply_chain", "SELECT * FROM v_mart_supply ORDER BY machineId")
def sort_fact_supply_chain(i: Inputs) -> DataFrame:
    """Other columns take part in the ranges, so that rows of one machine can go to several tasks; day and part come
    first of them, as the mart needs its rows by these anyway."""
    order = ["machineId", "timeId", "partId"]
    mart = marts.fact_supply_chain(i.ods("fact_supply_chain"), order=order)
    return mart.orderBy(*order, "materialId", "materialPrice", "materialPriceDate", "partDefaultPrice")


@query(
    "sort_fact_sales",
    """SELECT partId, contractId, timeId, round(cash, 2) AS cash, date, PartPurchasedPerDay,
  round(cash - (CostMaterialPricePerDay + CostPartPricePerDay), 2) AS MarginPerDay FROM v_margin_inputs ORDER BY partId""",
)
def sort_fact_sales(i: Inputs) -> DataFrame:
    """The sales mart by part, the other columns behind it."""
    i.ods_with("fact_sales", "fact_supply_chain")
    mart = marts.fact_sales(i.ods("fact_sales"), i.ods("fact_supply_chain"))
    mart = mart.withColumns({c: F.round(c, 2) for c in ("cash", "MarginPerDay")})
    return mart.orderBy("partId", *[c for c in mart.columns if c != "partId"])


# -- checks ------------------------------------------------------------------------------------------


@query(
    "check_not_null",
    """SELECT * FROM (SELECT 'machineId' AS "column", count(*) AS nulls FROM v_log WHERE machineId % 10 = 3
UNION ALL SELECT 'partId', 0) WHERE nulls > 0""",
)
def check_not_null(i: Inputs) -> DataFrame:
    """The log with the machine blanked out for some machines."""
    machine = F.when(F.col("machineId") % 10 != 3, F.col("machineId"))
    return quality.check_not_null(i.log.withColumn("machineId", machine), ["machineId", "partId"])


@query(
    "check_unique_key",
    """SELECT timeId, machineId, partId, materialId, count(*) AS copies FROM v_mart_supply
GROUP BY ALL HAVING count(*) > 1""",
)
def check_unique_key(i: Inputs) -> DataFrame:
    """Key violations of the supply-chain mart: a material with several quotes in a year."""
    mart = marts.fact_supply_chain(i.ods("fact_supply_chain"))
    return quality.check_unique_key(mart, ["timeId", "machineId", "partId", "materialId"])


@query(
    "number_rows",
    """SELECT event_id, CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS n FROM events WHERE event_type = 'click'""",
)
def numbered(i: Inputs) -> DataFrame:
    """Dense numbers in event order, without one task seeing all events."""
    clicks = i.table("events").filter("event_type = 'click'").select("event_id")
    return number_rows(clicks, "event_id", [], "n", block=64)
