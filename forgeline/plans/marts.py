"""Operational star schema to reporting marts.

The inputs are meant to be stored tables: each count scans its two or three columns, which
costs less than carrying the wide rows through one more shuffle.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.cells import margin
from ..functions.dates import time_id
from ..operators import aggregates, joins
from ..session import materialize, materialize_alone, run_together

_FACT_COLUMNS = [
    "machineId",
    "partId",
    "materialId",
    "timeId",
    "materialPrice",
    "materialPriceDate",
    "partDefaultPrice",
]


_PLACE = ["timeId", "machineId", "partId"]
_COUNTS = ["CountProductionMachine", "CountProductionPart", "GarbageProduction"]
# Fact rows which a task of the mart's own shuffle takes, about.
_ROWS_PER_TASK = 1_000_000


def _places(fact: DataFrame) -> DataFrame:
    """Per day, machine and part what the daily counts add up, stored."""
    damaged = F.col("isDamaged") == 1
    places = fact.groupBy(*_PLACE).agg(
        F.count("timeOfProduction").alias("_made"),
        F.count(F.when(damaged, F.col("timeOfProduction"))).alias("_garbage"),
        F.count_if(damaged).alias("_damaged"),
        F.count("*").alias("_rows"),
    )
    return materialize(places, "places")


def _day_counts(places: DataFrame) -> list[DataFrame]:
    """The three daily counts of the mart, stored, each with ``_rows``: how many of the places
    share its key."""
    made, rows = F.sum("_made"), F.count("*").alias("_rows")
    counts = [
        places.groupBy("timeId", "machineId").agg(made.alias("CountProductionMachine"), rows),
        places.groupBy("timeId", "partId").agg(made.alias("CountProductionPart"), rows),
        places.groupBy("timeId").agg(
            F.sum("_garbage").alias("GarbageProduction"),
            F.sum("_damaged").alias("_damaged"),
            rows,
        ),
    ]
    return run_together(places.sparkSession, [partial(materialize, df, "day-counts") for df in counts])


def _join_counts(rows: DataFrame, counted: DataFrame, keep_undamaged: bool) -> DataFrame:
    """``rows``, one per day, machine and part, with the counts over the places ``counted``."""
    by_machine, by_part, by_day = _day_counts(counted)
    if not keep_undamaged:
        by_day = by_day.filter("_damaged > 0")
    joined = rows
    for groups, key, spread in (
        (by_machine, ["timeId", "machineId"], ["partId"]),
        (by_part, ["timeId", "partId"], ["machineId"]),
        (by_day.drop("_damaged"), ["timeId"], ["machineId", "partId"]),
    ):
        joined = joins.join_to_groups(joined, groups, key, "_rows", spread, stored=True)
    return joined


def join_daily_counts(fact: DataFrame, keep_undamaged: bool = False, counted: DataFrame | None = None) -> DataFrame:
    """Fact rows with the production counts of their machine and day, of their part
    and day, and with the damaged count of the day.

    Days without a damaged unit drop out unless ``keep_undamaged``. ``counted`` is the table
    the counts run over, when that is not the fact itself.

    The counts depend on day, machine and part alone, so they are joined to one row of each first; the fact
    takes part in one join only, and in none when it has no other columns.
    """
    wide = [c for c in fact.columns if c not in _PLACE]
    if counted is None:
        places = _places(fact)
        return _on_places(fact, _join_counts(places.select(*_PLACE), places, keep_undamaged))
    if not wide:
        return _join_counts(fact, _places(counted), keep_undamaged)
    return _on_places(fact, _join_counts(fact.select(*_PLACE).distinct(), _places(counted), keep_undamaged))


def _on_places(rows: DataFrame, counts: DataFrame) -> DataFrame:
    return rows.join(materialize(counts, "place-counts"), _PLACE)


def fact_supply_chain(
    fact: DataFrame, keep_undamaged: bool = False, unit_log: DataFrame | None = None, order: list[str] | None = None
) -> DataFrame:
    """The supply-chain mart. With ``unit_log`` (one row per produced unit) the counts are of
    units; without it they are of fact rows, which repeat a unit per material and quote. With ``order``, which
    are day, machine and part in some order, the rows lie in ranges of these and are sorted by them and the fact's other
    columns."""
    spark, total = fact.sparkSession, 0

    def counted() -> DataFrame:
        nonlocal total
        places = _places(fact)
        total = places.agg(F.sum("_rows")).first()[0] or 0
        return _join_counts(places.select(*_PLACE), places if unit_log is None else _places(unit_log), keep_undamaged)

    counts = materialize_alone(spark, counted, "place-counts")
    # DISTINCT and the counts need the rows of a place together: one shuffle serves both. Its width follows the
    # rows, so that a task's share does not grow with them.
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // _ROWS_PER_TASK + 1)
    rows = fact.select(*_FACT_COLUMNS)
    if order is None:
        marked = rows.repartition(width, *_PLACE).distinct().join(counts, _PLACE)
    else:
        # A join would shuffle the ranges again, so the counts take part in the shuffle as rows of their own.
        both = rows.unionByName(counts, allowMissingColumns=True).repartitionByRange(width, *order).distinct()
        others = [c for c in _FACT_COLUMNS if c not in order]
        place = Window.partitionBy(*order).orderBy(*others).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        marked = both.withColumns({"_own": F.col(_COUNTS[0]).isNull()} | {c: F.max(c).over(place) for c in _COUNTS})
        marked = marked.filter(F.col("_own") & F.col(_COUNTS[0]).isNotNull())
    return marked.select(*_FACT_COLUMNS, *_COUNTS)


def join_margin_inputs(sales: DataFrame, fact: DataFrame) -> DataFrame:
    """Sales with the purchases and the part cost of their day, once per material quote date
    of their year. A sale drops out when its day has no production or its year no quote."""
    purchased = aggregates.count_purchased_day(sales)
    day = purchased.join(aggregates.sum_part_cost(fact), "timeId")
    quotes = aggregates.sum_material_cost(fact).withColumn("_year", F.year("materialPriceDate"))
    # Both sides have at most one row per calendar day (a DATE has 3.7 million values), so
    # the broadcast stays small and the sales are not shuffled at all.
    return (
        sales.withColumn("timeId", time_id("date"))
        .withColumn("_year", F.year("date"))
        .join(F.broadcast(day), "timeId")
        .join(F.broadcast(quotes), "_year")
        .drop("_year")
    )


def fact_sales(sales: DataFrame, fact: DataFrame) -> DataFrame:
    """The sales mart: purchases of the day and margin against the costs of the day."""
    return join_margin_inputs(sales, fact).select(
        "partId",
        "contractId",
        "timeId",
        "cash",
        "date",
        "PartPurchasedPerDay",
        margin("cash", "CostMaterialPricePerDay", "CostPartPricePerDay").alias("MarginPerDay"),
    )


def project_dim(dim: DataFrame, table: str) -> DataFrame:
    """An operational dimension cut to its reporting columns."""
    return dim.select(*table_columns(table, "dwh"))


def current_dim(dim: DataFrame, table: str, order: list[str]) -> DataFrame:
    """The reporting dimension of a table that may hold several versions of an entity: the
    newest one by ``order``."""
    key = schemas.KEYS[table]
    return project_dim(aggregates.latest_by_key(dim, key, order), table)


def table_columns(table: str, layer: str) -> list[str]:
    return schemas.table_schema(table, layer).fieldNames()
