"""The whole batch run: raw inputs to operational tables to reporting tables."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession

from .. import schemas
from ..operators.layers import to_ods
from ..session import materialize, run_together, temporary_work
from ..sinks import published
from ..sources.tables import scan_table
from . import marts, staging


def load_ods(
    log: DataFrame, parts: DataFrame, materials: DataFrame, spark: SparkSession, run_ts: Column, root: str,
    names: Collection[str] = schemas.TABLE_NAMES,
) -> None:
    """Build the operational tables from the raw inputs and write them, all or those in ``names``.

    What several tables are built from is written first and read back: the part bridge, its
    machines and the priced orders, each only if one of the tables needs it. Rows whose key does not fit its type go to
    ``rejects``; a table that has its keys in their types already is not looked through for them.
    """
    with temporary_work(spark):
        quotes = staging.build_material_price(materials, run_ts)
        tables = {}
        if {"dim_machine", "dim_contract", "fact_sales", "fact_supply_chain"} & set(names):
            bridge = materialize(staging.build_part_bridge(parts, run_ts), "bridge")
            stored = {
                "sales": (("dim_contract", "fact_sales"), lambda: staging.build_sales(log, bridge, run_ts)),
                "machines": (("dim_machine", "fact_supply_chain"), lambda: staging.build_dim_machine(bridge, run_ts)),
            }
            needed = [label for label, (users, _) in stored.items() if set(users) & set(names)]
            jobs = [lambda label=label: materialize(stored[label][1](), label) for label in needed]
            built = dict(zip(needed, run_together(spark, jobs), strict=True))
            if "sales" in built:
                tables["dim_contract"] = staging.build_dim_contract(built["sales"], run_ts)
                tables["fact_sales"] = staging.build_fact_sales(built["sales"])
            if "machines" in built:
                tables["dim_machine"] = built["machines"]
                tables["fact_supply_chain"] = staging.build_fact_supply_chain(log, bridge, quotes, built["machines"], run_ts)
        tables["dim_material"] = staging.build_dim_material(materials, run_ts)
        tables["dim_part_information"] = staging.build_dim_part(parts, run_ts)
        tables["dim_time"] = staging.build_dim_time(spark)
        conformed = {name: to_ods(tables[name], name) for name in schemas.TABLE_NAMES if name in names}
        published.load_star_schema({name: rows for name, (rows, _) in conformed.items()}, root)
        lost = reduce(DataFrame.unionByName, [rejects for _, rejects in conformed.values()])
        lost.write.mode("append").parquet(f"{root}/rejects")


def build_marts(spark: SparkSession, ods_root: str) -> dict[str, DataFrame]:
    """Every reporting table from the stored operational tables."""

    def ods(table: str) -> DataFrame:
        return scan_table(spark, ods_root, table)

    result = {
        name: marts.project_dim(ods(name), name) for name in schemas.TABLE_NAMES if name.startswith("dim_")
    }
    result["fact_sales"] = marts.fact_sales(ods("fact_sales"), ods("fact_supply_chain"))
    result["fact_supply_chain"] = marts.fact_supply_chain(ods("fact_supply_chain"))
    return result
