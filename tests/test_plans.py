"""What the physical plans must and must not contain."""

import pytest

from forgeline import catalog
from forgeline.catalog import registry

from conftest import SMALL

# Work that Spark would do row by row in Python, on one task, or on all pairs of rows.
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]
HEAVY = [
    "build_dim_material_price", "build_part_bridge", "build_dim_machine", "build_fact_sales_ods",
    "build_fact_supply_chain_ods", "mart_fact_supply_chain", "mart_fact_sales", "apply_machine", "apply_contract",
    "apply_supply_chain", "join_daily_counts", "join_margin_inputs", "check_unique_key", "latest_by_key",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_no_python_rows_no_pairs(spark, name):
    text = plan(catalog.queries()[name](spark, SMALL))
    assert [f for f in FORBIDDEN if f in text] == []


def test_scans_are_pruned_and_filtered(spark, small):
    from forgeline.operators import aggregates

    text = plan(aggregates.count_garbage_day(small.ods("fact_supply_chain")))
    assert "EqualTo(isDamaged,1)" in text
    assert "materialPrice" not in text


def test_sales_are_not_shuffled_for_the_margin(spark, small):
    text = plan(catalog.queries()["mart_fact_sales"](spark, SMALL))
    assert "SortMergeJoin" not in text


def test_the_dimension_check_of_the_log_does_not_shuffle_it(spark, small):
    text = plan(catalog.queries()["join_machine_dim"](spark, SMALL))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_the_fact_is_shuffled_once_for_the_mart(spark, small):
    """One shuffle for DISTINCT and for the join of the counts, one for the counts."""
    from forgeline.plans import marts

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.fact_supply_chain(small.ods("fact_supply_chain")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name, tables", [
    ("apply_contract", {"dim_part_information", "dim_contract", "fact_sales"}),
    ("join_margin_inputs", {"fact_sales", "fact_supply_chain"}),
])
def test_tables_a_query_reads_are_loaded_together(spark, small, monkeypatch, name, tables):
    """One after the other, they would build the rows they share once each."""
    def load(*args):
        raise LookupError(set(args[-1]))

    monkeypatch.setattr(registry.run, "load_ods", load)
    monkeypatch.setattr(registry, "_loaded", {})
    with pytest.raises(LookupError) as first:
        registry.QUERIES[name](spark, small.sf_dir)
    assert first.value.args[0] == tables
