"""Joins, keys, checks and layers against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from forgeline import schemas
from forgeline.operators import aggregates, joins, keys, quality
from forgeline.operators.layers import conform_to_layer
from forgeline.plans import marts
from forgeline.session import materialize


def test_distinct_rows_take_more_tasks_the_more_rows_there_are(spark):
    rows = spark.range(20_000).select((F.col("id") % 15_000).alias("a"), (F.col("id") % 15_000 % 7).alias("b"))
    found = aggregates.distinct_rows(rows, rows_per_task=500)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 15_000 and len(sizes) >= 35 and max(sizes) < 1_000
    assert sorted(map(tuple, found.collect())) == [(n, n % 7) for n in range(15_000)]


def test_a_table_is_not_shuffled_for_few_deletes(spark):
    """However large the rows are that the deletes are picked from."""
    log = materialize(spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("value")), "log")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        left = joins.delete_by_key(log.select("id"), log.filter("id % 1000 = 7").select("id"), ["id"])
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and left.count() == 20_000 - 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_split_and_nothing_is_lost(spark, how):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k")
    )
    groups = rows.filter("k <> 11").groupBy("k").agg(F.sum("id").alias("total"), F.count("*").alias("n"))
    plain = rows.join(groups.drop("n"), "k", how)
    split = joins.join_to_groups(rows, groups, ["k"], "n", ["id"], how, rows_per_split=100)
    assert set(split.columns) == set(plain.columns)
    assert sorted(map(tuple, split.select("k", "id", "total").collect()), key=str) == sorted(
        map(tuple, plain.select("k", "id", "total").collect()), key=str
    )


def test_split_join_spreads_the_rows_of_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(8000).select("id", F.lit(1).alias("k"))
        groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("last"))
        joined = joins.join_to_groups(rows, groups, ["k"], "n", ["id"], rows_per_split=500)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and len(sizes) >= 4 and max(sizes) < 6000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("block", [2, 5, 65_536])
def test_number_rows_is_dense_and_ordered(spark, block):
    random.seed(block)
    seqs = [random.randrange(0, 400) for _ in range(150)]
    rows = [(s, n) for n, s in enumerate(seqs)]
    df = spark.createDataFrame(rows, "seq bigint, tie int").repartition(7)
    got = {(r.seq, r.tie): r.rank for r in keys.number_rows(df, "seq", ["tie"], block=block).collect()}
    assert got == {pair: n for n, pair in enumerate(sorted(rows), start=1)}


def test_surrogate_keys(spark):
    known = spark.createDataFrame([(10, 4), (0, 9)], "trsc bigint, id bigint")
    seen = spark.createDataFrame([(10, 5), (77, 3), (66, 8), (77, 9), (0, 1), (None, 2)], "trsc bigint, seq bigint")
    got = {r.trsc: (r.id, r.isNew) for r in keys.assign_surrogate_keys(known, seen, "trsc", "id").collect()}
    assert got == {10: (4, False), 0: (9, False), 77: (10, True), 66: (11, True)}


def test_surrogate_keys_of_an_empty_table_start_at_one(spark):
    known = spark.createDataFrame([], "trsc bigint, id bigint")
    seen = spark.createDataFrame([(5, 0), (3, 1)], "trsc bigint, seq bigint")
    got = {r.trsc: r.id for r in keys.assign_surrogate_keys(known, seen, "trsc", "id").collect()}
    assert got == {5: 1, 3: 2}


def test_surrogate_keys_do_not_depend_on_the_batches(spark):
    random.seed(3)
    seen = [(random.randrange(40), n) for n in range(200)]
    schema = "trsc bigint, seq bigint"
    empty = spark.createDataFrame([], "trsc bigint, id bigint")
    whole = keys.assign_surrogate_keys(empty, spark.createDataFrame(seen, schema), "trsc", "id")
    known: dict[int, int] = {}
    for start in range(0, 200, 67):
        table = spark.createDataFrame(list(known.items()), "trsc bigint, id bigint")
        part = spark.createDataFrame(seen[start : start + 67], schema)
        for row in keys.assign_surrogate_keys(table, part, "trsc", "id").filter("isNew").collect():
            known[row.trsc] = row.id
    assert {r.trsc: r.id for r in whole.collect()} == known


def test_max_plus_one_of_an_empty_table(spark):
    assert aggregates.max_plus_one(spark.createDataFrame([], "id bigint"), "id").collect()[0][0] == 1


def test_delete_ignores_null_keys(spark):
    table = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k bigint, v string")
    deletes = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert {r.v for r in joins.delete_by_key(table, deletes, ["k"]).collect()} == {"b", "c"}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None)], "a int, b int")
    assert [tuple(r) for r in quality.check_unique_key(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    assert [tuple(r) for r in quality.check_not_null(df, ["a", "b"]).collect()] == [("b", 1)]
    with pytest.raises(ValueError, match="key"):
        quality.enforce(quality.check_unique_key(df, ["a"]), "key")
    quality.enforce(quality.check_not_null(df, ["a"]), "null")
    dim = spark.createDataFrame([(1,)], "a int")
    assert [tuple(r) for r in quality.check_foreign_keys(df, {"a": dim}).collect()] == [("a", 1)]


def test_conform_to_layer(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "materialId string, name string")
    rows, bad = conform_to_layer(df, "dim_material", "ods", fill_transactional=True)
    assert rows.schema == schemas.table_schema("dim_material", "ods")
    assert sorted(map(str, rows.select("trscMaterialId", "name").collect())) == sorted(
        map(str, [rows.select("trscMaterialId", "name").collect()[n] for n in range(2)])
    )
    assert [r.name for r in bad.collect()] == ["b"]
    assert conform_to_layer(df, "dim_material", "ods")[0].filter("trscMaterialId IS NOT NULL").count() == 0
    assert conform_to_layer(df, "dim_material", "dwh")[0].columns == ["materialId", "name"]


def test_mart_equals_brute_force(spark):
    random.seed(11)
    rows = [
        (random.randrange(4), random.randrange(3), random.randrange(2), 20000101 + random.randrange(3),
         float(random.randrange(2)), random.randrange(2))
        for _ in range(300)
    ]
    schema = "machineId bigint, partId bigint, materialId bigint, timeId int, materialPrice double, isDamaged int"
    fact = spark.createDataFrame(rows, schema).withColumns(
        {
            "timeOfProduction": F.lit("2000-01-01").cast("date"),
            "materialPriceDate": F.lit("2000-01-01").cast("date"),
            "partDefaultPrice": F.lit(1.0),
        }
    )
    by_machine = Counter((r[3], r[0]) for r in rows)
    by_part = Counter((r[3], r[1]) for r in rows)
    damaged = Counter(r[3] for r in rows if r[5] == 1)
    want = {
        (*r[:5], by_machine[r[3], r[0]], by_part[r[3], r[1]], damaged[r[3]]) for r in rows if damaged[r[3]]
    }
    got = marts.fact_supply_chain(fact).drop("materialPriceDate", "partDefaultPrice").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
