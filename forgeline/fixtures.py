"""The engine's inputs derived from the given tables.

The tables are plain Parquet files; each function below turns them into one of the
inputs the engine is made for. All of it is linear in the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_TS = "2024-06-01 12:30:45"
# Fixed values of the test data: price list years and months, materials.
QUOTE_YEARS = (1995, 2001)
QUOTE_MONTHS = (1, 4, 7, 10)
MATERIALS = 25
#: Rows of the part reference that a part's machines are dealt to.
MACHINE_BUCKETS = 8


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def machine_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order"),
        F.col("l_partkey").alias("partId"),
        F.col("l_suppkey").alias("machineId"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timeOfProduction"),
        (F.col("l_returnflag") == "R").cast("int").alias("var5"),
    )


def material_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materials with a JSON price history of four quotes a year."""
    key = F.col("n_nationkey")
    quotes = F.flatten(
        F.transform(
            F.sequence(F.lit(QUOTE_YEARS[0]), F.lit(QUOTE_YEARS[1])),
            lambda year: F.transform(
                F.array(*[F.lit(m) for m in QUOTE_MONTHS]),
                lambda month: F.struct(
                    (F.lit(10) + (key * 7 + year * 3 + month) % 50).cast("double").alias("price"),
                    F.concat(F.lpad(month.cast("string"), 2, "0"), F.lit("-01-"), year.cast("string")).alias("d"),
                ),
            ),
        )
    )
    return table(spark, sf_dir, "nation").select(
        key.cast("bigint").alias("id"), F.col("n_name").alias("name"), F.to_json(quotes).alias("prices")
    )


def part_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part references with their materials and machines as list text.

    Every machine that made a part is listed. A sheet row holds the machines of one bucket, so a
    part gives several rows and no cell grows with the rows of a hot part; DISTINCT and the
    collection work on (part, machine), which combines before the shuffle.
    """
    made = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("m")).distinct()
    made_on = made.groupBy("p_partkey", (F.col("m") % MACHINE_BUCKETS).alias("bucket")).agg(F.collect_list("m").alias("made_by"))
    key = F.col("p_partkey")
    materials = F.array_distinct(F.array(key % MATERIALS, (key * 3 + 1) % MATERIALS))
    machines = F.array_sort(F.coalesce("made_by", F.array().cast("array<bigint>")))

    def joined(items: Column) -> Column:
        return F.array_join(items.cast("array<string>"), ", ")

    return (
        table(spark, sf_dir, "part")
        .join(made_on, "p_partkey", "left")
        .select(
            key.alias("id"),
            F.col("p_size").cast("double").alias("timeToProduce"),
            F.col("p_retailprice").alias("defaultPrice"),
            F.concat(
                F.lit("["), F.array_join(F.transform(materials, lambda m: F.concat(F.lit("'"), m, F.lit("'"))), ", "), F.lit("]")
            ).alias("meterials"),
            F.concat(F.lit("["), joined(machines), F.lit("]")).alias("machine"),
        )
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages: topic, partition, offset, broker time and the JSON value.

    Messages alternate between two partitions, each with its own offsets from 0 on, so that offsets
    alone say nothing about their order. Some production dates lie behind the price list.
    """
    parts = table(spark, sf_dir, "part").select(F.count("*")).scalar()
    user, event = F.col("user_id"), F.col("event_id")
    topic = F.when(event % 50 == 0, F.lit("material_prices")).otherwise(
        F.element_at(
            F.create_map(
                *[
                    F.lit(v)
                    for v in (
                        "view", "part_information", "click", "machine", "signup", "material",
                        "purchase", "sales", "error", "supply_chain",
                    )
                ]
            ),
            F.col("event_type"),
        )
    )
    deleted = (event % 7 == 0).alias("isDeleted")
    updated = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("lastUpdate")
    late = F.when(event % 9 == 0, 3000).otherwise(0)
    made = F.date_add(F.lit("1995-01-01").cast("date"), (user * 37 % 2500 + late).cast("int"))
    value = (
        F.when(
            F.col("topic") == "part_information",
            F.to_json(F.struct(user.alias("id"), F.col("value").alias("timeToProduce"), deleted, updated)),
        )
        .when(F.col("topic") == "machine", F.to_json(F.struct(user.alias("id"), deleted, updated)))
        .when(
            F.col("topic").isin("material", "material_prices"),
            F.to_json(F.struct(user.alias("id"), F.concat(F.lit("MATERIAL_"), user).alias("name"), deleted, updated)),
        )
        .when(
            F.col("topic") == "sales",
            F.to_json(
                F.struct(
                    user.alias("contract_number"),
                    F.array(user % F.col("parts"), (user * 3) % F.col("parts")).alias("parts"),
                    F.array(F.round("value").cast("double"), (event % 100).cast("double")).alias("cash"),
                    F.concat(F.lit("CLIENT NO_"), user).alias("client_name"),
                    F.date_format("ts", "yyyy-MM-dd").alias("date"),
                    deleted,
                    updated,
                )
            ),
        )
        .when(
            F.col("topic") == "supply_chain",
            F.to_json(
                F.struct(
                    (user % 10).alias("machineId"),
                    (user % F.col("parts")).alias("partId"),
                    F.concat(F.date_format(made, "yyyy-MM-dd"), F.lit("T00:00:00")).alias("timeOfProduction"),
                    (event % 2).cast("int").alias("var5"),
                    deleted,
                    updated,
                )
            ),
        )
    )
    return (
        table(spark, sf_dir, "events")
        .withColumn("topic", topic)
        .withColumn("parts", parts)
        .select(
            "topic",
            (event % 2).cast("int").alias("partition"),
            F.floor(event / 2).cast("bigint").alias("offset"),
            F.col("ts").cast("timestamp_ntz").alias("timestamp"),
            value.alias("value"),
        )
    )
