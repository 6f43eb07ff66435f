"""What keeps time and disk from growing faster than the tables."""

import datetime
import time
from decimal import ROUND_HALF_UP, Context, Decimal
from hashlib import md5

import pyarrow as pa
from pyspark.sql import functions as F

from forgeline import schemas
from forgeline.catalog.registry import QUERIES
from forgeline.plans import marts, staging
from forgeline.session import noted_work
from forgeline.sinks import contents as summed
from forgeline.sinks import parquet, published

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(k).name().startswith("shuffle_") for k in range(blocks.size()))


def test_checksums_hash_arrays_of_texts(monkeypatch):
    """The numbers of texts of every length and of awkward values, none of them hashed by itself."""

    def text(value):
        if isinstance(value, float):
            if value != value or value in (float("inf"), float("-inf")):
                return {"nan": "NaN", "inf": "Infinity", "-inf": "-Infinity"}[repr(value)]
            rounded = Decimal(repr(value)).quantize(Decimal("0.0001"), ROUND_HALF_UP, Context(prec=400))
            return f"{rounded if rounded else abs(rounded):f}"
        return value.decode() if isinstance(value, bytes) else str(value)

    def number(value):
        return int(md5(text(value).encode()).hexdigest()[:15], 16)

    texts = [b"x" * n for n in range(300)] + [None, "Ä€".encode()]
    doubles = [0.0, -0.0, 0.00005, 0.00015, -0.00005, -0.00004, -0.5, 1.00005, 2.5, 0.1 + 0.2, 1e9 + 0.00005, 123456789.12345,
               99999999999.99995, -1e11, 1e13 + 0.3, 1e15, 1e22, 4503599627370497.5, float("nan"), float("inf"), float("-inf"), None]
    doubles += [(-1) ** k * (k * 7919 % 100003) / 8 / 10 ** (k % 9) for k in range(280)]
    days = [datetime.date(1, 1, 1), datetime.date(1999, 2, 28), datetime.date(9999, 12, 31)] * 100 + [None, None]
    whole = [0, -1, 2**63 - 1, -(2**63)] * 75 + [None, 5]
    columns = [texts, doubles, days, whole]
    kinds = [pa.binary(), pa.float64(), pa.date32(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list("abcd"))
    rows = ["|".join("~" if v is None else text(v) for v in row) for row in zip(*columns, strict=True)]
    wanted = [sum(map(number, rows))] + [sum(number(v) for v in c if v is not None) for c in columns]
    monkeypatch.setattr(summed, "md5", None)
    got = list(summed._summing(4)(iter([batch.slice(0, 100), batch.slice(100, 0), batch.slice(100)])))
    assert [int(got[0].column(k)[0].as_py()) for k in range(6)] == [len(rows), *wanted]
    monkeypatch.undo()
    long = pa.RecordBatch.from_arrays([pa.array([b"y" * 5000, b"z"])], names=["a"])
    got = list(summed._summing(1)(iter([long])))
    assert int(got[0].column(2)[0].as_py()) == number(b"y" * 5000) + number(b"z")
    assert [c[0].as_py() for c in list(summed._summing(1)(iter([])))[0].columns] == [0, 0, 0]


def test_a_restored_snapshot_is_verified_once(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    published.snapshot_tables({"a": spark.range(9)}, root, "x")
    report = published.restore_snapshot(spark, root, "x", ["a"], str(tmp_path / "back"))
    assert report.inputFiles() and not any("snapshots" in path for path in report.inputFiles())
    assert [tuple(r) for r in report.collect()] == [("a", 9, True)]


def test_the_sorted_mart_is_shuffled_once(spark):
    """The ranges of the sort serve DISTINCT and the counts as well."""
    df = QUERIES["sort_fact_supply_chain"](spark, SMALL)
    plan = plan_of(df)
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan and plan.count("Sort ") == 1
    machines = [r.machineId for r in df.select("machineId").collect()]
    assert machines == sorted(machines) and len(machines) == df.count()


def test_the_mart_in_ranges_is_clustered_without_a_shuffle(spark, small):
    fact = small.ods("fact_supply_chain")
    fact = fact.unionByName(fact.limit(50)).unionByName(fact.limit(3).withColumn("timeId", F.lit(None).cast("int")))
    keys = schemas.KEYS["fact_supply_chain"]
    plain = marts.fact_supply_chain(fact, keep_undamaged=True)
    ranged = marts.fact_supply_chain(fact, keep_undamaged=True, order=keys[:3])
    assert sorted(map(str, ranged.collect())) == sorted(map(str, plain.collect()))
    plan = plan_of(parquet.cluster_by_key(ranged, keys, spread=["materialPrice", "materialPriceDate", "partDefaultPrice"]))
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan and plan.count("Sort ") == 1


def test_the_mart_leaves_one_stored_table(spark, small):
    fact = small.ods("fact_supply_chain")
    with noted_work() as made:
        mart = marts.fact_supply_chain(fact)
    assert len(made) == 1 and "place-counts" in made[0]
    assert mart.count() > 0


def test_what_a_query_shuffled_goes_with_it(spark, small):
    fact = small.ods("fact_supply_chain")
    spark._jvm.System.gc()
    time.sleep(1)
    before = shuffle_files(spark)
    counted = fact.groupBy("partId", "timeId").count()
    first = sorted(counted.collect())
    deadline = time.time() + 20
    while shuffle_files(spark) > before and time.time() < deadline:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert sorted(counted.collect()) == first  # worked out again


def test_stored_tables_and_messages_are_packed(spark, small, tmp_path):
    small.ods_with("dim_machine")
    assert all(path.endswith(".zstd.parquet") for path in small.ods("dim_machine").inputFiles())
    files = spark.read.text(small.message_files).inputFiles()
    assert files and all(path.endswith(".json.gz") for path in files)
    assert small.messages.count() == small.table("events").count()


def test_parts_that_lie_together_are_replaced_without_a_shuffle(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    rows = spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("year")).coalesce(2)
    published.replace_parts(rows, root, "year")
    monkeypatch.setattr(type(rows), "hint", None)
    published.replace_parts(rows.filter("year > 1 AND id > 20"), root, "year", [2, 3], rebalance=False)
    got = sorted(r.id for r in published.read_published(spark, root).collect())
    assert got == [k for k in range(40) if k % 4 < 2 or k > 20]


def test_the_long_cells_of_few_files_are_read_by_all_tasks(spark, small):
    whole = small.part_raw.coalesce(1)
    bridge = staging.build_part_bridge(whole, small.run_ts)
    assert bridge.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bridge.count() == small.bridge.count() > 0
