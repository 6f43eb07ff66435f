"""The change rule, message parsing and the streaming job."""

import json
import re
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgeline import schemas
from forgeline.operators import changes as ch
from forgeline.operators import keys
from forgeline.plans import marts
from forgeline.sinks.published import read_published
from forgeline.sources.messages import FILE_OPTIONS, read_message_files, stream_message_files
from forgeline.streaming import messages as job
from forgeline.streaming.refresh import refresh_after_changes, touched_tables

LOG = "k bigint, seq bigint, isDeleted boolean, lastUpdate bigint"


def brute(events, mode):
    """One change at a time."""
    table = []
    for key, seq, deleted, updated in sorted(events, key=lambda e: e[1]):
        if deleted:
            table = [r for r in table if r[0] != key or key is None]
        else:
            table.append((key, seq, updated))
    if mode == "upsert":
        newest = {}
        for row in table:
            if row[0] not in newest or (row[2], row[1]) > (newest[row[0]][2], newest[row[0]][1]):
                newest[row[0]] = row
        table = list(newest.values())
    return sorted((r[0], r[1]) for r in table)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.booleans(), st.integers(0, 5)), min_size=1, max_size=25))
@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_apply_changes_is_one_change_at_a_time(spark, mode, log):
    events = [(k, seq, deleted, updated) for seq, (k, deleted, updated) in enumerate(log)]
    df = spark.createDataFrame(events, LOG).repartition(3)
    got = sorted((r.k, r.seq) for r in ch.apply_changes(df, ["k"], mode).collect())
    assert got == brute(events, mode)


def test_apply_changes_in_two_steps(spark):
    """State after a, then b, is the state after both; b again changes nothing."""
    events = [(n * 7 % 5, n, n % 4 == 3, n) for n in range(40)]
    whole = ch.apply_changes(spark.createDataFrame(events, LOG), ["k"])
    first = ch.apply_changes(spark.createDataFrame(events[:17], LOG), ["k"])
    rest = spark.createDataFrame(events[17:], LOG)
    for later in (rest, rest.union(rest).distinct()):
        both = ch.apply_changes(first.unionByName(later), ["k"])
        assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))


def test_null_keys_match_no_delete(spark):
    events = [(None, 0, False, 0), (None, 1, True, 0), (2, 2, False, 0)]
    got = ch.apply_changes(spark.createDataFrame(events, LOG), ["k"]).collect()
    assert sorted((r.seq) for r in got) == [0, 2]


def messages(spark, rows):
    """Messages that arrive a second apart."""
    start = datetime(2024, 1, 1)
    data = [
        (t, 0, n, start + timedelta(seconds=n), v if isinstance(v, str) or v is None else json.dumps(v))
        for n, (t, v) in enumerate(rows)
    ]
    return spark.createDataFrame(data, schemas.MESSAGE_LOG)


def test_order_goes_across_partitions(spark):
    """Offsets overlap between topics and partitions; many messages share a broker time."""
    start = datetime(2024, 1, 1)
    rows = [(t, p, n, start + timedelta(seconds=n // 3), "") for t in "ab" for p in (0, 1) for n in range(40)]
    want = {r[:3]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[3], *r[:3])), 10)}
    log = spark.createDataFrame(rows[::-1], schemas.MESSAGE_LOG)
    for parts in (1, 7):
        got = ch.with_seq(log.repartition(parts), 10).collect()
        assert {(r.topic, r.partition, r.offset): r.seq for r in got} == want
    assert ch.with_seq(log.limit(0)).count() == 0


def test_a_late_delete_of_another_partition_wins_by_time(spark):
    """The delete has the smaller offset, but it came later."""
    start = datetime(2024, 1, 1)
    rows = [("machine", 0, 9, start, '{"id": 4}'), ("machine", 1, 2, start + timedelta(seconds=1), '{"id": 4, "isDeleted": true}')]
    parsed = ch.parse_topic(ch.with_seq(spark.createDataFrame(rows, schemas.MESSAGE_LOG)), "machine")
    assert ch.apply_changes(parsed, ["id"]).count() == 0


def test_reasons(spark):
    rows = [
        ("part_information", {"id": 0, "timeToProduce": "1.5", "lastUpdate": "2024-01-01T00:00:00"}),
        ("part_information", {"id": 1, "timeToProduce": "long"}),
        ("part_information", {"id": 2, "timeToProduce": "long", "isDeleted": True}),
        ("part_information", {"timeToProduce": 1}),
        ("part_information", "{oops"),
        ("part_information", None),
        ("material_prices", {"id": 3}),
    ]
    log = ch.with_seq(messages(spark, rows))
    parsed = ch.parse_topic(log, "part_information")
    assert {r.offset: r.reason for r in parsed.collect()} == {
        0: None, 1: "bad number", 2: None, 3: "missing field", 4: "unreadable value", 5: "unreadable value",
    }
    assert [r.id for r in ch.accepted(parsed).orderBy("offset").collect()] == [0, 2]
    assert [r.offset for r in ch.unknown_topics(log).collect()] == [6]


def test_supply_chain_deletes_between_inserts(spark):
    """A message sees the quotes whose fact rows are still there when it arrives."""
    fact = spark.createDataFrame(
        [(1, 5, 5, 8, "2000-03-01", 2.0), (1, 5, 5, 9, "2000-04-01", 3.0)],
        "trscMachineId bigint, trscPartId bigint, partId bigint, materialId bigint, d string, materialPrice double",
    ).select(
        "*", F.col("d").cast("date").alias("timeOfProduction"), F.lit("2000-01-01").cast("date").alias("materialPriceDate"),
        F.lit(7.0).alias("partDefaultPrice"),
    )

    def event(part, day, deleted=False, machine=1):
        return ("supply_chain", {"machineId": machine, "partId": part, "timeOfProduction": f"{day}T08:00:00",
                                 "var5": 1, "isDeleted": deleted, "lastUpdate": "2024-01-01T00:00:00"})

    log = ch.with_seq(messages(spark, [
        event(5, "2000-07-01", machine=2),
        event(5, "2000-03-01", deleted=True),
        event(5, "2000-07-02", machine=2),
        event(6, "2000-07-03"),
        event(5, "2001-07-03"),
    ]))
    rows = ch.supply_chain_rows(ch.accepted(ch.parse_topic(log, "supply_chain")))
    parts = spark.createDataFrame([(5, 5)], "trscPartId bigint, partId bigint")
    quotes = ch.visible_quotes(fact, rows, parts)
    got = ch.join_message_quotes(rows, quotes, parts).select("seq", "materialId").collect()
    # The first message's row took both quotes over, so the delete ends neither.
    assert sorted(map(tuple, got)) == [(0, 8), (0, 9), (2, 8), (2, 9)]
    lost = ch.unmatched_messages(rows, quotes, parts).collect()
    assert sorted(r.offset for r in lost) == [3, 4]


def test_an_insert_keeps_the_quote_it_saw(spark):
    """Insert, delete of the loaded row, insert, then a delete of the first: in one batch as in
    batches of one."""
    columns = "trscMachineId bigint, trscPartId bigint, partId bigint, materialId bigint, d string"
    fact = spark.createDataFrame([(1, 5, 5, 8, "2000-03-01")], columns).select(
        "*", F.lit(2.0).alias("materialPrice"), F.col("d").cast("date").alias("timeOfProduction"),
        F.lit("2000-01-01").cast("date").alias("materialPriceDate"), F.lit(7.0).alias("partDefaultPrice"),
    )

    def event(machine, day, deleted=False):
        return ("supply_chain", {"machineId": machine, "partId": 5, "timeOfProduction": f"{day}T08:00:00",
                                 "var5": 1, "isDeleted": deleted, "lastUpdate": "2024-01-01T00:00:00"})

    log = ch.with_seq(messages(spark, [
        event(2, "2000-07-01"),
        event(1, "2000-03-01", deleted=True),
        event(3, "2000-08-01"),
        event(2, "2000-07-01", deleted=True),
        event(4, "2000-08-02"),
        event(3, "2000-08-01", deleted=True),
        event(4, "2000-08-02", deleted=True),
        event(5, "2000-08-03"),
    ]))
    rows = ch.supply_chain_rows(ch.accepted(ch.parse_topic(log, "supply_chain")))
    parts = spark.createDataFrame([(5, 5)], "trscPartId bigint, partId bigint")
    quotes = ch.visible_quotes(fact, rows, parts)
    got = ch.join_message_quotes(rows, quotes, parts).select("seq", "materialId").collect()
    assert sorted(map(tuple, got)) == [(0, 8), (2, 8), (4, 8)]
    assert [r.offset for r in ch.unmatched_messages(rows, quotes, parts).collect()] == [7]


def test_quotes_of_the_fact_are_combined_before_they_are_shuffled(spark, monkeypatch):
    """Nothing but quotes goes through a shuffle: neither fact rows, nor their keys."""
    fact = spark.range(1000).select(
        F.lit(1).cast("bigint").alias("trscMachineId"), F.lit(5).cast("bigint").alias("trscPartId"), F.lit(5).cast("bigint").alias("partId"),
        (F.col("id") % 2).alias("materialId"), F.lit(2.0).alias("materialPrice"), F.lit("2000-01-01").cast("date").alias("materialPriceDate"),
        F.lit(7.0).alias("partDefaultPrice"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("timeOfProduction"),
    )
    value = {"machineId": 1, "partId": 5, "timeOfProduction": "2000-03-01T08:00:00", "lastUpdate": "2024-01-01T00:00:00"}
    log = ch.with_seq(messages(spark, [("supply_chain", value), ("supply_chain", {**value, "isDeleted": True})]))
    rows = ch.supply_chain_rows(ch.accepted(ch.parse_topic(log, "supply_chain")))
    plans, store = {}, ch.materialize
    monkeypatch.setattr(ch, "materialize", lambda df, label: plans.setdefault(label, plan_of(df)) and store(df, label))
    quotes = ch.visible_quotes(fact, rows, spark.createDataFrame([(5, 5)], "trscPartId bigint, partId bigint"))
    assert plans["held"].count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plans["held"]
    assert sorted(r.materialId for r in quotes.collect()) == [0, 1]


def test_sales_messages_that_cannot_be_stored(spark):
    good = {"contract_number": 1, "parts": [1], "cash": [2.0], "client_name": "c", "date": "2024-01-02"}
    rows = [good, {**good, "date": "oops"}, {k: v for k, v in good.items() if k != "cash"},
            {"contract_number": 1, "parts": [1], "isDeleted": True}]
    parsed = ch.parse_topic(ch.with_seq(messages(spark, [("sales", r) for r in rows])), "sales")
    assert {r.offset: r.reason for r in parsed.collect()} == {0: None, 1: "bad date", 2: "missing field", 3: None}


def test_pick_fields_leaves_out_what_is_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ch.pick_fields(df, ["c", "b", "a"]).columns == ["b", "a"]


@pytest.fixture(scope="module")
def streamed(spark, small, tmp_path_factory):
    """The test messages through the job in several batches, the job restarted midway."""
    base = tmp_path_factory.mktemp("stream")
    root, source, checkpoint = str(base / "root"), str(base / "in"), str(base / "checkpoint")
    job.initialize(spark, root, {t: small.ods(t) for t in job.TABLE_KEYS})
    log = small.messages
    highest = log.agg(F.max("seq")).collect()[0][0]
    cuts = [0, highest // 3, highest // 2, highest + 1]
    for start, end in zip(cuts, cuts[1:], strict=False):
        part = log.filter(F.col("seq").between(start, end - 1)).drop("seq")
        part.coalesce(1).write.mode("append").options(**FILE_OPTIONS).json(source)
        stream = stream_message_files(spark, source, files_per_batch=1)
        job.stream_to_tables(stream, root, checkpoint, available_now=True).awaitTermination()
    return root


def table_rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_stream_in_batches_equals_the_whole_log(spark, small, streamed):
    expected = {spec.table: ch.table_after(small.dim_changes(t), spec.table, [spec.trsc]) for t, spec in ch.DIM_TOPICS.items()}
    expected["fact_sales"] = ch.table_after(small.sales_changes, "fact_sales", ch.SALES_KEY)
    expected["fact_supply_chain"] = ch.table_after(small.supply_changes, "fact_supply_chain", ch.SUPPLY_CHAIN_KEY)
    for table, want in expected.items():
        assert table_rows(job.current_table(spark, streamed, table)) == table_rows(want), table


def test_every_message_is_used_or_rejected(spark, small, streamed):
    from forgeline.catalog.changes import all_rejects

    got = job.rejected(spark, streamed)
    assert table_rows(got) == table_rows(all_rejects(small).select(got.columns))


def test_a_repeated_batch_changes_nothing(spark, small, streamed):
    before = {t: table_rows(job.current_table(spark, streamed, t)) for t in job.TABLE_KEYS}
    rejected = table_rows(job.rejected(spark, streamed))
    highest = small.messages.agg(F.max("seq")).collect()[0][0]
    last = small.messages.filter(F.col("seq") >= highest // 2).drop("seq")
    job.process_batch(last, 2, streamed)
    assert {t: table_rows(job.current_table(spark, streamed, t)) for t in job.TABLE_KEYS} == before
    assert table_rows(job.rejected(spark, streamed)) == rejected


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    return df._jdf.queryExecution().executedPlan().toString()


def states(spark, root):
    return {t: table_rows(job.current_table(spark, root, t)) for t in job.TABLE_KEYS} | {"rejects": table_rows(job.rejected(spark, root))}


@pytest.mark.parametrize("fails_at", ["changes/dim_machine", "commits"])
def test_a_batch_killed_between_two_writes_is_not_seen(spark, small, streamed, tmp_path, monkeypatch, fails_at):
    """Readers keep the state before it, and the same batch tried again gives what an unharmed one gives."""
    root = str(tmp_path / "root")
    job.compact(spark, streamed, root)
    before = states(spark, root)
    batch = messages(spark, [
        ("machine", {"id": 10_001, "lastUpdate": "2024-03-01T00:00:00"}),
        ("part_information", {"id": 10_002, "timeToProduce": "3", "lastUpdate": "2024-03-01T00:00:00"}),
        ("supply_chain", {"machineId": 1, "partId": 1, "timeOfProduction": "1996-05-01T00:00:00", "var5": 1}),
        ("supply_chain", {"machineId": 1, "partId": 1, "timeOfProduction": "1996-05-01T00:00:00", "var5": 1, "isDeleted": True}),
        ("material_prices", {"id": 3}),
    ])
    whole = job.append_batch

    def failing(df, path, batch_id, by=None):
        if path.endswith(fails_at):
            raise RuntimeError("killed")
        whole(df, path, batch_id, by)

    monkeypatch.setattr(job, "append_batch", failing)
    with pytest.raises(RuntimeError, match="killed"):
        job.process_batch(batch, 7, root)
    assert states(spark, root) == before
    monkeypatch.setattr(job, "append_batch", whole)
    job.process_batch(batch, 7, root)
    after = states(spark, root)
    assert after != before and job.last_commit(spark, root)["batch_id"] == 7
    clean = str(tmp_path / "clean")
    job.compact(spark, streamed, clean)
    job.process_batch(batch, 7, clean)
    assert states(spark, clean) == after


def test_the_quotes_held_are_those_of_the_fact(spark, streamed):
    """The stored quotes after several batches are the fact's rows; only the buckets asked for are read."""
    end = job.last_commit(spark, streamed)["batch_id"] + 1
    every = job.held_quotes(spark, streamed, list(range(job.BUCKETS)), end)
    fact = job.current_table(spark, streamed, "fact_supply_chain").select(*job.QUOTES.fieldNames()).distinct()
    assert table_rows(every) == table_rows(fact)
    asked = [3, 5]
    some = job.held_quotes(spark, streamed, asked, end)
    assert re.search(r"PartitionFilters: \[.*batch_id#\d+L? = .*bucket#\d+ (IN \([35](,5)?\)|= [35])", plan_of(some))
    bucket = keys.key_bucket("trscPartId", job.BUCKETS)
    assert table_rows(some) == table_rows(fact.filter(bucket.isin(asked)))


def test_a_batch_writes_the_quotes_it_changed_only(spark, streamed, tmp_path, monkeypatch):
    """Not the buckets they are in, until a bucket was changed often enough; what is held is the fact's either way."""
    root = str(tmp_path / "root")
    job.compact(spark, streamed, root)
    row = job.current_table(spark, root, "fact_supply_chain").orderBy("timeOfProduction", "trscPartId", "trscMachineId").first()
    value = {"machineId": 10_001, "partId": row.trscPartId, "timeOfProduction": f"{row.timeOfProduction}T00:00:00", "var5": 1}
    gone = {**value, "machineId": row.trscMachineId, "isDeleted": True}
    bucket = keys.key_bucket("trscPartId", job.BUCKETS)

    def held_after(number, values):
        job.process_batch(messages(spark, [("supply_chain", v) for v in values]), number, root)
        fact = job.current_table(spark, root, "fact_supply_chain").select(*job.QUOTES.fieldNames()).distinct()
        assert table_rows(job.held_quotes(spark, root, list(range(job.BUCKETS)), number + 1)) == table_rows(fact)
        of_bucket = fact.filter(bucket == fact.filter(F.col("trscPartId") == row.trscPartId).select(bucket).first()[0])
        return spark.read.parquet(f"{root}/quotes/batch_id={number}").count(), of_bucket.count()

    written, held = held_after(0, [value])
    assert 0 < written < held
    monkeypatch.setattr(job, "REWRITE_AFTER", 1)
    written, held = held_after(1, [gone])
    assert written == held
    monkeypatch.undo()
    written, held = held_after(2, [{**value, "isDeleted": True}])
    assert written < held


def test_the_key_log_is_not_shuffled(spark, streamed):
    """A batch looks its ids up in the buckets of these, without a shuffle of the ids known."""
    end = job.last_commit(spark, streamed)["batch_id"] + 1
    seen = spark.createDataFrame([(n, n) for n in (1, 2, 99_999)], "trscPartId bigint, seq bigint")
    first = keys.first_seen(seen, "trscPartId")
    known = job.known_ids(spark, streamed, "partId", end, job.buckets_of(first, "trscPartId", job.BUCKETS))
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ IN", plan_of(known))
    joined = known.join(first.select("trscPartId"), "trscPartId")
    assert "hashpartitioning" not in plan_of(joined) and "BroadcastExchange" in plan_of(joined)
    highest = job.last_commit(spark, streamed)["partId"]
    got = {r.trscPartId: (r.partId, r.isNew) for r in keys.assign_ids(known, first, "trscPartId", "partId", highest).collect()}
    assert got == {1: (1, False), 2: (2, False), 99_999: (highest + 1, True)}


def test_a_refresh_reads_and_replaces_touched_months_only(spark, streamed, tmp_path):
    root, warehouse = str(tmp_path / "root"), str(tmp_path / "dwh")
    job.compact(spark, streamed, root)
    refresh_after_changes(spark, root, warehouse, since=job.LOADED)
    fact = job.current_table(spark, root, "fact_supply_chain")
    gone = fact.orderBy("timeOfProduction", "trscPartId", "trscMachineId").first()
    key = {"machineId": gone.trscMachineId, "partId": gone.trscPartId, "timeOfProduction": f"{gone.timeOfProduction}T00:00:00"}
    job.process_batch(messages(spark, [("supply_chain", {**key, "isDeleted": True})]), 9, root)
    month = gone.timeOfProduction.year * 100 + gone.timeOfProduction.month
    assert job.touched_periods(spark, root, "fact_supply_chain", 9, 10) == [month]
    assert "month#" in plan_of(job.changes(spark, root, "fact_supply_chain", where=F.col("month").isin([month])))
    versions = refresh_after_changes(spark, root, warehouse, since=9)
    assert versions["fact_supply_chain"] == 2 and versions["fact_sales"] == 2
    written = spark.read.parquet(f"{warehouse}/fact_supply_chain/version=2").select("month").distinct().collect()
    assert {r.month for r in written} <= {month}
    now = job.current_table(spark, root, "fact_supply_chain")
    assert table_rows(read_published(spark, f"{warehouse}/fact_supply_chain")) == table_rows(marts.fact_supply_chain(now))
    sales = marts.fact_sales(job.current_table(spark, root, "fact_sales"), now)
    assert table_rows(read_published(spark, f"{warehouse}/fact_sales")) == table_rows(sales)


def test_refresh_and_compact(spark, streamed, tmp_path):
    assert touched_tables(spark, streamed, since=0) == sorted(
        ["dim_contract", "dim_machine", "dim_material", "dim_part_information", "fact_sales", "fact_supply_chain"]
    )
    assert touched_tables(spark, streamed, since=99) == []
    versions = refresh_after_changes(spark, streamed, str(tmp_path / "dwh"), since=0)
    assert set(versions.values()) == {1}
    job.compact(spark, streamed, str(tmp_path / "compacted"))
    for table in job.TABLE_KEYS:
        assert table_rows(job.current_table(spark, str(tmp_path / "compacted"), table)) == table_rows(
            job.current_table(spark, streamed, table)
        )


def test_message_files_read_alike(spark, small):
    assert read_message_files(spark, small.message_files).count() == small.messages.count()
    assert read_message_files(spark, small.message_files).columns == schemas.MESSAGE_LOG.fieldNames()
