"""Edge rows of the column functions."""

import datetime as dt

from pyspark.sql import functions as F

from forgeline.functions import cells, dates
from forgeline.functions.sql_names import register_functions
from forgeline.plans import staging


def column(spark, values, kind, build):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r[0] for r in df.orderBy("n").select(build("v")).collect()]


def test_price_json(spark):
    texts = ['[{"price": 1.5, "d": "01-31-2024"}]', "oops", None, "[]", '{"price": 2, "d": "02-01-2024"}',
             '[{"price": "x"}]', ""]
    got = column(spark, texts, "string", cells.parse_price_history)
    assert [None if v is None else [tuple(q) for q in v] for v in got] == [
        [(1.5, "01-31-2024")], None, None, [], [(2.0, "02-01-2024")], [(None, None)], None,
    ]


def test_material_prices_drop_missing_lists_and_keep_bad_dates(spark):
    rows = [(1, "a", '[{"price": 1.0, "d": "2024-01-02"}]'), (2, "b", "[]"), (3, "c", None), (4, "d", "oops")]
    raw = spark.createDataFrame(rows, "id bigint, name string, prices string")
    got = staging.build_material_price(raw, F.lit(None).cast("timestamp_ntz")).collect()
    assert [(r.materialId, r.price, r.date) for r in got] == [(1, 1.0, None)]


def test_date_text(spark):
    got = column(spark, ["01-31-2024", "2024-01-02", "", None, "13-01-2024"], "string", dates.parse_date)
    assert got == [dt.date(2024, 1, 31), None, None, None, None]


def test_int_list(spark):
    texts = ["[1, 2]", "['1', '2']", "[]", "", "5", "[1, x]", None, '["7"]', "[-3]"]
    got = column(spark, texts, "string", cells.parse_int_list)
    assert got == [[1, 2], [1, 2], [], [], [5], [1], [], [7], [-3]]


def test_epoch(spark):
    values = [0, 951782400000, None, -1, 86399999]
    day = [dt.date(1970, 1, 1), dt.date(2000, 2, 29), None, dt.date(1969, 12, 31), dt.date(1970, 1, 1)]
    assert column(spark, values, "bigint", dates.epoch_to_date) == day
    stamps = column(spark, values, "bigint", dates.epoch_to_timestamp)
    assert stamps[1] == dt.datetime(2000, 2, 29) and stamps[3] == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert column(spark, [951782400], "bigint", lambda c: dates.epoch_to_date(c, "s")) == [dt.date(2000, 2, 29)]


def test_time_id_forms_agree(spark):
    days = [dt.date(1920, 1, 1), dt.date(2000, 2, 29), dt.date(2099, 12, 31), None]
    for build in (dates.time_id, dates.time_id_text):
        assert column(spark, days, "date", build) == [19200101, 20000229, 20991231, None]
    iso = ["2000-02-29T10:00:00", "2000-02-29", "x", None]
    assert column(spark, iso, "string", dates.time_id_from_iso) == [20000229, 20000229, None, None]


def test_dot_product_is_cut_to_the_shorter_array(spark):
    rows = [([1.0, 2.0, 9.0], [3, 4]), ([2.0], [5, 6]), ([], [1]), ([None, 1.0], [4, 2])]
    df = spark.createDataFrame(rows, "a array<double>, b array<bigint>")
    assert [r[0] for r in df.select(cells.dot_product("a", "b")).collect()] == [11.0, 10.0, 0.0, 2.0]


def test_date_in_year_covers_the_year_and_nothing_else(spark):
    seeds = spark.range(0, 1000).select("id", F.lit(2000).alias("y"))
    got = {r[0] for r in seeds.select(dates.date_in_year("y", "id")).collect()}
    assert min(got) == dt.date(2000, 1, 1) and max(got) == dt.date(2000, 12, 31) and len(got) == 366
    negative = spark.range(1).select(dates.date_in_year(F.lit(1999), F.lit(-1)))
    assert negative.collect()[0][0] == dt.date(1999, 12, 31)


def test_calendar(spark):
    calendar = staging.build_dim_time(spark)
    assert calendar.count() == 65381
    ends = calendar.filter("timeId IN (19200101, 20000229, 20990101)").orderBy("timeId").collect()
    assert [(r.timeId, r.semester, r.quarter) for r in ends] == [
        (19200101, 1, 1), (20000229, 1, 1), (20990101, 1, 1),
    ]
    monthly = staging.build_dim_time(spark, step="month")
    assert monthly.count() == 65379
    assert monthly.agg(F.max("date"), F.max("day")).collect()[0][:] == (dt.date(7368, 3, 1), 1)


def test_sql_names_match_the_column_functions(spark):
    register_functions(spark)
    row = spark.sql(
        """SELECT fl_int_list("['4', x, 5]") AS a, fl_parse_date('02-30-2024') AS b,
                  fl_epoch_ts(86400000) AS c, fl_day_in_year(1999, 364) AS d"""
    ).collect()[0]
    assert row.a == [4, 5] and row.b is None
    assert row.c == dt.datetime(1970, 1, 2) and row.d == dt.date(1999, 12, 31)


def test_snapshot_label_has_no_colon(spark):
    ts = F.lit("2024-06-01 12:30:45").cast("timestamp_ntz")
    assert spark.range(1).select(dates.snapshot_label(ts)).collect()[0][0] == "2024-06-01 12-30-45"
