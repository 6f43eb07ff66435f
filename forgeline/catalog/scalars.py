"""Column functions and projections, each over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import cells, dates
from ..functions.sql_names import register_functions
from ..operators import changes as ch
from ..operators.aggregates import filter_damaged, order_part_stats
from ..operators.layers import conform_to_layer
from ..plans import staging
from ..plans.marts import join_margin_inputs, project_dim
from .registry import Inputs, query, subquery


def order_date() -> Column:
    return F.col("o_orderdate").cast("date")


# -- dates ---------------------------------------------------------------------------------


@query(
    "year_month_day",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
  CAST(day(o_orderdate) AS INTEGER) AS d FROM orders""",
)
def year_month_day(i: Inputs) -> DataFrame:
    return i.table("orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        F.dayofmonth("o_orderdate").alias("d"),
    )


_SEMESTER = "CASE WHEN quarter(o_orderdate) IN (1, 2) THEN 1 ELSE 2 END"


@query(
    "quarter_semester",
    f"SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS q, {_SEMESTER} AS s FROM orders",
)
def quarter_semester(i: Inputs) -> DataFrame:
    quarter = F.quarter("o_orderdate")
    return i.table("orders").select("o_orderkey", quarter.alias("q"), dates.semester(quarter).alias("s"))


@query("case_semester", f"SELECT {_SEMESTER} AS semester, count(*) AS orders FROM orders GROUP BY 1")
def case_semester(i: Inputs) -> DataFrame:
    semester = dates.semester(F.quarter("o_orderdate")).alias("semester")
    return i.table("orders").groupBy(semester).agg(F.count("*").alias("orders"))


@query(
    "time_id",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS by_parts,
  CAST(replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS INTEGER) AS by_text,
  CAST(replace(split_part(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 'T', 1), '-', '') AS INTEGER) AS by_iso
FROM orders""",
)
def time_id(i: Inputs) -> DataFrame:
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return i.table("orders").select(
        "o_orderkey",
        dates.time_id(order_date()).alias("by_parts"),
        dates.time_id_text(order_date()).alias("by_text"),
        dates.time_id_from_iso(iso).alias("by_iso"),
    )


@query(
    "lpad_concat",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
  || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') AS day_text FROM orders""",
)
def lpad_concat(i: Inputs) -> DataFrame:
    def two(c):
        return F.lpad(c.cast("string"), 2, "0")

    parts = [F.year("o_orderdate").cast("string"), two(F.month("o_orderdate")), two(F.dayofmonth("o_orderdate"))]
    return i.table("orders").select("o_orderkey", F.concat(*parts).alias("day_text"))


@query(
    "parse_mdy_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders",
)
def parse_mdy_date(i: Inputs) -> DataFrame:
    """Every other order writes its date the wrong way round, which reads as NULL."""
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "MM-dd-yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return i.table("orders").select("o_orderkey", dates.parse_date(text).alias("parsed"))


@query(
    "epoch_to_timestamp",
    """SELECT "order", partId, machineId, epoch_ms(timeOfProduction) AS at_ms,
  epoch_ms(timeOfProduction // 1000 * 1000) AS at_s, CAST(epoch_ms(timeOfProduction) AS DATE) AS day FROM v_log""",
)
def epoch_to_timestamp(i: Inputs) -> DataFrame:
    seconds = F.floor(F.col("timeOfProduction") / 1000)
    return i.log.select(
        "order",
        "partId",
        "machineId",
        dates.epoch_to_timestamp("timeOfProduction").alias("at_ms"),
        dates.epoch_to_timestamp(seconds, "s").alias("at_s"),
        dates.epoch_to_date("timeOfProduction").alias("day"),
    )


@query(
    "format_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ms_text
FROM events""",
)
def format_date(i: Inputs) -> DataFrame:
    return i.table("events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ms_text"),
    )


@query(
    "add_months_spine",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + to_months(CAST(o_orderkey % 36 AS INTEGER)) AS DATE) AS shifted
FROM orders""",
)
def add_months_spine(i: Inputs) -> DataFrame:
    step = (F.col("o_orderkey") % 36).cast("int")
    return i.table("orders").select("o_orderkey", F.add_months(order_date(), step).alias("shifted"))


@query(
    "date_in_year",
    """SELECT contractId, partId, date FROM (SELECT o."order" AS contractId, o.partId,
  CAST(make_date(o.maxYear, 1, 1) + CAST((o."order" * 31 + o.partId * 17)
    % date_diff('day', make_date(o.maxYear, 1, 1), make_date(o.maxYear + 1, 1, 1)) AS INTEGER) AS DATE) AS date
  FROM v_order_parts o)""",
)
def date_in_year(i: Inputs) -> DataFrame:
    seed = F.col("order") * 31 + F.col("partId") * 17
    return order_part_stats(i.log).select(
        F.col("order").alias("contractId"), "partId", dates.date_in_year("maxYear", seed).alias("date")
    )


@query("now_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS lastUpdate FROM events")
def now_text(i: Inputs) -> DataFrame:
    return i.table("events").select("event_id", dates.now_text("ts").alias("lastUpdate"))


@query("snapshot_label", "SELECT event_id, strftime(ts, '%Y-%m-%d %H-%M-%S') AS label FROM events")
def snapshot_label(i: Inputs) -> DataFrame:
    return i.table("events").select("event_id", dates.snapshot_label("ts").alias("label"))


@query("replace_text", "SELECT o_orderkey, replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS t FROM orders")
def replace_text(i: Inputs) -> DataFrame:
    return i.table("orders").select(
        "o_orderkey", F.replace(order_date().cast("string"), F.lit("-"), F.lit("")).alias("t")
    )


subquery(
    "v_msg",
    """SELECT CASE WHEN event_id % 50 = 0 THEN 'material_prices' WHEN event_type = 'view' THEN 'part_information'
    WHEN event_type = 'click' THEN 'machine' WHEN event_type = 'signup' THEN 'material'
    WHEN event_type = 'purchase' THEN 'sales' WHEN event_type = 'error' THEN 'supply_chain' END AS topic,
  CAST(event_id % 2 AS INTEGER) AS partition, event_id // 2 AS "offset", event_id AS event,
  row_number() OVER (ORDER BY ts, topic, event_id % 2, event_id // 2) - 1 AS seq,
  user_id, event_id % 7 = 0 AS del, ts, value,
  user_id % p.n AS part1, (user_id * 3) % p.n AS part2, user_id % 10 AS machine,
  CAST(DATE '1995-01-01' + CAST(user_id * 37 % 2500 + CASE WHEN event_id % 9 = 0 THEN 3000 ELSE 0 END AS INTEGER) AS DATE) AS made
FROM events, (SELECT count(*) AS n FROM part) p""",
)


@query(
    "split_iso_date",
    "SELECT seq, strftime(made, '%Y-%m-%d') AS day_text FROM v_msg WHERE topic = 'supply_chain'",
)
def split_iso_date(i: Inputs) -> DataFrame:
    return i.parsed["supply_chain"].select("seq", dates.iso_date_text("timeOfProduction").alias("day_text"))


# -- cells and arrays --------------------------------------------------------------------------


@query("strip_quotes", "SELECT id, replace(meterials, '''', '') AS bare FROM v_part_raw")
def strip_quotes(i: Inputs) -> DataFrame:
    return i.part_raw.select("id", cells.strip_quotes("meterials").alias("bare"))


@query(
    "parse_int_list",
    """SELECT id, CAST(len(string_split(meterials, ',')) AS INTEGER) AS n_materials,
  CASE WHEN machine = '[]' THEN 0 ELSE CAST(len(string_split(machine, ',')) AS INTEGER) END AS n_machines,
  regexp_replace(meterials, '[^0-9,]', '', 'g') AS materials,
  regexp_replace(machine, '[^0-9,]', '', 'g') AS machines FROM v_part_raw""",
)
def parse_int_list(i: Inputs) -> DataFrame:
    lists = i.part_raw.select(
        "id", cells.parse_int_list("meterials").alias("a"), cells.parse_int_list("machine").alias("b")
    )
    return lists.select(
        "id",
        F.size("a").alias("n_materials"),
        F.size("b").alias("n_machines"),
        F.array_join(F.col("a").cast("array<string>"), ",").alias("materials"),
        F.array_join(F.col("b").cast("array<string>"), ",").alias("machines"),
    )


@query("explode_list", "SELECT partId AS id, materialId FROM v_part_materials")
def explode_list(i: Inputs) -> DataFrame:
    return i.part_raw.select("id", F.explode(cells.parse_int_list("meterials")).alias("materialId")).distinct()


@query("explode_cross", "SELECT partId AS id, materialId, machineId FROM v_bridge")
def explode_cross(i: Inputs) -> DataFrame:
    return i.part_raw.select(
        "id", F.explode(cells.parse_int_list("meterials")).alias("materialId"), "machine"
    ).select("id", "materialId", F.explode(cells.parse_int_list("machine")).alias("machineId"))


@query(
    "parse_price_json",
    """SELECT materialId AS id, CAST(count(*) AS INTEGER) AS quotes, round(sum(price), 2) AS total,
  strftime(min(date), '%m-%d-%Y') AS first_d FROM v_quotes GROUP BY materialId""",
)
def parse_price_json(i: Inputs) -> DataFrame:
    parsed = i.material_raw.select("id", cells.parse_price_history("prices").alias("p"))
    prices = F.transform("p", lambda q: q["price"])
    return parsed.select(
        "id", F.size("p").alias("quotes"), F.round(cells.array_total(prices), 2).alias("total"), F.col("p")[0]["d"].alias("first_d")
    )


@query("struct_field", "SELECT materialId AS id, price, strftime(date, '%m-%d-%Y') AS d FROM v_quotes")
def struct_field(i: Inputs) -> DataFrame:
    exploded = i.material_raw.select("id", F.explode(cells.parse_price_history("prices")).alias("e"))
    return exploded.select("id", "e.price", "e.d")


@query("row_id", "SELECT materialId, date, price, 1 AS uses FROM v_quotes")
def row_id(i: Inputs) -> DataFrame:
    """Each quote with the number of quotes that share its generated id."""
    uses = i.quotes.groupBy("id").agg(F.count("*").cast("int").alias("uses"))
    return i.quotes.join(uses, "id").select("materialId", "date", "price", "uses")


@query(
    "dot_product",
    """SELECT seq, round(round(value) * part1 + (event % 100) * part2, 2) AS total,
  round(round(value) + event % 100, 2) AS cash_sum FROM v_msg WHERE topic = 'sales'""",
)
def dot_product(i: Inputs) -> DataFrame:
    return i.parsed["sales"].select(
        "seq",
        F.round(cells.dot_product("cash", "parts"), 2).alias("total"),
        F.round(cells.array_total("cash"), 2).alias("cash_sum"),
    )


@query(
    "decode_json_value",
    "SELECT seq, user_id AS id, CAST(del AS INTEGER) AS deleted, ts AS updated FROM v_msg WHERE topic = 'machine'",
)
def decode_json_value(i: Inputs) -> DataFrame:
    raw = i.messages.filter("topic = 'machine'").select("seq", F.encode("value", "UTF-8").alias("value"))
    parsed = raw.select(
        "seq", F.from_json(F.col("value").cast("string"), schemas.message_schema("machine")).alias("m")
    )
    return parsed.select(
        "seq",
        "m.id",
        F.col("m.isDeleted").cast("int").alias("deleted"),
        F.col("m.lastUpdate").try_cast("timestamp_ntz").alias("updated"),
    )


@query("parse_float", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS number FROM orders")
def parse_float(i: Inputs) -> DataFrame:
    """Every other order offers its priority text instead of a number, which reads as NULL."""
    text = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice").cast("string")).otherwise(
        F.col("o_orderpriority")
    )
    return i.table("orders").select("o_orderkey", cells.parse_number(text).alias("number"))


@query("constant_prefix", "SELECT o_orderkey, 'CLIENT NO_' || o_orderkey AS clientName FROM orders")
def constant_prefix(i: Inputs) -> DataFrame:
    return i.table("orders").select("o_orderkey", cells.prefixed("CLIENT NO_", "o_orderkey").alias("clientName"))


@query(
    "margin_expr",
    """SELECT partId, contractId, materialPriceDate,
  round(cash - (CostMaterialPricePerDay + CostPartPricePerDay), 2) AS margin FROM v_margin_inputs""",
)
def margin_expr(i: Inputs) -> DataFrame:
    return join_margin_inputs(i.ods("fact_sales"), i.ods("fact_supply_chain")).select(
        "partId",
        "contractId",
        "materialPriceDate",
        cells.margin("cash", "CostMaterialPricePerDay", "CostPartPricePerDay").alias("margin"),
    )


@query(
    "udf_register",
    """SELECT "order", partId, epoch_ms(timeOfProduction) AS at,
  CAST(strptime(strftime(epoch_ms(timeOfProduction), '%m-%d-%Y'), '%m-%d-%Y') AS DATE) AS day,
  CAST(make_date(CAST(year(epoch_ms(timeOfProduction)) AS INTEGER), 1, 1) + CAST(partId % date_diff('day',
    make_date(CAST(year(epoch_ms(timeOfProduction)) AS INTEGER), 1, 1),
    make_date(CAST(year(epoch_ms(timeOfProduction)) AS INTEGER) + 1, 1, 1)) AS INTEGER) AS DATE) AS drawn,
  partId + machineId AS list_sum, strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM v_log, v_run""",
)
def udf_register(i: Inputs) -> DataFrame:
    register_functions(i.spark)
    return i.spark.sql(
        """SELECT `order`, partId, fl_epoch_ts(timeOfProduction) AS at,
             fl_parse_date(date_format(fl_epoch_ts(timeOfProduction), 'MM-dd-yyyy')) AS day,
             fl_day_in_year(year(fl_epoch_ts(timeOfProduction)), partId) AS drawn,
             aggregate(fl_int_list(concat('[''', partId, ''', x, ', machineId, ']')), 0L, (a, b) -> a + b) AS list_sum,
             fl_now_text(TIMESTAMP_NTZ '2024-06-01 12:30:45') AS stamp
           FROM {log}""",
        log=i.log,
    )


# -- projections and filters ---------------------------------------------------------------------


@query("project_columns", "SELECT partId, materialId, machineId, defaultPrice FROM v_bridge")
def project_columns(i: Inputs) -> DataFrame:
    return i.bridge.select("partId", "materialId", "machineId", "defaultPrice")


@query("project_renamed", "SELECT id AS partId, timeToProduce, meterials AS materials, machine AS machines FROM v_part_raw")
def project_renamed(i: Inputs) -> DataFrame:
    renamed = i.part_raw.withColumnsRenamed({"id": "partId", "meterials": "materials", "machine": "machines"})
    return renamed.drop("defaultPrice")


@query("derive_columns", "SELECT * FROM v_log_days")
def derive_columns(i: Inputs) -> DataFrame:
    return staging.production_days(i.log)


@query(
    "qualified_columns",
    """SELECT fact."order", fact.partId, machine.s_name AS machineName, machine.s_suppkey AS machineId
FROM v_log fact JOIN supplier machine ON fact.machineId = machine.s_suppkey""",
)
def qualified_columns(i: Inputs) -> DataFrame:
    fact, machine = i.log.alias("fact"), i.table("supplier").alias("machine")
    return fact.join(machine, F.col("fact.machineId") == F.col("machine.s_suppkey")).select(
        "fact.order",
        "fact.partId",
        F.col("machine.s_name").alias("machineName"),
        F.col("machine.s_suppkey").alias("machineId"),
    )


@query(
    "cast_columns",
    """SELECT o_orderkey, CASE WHEN o_orderkey <= 32767 THEN CAST(o_orderkey AS INTEGER) END AS as_short,
  CAST(o_orderkey AS INTEGER) AS as_int, CAST(o_orderdate AS DATE) AS as_date,
  CAST(o_orderkey AS DOUBLE) AS as_double FROM orders""",
)
def cast_columns(i: Inputs) -> DataFrame:
    """An id too large for a SMALLINT becomes NULL instead of failing the job."""
    return i.table("orders").select(
        "o_orderkey",
        F.col("o_orderkey").try_cast("smallint").cast("int").alias("as_short"),
        F.col("o_orderkey").cast("int").alias("as_int"),
        order_date().alias("as_date"),
        F.col("o_orderkey").cast("double").alias("as_double"),
    )


@query("filter_damaged", "SELECT machineId, partId, materialId, timeId, materialPrice FROM v_fact WHERE isDamaged = 1")
def damaged(i: Inputs) -> DataFrame:
    fact = filter_damaged(i.ods("fact_supply_chain"))
    return fact.select("machineId", "partId", "materialId", "timeId", "materialPrice")


@query(
    "filter_part_and_year",
    """SELECT DISTINCT w.part1 AS partId, f.materialId, f.materialPrice, f.materialPriceDate, f.partDefaultPrice
FROM v_fact f JOIN (SELECT DISTINCT part1, year(made) AS y FROM v_msg WHERE topic = 'supply_chain' AND NOT del) w
  ON f.partId = w.part1 AND year(f.materialPriceDate) = w.y""",
)
def filter_part_and_year(i: Inputs) -> DataFrame:
    """The distinct quotes in the fact for every part and year some message asks for."""
    rows = i.supply_rows.filter("NOT isDeleted")
    asked = rows.select(F.col("trscPartId").alias("partId"), F.year("timeOfProduction").alias("y"))
    fact = i.ods("fact_supply_chain").withColumn("y", F.year("materialPriceDate"))
    return (
        fact.join(asked.distinct(), ["partId", "y"], "left_semi")
        .select("partId", "materialId", "materialPrice", "materialPriceDate", "partDefaultPrice")
        .distinct()
    )


@query(
    "filter_key_equals",
    """SELECT m.machineId FROM v_machines m
WHERE m.machineId IN (SELECT user_id FROM v_msg WHERE topic = 'machine')""",
)
def filter_key_equals(i: Inputs) -> DataFrame:
    """The machines named by a message, found through their transactional id."""
    wanted = i.parsed["machine"].select(F.col("id").alias("trscMachineId"))
    return i.ods("dim_machine").join(wanted, "trscMachineId", "left_semi").select("machineId")


@query(
    "pick_message_fields",
    """SELECT CAST(strftime(made, '%Y%m%d') AS INTEGER) AS timeId, CAST(event % 2 AS INTEGER) AS isDamaged, ts AS lastUpdate
FROM v_msg WHERE topic = 'supply_chain'""",
)
def pick_message_fields(i: Inputs) -> DataFrame:
    """A listed field no message carries is left out without a failure."""
    return ch.pick_fields(i.supply_rows, ["materialIdODS", "timeId", "isDamaged", "lastUpdate"])


@query(
    "split_deletes",
    """SELECT topic, count(*) FILTER (WHERE NOT del) AS inserts, count(*) FILTER (WHERE del) AS deletes
FROM v_msg WHERE topic <> 'material_prices' GROUP BY topic""",
)
def split_deletes(i: Inputs) -> DataFrame:
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.select("topic", F.lit(name).alias("kind"))

    union = None
    for topic in schemas.MESSAGE_FIELDS:
        inserts, deletes = ch.split_deletes(i.parsed[topic])
        both = counted(inserts, "inserts").unionByName(counted(deletes, "deletes"))
        union = both if union is None else union.unionByName(both)
    return union.groupBy("topic").agg(
        F.count_if(F.col("kind") == "inserts").alias("inserts"),
        F.count_if(F.col("kind") == "deletes").alias("deletes"),
    )


@query(
    "derived_table",
    """SELECT CAST(year(materialPriceDate) AS INTEGER) AS y, count(*) AS quoteDays,
  round(sum(CostMaterialPricePerDay), 2) AS cost FROM v_quote_cost GROUP BY 1""",
)
def derived_table(i: Inputs) -> DataFrame:
    """A DISTINCT inside a GROUP BY inside another one."""
    from ..operators.aggregates import sum_material_cost

    per_day = sum_material_cost(i.ods("fact_supply_chain"))
    return per_day.groupBy(F.year("materialPriceDate").alias("y")).agg(
        F.count("*").alias("quoteDays"), F.round(F.sum("CostMaterialPricePerDay"), 2).alias("cost")
    )


_SALE_COLUMNS = "partId AS trscPartId, contractId AS trscContractId, partId, contractId, round(cash, 2) AS cash, date"


@query("conform_to_layer", f"SELECT {_SALE_COLUMNS}, run_ts AS lastUpdate FROM v_sales, v_run")
def conform(i: Inputs) -> DataFrame:
    rows, _ = conform_to_layer(i.sales, "fact_sales", "ods", fill_transactional=True)
    return rows.withColumn("cash", F.round("cash", 2))


@query(
    "conform_to_layer_rejects",
    "SELECT l_partkey AS n, CAST(count(*) AS BIGINT) AS lines FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1",
)
def conform_rejects(i: Inputs) -> DataFrame:
    """Log rows of one return flag spell their machine as text; these are the rejects."""
    key = F.when(F.col("l_returnflag") == "A", F.lit("unknown")).otherwise(F.col("l_suppkey").cast("string"))
    raw = i.table("lineitem").select(key.alias("machineId"), F.col("l_partkey").alias("n"))
    _, rejected = conform_to_layer(raw, "dim_machine", "ods")
    return rejected.groupBy("n").agg(F.count("*").alias("lines"))


# -- reporting dimensions ------------------------------------------------------------------------


@query("project_dims", "SELECT partId, timeToProduce FROM (SELECT DISTINCT id AS partId, timeToProduce FROM v_part_raw)")
def project_dims(i: Inputs) -> DataFrame:
    return project_dim(i.ods("dim_part_information"), "dim_part_information")


@query("mart_dim_part_information", "SELECT p_partkey AS partId, CAST(p_size AS DOUBLE) AS timeToProduce FROM part")
def mart_dim_part(i: Inputs) -> DataFrame:
    return project_dim(i.ods("dim_part_information"), "dim_part_information")


@query("mart_dim_contract", "SELECT DISTINCT contractId, clientName FROM v_sales")
def mart_dim_contract(i: Inputs) -> DataFrame:
    return project_dim(i.ods("dim_contract"), "dim_contract")


@query("mart_dim_machine", "SELECT machineId FROM v_machines")
def mart_dim_machine(i: Inputs) -> DataFrame:
    return project_dim(i.ods("dim_machine"), "dim_machine")


@query("mart_dim_material", "SELECT CAST(n_nationkey AS BIGINT) AS materialId, n_name AS name FROM nation")
def mart_dim_material(i: Inputs) -> DataFrame:
    return project_dim(i.ods("dim_material"), "dim_material")
