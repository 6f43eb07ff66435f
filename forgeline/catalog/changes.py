"""Change messages applied to the stored operational tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import changes as ch
from ..operators import joins
from ..plans import marts
from .registry import Inputs, query, subquery
from .subqueries import MART_SALES, MART_SUPPLY

# -- the same in SQL: messages by topic, ids, table states -----------------------------------------

_DIMS = {
    # topic: (table's loaded rows as trsc/key, key, transactional id, first uses, payload)
    "machine": (
        "SELECT machineId AS trsc, machineId AS id FROM v_machines",
        "SELECT user_id AS trsc, seq FROM v_msg WHERE topic = 'machine' AND NOT del "
        "UNION ALL SELECT machine, seq FROM v_msg WHERE topic = 'supply_chain' AND NOT del",
    ),
    "part": (
        "SELECT p_partkey AS trsc, p_partkey AS id FROM part",
        "SELECT user_id AS trsc, seq FROM v_msg WHERE topic = 'part_information' AND NOT del "
        "UNION ALL SELECT part1, seq FROM v_msg WHERE topic = 'sales' AND NOT del "
        "UNION ALL SELECT part2, seq FROM v_msg WHERE topic = 'sales' AND NOT del",
    ),
    "material": (
        "SELECT CAST(n_nationkey AS BIGINT) AS trsc, CAST(n_nationkey AS BIGINT) AS id FROM nation",
        "SELECT user_id AS trsc, seq FROM v_msg WHERE topic = 'material' AND NOT del",
    ),
    "contract": (
        "SELECT DISTINCT contractId AS trsc, contractId AS id FROM v_sales",
        "SELECT user_id AS trsc, seq FROM v_msg WHERE topic = 'sales' AND NOT del",
    ),
}
for _name, (_loaded, _uses) in _DIMS.items():
    subquery(f"v_{_name}_loaded", _loaded)
    subquery(f"v_{_name}_uses", _uses)
    subquery(
        f"v_{_name}_ids",
        f"""SELECT u.trsc, coalesce(l.id, (SELECT max(id) FROM v_{_name}_loaded)
    + row_number() OVER (PARTITION BY l.id IS NULL ORDER BY u.first, u.trsc)) AS id, l.id IS NULL AS isNew
FROM (SELECT trsc, min(seq) AS first FROM v_{_name}_uses GROUP BY trsc) u
LEFT JOIN v_{_name}_loaded l ON l.trsc = u.trsc""",
    )

subquery(
    "v_machine_changes",
    """SELECT machineId AS trscMachineId, machineId, run_ts AS lastUpdate, CAST(-1 AS BIGINT) AS seq, false AS del
FROM v_machines, v_run
UNION ALL SELECT m.user_id, k.id, m.ts, m.seq, m.del FROM v_msg m LEFT JOIN v_machine_ids k ON k.trsc = m.user_id
WHERE m.topic = 'machine'""",
)
subquery(
    "v_part_changes",
    """SELECT p_partkey AS trscPartId, p_partkey AS partId, CAST(p_size AS DOUBLE) AS timeToProduce, run_ts AS lastUpdate,
  CAST(-1 AS BIGINT) AS seq, false AS del FROM part, v_run
UNION ALL SELECT m.user_id, k.id, m.value, m.ts, m.seq, m.del FROM v_msg m LEFT JOIN v_part_ids k ON k.trsc = m.user_id
WHERE m.topic = 'part_information'""",
)
subquery(
    "v_material_changes",
    """SELECT CAST(n_nationkey AS BIGINT) AS trscMaterialId, CAST(n_nationkey AS BIGINT) AS materialId, n_name AS name,
  run_ts AS lastUpdate, CAST(-1 AS BIGINT) AS seq, false AS del FROM nation, v_run
UNION ALL SELECT m.user_id, k.id, 'MATERIAL_' || m.user_id, m.ts, m.seq, m.del
FROM v_msg m LEFT JOIN v_material_ids k ON k.trsc = m.user_id WHERE m.topic = 'material'""",
)
subquery(
    "v_contract_changes",
    """SELECT DISTINCT contractId AS trscContractId, contractId, clientName, run_ts AS lastUpdate,
  CAST(-1 AS BIGINT) AS seq, false AS del FROM v_sales, v_run
UNION ALL SELECT m.user_id, k.id, 'CLIENT NO_' || m.user_id, m.ts, m.seq, m.del
FROM v_msg m LEFT JOIN v_contract_ids k ON k.trsc = m.user_id WHERE m.topic = 'sales'""",
)
subquery(
    "v_sale_parts",
    """SELECT seq, del, user_id, ts, part1 AS part, round(value) * part1 + (event % 100) * part2 AS cash FROM v_msg
WHERE topic = 'sales'
UNION ALL SELECT seq, del, user_id, ts, part2, round(value) * part1 + (event % 100) * part2 FROM v_msg
WHERE topic = 'sales'""",
)
subquery(
    "v_sales_changes",
    """SELECT partId AS trscPartId, contractId AS trscContractId, partId, contractId, cash, date, run_ts AS lastUpdate,
  CAST(-1 AS BIGINT) AS seq, false AS del FROM v_sales, v_run
UNION ALL SELECT s.part, s.user_id, p.id, c.id, s.cash, CAST(s.ts AS DATE), s.ts, s.seq, s.del FROM v_sale_parts s
LEFT JOIN v_part_ids p ON p.trsc = s.part LEFT JOIN v_contract_ids c ON c.trsc = s.user_id""",
)
subquery(
    "v_supply_deletes",
    "SELECT machine, part1, made, min(seq) AS dead FROM v_msg WHERE topic = 'supply_chain' AND del GROUP BY ALL",
)
_QUOTE = "partId, y, materialId, materialPrice, materialPriceDate, partDefaultPrice"
subquery(
    "v_quotes_loaded",
    """SELECT f.partId, year(f.materialPriceDate) AS y, f.materialId, f.materialPrice, f.materialPriceDate,
  f.partDefaultPrice, CAST(-1 AS BIGINT) AS starts, max(coalesce(d.dead, 9223372036854775807)) AS ends
FROM v_fact f LEFT JOIN v_supply_deletes d
  ON d.machine = f.machineId AND d.part1 = f.partId AND d.made = f.timeOfProduction GROUP BY ALL""",
)
subquery(
    "v_supply_spans",
    """SELECT seq, part1, made, del, coalesce(min(CASE WHEN del THEN seq END) OVER (PARTITION BY machine, part1, made
  ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 9223372036854775807) AS ends
FROM v_msg WHERE topic = 'supply_chain'""",
)
subquery(
    "v_quotes_held",
    """SELECT * FROM v_quotes_loaded
UNION ALL SELECT q.* EXCLUDE (starts, ends), s.seq, s.ends FROM v_quotes_loaded q
JOIN v_supply_spans s ON s.part1 = q.partId AND year(s.made) = q.y AND NOT s.del""",
)
subquery(
    "v_visible",
    f"""SELECT {_QUOTE}, coalesce(min(CASE WHEN covered <= starts THEN covered END), max(ends)) AS goneAt
FROM (SELECT *, max(ends) OVER (PARTITION BY {_QUOTE} ORDER BY starts
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered FROM v_quotes_held) GROUP BY {_QUOTE}""",
)
subquery(
    "v_supply_priced",
    """SELECT m.seq, m.event, m.machine, m.part1, m.made, m.ts, q.* FROM v_msg m JOIN v_visible q
  ON q.partId = m.part1 AND q.y = year(m.made) AND m.seq < q.goneAt
WHERE m.topic = 'supply_chain' AND NOT m.del AND m.part1 IN (SELECT trsc FROM v_part_ids)""",
)
subquery(
    "v_supply_changes",
    """SELECT machineId AS trscMachineId, partId AS trscPartId, materialId AS trscMaterialId, machineId, partId, materialId,
  timeOfProduction, timeId, materialPrice, materialPriceDate, partDefaultPrice, isDamaged, run_ts AS lastUpdate,
  CAST(-1 AS BIGINT) AS seq, false AS del FROM v_fact, v_run
UNION ALL SELECT p.machine, p.part1, p.materialId, k.id, p.partId, p.materialId, p.made,
  CAST(strftime(p.made, '%Y%m%d') AS INTEGER), p.materialPrice, p.materialPriceDate, p.partDefaultPrice,
  CAST(p.event % 2 AS INTEGER), p.ts, p.seq, false
FROM v_supply_priced p JOIN v_machine_ids k ON k.trsc = p.machine""",
)

_STATE = """SELECT c.* EXCLUDE (seq, del) FROM {changes} c LEFT JOIN (
  SELECT {keys}, max(seq) AS dead FROM {deletes} WHERE del GROUP BY ALL) d
  ON {on} WHERE NOT c.del AND (d.dead IS NULL OR c.seq > d.dead)"""


def _state(changes: str, keys: list[str], upsert: bool = False) -> str:
    sql = _STATE.format(
        changes=changes, deletes=changes, keys=", ".join(keys), on=" AND ".join(f"d.{k} = c.{k}" for k in keys)
    )
    if upsert:
        sql += f" QUALIFY row_number() OVER (PARTITION BY {', '.join('c.' + k for k in keys)} ORDER BY c.lastUpdate DESC, c.seq DESC) = 1"
    return sql


subquery("v_machine_after", _state("v_machine_changes", ["trscMachineId"]))
subquery("v_part_after", _state("v_part_changes", ["trscPartId"]))
subquery("v_material_after", _state("v_material_changes", ["trscMaterialId"]))
subquery("v_contract_after", _state("v_contract_changes", ["trscContractId"]))
subquery("v_sales_after", _state("v_sales_changes", ["trscContractId", "trscPartId"]))
subquery(
    "v_supply_after",
    """SELECT c.* EXCLUDE (seq, del) FROM v_supply_changes c
LEFT JOIN (SELECT machine, part1, made, max(seq) AS dead FROM v_msg WHERE topic = 'supply_chain' AND del GROUP BY ALL) d
  ON d.machine = c.trscMachineId AND d.part1 = c.trscPartId AND d.made = c.timeOfProduction
WHERE d.dead IS NULL OR c.seq > d.dead""",
)

# -- the tables as loaded, after the messages, and as reported ----------------------------------------

_BY_TABLE = {
    "dim_machine": "machine", "dim_material": "material", "dim_part_information": "part",
    "dim_contract": "contract", "fact_sales": "sales", "fact_supply_chain": "supply",
}
_DIM_KEYS = {"machine": "trscMachineId", "material": "trscMaterialId", "part": "trscPartId", "contract": "trscContractId"}
CALENDAR = """SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS timeId, date, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CASE WHEN quarter(date) IN (1, 2) THEN 1 ELSE 2 END AS semester, CAST(quarter(date) AS INTEGER) AS quarter FROM v_calendar"""


def loaded_sources() -> dict[str, tuple]:
    """The operational tables as the batch run loads them, per table a statement and its schema."""
    found = {t: f"SELECT * EXCLUDE (seq, del) FROM v_{n}_changes WHERE seq = -1" for t, n in _BY_TABLE.items()}
    return _with_schemas(found | {"dim_time": CALENDAR}, "ods")


def changed_sources() -> dict[str, tuple]:
    """The operational tables after all messages."""
    return _with_schemas({t: f"SELECT * FROM v_{n}_after" for t, n in _BY_TABLE.items()}, "ods")


def reported_sources(after: bool) -> dict[str, tuple]:
    """The reporting tables; after the messages a dimension holds the newest row of each entity."""
    end, fact = ("_after", "v_supply_after") if after else ("", "v_fact")
    found = {}
    for table, name in _BY_TABLE.items():
        if table.startswith("dim_"):
            newest = _state(f"v_{name}_changes", [_DIM_KEYS[name]], upsert=True)
            found[table] = newest if after else f"SELECT * FROM v_{name}_changes WHERE seq = -1"
    found["fact_sales"] = MART_SALES.format(inputs=f"v_margin_inputs{end}")
    found["fact_supply_chain"] = f"SELECT * FROM ({MART_SUPPLY.format(fact=fact)}) WHERE GarbageProduction > 0"
    if not after:
        found["dim_time"] = CALENDAR
    return _with_schemas(found, "dwh")


def _with_schemas(found: dict[str, str], layer: str) -> dict[str, tuple]:
    return {t: (sql, schemas.table_schema(t, layer)) for t, sql in found.items()}


# -- routing and rejecting --------------------------------------------------------------------------


def all_rejects(i: Inputs) -> DataFrame:
    """Messages that cannot be applied, each with the reason."""
    parts = [ch.unknown_topics(i.messages)]
    parts += [ch.rejects(ch.parse_topic(i.messages, t)) for t in schemas.MESSAGE_FIELDS]
    parts.append(ch.unmatched_messages(i.supply_rows, i.visible_quotes, i.part_ids))
    return reduce(DataFrame.unionByName, parts)


@query(
    "route_topics",
    """SELECT topic, CAST(topic <> 'material_prices' AS INTEGER) AS handled, count(*) AS messages FROM v_msg GROUP BY ALL""",
)
def route_topics(i: Inputs) -> DataFrame:
    taken = [i.parsed[t].select("topic", F.lit(1).alias("handled")) for t in schemas.MESSAGE_FIELDS]
    routed = reduce(DataFrame.unionByName, taken, ch.unknown_topics(i.messages).select("topic", F.lit(0).alias("handled")))
    return routed.groupBy("topic", "handled").agg(F.count("*").alias("messages"))


_UNMATCHED = """SELECT topic, partition, "offset", 'no quote for part and year' AS reason FROM v_msg
WHERE topic = 'supply_chain' AND NOT del AND seq NOT IN (SELECT seq FROM v_supply_priced)"""


@query(
    "reject_messages",
    f"""SELECT topic, partition, "offset", 'unknown topic' AS reason FROM v_msg WHERE topic = 'material_prices'
UNION ALL {_UNMATCHED}""",
)
def reject_messages(i: Inputs) -> DataFrame:
    return all_rejects(i).drop("value")


@query(
    "reject_sales_messages",
    """SELECT partition, "offset", CASE WHEN seq % 3 = 0 THEN 'bad date' ELSE 'missing field' END AS reason
FROM v_msg WHERE topic = 'sales' AND NOT del AND seq % 3 < 2""",
)
def reject_sales_messages(i: Inputs) -> DataFrame:
    """Sales messages, a third of them with a garbled date and a third without cash: the
    inserts among these are rejected, a delete needs neither field."""
    third = F.col("seq") % 3
    value = F.when(third == 0, F.regexp_replace("value", '"date":"[^"]*"', '"date":"oops"')).when(
        third == 1, F.regexp_replace("value", r'"cash":\[[^\]]*\],', "")
    )
    garbled = i.messages.withColumn("value", F.coalesce(value, "value"))
    return ch.rejects(ch.parse_topic(garbled, "sales")).select("partition", "offset", "reason")


@query("unmatched_messages", _UNMATCHED)
def unmatched_messages(i: Inputs) -> DataFrame:
    return ch.unmatched_messages(i.supply_rows, i.visible_quotes, i.part_ids).drop("value")


# -- keys ----------------------------------------------------------------------------------------------


@query("assign_surrogate_keys", "SELECT trsc AS trscMaterialId, CAST(id AS BIGINT) AS materialId, CAST(isNew AS INTEGER) AS isNew FROM v_material_ids")
def assign_surrogate_keys(i: Inputs) -> DataFrame:
    return i.key_map("materialId").select("trscMaterialId", "materialId", F.col("isNew").cast("int").alias("isNew"))


@query(
    "join_surrogate_lookup",
    """SELECT m.seq, m.user_id AS trscMachineId, CAST(k.id AS BIGINT) AS machineId
FROM v_msg m JOIN v_machine_ids k ON k.trsc = m.user_id WHERE m.topic = 'machine' AND NOT m.del""",
)
def join_surrogate_lookup(i: Inputs) -> DataFrame:
    from ..operators.keys import lookup_surrogate

    rows = i.parsed["machine"].filter("NOT isDeleted").select("seq", F.col("id").alias("trscMachineId"))
    return lookup_surrogate(rows, i.key_map("machineId"), "trscMachineId", "machineId")


@query(
    "join_material_trsc",
    """SELECT DISTINCT v.materialId, v.materialId AS trscMaterialId FROM v_visible v JOIN v_msg m
  ON m.topic = 'supply_chain' AND NOT m.del AND m.part1 = v.partId AND year(m.made) = v.y""",
)
def join_material_trsc(i: Inputs) -> DataFrame:
    return ch.material_trsc(i.ods("dim_material"), i.visible_quotes)


# -- set forms of DELETE ------------------------------------------------------------------------------------


@query(
    "delete_by_key",
    """SELECT trsc AS machineId FROM v_machine_loaded
WHERE trsc NOT IN (SELECT user_id FROM v_msg WHERE topic = 'machine' AND del)""",
)
def delete_by_key(i: Inputs) -> DataFrame:
    deletes = i.parsed["machine"].filter("isDeleted").select(F.col("id").alias("trscMachineId"))
    return joins.delete_by_key(i.ods("dim_machine"), deletes, ["trscMachineId"]).select("machineId")


@query(
    "delete_by_composite_key",
    """SELECT f.* FROM v_fact f LEFT JOIN v_supply_deletes d
  ON d.machine = f.machineId AND d.part1 = f.partId AND d.made = f.timeOfProduction WHERE d.dead IS NULL""",
)
def delete_by_composite_key(i: Inputs) -> DataFrame:
    left = joins.delete_by_key(
        i.ods("fact_supply_chain"), i.supply_rows.filter("isDeleted"), ch.SUPPLY_CHAIN_KEY
    )
    return left.drop("trscMachineId", "trscPartId", "trscMaterialId", "lastUpdate")


# -- tables after the messages ------------------------------------------------------------------------------------


def _events(i: Inputs) -> DataFrame:
    """The events behind the messages, by the message's place."""
    event = F.col("event_id")
    return i.table("events").select(
        (event % 2).cast("int").alias("partition"),
        F.floor(event / 2).cast("bigint").alias("offset"),
        "event_id",
        "user_id",
        F.col("ts").alias("lastUpdate"),
    )


@query(
    "apply_changes",
    """SELECT m.topic, m.user_id, m.seq FROM v_msg m LEFT JOIN (
  SELECT topic, user_id, max(seq) AS dead FROM v_msg WHERE del GROUP BY ALL) d USING (topic, user_id)
WHERE NOT m.del AND (d.dead IS NULL OR m.seq > d.dead)""",
)
def apply_changes(i: Inputs) -> DataFrame:
    """The change rule alone, over every topic: the inserts later than the last delete."""
    changes = i.messages.join(_events(i), ["partition", "offset"]).select(
        "topic", "user_id", "seq", (F.col("event_id") % 7 == 0).alias("isDeleted")
    )
    return ch.apply_changes(changes, ["topic", "user_id"]).drop("isDeleted")


@query(
    "apply_changes_upsert",
    """SELECT m.topic, m.user_id, max(m.seq) AS seq FROM v_msg m LEFT JOIN (
  SELECT topic, user_id, max(seq) AS dead FROM v_msg WHERE del GROUP BY ALL) d USING (topic, user_id)
WHERE NOT m.del AND (d.dead IS NULL OR m.seq > d.dead) GROUP BY ALL""",
)
def apply_changes_upsert(i: Inputs) -> DataFrame:
    changes = i.messages.join(_events(i), ["partition", "offset"]).select(
        "topic", "user_id", "seq", "lastUpdate", (F.col("event_id") % 7 == 0).alias("isDeleted")
    )
    return ch.apply_changes(changes, ["topic", "user_id"], "upsert").drop("isDeleted", "lastUpdate")


def _dim(i: Inputs, topic: str, mode: str = "append") -> DataFrame:
    spec = ch.DIM_TOPICS[topic]
    return ch.table_after(i.dim_changes(topic), spec.table, [spec.trsc], mode)


def _ids(names: str, source: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'CAST({n} AS BIGINT) AS {n}' for n in names.split())}) FROM {source}"


@query("apply_part", _ids("partId", "v_part_after"))
def apply_part(i: Inputs) -> DataFrame:
    return _dim(i, "part_information")


@query("apply_machine", _ids("machineId", "v_machine_after"))
def apply_machine(i: Inputs) -> DataFrame:
    return _dim(i, "machine")


@query("apply_machine_upsert", _ids("machineId", f"({_state('v_machine_changes', ['trscMachineId'], upsert=True)})"))
def apply_machine_upsert(i: Inputs) -> DataFrame:
    return _dim(i, "machine", "upsert")


@query("apply_material", _ids("materialId", "v_material_after"))
def apply_material(i: Inputs) -> DataFrame:
    return _dim(i, "material")


@query("apply_contract_dim", _ids("contractId", "v_contract_after"))
def apply_contract_dim(i: Inputs) -> DataFrame:
    return _dim(i, "sales")


@query(
    "apply_contract",
    """SELECT trscPartId, trscContractId, CAST(partId AS BIGINT) AS partId, CAST(contractId AS BIGINT) AS contractId,
  round(cash, 2) AS cash, date, lastUpdate FROM v_sales_after""",
)
def apply_contract(i: Inputs) -> DataFrame:
    return ch.table_after(i.sales_changes, "fact_sales", ch.SALES_KEY).withColumn("cash", F.round("cash", 2))


@query("apply_supply_chain", _ids("machineId", "v_supply_after"))
def apply_supply_chain(i: Inputs) -> DataFrame:
    return ch.table_after(i.supply_changes, "fact_supply_chain", ch.SUPPLY_CHAIN_KEY)


_TUPLE = "materialId, materialPrice, materialPriceDate, partDefaultPrice"


@query("join_message_quotes", f"SELECT seq, {_TUPLE} FROM v_supply_priced")
def join_message_quotes(i: Inputs) -> DataFrame:
    joined = ch.join_message_quotes(i.supply_rows, i.visible_quotes, i.part_ids)
    return joined.select("seq", *_TUPLE.split(", "))


@query(
    "append_message_fields",
    f"""SELECT {_TUPLE}, CAST(strftime(made, '%Y%m%d') AS INTEGER) AS timeId, machine AS trscMachineId,
  part1 AS trscPartId, made AS timeOfProduction, CAST(event % 2 AS INTEGER) AS isDamaged, ts AS lastUpdate
FROM v_supply_priced""",
)
def append_message_fields(i: Inputs) -> DataFrame:
    """The listed message fields behind each quote tuple, in list order."""
    joined = ch.join_message_quotes(i.supply_rows, i.visible_quotes, i.part_ids)
    wanted = ["materialIdODS", "timeId", "trscMachineId", "trscPartId", "timeOfProduction", "isDamaged", "lastUpdate"]
    return ch.pick_fields(joined, [*_TUPLE.split(", "), *wanted])


@query(
    "mart_dim_material_current",
    f"SELECT CAST(materialId AS BIGINT) AS materialId, name FROM ({_state('v_material_changes', ['trscMaterialId'], upsert=True)})",
)
def mart_dim_material_current(i: Inputs) -> DataFrame:
    """The reporting dimension after messages: one row per material, its newest."""
    changes = ch.apply_changes(i.dim_changes("material"), ["trscMaterialId"])
    return marts.current_dim(changes, "dim_material", ["lastUpdate", "seq"])
