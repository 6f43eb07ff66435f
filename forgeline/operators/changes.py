"""Change messages to table rows, as pure functions over whole sets of messages.

A message log has the columns topic, partition, offset, timestamp (the broker's), value and ``seq``, its
place in the order of arrival. Offsets only compare within one partition, so messages are ordered by
broker time, then topic, partition and offset. Rows loaded before any message carry `BEFORE_ALL`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import cells, dates
from ..session import materialize
from . import keys as key_ops
from .aggregates import latest_by_key

BEFORE_ALL = -1
_NEVER = 2**63 - 1
ORDER = ["timestamp", "topic", "partition", "offset"]
_ORIGIN = ["topic", "partition", "offset", "seq", "value"]


@dataclass(frozen=True)
class DimTopic:
    """How one topic feeds one dimension: the message field of its key, the table and the
    id column."""

    topic: str
    table: str
    field: str
    key: str

    @property
    def trsc(self) -> str:
        return schemas.TRANSACTIONAL_ID[self.key]


# Which topic feeds which dimension.
DIM_TOPICS = {
    t.topic: t
    for t in (
        DimTopic("part_information", "dim_part_information", "id", "partId"),
        DimTopic("machine", "dim_machine", "id", "machineId"),
        DimTopic("material", "dim_material", "id", "materialId"),
        DimTopic("sales", "dim_contract", "contract_number", "contractId"),
    )
}
# The delete keys of the two facts.
SUPPLY_CHAIN_KEY = ["trscMachineId", "trscPartId", "timeOfProduction"]
SALES_KEY = ["trscContractId", "trscPartId"]
_REQUIRED = {
    "part_information": ["id"],
    "machine": ["id"],
    "material": ["id"],
    "sales": ["contract_number", "parts"],
    "supply_chain": ["machineId", "partId", "timeOfProduction"],
}
# What an insert needs besides; a delete is applied without it.
_REQUIRED_OF_INSERTS = {"sales": ["cash"]}


def with_seq(messages: DataFrame, first: int = 0) -> DataFrame:
    """Messages numbered from ``first`` on, across topics and partitions; stored. Messages without a
    broker time come first. A later call with the next number continues the order: what arrives in a
    later batch is later."""
    return key_ops.number_in_order(messages, ORDER, "seq", first)


def parse_topic(messages: DataFrame, topic: str) -> DataFrame:
    """Messages of one topic with their fields, ``isDeleted`` as a plain flag and ``reason``:
    why the message cannot be applied, NULL when it can."""
    schema = schemas.message_schema(topic).add("_unreadable", "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"}
    # A generator, not a projection: filters on the fields are not pushed below it, so the
    # text is parsed once per message and not once per use of a field.
    parsed = F.inline(F.array(F.from_json(F.col("value").cast("string"), schema, options)))
    fields = (
        messages.filter(F.col("topic") == topic)
        .select(*_ORIGIN, parsed)
        .withColumn("isDeleted", F.coalesce("isDeleted", F.lit(False)))
    )
    missing = F.lit(False)
    for name in _REQUIRED[topic]:
        missing = missing | F.col(name).isNull()
    for name in _REQUIRED_OF_INSERTS.get(topic, []):
        missing = missing | (~F.col("isDeleted") & F.col(name).isNull())
    reason = F.when(F.col("value").isNull() | F.col("_unreadable").isNotNull(), "unreadable value").when(
        missing, "missing field"
    )
    if topic == "part_information":
        bad = ~F.col("isDeleted") & cells.parse_number("timeToProduce").isNull()
        reason = reason.when(bad, "bad number")
    if topic == "sales":
        bad = ~F.col("isDeleted") & F.col("date").try_cast("date").isNull()
        reason = reason.when(bad, "bad date")
    if topic == "supply_chain":
        reason = reason.when(dates.iso_date("timeOfProduction").isNull(), "bad date")
    return fields.withColumn("reason", reason).drop("_unreadable")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("topic", "partition", "offset", "value", "reason")


def unknown_topics(messages: DataFrame) -> DataFrame:
    """Messages no handler takes."""
    handled = F.coalesce(F.col("topic").isin(list(schemas.MESSAGE_FIELDS)), F.lit(False))
    return messages.filter(~handled).select(
        "topic", "partition", "offset", "value", F.lit("unknown topic").alias("reason")
    )


def split_deletes(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parsed.filter(~F.col("isDeleted")), parsed.filter(F.col("isDeleted"))


def pick_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """The listed columns which are there, in list order; the others are left out."""
    return df.select(*[c for c in fields if c in df.columns])


def _updated() -> Column:
    return F.col("lastUpdate").try_cast("timestamp_ntz").alias("lastUpdate")


def as_changes(table: DataFrame) -> DataFrame:
    """Loaded rows in the form of a change log, older than any message."""
    return table.withColumn("seq", F.lit(BEFORE_ALL).cast("bigint")).withColumn("isDeleted", F.lit(False))


def apply_changes(changes: DataFrame, keys: list[str], mode: str = "append") -> DataFrame:
    """The table after a change log (``keys``, ``seq``, ``isDeleted`` and the other columns).

    ``append`` keeps every insert after the last delete of its key; ``upsert`` keeps only the
    newest of them. Rows with a NULL key match no delete.

    The last deletes are written out first: they are few beside the rows, so the rows need no
    shuffle while they fit a broadcast, and beyond that the join has two plain scans
    below it, whose skewed partitions AQE splits.
    """
    if mode not in ("append", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    deletes = changes.filter("isDeleted").groupBy(*keys).agg(F.max("seq").alias("_dead"))
    inserts = changes.filter(~F.col("isDeleted"))
    kept = (
        inserts.join(materialize(deletes, "deletes"), keys, "left")
        .filter(F.col("_dead").isNull() | (F.col("seq") > F.col("_dead")))
        .select(*inserts.columns)
    )
    if mode == "upsert":
        kept = latest_by_key(kept, keys, ["lastUpdate", "seq"])
    return kept


def table_after(changes: DataFrame, table: str, keys: list[str], mode: str = "append") -> DataFrame:
    """`apply_changes` cut to the columns of the operational table."""
    return apply_changes(changes, keys, mode).select(*schemas.table_schema(table, "ods").fieldNames())


# -- keys seen in messages ---------------------------------------------------------------


def _inserts(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("isDeleted"))


def seen_keys(parsed: dict[str, DataFrame], key: str) -> DataFrame:
    """Every use of a transactional id by an insert: (trsc, seq)."""
    trsc = schemas.TRANSACTIONAL_ID[key]

    def use(topic: str, column: Column) -> DataFrame:
        return _inserts(parsed[topic]).select(column.alias(trsc), "seq")

    uses = {
        "partId": [("part_information", F.col("id")), ("sales", F.explode("parts"))],
        "machineId": [("machine", F.col("id")), ("supply_chain", F.col("machineId"))],
        "materialId": [("material", F.col("id"))],
        "contractId": [("sales", F.col("contract_number"))],
    }[key]
    result = use(*uses[0])
    for other in uses[1:]:
        result = result.unionByName(use(*other))
    return result


# -- dimensions ----------------------------------------------------------------------------


def dim_changes(parsed: DataFrame, topic: str, key_map: DataFrame) -> DataFrame:
    """Change rows of the dimension a topic feeds."""
    spec = DIM_TOPICS[topic]
    rows = parsed.withColumn(spec.trsc, F.col(spec.field))
    mapped = key_ops.lookup_surrogate(rows, key_map, spec.trsc, spec.key, "left")
    payload = {
        "part_information": [cells.parse_number("timeToProduce").alias("timeToProduce")],
        "machine": [],
        "material": [F.col("name")],
        "sales": [F.col("client_name").alias("clientName")],
    }[topic]
    return mapped.select(spec.trsc, spec.key, *payload, _updated(), "seq", "isDeleted")


# -- sales ---------------------------------------------------------------------------------


def sales_changes(
    parsed: DataFrame, part_map: DataFrame, contract_map: DataFrame, total: str = "dot_product"
) -> DataFrame:
    """Change rows of the sales fact: one per listed part, each with the contract's total.

    The total multiplies cash by the part id (``dot_product``) or adds the cash up (``sum``).
    """
    cash = {"dot_product": cells.dot_product("cash", "parts"), "sum": cells.array_total("cash")}[total]
    rows = parsed.select(
        F.col("contract_number").alias("trscContractId"),
        F.explode("parts").alias("trscPartId"),
        cash.alias("cash"),
        F.col("date").try_cast("date").alias("date"),
        _updated(),
        "seq",
        "isDeleted",
    )
    with_part = key_ops.lookup_surrogate(rows, part_map, "trscPartId", "partId", "left")
    with_contract = key_ops.lookup_surrogate(with_part, contract_map, "trscContractId", "contractId", "left")
    return with_contract.select(
        *schemas.table_schema("fact_sales", "ods").fieldNames(), "seq", "isDeleted"
    )


# -- supply chain ----------------------------------------------------------------------------


def supply_chain_rows(parsed: DataFrame) -> DataFrame:
    """Messages under the names of the fact, with their day, calendar key and damage flag."""
    day = dates.iso_date("timeOfProduction")
    return parsed.select(
        "topic",
        "partition",
        "offset",
        "value",
        F.col("machineId").alias("trscMachineId"),
        F.col("partId").alias("trscPartId"),
        day.alias("timeOfProduction"),
        dates.time_id(day).alias("timeId"),
        F.col("var5").alias("isDamaged"),
        _updated(),
        "seq",
        "isDeleted",
    )


def _held_spans(rows: DataFrame, part_map: DataFrame) -> DataFrame:
    """When the inserts among ``rows`` are in the fact: (partId, priceYear, start, end), ``end``
    being the next delete of the key. Of the inserts of a key between two deletes the first one
    speaks for all, and of those that stay the first one of its part and year."""
    later = Window.partitionBy(*SUPPLY_CHAIN_KEY).orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    ends = F.coalesce(F.min(F.when(F.col("isDeleted"), F.col("seq"))).over(later), F.lit(_NEVER))
    key = F.when(F.col("end") < _NEVER, F.struct("trscMachineId", "timeOfProduction"))
    return (
        rows.select(*SUPPLY_CHAIN_KEY, "isDeleted", "seq", ends.alias("end"))
        .filter(~F.col("isDeleted"))
        .join(part_map.select("trscPartId", "partId"), "trscPartId")
        .groupBy("partId", F.year("timeOfProduction").alias("priceYear"), "end", key.alias("key"))
        .agg(F.min("seq").alias("start"))
        .drop("key")
    )


def visible_quotes(fact: DataFrame, rows: DataFrame, part_map: DataFrame) -> DataFrame:
    """The distinct quotes in the fact for each part and year the inserts among ``rows`` ask
    for, and in ``goneAt`` the seq of the delete among ``rows`` after which no fact row holds the
    quote. An insert among ``rows`` takes over the quotes it sees and so keeps them: the
    result is the same however the messages are cut into batches."""
    inserts, deletes = split_deletes(rows)
    asked = (
        inserts.select("trscPartId", F.year("timeOfProduction").alias("priceYear"))
        .distinct()
        .join(part_map.select("trscPartId", "partId"), "trscPartId")
        .select("partId", "priceYear")
    )
    # Stored, as in `apply_changes`: the rows are not shuffled while the deletes fit a broadcast.
    first_delete = materialize(deletes.groupBy(*SUPPLY_CHAIN_KEY).agg(F.min("seq").alias("_dead")), "first-deletes")
    quote = ["partId", "priceYear", "materialId", "materialPrice", "materialPriceDate", "partDefaultPrice"]
    held = (
        fact.withColumn("priceYear", F.year("materialPriceDate"))
        .select(*quote, *SUPPLY_CHAIN_KEY)
        .join(materialize(asked, "asked"), ["partId", "priceYear"], "left_semi")
    )
    loaded = materialize(
        held.join(first_delete, SUPPLY_CHAIN_KEY, "left")
        .groupBy(*quote)
        .agg(F.max(F.coalesce("_dead", F.lit(_NEVER))).alias("end")),
        "held",
    )
    # A quote no delete can reach needs no look at the inserts.
    safe = loaded.filter(F.col("end") == _NEVER).withColumnRenamed("end", "goneAt")
    mortal = loaded.filter(F.col("end") < _NEVER)
    taken = mortal.drop("end").join(_held_spans(rows, part_map), ["partId", "priceYear"])
    spans = mortal.withColumn("start", F.lit(BEFORE_ALL).cast("bigint")).unionByName(taken)
    before = Window.partitionBy(*quote).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    gone = (
        spans.withColumn("covered", F.max("end").over(before))
        .groupBy(*quote)
        .agg(
            F.coalesce(F.min(F.when(F.col("covered") <= F.col("start"), F.col("covered"))), F.max("end")).alias("goneAt")
        )
    )
    return materialize(safe.unionByName(gone), "quotes")


def material_trsc(materials: DataFrame, quotes: DataFrame) -> DataFrame:
    """Transactional id of each quoted material from ``materials`` (materialId,
    trscMaterialId); a material without one gets the next free number."""
    known = materials.groupBy("materialId").agg(F.min("trscMaterialId").alias("trscMaterialId"))
    wanted = quotes.select("materialId").distinct().join(known, "materialId", "left")
    highest = materials.select(F.coalesce(F.max("trscMaterialId"), F.lit(0))).scalar()
    free = key_ops.number_rows(
        wanted.filter("trscMaterialId IS NULL").drop("trscMaterialId"), "materialId", []
    ).select("materialId", (F.col("rank") + highest).alias("trscMaterialId"))
    return wanted.filter("trscMaterialId IS NOT NULL").unionByName(free)


def _same_part_and_year(rows: DataFrame, quotes: DataFrame) -> Column:
    return (
        (rows["partId"] == quotes["partId"])
        & (rows["_year"] == quotes["priceYear"])
        & (rows["seq"] < quotes["goneAt"])
    )


def _insert_rows(rows: DataFrame, part_map: DataFrame) -> DataFrame:
    inserts = rows.filter(~F.col("isDeleted")).withColumn("_year", F.year("timeOfProduction"))
    return inserts.join(part_map.select("trscPartId", "partId"), "trscPartId", "left")


def join_message_quotes(rows: DataFrame, quotes: DataFrame, part_map: DataFrame) -> DataFrame:
    """Insert messages with each quote of their part and year: the message's fields repeated
    on every quote."""
    inserts = _insert_rows(rows, part_map)
    return inserts.join(quotes, _same_part_and_year(inserts, quotes), "inner").drop(
        quotes["partId"], quotes["priceYear"], quotes["goneAt"], inserts["_year"]
    )


def unmatched_messages(rows: DataFrame, quotes: DataFrame, part_map: DataFrame) -> DataFrame:
    """Insert messages without any quote."""
    inserts = _insert_rows(rows, part_map)
    lost = inserts.join(quotes, _same_part_and_year(inserts, quotes), "left_anti")
    return lost.select(
        "topic", "partition", "offset", "value", F.lit("no quote for part and year").alias("reason")
    )


def supply_chain_changes(
    rows: DataFrame, quotes: DataFrame, part_map: DataFrame, machine_map: DataFrame, materials: DataFrame
) -> DataFrame:
    """Change rows of the supply-chain fact: one per insert and quote, one per delete."""
    columns = schemas.table_schema("fact_supply_chain", "ods").fieldNames()
    priced = join_message_quotes(rows, quotes, part_map).join(
        material_trsc(materials, quotes), "materialId", "left"
    )
    inserts = key_ops.lookup_surrogate(priced, machine_map, "trscMachineId", "machineId", "left")
    deletes = rows.filter("isDeleted").select(*SUPPLY_CHAIN_KEY, "seq", "isDeleted")
    return inserts.select(*columns, "seq", "isDeleted").unionByName(deletes, allowMissingColumns=True)
