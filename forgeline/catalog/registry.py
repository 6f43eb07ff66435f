"""Registry of queries and their SQL twins, and the inputs both sides share.

The Spark side goes through `Inputs`; the SQL side through the named subqueries in
`SUBQUERIES`, of which a statement gets those it mentions.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures, schemas
from ..operators import changes as ch
from ..operators import keys as key_ops
from ..plans import run, staging
from ..session import apply_settings, temporary_work, work_dir
from ..sources.messages import FILE_OPTIONS, read_message_files
from ..sources.tables import scan_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SUBQUERIES: dict[str, str] = {}

_stored: dict[tuple[str, str, str], str] = {}
# The tables loaded below an operational root.
_loaded: dict[str, set[str]] = {}


class Inputs:
    """The inputs of the engine over one directory of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.run_ts = fixtures.run_ts()

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def work_dir(self, label: str) -> str:
        return work_dir(self.spark, label)

    @cached_property
    def log(self) -> DataFrame:
        return fixtures.machine_log(self.spark, self.sf_dir)

    @cached_property
    def material_raw(self) -> DataFrame:
        return fixtures.material_raw(self.spark, self.sf_dir)

    @cached_property
    def part_raw(self) -> DataFrame:
        """The part references, stored once like the sheet they stand for."""
        path = self.once("part-reference", fixtures.part_raw(self.spark, self.sf_dir).write.parquet)
        return self.spark.read.schema(schemas.PART_REFERENCE).parquet(path)

    @cached_property
    def message_files(self) -> str:
        """The change log as JSON-lines files in arrival order, as producers leave it."""

        def write(path: str) -> None:
            log = fixtures.change_log(self.spark, self.sf_dir)
            ordered = log.repartitionByRange(*ch.ORDER).sortWithinPartitions(*ch.ORDER)
            ordered.write.options(**FILE_OPTIONS, compression="gzip").json(path)

        return self.once("messages", write)

    @cached_property
    def messages(self) -> DataFrame:
        """The change log in its order, stored once."""
        log = read_message_files(self.spark, self.message_files)

        def write(path: str) -> None:
            with temporary_work(self.spark):
                ch.with_seq(log).write.parquet(path)

        path = self.once("message-log", write)
        return self.spark.read.schema(schemas.struct("topic string, partition int, offset bigint, timestamp timestamp_ntz, value string, seq bigint")).parquet(path)

    @cached_property
    def bridge(self) -> DataFrame:
        return staging.build_part_bridge(self.part_raw, self.run_ts)

    @cached_property
    def quotes(self) -> DataFrame:
        return staging.build_material_price(self.material_raw, self.run_ts)

    @cached_property
    def machines(self) -> DataFrame:
        return staging.build_dim_machine(self.bridge, self.run_ts)

    @cached_property
    def sales(self) -> DataFrame:
        return staging.build_sales(self.log, self.bridge, self.run_ts)

    @property
    def ods_root(self) -> str:
        """The operational tables, loaded once per session and directory of tables: what a
        stored operational layer is to the reports."""
        return self.ods_with(*schemas.TABLE_NAMES)

    def ods_with(self, *names: str) -> str:
        """The root of the operational tables, with those in ``names`` loaded: a query that reads few of them
        waits for no others. One that reads several names them together, as they are built from the same rows."""
        root = self.once("ods", lambda path: None)
        loaded = _loaded.setdefault(root, set())
        missing = [name for name in names if name not in loaded]
        if missing:
            run.load_ods(self.log, self.part_raw, self.material_raw, self.spark, self.run_ts, root, missing)
            loaded.update(missing)
        return root

    def once(self, label: str, write: Callable[[str], None]) -> str:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, label)
        if key not in _stored:
            path = self.work_dir(label)
            write(path)
            _stored[key] = path
        return _stored[key]

    def ods(self, table: str) -> DataFrame:
        return scan_table(self.spark, self.ods_with(table), table)

    # -- messages -------------------------------------------------------------------------

    @cached_property
    def parsed(self) -> dict[str, DataFrame]:
        """The messages that can be applied, per topic, stored once."""
        return {t: self._parsed_topic(t) for t in schemas.MESSAGE_FIELDS}

    def _parsed_topic(self, topic: str) -> DataFrame:
        rows = ch.accepted(ch.parse_topic(self.messages, topic))
        path = self.once(f"parsed-{topic}", rows.write.parquet)
        return self.spark.read.schema(rows.schema).parquet(path)

    def key_map(self, key: str) -> DataFrame:
        table = {k: t for t, k in (("dim_part_information", "partId"), ("dim_machine", "machineId"),
                                   ("dim_material", "materialId"), ("dim_contract", "contractId"))}[key]
        trsc = schemas.TRANSACTIONAL_ID[key]
        known = key_ops.known_keys(self.ods(table), trsc, key)
        return key_ops.assign_surrogate_keys(known, ch.seen_keys(self.parsed, key), trsc, key)

    @cached_property
    def part_ids(self) -> DataFrame:
        return self.key_map("partId")

    @cached_property
    def supply_rows(self) -> DataFrame:
        return ch.supply_chain_rows(self.parsed["supply_chain"])

    @cached_property
    def visible_quotes(self) -> DataFrame:
        return ch.visible_quotes(self.ods("fact_supply_chain"), self.supply_rows, self.part_ids)

    def dim_changes(self, topic: str) -> DataFrame:
        """Loaded rows and message rows of a topic's dimension."""
        spec = ch.DIM_TOPICS[topic]
        changes = ch.dim_changes(self.parsed[topic], topic, self.key_map(spec.key))
        return ch.as_changes(self.ods(spec.table)).unionByName(changes)

    @cached_property
    def sales_changes(self) -> DataFrame:
        self.ods_with("dim_part_information", "dim_contract", "fact_sales")
        changes = ch.sales_changes(self.parsed["sales"], self.key_map("partId"), self.key_map("contractId"))
        return ch.as_changes(self.ods("fact_sales")).unionByName(changes)

    @cached_property
    def supply_changes(self) -> DataFrame:
        self.ods_with("dim_part_information", "dim_machine", "dim_material", "fact_supply_chain")
        changes = ch.supply_chain_changes(
            self.supply_rows, self.visible_quotes, self.part_ids, self.key_map("machineId"),
            self.ods("dim_material"),
        )
        return ch.as_changes(self.ods("fact_supply_chain")).unionByName(changes)


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``build(inputs) -> DataFrame`` under ``name``, with its SQL twin."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Inputs(apply_settings(spark), sf_dir))

        call.__doc__ = build.__doc__
        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def subquery(name: str, sql: str) -> None:
    SUBQUERIES[name] = sql.strip()


def _mentioned(sql: str) -> list[str]:
    return [n for n in SUBQUERIES if re.search(rf"\b{n}\b", sql)]


def complete_sql(sql: str) -> str:
    """The statement with the subqueries it needs in front of it, each before its users."""
    ordered: list[str] = []

    def add(statement: str) -> None:
        for name in _mentioned(statement):
            if name not in ordered:
                add(SUBQUERIES[name])
                ordered.append(name)

    add(sql)
    if not ordered:
        return sql.strip()
    # Written out once: a subquery that is used several times is not computed several times.
    parts = ",\n".join(f"{n} AS MATERIALIZED (\n{SUBQUERIES[n]}\n)" for n in ordered)
    return f"WITH {parts}\n{sql.strip()}"
