"""Column sets and keys per table and layer, and the message schemas per topic."""

from __future__ import annotations

from pyspark.sql import types as T

LAYERS = ("ods", "dwh")

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<bigint>": T.ArrayType(T.LongType()),
    "array<double>": T.ArrayType(T.DoubleType()),
}


def struct(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema, without needing a session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

# The star schema. (name, type) per table; ``ods`` columns exist only in
# the operational layer, ``dwh`` columns only in the reporting layer.
_BOTH, _ODS, _DWH = LAYERS, ("ods",), ("dwh",)
_TABLES = {
    "dim_part_information": [
        ("trscPartId", "bigint", _ODS),
        ("partId", "bigint", _BOTH),
        ("timeToProduce", "double", _BOTH),
        ("lastUpdate", "timestamp_ntz", _ODS),
    ],
    "dim_material": [
        ("trscMaterialId", "bigint", _ODS),
        ("materialId", "bigint", _BOTH),
        ("name", "string", _BOTH),
        ("lastUpdate", "timestamp_ntz", _ODS),
    ],
    "dim_contract": [
        ("trscContractId", "bigint", _ODS),
        ("contractId", "bigint", _BOTH),
        ("clientName", "string", _BOTH),
        ("lastUpdate", "timestamp_ntz", _ODS),
    ],
    "dim_machine": [
        ("trscMachineId", "bigint", _ODS),
        ("machineId", "bigint", _BOTH),
        ("lastUpdate", "timestamp_ntz", _ODS),
    ],
    "dim_time": [
        ("timeId", "int", _BOTH),
        ("date", "date", _BOTH),
        ("year", "int", _BOTH),
        ("month", "int", _BOTH),
        ("day", "int", _BOTH),
        ("semester", "int", _BOTH),
        ("quarter", "int", _BOTH),
    ],
    "fact_supply_chain": [
        ("trscMachineId", "bigint", _ODS),
        ("trscPartId", "bigint", _ODS),
        ("trscMaterialId", "bigint", _ODS),
        ("machineId", "bigint", _BOTH),
        ("partId", "bigint", _BOTH),
        ("materialId", "bigint", _BOTH),
        ("timeOfProduction", "date", _ODS),
        ("timeId", "int", _BOTH),
        ("materialPrice", "double", _BOTH),
        ("materialPriceDate", "date", _BOTH),
        ("partDefaultPrice", "double", _BOTH),
        ("isDamaged", "int", _ODS),
        ("lastUpdate", "timestamp_ntz", _ODS),
        ("CountProductionMachine", "bigint", _DWH),
        ("CountProductionPart", "bigint", _DWH),
        ("GarbageProduction", "bigint", _DWH),
    ],
    "fact_sales": [
        ("trscPartId", "bigint", _ODS),
        ("trscContractId", "bigint", _ODS),
        ("partId", "bigint", _BOTH),
        ("contractId", "bigint", _BOTH),
        ("timeId", "int", _DWH),
        ("cash", "double", _BOTH),
        ("date", "date", _BOTH),
        ("lastUpdate", "timestamp_ntz", _ODS),
        ("PartPurchasedPerDay", "bigint", _DWH),
        ("MarginPerDay", "double", _DWH),
    ],
}

KEYS = {
    "dim_part_information": ["partId"],
    "dim_material": ["materialId"],
    "dim_contract": ["contractId"],
    "dim_machine": ["machineId"],
    "dim_time": ["timeId"],
    "fact_supply_chain": ["timeId", "machineId", "partId", "materialId"],
    "fact_sales": ["contractId", "partId", "timeId"],
}

# Dimensions first: the order in which tables are loaded.
TABLE_NAMES = (
    "dim_material",
    "dim_part_information",
    "dim_machine",
    "dim_contract",
    "dim_time",
    "fact_sales",
    "fact_supply_chain",
)


def table_schema(table: str, layer: str) -> T.StructType:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return struct(", ".join(f"{name} {kind}" for name, kind, layers in _TABLES[table] if layer in layers))


# The transactional id column of each ODS column that has one.
TRANSACTIONAL_ID = {
    "partId": "trscPartId",
    "materialId": "trscMaterialId",
    "contractId": "trscContractId",
    "machineId": "trscMachineId",
}

# Message fields per topic. Numbers arrive as text or number, so they are
# read as text where a bad one has to be told from a missing one.
MESSAGE_FIELDS = {
    "part_information": "id bigint, timeToProduce string, isDeleted boolean, lastUpdate string",
    "machine": "id bigint, isDeleted boolean, lastUpdate string",
    "material": "id bigint, name string, isDeleted boolean, lastUpdate string",
    "sales": (
        "contract_number bigint, parts array<bigint>, cash array<double>, client_name string, "
        "date string, isDeleted boolean, lastUpdate string"
    ),
    "supply_chain": (
        "machineId bigint, partId bigint, timeOfProduction string, var5 int, "
        "isDeleted boolean, lastUpdate string"
    ),
}

# Every topic the stream subscribes to; one of them has no handler and is rejected.
TOPICS = ("material", "material_prices", "part_information", "machine", "supply_chain", "sales")


def message_schema(topic: str) -> T.StructType:
    return struct(MESSAGE_FIELDS[topic])


MACHINE_LOG = struct("order bigint, partId bigint, machineId bigint, timeOfProduction bigint, var5 int")
MESSAGE_LOG = struct("topic string, partition int, offset bigint, timestamp timestamp_ntz, value string")
PART_REFERENCE = struct("id bigint, timeToProduce double, defaultPrice double, meterials string, machine string")
MATERIAL_SHEET = struct("id bigint, name string, prices string")
