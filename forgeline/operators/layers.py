"""Bring a table to the column set and types of a layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas


def conform_to_layer(
    df: DataFrame, table: str, layer: str, fill_transactional: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: the table in its layer's columns and types, and the input rows
    whose key does not fit its type. Columns the layer lacks are dropped; a missing
    transactional id is NULL, or the id itself with ``fill_transactional``."""
    fields = schemas.table_schema(table, layer).fields
    source_of = {trsc: key for key, trsc in schemas.TRANSACTIONAL_ID.items()}
    bad_key: Column = F.lit(False)
    for key in schemas.KEYS[table]:
        if key in df.columns:
            kind = schemas.table_schema(table, "dwh")[key].dataType
            if df.schema[key].dataType == kind:
                continue
            bad_key = bad_key | (F.col(key).isNotNull() & F.col(key).try_cast(kind).isNull())

    def value(name: str) -> Column:
        if name in df.columns:
            return F.col(name)
        if fill_transactional and source_of.get(name) in df.columns:
            return F.col(source_of[name])
        return F.lit(None)

    columns = [value(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    return df.filter(~bad_key).select(*columns), df.filter(bad_key)


def to_ods(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: a batch-built table in the operational layer, each id serving as its
    own transactional id until a message says otherwise; rejects as (table, row), the row as JSON."""
    rows, lost = conform_to_layer(df, table, "ods", fill_transactional=True)
    return rows, lost.select(F.lit(table).alias("table"), F.to_json(F.struct("*")).alias("row"))
