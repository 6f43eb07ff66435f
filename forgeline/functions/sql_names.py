"""The scalar functions under SQL names.

They are SQL functions, which the analyzer inlines: a query calling them keeps its
predicate pushdown and code generation, unlike one with Python functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Name, signature, result type and body of each function.
FUNCTIONS = {
    "fl_parse_date": ("text STRING", "DATE", "try_to_date(text, 'MM-dd-yyyy')"),
    "fl_int_list": (
        "text STRING",
        "ARRAY<BIGINT>",
        r"coalesce(array_compact(transform(split(regexp_replace(text, '[\\[\\]\\s\'\"]', ''), ','), "
        "x -> try_cast(x AS BIGINT))), CAST(array() AS ARRAY<BIGINT>))",
    ),
    "fl_epoch_ts": ("epoch BIGINT", "TIMESTAMP_NTZ", "CAST(timestamp_millis(epoch) AS TIMESTAMP_NTZ)"),
    "fl_day_in_year": (
        "y INT, seed BIGINT",
        "DATE",
        "date_add(make_date(y, 1, 1), CAST(pmod(seed, CAST(datediff(make_date(y + 1, 1, 1), "
        "make_date(y, 1, 1)) AS BIGINT)) AS INT))",
    ),
    "fl_now_text": ("ts TIMESTAMP_NTZ", "STRING", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to this session's SQL; returns their names."""
    for name, (signature, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
