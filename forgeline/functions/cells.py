"""Functions for values serialized into text cells, and for numeric arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import ColumnLike, _col

PRICE_HISTORY = T.ArrayType(
    T.StructType([T.StructField("price", T.DoubleType()), T.StructField("d", T.StringType())])
)


def strip_quotes(text: ColumnLike) -> Column:
    return F.translate(_col(text), "'", "")


def parse_int_list(text: ColumnLike, element: str = "bigint") -> Column:
    """``"['1', '2']"`` or ``"[1, 2]"`` to an array; a bad element is dropped and a
    missing or empty list is the empty array."""
    bare = F.regexp_replace(_col(text), r"[\[\]\s'\"]", "")
    numbers = F.transform(F.split(bare, ","), lambda part: part.try_cast(element))
    return F.coalesce(F.array_compact(numbers), F.array().cast(f"array<{element}>"))


def parse_price_history(text: ColumnLike) -> Column:
    """JSON array of ``{price, d}``. A bad element becomes a struct of NULLs, a lone
    object a one-element array, text which is no JSON a NULL."""
    parsed = F.from_json(_col(text), PRICE_HISTORY, {"mode": "PERMISSIVE"})
    # An object without brackets comes back as one element, unreadable text too: the
    # latter is told apart by its first character.
    return F.when(F.ltrim(_col(text)).rlike(r"^[\[{]"), parsed)


def parse_number(text: ColumnLike) -> Column:
    return _col(text).try_cast("double")


def dot_product(left: ColumnLike, right: ColumnLike) -> Column:
    """Sum of the pairwise products, cut to the shorter array; 0 for empty arrays."""
    products = F.zip_with(
        _col(left), _col(right), lambda a, b: F.coalesce(a.cast("double") * b, F.lit(0.0))
    )
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def array_total(values: ColumnLike) -> Column:
    return F.aggregate(
        _col(values), F.lit(0.0), lambda total, v: total + F.coalesce(v.cast("double"), F.lit(0.0))
    )


def prefixed(prefix: str, value: ColumnLike) -> Column:
    return F.concat(F.lit(prefix), _col(value).cast("string"))


def margin(revenue: ColumnLike, *costs: ColumnLike) -> Column:
    total = _col(costs[0])
    for cost in costs[1:]:
        total = total + _col(cost)
    return F.round(_col(revenue) - total, 2)


def stable_row_id(*columns: ColumnLike) -> Column:
    """An id which is the same on every run because it depends on the values alone."""
    return F.xxhash64(*[_col(c) for c in columns])


def exact_sum(value: ColumnLike) -> Column:
    """The sum of amounts, added up as decimals: the same in whatever order rows arrive."""
    return F.sum(_col(value).cast("decimal(28,8)")).cast("double")
