"""Calendar and epoch functions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Units per day of the two epoch encodings.
_UNITS_PER_DAY = {"ms": 86_400_000, "s": 86_400}


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_id(date: ColumnLike) -> Column:
    """Calendar key: a date as the integer yyyyMMdd."""
    d = _col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def time_id_text(date: ColumnLike) -> Column:
    """The same key built from zero-padded text parts."""
    d = _col(date)
    return F.concat(
        F.lpad(F.year(d).cast("string"), 4, "0"),
        F.lpad(F.month(d).cast("string"), 2, "0"),
        F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
    ).cast("int")


def time_id_from_iso(text: ColumnLike) -> Column:
    """Calendar key of an ISO date or datetime text; NULL when the text is no date."""
    return time_id(iso_date(text))


def iso_date_text(text: ColumnLike) -> Column:
    """The part of an ISO datetime before the ``T``."""
    return F.substring_index(_col(text), "T", 1)


def iso_date(text: ColumnLike) -> Column:
    return iso_date_text(text).try_cast("date")


def semester(quarter: ColumnLike) -> Column:
    return F.when(_col(quarter).isin(1, 2), F.lit(1)).otherwise(F.lit(2))


def parse_date(text: ColumnLike, fmt: str = "MM-dd-yyyy") -> Column:
    """Text to DATE; anything which does not fit the format is NULL."""
    return F.try_to_date(_col(text), fmt)


def epoch_to_timestamp(epoch: ColumnLike, unit: str = "ms") -> Column:
    """Epoch number to a zone-free UTC timestamp (needs a UTC session zone)."""
    convert = {"ms": F.timestamp_millis, "s": F.timestamp_seconds}[unit]
    return convert(_col(epoch).cast("long")).cast("timestamp_ntz")


def epoch_to_date(epoch: ColumnLike, unit: str = "ms") -> Column:
    """Epoch number to the UTC calendar day, whatever the session zone is."""
    days = F.floor(_col(epoch) / F.lit(_UNITS_PER_DAY[unit]))
    return F.date_from_unix_date(days.cast("int"))


def days_in_year(year: ColumnLike) -> Column:
    y = _col(year)
    one = F.lit(1)
    return F.date_diff(F.make_date(y + 1, one, one), F.make_date(y, one, one))


def date_in_year(year: ColumnLike, seed: ColumnLike) -> Column:
    """A day inside ``year`` picked by ``seed``: the same seed gives the same day."""
    y = _col(year)
    offset = F.pmod(_col(seed).cast("long"), days_in_year(y).cast("long")).cast("int")
    return F.date_add(F.make_date(y, F.lit(1), F.lit(1)), offset)


def now_text(run_ts: ColumnLike | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the run time; the query's own clock when none is given."""
    ts = F.current_timestamp() if run_ts is None else _col(run_ts)
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def snapshot_label(run_ts: ColumnLike | None = None) -> Column:
    """The run time in a form usable inside a path."""
    return F.translate(now_text(run_ts), ":", "-")
