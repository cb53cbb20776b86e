"""Scalar column expressions. All are built-in Spark functions (JVM side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwatch.schemas import AMOUNT, END_TS, EPOCH_TS, TS_FMT


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lit_ts(value: str) -> Column:
    """A TIMESTAMP_NTZ literal from 'yyyy-MM-dd HH:mm:ss'."""
    return F.lit(value).cast("timestamp_ntz")


def end_ts() -> Column:
    return lit_ts(END_TS)


def epoch_ts() -> Column:
    return lit_ts(EPOCH_TS)


def blank_to_null(col) -> Column:
    """Empty string is NULL, as in the source store."""
    c = _c(col)
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def clean_string(col) -> Column:
    """trim (spaces only, like the source) then empty -> NULL."""
    return blank_to_null(F.trim(_c(col)))


def parse_ts(col) -> Column:
    """'yyyy-mm-dd hh24:mi:ss' -> TIMESTAMP_NTZ; malformed input raises (ANSI)."""
    return F.to_timestamp_ntz(_c(col), F.lit(TS_FMT))


def parse_day(col) -> Column:
    """First 10 characters as yyyy-mm-dd -> midnight TIMESTAMP_NTZ."""
    return F.to_date(F.substring(_c(col), 1, 10), "yyyy-MM-dd").cast("timestamp_ntz")


def parse_amount(col) -> Column:
    """Decimal text with either '.' or ',' as the decimal mark; junk raises (ANSI).
    The source column is an unrestricted number: ten decimals are kept."""
    return F.regexp_replace(F.trim(_c(col)), ",", ".").cast(AMOUNT.simpleString())


def minus_one_second(col) -> Column:
    return _c(col) - F.expr("INTERVAL 1 SECOND")


def full_name(last, first, patronymic) -> Column:
    """last || ' ' || first || ' ' || patronymic with NULL treated as ''."""
    return F.concat(F.coalesce(_c(last), F.lit("")), F.lit(" "),
                    F.coalesce(_c(first), F.lit("")), F.lit(" "),
                    F.coalesce(_c(patronymic), F.lit("")))


def ts_string(col) -> Column:
    """Render a timestamp as 'yyyy-MM-dd HH:mm:ss' (year 9999 is not pandas-safe)."""
    return F.date_format(_c(col), TS_FMT)


def epoch_micros(col) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _c(col))


def changed(columns, left: str, right: str) -> Column:
    """Null-safe 'any tracked column differs' between two aliased sides."""
    parts = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, parts)
