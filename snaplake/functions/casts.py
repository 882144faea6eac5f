"""ANSI-safe casts with the lenient results of a non-ANSI cast.

Under ANSI mode ``cast('55.0' AS INT)`` and a bad ``to_timestamp`` raise.
The lake needs NULL on bad input, and the integer result of the lenient
cast (truncation of a decimal text).  Everything here is a built-in
expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaplake.schemas import PAYLOAD_TS_FORMAT

_INTEGRAL = {"int": "int", "integer": "int", "bigint": "bigint", "long": "bigint",
             "smallint": "smallint", "tinyint": "tinyint"}


def lenient_int(s: Column, target: str = "int") -> Column:
    """'55' -> 55, '55.7' -> 55, '-3.9' -> -3, 'abc' -> NULL, overflow -> NULL."""
    return s.try_cast("decimal(38,10)").try_cast(target)


def lenient_double(s: Column) -> Column:
    return s.try_cast("double")


def parse_timestamp(s: Column, formats: list[str] | None = None) -> Column:
    """First format that parses wins; none -> NULL (never raises)."""
    fmts = formats or [PAYLOAD_TS_FORMAT]
    parsed = [F.try_to_timestamp(s, F.lit(f)) for f in fmts]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def lenient_cast(s: Column, typ: str, ts_formats: list[str] | None = None) -> Column:
    t = typ.lower()
    if t in ("string", "str"):
        return s
    if t in _INTEGRAL:
        return lenient_int(s, _INTEGRAL[t])
    if t in ("double", "float"):
        return lenient_double(s).cast(t)
    if t == "boolean":
        return s.try_cast("boolean")
    if t == "timestamp":
        return parse_timestamp(s, ts_formats)
    if t == "date":
        return F.to_date(parse_timestamp(s, ts_formats))
    if t.startswith("decimal"):
        return s.try_cast(t)
    raise ValueError(f"unsupported leaf type {typ!r}")
