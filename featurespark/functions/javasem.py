"""Strict parsing and blank tests, where Spark's own casts and trims are too lenient."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import MILLIS_FROM

_INTEGER = r"\A[+-]?[0-9]+\z"
_NUMBER = r"\A[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][+-]?[0-9]+[fFdD]?)[\x00-\x20]*\z"


def trim_control(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends; SQL's trim strips spaces only."""
    return F.regexp_replace(text, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def blank(text: Column) -> Column:
    """Null, or nothing but characters up to U+0020."""
    return text.isNull() | text.rlike(r"\A[\x00-\x20]*\z")


def strict_long(text: Column) -> Column:
    """A decimal integer within 64 bits, without surrounding space; else null."""
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def parse_long(text: Column) -> Column:
    return F.coalesce(strict_long(text), F.lit(0).cast("bigint"))


def parse_double(text: Column) -> Column:
    """A floating-point literal, else 0.  ``nan`` and ``inf`` in other spellings are no literals."""
    clean = F.regexp_replace(trim_control(text), "[fFdD]\\z", "")
    hexadecimal = trim_control(text).rlike(r"\A[+-]?0[xX]")
    value = F.when(hexadecimal, trim_control(text).try_cast("double")).otherwise(clean.try_cast("double"))
    return F.coalesce(F.when(text.rlike(_NUMBER), value), F.lit(0.0))


def epoch_millis(text: Column, fallback: Column) -> Column:
    """An epoch in seconds or milliseconds as milliseconds; the fallback if it isn't an integer."""
    parsed = strict_long(text)
    return F.coalesce(F.when(parsed < MILLIS_FROM, F.try_multiply(parsed, F.lit(1000).cast("bigint"))).otherwise(parsed), fallback)


def utc_day(millis: Column) -> Column:
    """ISO date in UTC, whatever the session's time zone."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(millis / F.lit(86_400_000)).cast("int")), "yyyy-MM-dd")


def first_filled(preferred: Column, other: Column) -> Column:
    return F.when(blank(preferred), other).otherwise(preferred)
