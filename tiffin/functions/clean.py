"""Forgiving casts and text clean-up. A bad value becomes NULL, or the default where one is given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKENS = ("", "NULL", "null")
TRUE_TOKENS = ("Y", "1", "TRUE")

# The widest decimal: money keeps all its digits.
MONEY_PRECISION = 38


def _with_default(c: Column, default) -> Column:
    return c if default is None else F.coalesce(c, F.lit(default).cast("double") if isinstance(default, float) else F.lit(default))


def to_int(name: str, default: int | None = None) -> Column:
    """Text to bigint, rounding half up. The plain integer cast answers first; decimal text ('7.5', '1e3') takes the slow path."""
    c = F.col(name)
    parsed = F.coalesce(c.try_cast("bigint"), c.try_cast("decimal(38,0)").try_cast("bigint"))
    return _with_default(parsed, default).alias(name)


def to_money(name: str, scale: int = 2, default: int | None = 0) -> Column:
    """Text to decimal. ``scale=0`` rounds to whole units, as a scale-less number cast does.

    The default stands for text that is no number; a number too wide for the type becomes NULL, never the default.
    """
    kind = f"decimal({MONEY_PRECISION},{scale})"
    parsed = F.col(name).try_cast(kind)
    if default is not None:
        no_number = F.col(name).try_cast("double").isNull()
        parsed = F.coalesce(parsed, F.when(no_number, F.lit(default).cast(kind)))
    return parsed.alias(name)


def to_double(name: str, default: float | None = None) -> Column:
    return _with_default(F.col(name).try_cast("double"), default).alias(name)


def to_ts(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz").alias(name)


def to_flag(name: str) -> Column:
    """Y, 1 and TRUE (any case, trimmed) are true; everything else, NULL and blank included, is false."""
    return F.coalesce(F.upper(F.trim(F.col(name))).isin(*TRUE_TOKENS), F.lit(False)).alias(name)


def to_text(name: str, *, blank_null: bool = False, default: str | None = None, case: str | None = None) -> Column:
    c = F.trim(F.col(name))
    if case is not None:
        c = {"lower": F.lower, "upper": F.upper}[case](c)
    if blank_null or default is not None:
        c = F.nullif(c, F.lit(""))
    return _with_default(c, default).alias(name)


def digits(name: str) -> Column:
    return F.regexp_replace(F.col(name), "[^0-9]", "").alias(name)


def token_to_null(name: str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~F.col(name).isin(list(tokens)), F.col(name)).alias(name)
