"""The search operators as Column expressions. Complements keep null rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value: Any) -> Column:
    """Literal usable against any column; dates and times go through text to stay zone-free."""
    if isinstance(value, datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, date):
        return F.lit(value.isoformat()).cast("date")
    return F.lit(value)


def op_equal(c: Column, v: Any) -> Column:
    return c == literal(v)


def op_not_equal(c: Column, v: Any) -> Column:
    return ~c.eqNullSafe(literal(v))


def op_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def op_not_blank(c: Column) -> Column:
    return ~op_blank(c)


def op_lt(c: Column, v: Any) -> Column:
    return c < literal(v)


def op_gt(c: Column, v: Any) -> Column:
    return c > literal(v)


def op_le(c: Column, v: Any) -> Column:
    return c <= literal(v)


def op_ge(c: Column, v: Any) -> Column:
    return c >= literal(v)


def op_in(c: Column, values: Sequence[Any]) -> Column:
    """List membership; IN_RANGE is documented as a list, the two-ended form is op_between."""
    return c.isin(*[literal(v) for v in values])


def op_not_in(c: Column, values: Sequence[Any]) -> Column:
    return ~F.coalesce(op_in(c, values), F.lit(False))


def op_contain(c: Column, v: str, ignore_case: bool = True) -> Column:
    """Literal substring; % and _ have no special meaning."""
    text = c.cast("string")
    if ignore_case:
        return F.contains(F.lower(text), F.lit(str(v).lower()))
    return F.contains(text, F.lit(str(v)))


def op_not_contain(c: Column, v: str, ignore_case: bool = True) -> Column:
    return ~F.coalesce(op_contain(c, v, ignore_case), F.lit(False))


def op_between(c: Column, lo: Any, hi: Any) -> Column:
    return c.between(literal(lo), literal(hi))


def op_in_list(c: Column, text: str) -> Column:
    """Membership in a comma-separated list."""
    return op_in(c, [part.strip() for part in text.split(",") if part.strip()])


def _between_value(c: Column, v: Any) -> Column:
    lo, hi = v.split("|", 1) if isinstance(v, str) else v
    return op_between(c, lo, hi)


OPERATORS: dict[str, Callable[..., Column]] = {
    "EQUAL": op_equal,
    "NOT_EQUAL": op_not_equal,
    "BLANK": op_blank,
    "NOT_BLANK": op_not_blank,
    "LESS_THAN": op_lt,
    "GREATER_THAN": op_gt,
    "LESS_AND_EQUAL": op_le,
    "GREATER_AND_EQUAL": op_ge,
    "IN_RANGE": op_in,
    "NOT_IN_RANGE": op_not_in,
    "CONTAIN": op_contain,
    "NOT_CONTAIN": op_not_contain,
    "BETWEEN": _between_value,
    "IN": op_in_list,
}
NO_VALUE = frozenset({"BLANK", "NOT_BLANK"})


def predicate(c: Column, operator: str, value: Any = None) -> Column:
    """One search field as a Column; unknown operators and missing values are errors."""
    if operator not in OPERATORS:
        raise ValueError(f"unknown operator {operator!r}; known: {sorted(OPERATORS)}")
    if operator in NO_VALUE:
        return OPERATORS[operator](c)
    if value is None:
        raise ValueError(f"operator {operator!r} needs a value")
    return OPERATORS[operator](c, value)
