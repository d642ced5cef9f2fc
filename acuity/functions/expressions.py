"""Column builders shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quoted(values: Iterable[str]) -> str:
    escaped = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return ", ".join(f"'{v}'" for v in escaped)


def like_any(column: str, patterns: Sequence[str]) -> Column:
    """True where the text is LIKE one of the patterns (case-sensitive)."""
    return F.expr(f"{column} LIKE ANY ({_quoted(patterns)})")


def one_of(column: str, values: Sequence[str]) -> Column:
    """True where the text is one of the values."""
    return F.expr(f"{column} IN ({_quoted(values)})") if values else F.lit(False)


def after_exclusions(column: str, values: Sequence[str], patterns: Sequence[str] = ()) -> Column:
    """True for a known text that is none of the values and like none of the patterns."""
    kept = ~one_of(column, values)
    return kept & ~like_any(column, patterns) if patterns else kept


def strict_or_lenient_number(column: Column, strict: bool) -> Column:
    """Text to double through a 9-digit decimal.

    The decimal refuses ``NaN``, ``Infinity`` and float suffixes, which a bare
    cast to double would let through. Lenient mode gives NULL for bad text, strict
    mode raises.
    """
    text = F.trim(column)
    number = text.cast("decimal(38,9)") if strict else text.try_cast("decimal(38,9)")
    return number.cast("double")


#: an exact dose
DOSE = "decimal(18,4)"
_BILLION = 1_000_000_000


def exact_number(column: Column, strict: bool) -> Column:
    """Text to a decimal of eleven digits before the point and nine behind; what needs more is no number."""
    text = F.trim(column)
    return text.cast("decimal(20,9)") if strict else text.try_cast("decimal(20,9)")


def billionths(column: Column) -> Column:
    """A number as a whole number of billionths, NULL beyond eleven digits."""
    return (column.try_cast("decimal(20,9)") * F.lit(_BILLION)).cast("decimal(20,0)")


def exact_quotient(top: Column, bottom: Column) -> Column:
    """A quotient of whole numbers, rounded half away from zero to four places; NULL for a divisor of zero.

    The quotient is never written out: twice its ten-thousandfold plus one is divided as a whole
    number, so that no earlier rounding can move a half. A dose over ten million millions is NULL.
    """
    size = F.when((bottom != 0) & (F.abs(top).cast("double") < 1e13 * F.abs(bottom).cast("double")), F.abs(bottom))
    whole = F.call_function("div", F.abs(top) * F.lit(20_000) + size, size * F.lit(2))
    signed = F.when((top < 0) != (bottom < 0), -whole).otherwise(whole)
    return (signed.cast("decimal(18,0)") / F.lit(10_000)).cast(DOSE)


def case(pairs: Iterable[tuple[Column, object]]) -> Column:
    """The value of the first condition that holds, else NULL."""
    (condition, value), *rest = pairs
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain


def points(rules: Sequence[tuple[Column, int]], *inputs: Column) -> Column:
    """Score by the first rule that holds; 0 if none does, NULL without any input."""
    return case([*rules, (F.coalesce(*inputs).isNotNull(), 0)])


def below(column: Column, bands: Sequence[tuple[float, int]]) -> list[tuple[Column, int]]:
    return [(column < limit, score) for limit, score in bands]


def at_least(column: Column, bands: Sequence[tuple[float, int]]) -> list[tuple[Column, int]]:
    return [(column >= limit, score) for limit, score in bands]


def above(column: Column, bands: Sequence[tuple[float, int]]) -> list[tuple[Column, int]]:
    return [(column > limit, score) for limit, score in bands]


def between(column: Column, bands: Sequence[tuple[float, float, int]]) -> list[tuple[Column, int]]:
    return [(column.between(low, high), score) for low, high, score in bands]
