"""Means that do not depend on the order of their rows.

A sum of doubles changes in its last bits with the order of the rows, and with
it the result of rounding. Rates have 4 decimals, so all of them are summed as
whole ten-thousandths, exactly, whatever their size. The largest rate there can
be, three counters of 2^63 over one view, has 26 digits in that unit; the sum
has room for 9 * 10^11 of those.

Decimals cost far more for each row than whole numbers do. So a number is summed
as its groups of seven digits, each group in a bigint of its own, and the sums
are joined to one decimal once a group of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = 10_000
#: One past the largest group of digits, and the groups that hold a bigint and a rate in its unit.
_DIGITS = 10 ** 7
WHOLE_GROUPS, RATE_GROUPS = 3, 4


def rate_mean(rate: str) -> Column:
    """Aggregate: mean of a column of 4-decimal rates."""
    return _finish(_joined([F.sum(g) for g in _rate_groups(rate)]), F.count(rate))


def count_mean(counter: str) -> Column:
    """Aggregate: mean of whole numbers from their exact sum; NULL when that passes 2^63."""
    return F.try_divide(F.try_sum(counter), F.count(counter))


def rate_parts(rate: str) -> list[Column]:
    """Aggregates a mean of rates can be finished from later."""
    units = _joined([F.sum(g) for g in _rate_groups(rate)])
    return [part.alias(name) for part, name in zip((units, F.count(rate)), _names(rate))]


def merged_rate_parts(rate: str, rows: Column) -> list[Column]:
    """Aggregates over earlier parts, of the rows where ``rows`` holds."""
    return [F.sum(F.when(rows, F.col(name))).alias(name) for name in _names(rate)]


def rate_mean_of_parts(rate: str) -> Column:
    """Aggregate: the mean from merged parts."""
    return _finish(*(F.sum(name) for name in _names(rate)))


def whole_sums(counter: str) -> list[Column]:
    """Aggregates of bigints alone that ``whole_sum_of`` joins."""
    return _aliased(counter, [F.sum(g) for g in _whole_groups(F.col(counter))])


def whole_total(counter: str) -> Column:
    """Aggregate: the exact total of bigints as a decimal, for parts that are merged later."""
    return _joined([F.sum(g) for g in _whole_groups(F.col(counter))])


def rate_sums(rate: str) -> list[Column]:
    """The same of 4-decimal rates, with their count, for ``rate_mean_of_sums``."""
    return [*_aliased(rate, [F.sum(g) for g in _rate_groups(rate)]), F.count(rate).alias(_names(rate)[1])]


def whole_sum_of(counter: str) -> Column:
    """Aggregate: the exact total from ``whole_sums``; NULL when it passes 2^63."""
    return _joined([F.sum(name) for name in _group_names(counter, WHOLE_GROUPS)]).try_cast("bigint")


def rate_mean_of_sums(rate: str) -> Column:
    """Aggregate: the mean from ``rate_sums``."""
    return _finish(_joined([F.sum(name) for name in _group_names(rate, RATE_GROUPS)]), F.sum(_names(rate)[1]))


def _names(rate: str) -> list[str]:
    return [f"_{rate}_{part}" for part in ("units", "rows")]


def _group_names(name: str, groups: int) -> list[str]:
    return [f"_{name}_digits{i}" for i in range(groups)]


def _aliased(name: str, sums: Sequence[Column]) -> list[Column]:
    return [total.alias(alias) for total, alias in zip(sums, _group_names(name, len(sums)))]


def _whole_groups(number: Column) -> list[Column]:
    """Groups of digits of a bigint, lowest first, each with the sign of the number."""
    return [number % F.lit(_DIGITS), _div(number, _DIGITS) % F.lit(_DIGITS), _div(number, _DIGITS ** 2)]


def _rate_groups(rate: str) -> list[Column]:
    """Groups of digits of a rate's units.

    A small product that is whole but for the error of a double is the number of
    units; all others go through decimals, row by row.
    """
    product = F.col(rate) * F.lit(float(_UNITS))
    near = (F.abs(product) < 1e9) & (F.abs(product - F.rint(product)) < 1e-3)
    small = F.rint(product).cast("bigint")
    units = (F.col(rate).cast("decimal(28,4)") * _UNITS).cast("decimal(28,0)")
    # Halves of 14 digits are bigints.
    low, high = (units % F.lit(Decimal(_DIGITS ** 2))).cast("bigint"), _div(units, Decimal(_DIGITS ** 2))
    return [
        F.when(near, small % F.lit(_DIGITS)).otherwise(low % F.lit(_DIGITS)),
        F.when(near, _div(small, _DIGITS)).otherwise(_div(low, _DIGITS)),
        F.when(~near, high % F.lit(_DIGITS)), F.when(~near, _div(high, _DIGITS)),
    ]


def _div(number: Column, by: int | Decimal) -> Column:
    return F.call_function("div", number, F.lit(by))


def _joined(sums: Sequence[Column]) -> Column:
    """The total of the sums of groups of digits, as a decimal; NULL without a number."""
    total = sums[0].cast("decimal(38,0)")
    for i, part in enumerate(sums[1:], 1):
        total = total + F.coalesce(part, F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(_DIGITS ** i))
    return total.cast("decimal(38,0)")


def _finish(units: Column, rows: Column) -> Column:
    return F.try_divide(units.cast("double"), (rows * _UNITS).cast("double"))
