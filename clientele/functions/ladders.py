"""Score expressions: churn risk, lifetime value, engagement, labels, exact ratios."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.functions import fixed_values as fv

SCORE = "decimal(5,4)"
CLV = "decimal(12,4)"
WIDE_SCORE = "decimal(9,4)"
RATE = "decimal(8,6)"


def decimal_of(text: str) -> Column:
    """A decimal literal with exactly the digits written."""
    digits, _, fraction = text.partition(".")
    return F.lit(text).cast(f"decimal({len(digits) + len(fraction)},{len(fraction)})")


def above(value: Column, steps: Sequence[tuple[int, str]], otherwise: str) -> Column:
    """The value of the first step that ``value`` exceeds."""
    (limit, result), *rest = steps
    ladder = F.when(value > limit, decimal_of(result))
    for limit, result in rest:
        ladder = ladder.when(value > limit, decimal_of(result))
    return ladder.otherwise(decimal_of(otherwise))


def days_since(last_day: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), last_day)


def churn_risk(last_purchase: Column, as_of: dt.date) -> Column:
    return (
        F.when(last_purchase.isNull(), decimal_of(fv.CHURN_NEVER_BOUGHT))
        .otherwise(above(days_since(last_purchase, as_of), fv.CHURN_STEPS, fv.CHURN_RECENT))
        .cast(SCORE)
    )


def clv_score(lifetime_value: Column, cap: str | None = None) -> Column:
    """Lifetime value in thousands, to four places, with an optional upper limit."""
    thousands = F.coalesce(lifetime_value, F.lit(0).cast("decimal(14,2)")) * decimal_of("0.001")
    if cap is not None:
        thousands = F.least(thousands, decimal_of(cap))
    return F.round(thousands, 4).cast(CLV)


def label(segment: Column, labels: Mapping[str, str]) -> Column:
    result = None
    for code, text in labels.items():
        result = F.when(segment == code, text) if result is None else result.when(segment == code, text)
    return result.otherwise(fv.NO_LABEL)


def ratio(part: Column, whole: Column, places: int) -> Column:
    """``part / whole`` of two counts rounded half away from zero; null where ``whole`` is zero."""
    exact = part.cast("decimal(18,0)") / F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(exact, places)


def mean(value: Column, places: int) -> Column:
    """Mean of a decimal column, rounded once from the exact sum."""
    return F.round(F.sum(value) / F.count(value).cast("decimal(18,0)"), places)


def plain_mean(value: Column) -> Column:
    """Unrounded mean of a decimal column as a double; the sum is exact, so row order cannot matter."""
    return F.sum(value).cast("double") / F.count(value)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))
