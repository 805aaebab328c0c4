"""Conditional-sum pivots into structs (one hash aggregate, no ``pivot()`` value discovery)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The charge types broken out per invoice (in this order), plus 'other'.
CHARGE_TYPES = [
    ("usage", "Usage"),
    ("tax", "Tax"),
    ("fee", "Fee"),
    ("rifee", "RIFee"),
    ("credit", "Credit"),
    ("refund", "Refund"),
    ("discounted_usage", "DiscountedUsage"),
    ("savings_plan_covered_usage", "SavingsPlanCoveredUsage"),
    ("savings_plan_recurring_fee", "SavingsPlanRecurringFee"),
    ("savings_plan_upfront_fee", "SavingsPlanUpfrontFee"),
    ("savings_plan_negation", "SavingsPlanNegation"),
    ("edp_discount", "EdpDiscount"),
    ("bundled_discount", "BundledDiscount"),
]


def conditional_sums(cases: list[tuple[str, Column]], value: str | Column, scale: int | None = 4,
                     as_double: bool = True) -> list[Column]:
    v = F.col(value) if isinstance(value, str) else value
    out = []
    for name, cond in cases:
        s = F.sum(F.when(cond, v).otherwise(F.lit(0)))
        if scale is not None:
            s = F.round(s, scale)
        out.append((s.cast("double") if as_double else s).alias(name))
    return out


def charge_type_pivot(value: str, charge_col: str = "charge_type") -> Column:
    """struct(usage, tax, ..., other) of round(sum(value per charge type), 4) as doubles."""
    ct = F.col(charge_col)
    cases = [(name, ct == label) for name, label in CHARGE_TYPES]
    # NULL charge type is in no bucket (NOT IN over NULL is NULL)
    cases.append(("other", ~ct.isin([label for _, label in CHARGE_TYPES])))
    return F.struct(*conditional_sums(cases, value))
