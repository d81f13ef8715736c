"""Column expressions for sales-like tables. Pure expressions: no job, no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band edges, labels and value sets.
AGE_EDGES = (25, 35, 45, 55)
AGE_LABELS = ("18-24", "25-34", "35-44", "45-54", "55+")
TIER_FLOORS = ((10000, "Platinum"), (5000, "Gold"), (1000, "Silver"))
TIER_DEFAULT = "Bronze"
DISCOUNT_CEILINGS = ((0.10, "Low"), (0.25, "Medium"))
DISCOUNT_ZERO, DISCOUNT_DEFAULT = "None", "High"
ONLINE_METHODS = ("Credit Card", "Digital Wallet")


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """Value of the first rule whose condition holds; a null condition does not hold."""
    if not rules:
        return F.lit(default)
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def revenue(quantity: Column, unit_price: Column, discount: Column | None = None) -> Column:
    """``quantity * unit_price * (1 - discount)`` to 2 places.

    The 1 is an integer, so decimal inputs give an exact decimal result.
    """
    gross = quantity * unit_price
    return F.round(gross if discount is None else gross * (F.lit(1) - discount), 2)


def profit_margin(revenue: Column, quantity: Column, unit_price: Column) -> Column:
    """Share of the gross amount kept, to 4 places; 0 without a positive price, null for a zero quantity."""
    kept = F.round(F.try_divide(revenue, quantity * unit_price), 4)
    return F.when(unit_price > 0, kept).otherwise(F.lit(0))


def to_date_or_null(value: Column) -> Column:
    """Date of a date, timestamp or ISO string; null where the string is no date (also in ANSI mode)."""
    return value.try_cast("date")


def age_band(age: Column, edges: Sequence = AGE_EDGES, labels: Sequence[str] = AGE_LABELS) -> Column:
    """Right-open bands; null and everything from the last edge up fall in the last band."""
    if len(labels) != len(edges) + 1:
        raise ValueError("age_band needs one label more than edges")
    return first_match([(age < edge, label) for edge, label in zip(edges, labels)], labels[-1])


def revenue_tier(amount: Column, floors: Sequence[tuple] = TIER_FLOORS, default: str = TIER_DEFAULT) -> Column:
    """Label of the highest floor reached; ``floors`` go from high to low."""
    return first_match([(amount >= floor, label) for floor, label in floors], default)


def discount_level(discount: Column, ceilings: Sequence[tuple] = DISCOUNT_CEILINGS) -> Column:
    """``None`` for exactly 0, then the first ceiling not exceeded, else ``High`` (also for null)."""
    rules = [(discount == 0, DISCOUNT_ZERO)]
    rules += [(discount <= ceiling, label) for ceiling, label in ceilings]
    return first_match(rules, DISCOUNT_DEFAULT)


def payment_flag(method: Column, online: Sequence[str] = ONLINE_METHODS) -> Column:
    """1 for an online payment method, else 0. Case-sensitive: apply it before upper-casing the column."""
    return F.when(method.isin(*online), 1).otherwise(0)
