"""Currency, risk and compliance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units of the currency per euro (amount / rate = euros).
PER_EURO = {"USD": 1.08, "GBP": 0.86}
# Euros per unit of the currency (amount * rate = euros).
EURO_VALUE = {"USD": 0.92, "GBP": 1.16, "CHF": 1.06}


def fx_normalize(amount: Column, currency: Column, mode: str = "divide", rates: dict[str, float] | None = None) -> Column:
    """Euro value of ``amount``; currencies without a rate pass through unchanged."""
    if mode not in ("divide", "multiply"):
        raise ValueError(f"unknown conversion mode {mode!r}")
    table = rates if rates is not None else (PER_EURO if mode == "divide" else EURO_VALUE)
    result = None
    for code, rate in table.items():
        value = amount / F.lit(rate) if mode == "divide" else amount * F.lit(rate)
        result = F.when(currency == code, value) if result is None else result.when(currency == code, value)
    return amount if result is None else result.otherwise(amount)


def amount_eur(known: Column, amount: Column, currency: Column) -> Column:
    return F.coalesce(known, fx_normalize(amount, currency))


def risk_level(amount: Column, with_critical: bool = False) -> Column:
    """LOW / MEDIUM / HIGH by amount; the streaming form adds CRITICAL."""
    level = F.when(amount > 50000, "CRITICAL") if with_critical else None
    level = F.when(amount > 10000, "HIGH") if level is None else level.when(amount > 10000, "HIGH")
    return level.when(amount > 1000, "MEDIUM").otherwise("LOW")


def requires_aml_check(cross_border: Column, amount: Column) -> Column:
    """Cross-border above 5000; false, not null, when either input is missing."""
    return F.coalesce(cross_border & (amount > 5000), F.lit(False))


def fee(amount: Column, transaction_type: Column) -> Column:
    return F.round(amount * F.when(transaction_type.contains("INSTANT"), 0.002).otherwise(0.001), 2)


def value_date(booked: Column, cross_border: Column) -> Column:
    return F.when(cross_border, F.date_add(booked.cast("date"), 1)).otherwise(booked.cast("date"))
