"""Derived values: pricing, buckets, codes, date shifts, stock and defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"


def order_amounts(
    quantity: Column, price: Column, discount_percent: Column, tax_rate: Column
) -> tuple[Column, Column, Column]:
    """Subtotal, tax and total of an order line, each rounded to four digits in turn.

    The discount becomes an exact factor first, which keeps every product within 38 digits
    so that no intermediate result is rounded.
    """
    factor = ((F.lit(100) - discount_percent) * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(5,4)")
    subtotal = (quantity.cast("decimal(10,0)") * price.cast(MONEY) * factor).cast(MONEY)
    tax = (subtotal * tax_rate.cast("decimal(5,4)")).cast(MONEY)
    return subtotal, tax, (subtotal + tax).cast(MONEY)


def cycle_bucket(number: Column, labels: Sequence[str]) -> Column:
    """Label a whole number by its remainder; the last label takes what is left over."""
    remainder = number % len(labels)
    chosen = F.when(remainder == 0, labels[0])
    for position, label in enumerate(labels[1:-1], start=1):
        chosen = chosen.when(remainder == position, label)
    return chosen.otherwise(labels[-1])


def padded_code(prefix: str, number: Column, width: int) -> Column:
    """Prefix plus the last ``width`` digits, zero-filled on the left."""
    digits = F.concat(F.lit("0" * width), number.cast("string"))
    return F.concat(F.lit(prefix), F.right(digits, F.lit(width)))


def text_concat(*parts: Column) -> Column:
    """Concatenate as text, with NULL counting as the empty string."""
    return F.concat(*[F.coalesce(part.cast("string"), F.lit("")) for part in parts])


def days_before(moment: Column, days: Column) -> Column:
    return F.date_sub(F.to_date(moment), days)


def minutes_before(moment: Column, minutes: Column) -> Column:
    return moment - F.make_dt_interval(mins=minutes)


def available_stock(on_hand: Column, reserved: Column) -> Column:
    return on_hand - F.coalesce(reserved, F.lit(0))


def below_reorder(available: Column, reorder_point: Column) -> Column:
    return F.when(available < reorder_point, True).otherwise(False)


def sparse(condition: Column, value: Column) -> Column:
    """The value where the condition holds and NULL everywhere else."""
    return F.when(condition, value)


def with_default(column: Column, default: Column) -> Column:
    return F.coalesce(column, default)
