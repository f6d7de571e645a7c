"""Column functions on text: masks, ids and display text. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CURRENCY = "₹"


def mask_email(email: Column, strict: bool = False) -> Column:
    """Keep the first three characters and the domain: ``joh****@example.com``.

    An address whose local part has fewer than three characters does not match and stays
    readable; ``strict`` masks the whole local part of such an address.
    """
    masked = F.regexp_replace(email, r"(^.{3})(.*)(@.*$)", "$1****$3")
    if not strict:
        return masked
    return F.when(masked == email, F.regexp_replace(email, r"^[^@]*", "****")).otherwise(masked)


def mask_name(name: Column) -> Column:
    """``Jane Smith`` → ``J***e Smith``: mask the first word of three or more characters only."""
    return F.regexp_replace(name, r"^(.*?)(\w)\w+(\w)", "$1$2***$3")


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded id that never cuts a number longer than ``width``, as ``lpad`` would."""
    whole = number.cast("bigint")
    padded = F.concat(F.lit(prefix), F.format_string(f"%0{width}d", whole))
    return F.when(whole.isNotNull(), padded)


def title_text(text: Column) -> Column:
    return F.initcap(F.trim(text))


def join_items(items: Column) -> Column:
    return F.array_join(F.array_sort(items), ", ")


def money(amount: Column, digits: int = 2) -> Column:
    """``₹1,234.50``; text of a missing amount is ``N/A``."""
    shown = F.concat(F.lit(CURRENCY), F.format_number(amount, digits))
    return F.coalesce(shown, F.lit("N/A"))


def count_text(number: Column) -> Column:
    return F.coalesce(F.format_number(number, 0), F.lit("N/A"))


def percent(number: Column) -> Column:
    """Whole percent as text, cut towards zero: 12.0 → ``12%``."""
    return F.concat(number.cast("int").cast("string"), F.lit("%"))
