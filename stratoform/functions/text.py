"""String expressions of the cleansing transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of the source keys.
ERP_PREFIX = "NAS"
CATEGORY_LENGTH = 5
LOG_TEXT_LENGTH = 255


def without_prefix(value: Column, prefix: str = ERP_PREFIX) -> Column:
    return F.when(value.startswith(prefix), F.substr(value, F.lit(len(prefix) + 1))).otherwise(value)


def without_dashes(value: Column) -> Column:
    return F.regexp_replace(value, "-", "")


def category_of(product_key: Column) -> Column:
    """The leading category code, spelled as in the category table."""
    return F.regexp_replace(F.substring(product_key, 1, CATEGORY_LENGTH), "-", "_")


def product_of(product_key: Column) -> Column:
    """The part after the category; a key too short to have one is kept whole."""
    start = CATEGORY_LENGTH + 2
    return F.when(F.length(product_key) >= start, F.substr(product_key, F.lit(start))).otherwise(product_key)


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """``CUST001``-style key; a number wider than the padding is not cut."""
    return F.format_string(f"{prefix}%0{width}d", number)


def log_text(value: Column) -> Column:
    """What fits into a text column of the job tables of a database."""
    return F.left(value, F.lit(LOG_TEXT_LENGTH))


def composite(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)
