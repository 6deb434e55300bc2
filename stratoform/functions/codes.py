"""Code standardisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "n/a"

# Codes in the source systems and the labels they stand for.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"F": "Female", "M": "Male"}
ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}


def normalised(value: Column) -> Column:
    return F.upper(F.trim(value))


def decode(value: Column, labels: Mapping[str, str], default: Column | str = UNKNOWN) -> Column:
    """Label of a code, one ``WHEN … IN`` branch per label."""
    codes_by_label: dict[str, list[str]] = {}
    for code, label in labels.items():
        codes_by_label.setdefault(label, []).append(code)
    branches = None
    for label, codes in codes_by_label.items():
        hit = value.isin(*codes)
        branches = F.when(hit, label) if branches is None else branches.when(hit, label)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return branches.otherwise(fallback)


def marital_status(value: Column) -> Column:
    return decode(normalised(value), MARITAL_STATUS)


def crm_gender(value: Column) -> Column:
    return decode(normalised(value), CRM_GENDER)


def erp_gender(value: Column) -> Column:
    return decode(normalised(value), ERP_GENDER)


def product_line(value: Column) -> Column:
    return decode(normalised(value), PRODUCT_LINE)


def country(value: Column) -> Column:
    """Case-sensitive, unlike the other codes; an unknown name passes through trimmed."""
    name = F.trim(value)
    named = F.when(F.coalesce(name, F.lit("")) == "", UNKNOWN).otherwise(name)
    return decode(name, COUNTRY, default=named)


def merged_gender(crm: Column, erp: Column) -> Column:
    """The CRM value unless it is unknown, else the ERP value."""
    return F.coalesce(F.when(crm != UNKNOWN, crm), erp, F.lit(UNKNOWN))
