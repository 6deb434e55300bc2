"""The whole warehouse: bronze tables in, silver and gold tables out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from stratoform.model.schemas import DeclaredTable
from stratoform.plans.gold import GoldKeys, build_dimensions, fact_sales
from stratoform.plans.silver import TRANSFORMS
from stratoform.sources.files import count_tables


def save_layer(
    spark: SparkSession, layer: str, tables: Mapping[str, DataFrame], database: str
) -> dict[str, DataFrame]:
    """Replace the layer's tables, in their declared schema, and return them as stored."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        DeclaredTable(layer, name, database).replace(df)
    return read_layer(spark, tables, database)


def read_layer(spark: SparkSession, names: Iterable[str], database: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in names}


def refresh(
    spark: SparkSession,
    batch_time: dt.datetime,
    bronze: str = "bronze",
    silver: str = "silver",
    gold: str = "gold",
    keys: GoldKeys | None = None,
) -> DataFrame:
    """Rebuild silver from bronze and gold from silver; returns the row counts.

    With ``keys`` a member has the same surrogate key after each refresh.

    Each table is computed and written once, and the next one reads it as
    stored. Counting reads file footers.
    """
    raw = read_layer(spark, TRANSFORMS, bronze)
    cleaned = {name: TRANSFORMS[name](df, batch_time) for name, df in raw.items()}
    clean = save_layer(spark, "silver", cleaned, silver)
    if keys:
        keys.assign(clean)
    dimensions = save_layer(spark, "gold", build_dimensions(clean, keys), gold)
    facts = fact_sales(clean["crm_sales_details"], dimensions["dim_products"], dimensions["dim_customers"])
    stored = save_layer(spark, "gold", {"fact_sales": facts}, gold)
    counted = {f"{silver}.{n}": df for n, df in clean.items()}
    counted |= {f"{gold}.{n}": df for n, df in (dimensions | stored).items()}
    return count_tables(counted)
