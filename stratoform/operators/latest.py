"""One row per key: latest version, deduplication, keyed merge.

``row_number() = 1`` is planned with a limit per key before the shuffle
(``WindowGroupLimit``), so a key that holds a third of the rows sends one row
per map task and not the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The row of each key with the largest ``newest_by``.

    Ties go by every other column, so only rows that are equal tie for good.
    """
    newest = [F.col(c).desc_nulls_last() for c in newest_by]
    others = [F.col(c).asc_nulls_last() for c in df.columns if c not in {*keys, *newest_by}]
    ranked = Window.partitionBy(*keys).orderBy(*newest, *others)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def upsert_latest(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], newest_by: Sequence[str]
) -> DataFrame:
    """``current`` after the keyed changes; the newest row of a key wins.

    Applying the same changes twice gives the same table.
    """
    return latest_per_key(current.unionByName(changes), keys, newest_by)
