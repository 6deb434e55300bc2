"""Points in ranges, counted by equi-joins.

"Which ids lie in a zone's range" would pair every zone with every point. Here
the number line is cut into cells of 1, 64, 64 * 64 ... ids. A range is a few
cells of each size, a point is in one cell of each size, and points are counted
per cell before they meet the ranges, so no pair is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEP = 6  # bits: a cell has 64 of the next smaller size


def _cells(low: Column, high: Column, level: int) -> Column:
    """Cells ``low`` to ``high`` of a level as an array of (level, cell); none if the range is empty."""
    numbers = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(numbers, lambda n: F.struct(F.lit(level).alias("level"), n.alias("cell")))


def _covered(zones: DataFrame, low: str, high: str, levels: int) -> DataFrame:
    """``zones`` with a row for each cell that makes up the range."""
    rows = zones.withColumns({"_low": F.col(low).cast("bigint"), "_high": F.col(high).cast("bigint")})
    parts = []
    for level in range(levels - 1):
        # Whole cells of the next size are left to it; what sticks out at both ends is taken here.
        up = F.shiftright(F.col("_low") + ((1 << _STEP) - 1), _STEP)
        down = F.shiftright(F.col("_high") + 1, _STEP) - 1
        rows = rows.withColumns({"_up": up, "_down": down})
        whole = F.col("_up") <= F.col("_down")
        left_end = F.when(whole, F.shiftleft("_up", _STEP) - 1).otherwise(F.col("_high"))
        right_start = F.when(whole, F.shiftleft(F.col("_down") + 1, _STEP)).otherwise(F.col("_high") + 1)
        taken = F.concat(_cells(F.col("_low"), left_end, level), _cells(right_start, F.col("_high"), level))
        parts.append(f"_part{level}")
        rows = rows.withColumn(parts[-1], taken)
        rows = rows.withColumns(
            {"_low": F.when(whole, F.col("_up")).otherwise(0), "_high": F.when(whole, F.col("_down")).otherwise(-1)}
        )
    last = rows.withColumn("_last", _cells(F.col("_low"), F.col("_high"), levels - 1))
    return last.select(*zones.columns, F.explode(F.concat(*parts, "_last")).alias("_c")).select(*zones.columns, "_c.*")


def count_points_in_zones(
    zones: DataFrame,
    zone_key: str,
    low: str,
    high: str,
    points: DataFrame,
    group: str | None,
    point_id: str,
    output: str = "points_in_zone",
) -> DataFrame:
    """Rows ``(zone_key, group, output)`` for each zone and group that meet; without a group, for each zone with points."""
    bounds = zones.select(zone_key, low, high).where(F.col(low) <= F.col(high))
    # One number: how many sizes of cells the widest range needs.
    widest = bounds.agg(F.max(F.col(high).cast("bigint") - F.col(low).cast("bigint"))).first()[0] or 0
    levels = 1 + max(0, (int(widest).bit_length() - 1) // _STEP)
    keys = [group] if group else []
    known = points.where(F.col(point_id).isNotNull())
    if group:
        known = known.where(F.col(group).isNotNull())
    counted = known.groupBy(*keys, F.col(point_id).cast("bigint").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    places = F.array(
        *[F.struct(F.lit(k).alias("level"), F.shiftright("_id", _STEP * k).alias("cell")) for k in range(levels)]
    )
    cells = counted.select(*keys, "_n", F.explode(places).alias("_c")).groupBy(*keys, "_c.level", "_c.cell")
    cells = cells.agg(F.sum("_n").alias("_n"))
    met = _covered(bounds, low, high, levels).join(cells, ["level", "cell"])
    return met.groupBy(zone_key, *keys).agg(F.sum("_n").alias(output))
