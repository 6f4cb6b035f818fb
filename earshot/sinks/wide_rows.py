"""Cells of wide rows, one per (user, item): ``rowkey, family, qualifier, value``, all text.

Counts are stored as cells, whatever the number a user has; only recommendations, of which
a user has k, are also handled as one row per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.text import row_key
from earshot.operators.upsert import last_write


def count_cells(
    rows: DataFrame, user: str, item: str, value: str, family: str, order: str | None = None
) -> DataFrame:
    """The last write per cell.  It combines map-side and spreads a busy user over items."""
    latest = last_write(rows, [user, item], value, order)
    return latest.select(
        row_key(F.col(user)).alias("rowkey"),
        F.lit(family).alias("family"),
        F.col(item).cast("string").alias("qualifier"),
        F.col(value).cast("string").alias("value"),
    )


def dated_cells(
    rows: DataFrame, user: str, item: str, value: str, family: str, day: str
) -> DataFrame:
    """The same with the ``day`` of each cell's last write; of several on a day the largest."""
    last = F.max(F.struct(F.col(day).alias("day"), F.col(value).alias("value"))).alias("last")
    return (
        rows.groupBy(user, item)
        .agg(last)
        .select(
            row_key(F.col(user)).alias("rowkey"),
            F.lit(family).alias("family"),
            F.col(item).cast("string").alias("qualifier"),
            F.col("last.value").cast("string").alias("value"),
            F.col("last.day").cast("string").alias("day"),
        )
    )


def by_row_key(cells: DataFrame) -> DataFrame:
    """Cells in ranges of row key and qualifier: a user's stand together, a busy one's in pieces."""
    return cells.repartitionByRange("rowkey", "qualifier").sortWithinPartitions(
        "rowkey", "qualifier"
    )


def recommendation_rows(recommendations: DataFrame) -> DataFrame:
    """``rowkey, cells`` of a top-k result.  It already is one row per user: no shuffle."""
    return recommendations.select(
        row_key(F.col("userId")).alias("rowkey"),
        _cells(F.col("recommendations"), "sourceId", "rating").alias("cells"),
    )


def recommendation_cells(wide: DataFrame, family: str) -> DataFrame:
    """The same as one row per cell."""
    return wide.select(
        "rowkey",
        F.lit(family).alias("family"),
        F.explode("cells").alias("qualifier", "value"),
    )


def _cells(entries: Column, item: str, value: str) -> Column:
    return F.map_from_entries(
        F.transform(
            entries, lambda e: F.struct(e[item].cast("string"), e[value].cast("string"))
        )
    )
