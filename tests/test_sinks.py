from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from earshot.operators.upsert import last_write
from earshot.sinks.tables import overwrite_dates, overwrite_table, preview
from earshot.sinks.wide_rows import (
    by_row_key,
    count_cells,
    recommendation_cells,
    recommendation_rows,
)
from tests.plans import plan_of, shuffle_keys


def cells_in(frame):
    return sorted((r["rowkey"], r["family"], r["qualifier"], r["value"]) for r in frame.collect())


def test_counts_become_text_cells(spark):
    rows = spark.createDataFrame(
        [(1, 10, 3), (1, 2, 4), (2, 10, 5), (1, 10, 2)], "userId int, ocId int, count int"
    )
    cells = count_cells(rows, "userId", "ocId", "count", "listenCountInfo")
    assert cells.dtypes == [(c, "string") for c in ("rowkey", "family", "qualifier", "value")]
    assert cells_in(cells) == [
        ("userId:1", "listenCountInfo", "10", "3"),
        ("userId:1", "listenCountInfo", "2", "4"),
        ("userId:2", "listenCountInfo", "10", "5"),
    ]


def test_last_write_wins(spark):
    rows = spark.createDataFrame(
        [(1, 1, 9, 1), (1, 1, 4, 3), (1, 1, 7, 2), (2, 1, 5, 1)],
        "userId int, item int, value int, at int",
    )
    keys = ["userId", "item"]
    ordered = last_write(rows, keys, "value", "at")
    assert {tuple(r) for r in ordered.collect()} == {(1, 1, 4), (2, 1, 5)}
    unordered = last_write(rows, keys, "value")
    assert {tuple(r) for r in unordered.collect()} == {(1, 1, 9), (2, 1, 5)}
    tied = rows.withColumn("at", F.lit(1))
    assert {tuple(r) for r in last_write(tied, keys, "value", "at").collect()} == {
        (1, 1, 9),
        (2, 1, 5),
    }
    assert cells_in(count_cells(rows, *keys, "value", "f", "at")) == [
        ("userId:1", "f", "1", "4"),
        ("userId:2", "f", "1", "5"),
    ]


@pytest.fixture(scope="module")
def skewed(spark):
    """User 0 holds a third of 200,000 rows, and one of its cells is written 30,000 times."""
    return spark.range(200_000).select(
        F.expr("int(if(id % 3 = 0, 0, id % 200 + 1))").alias("userId"),
        F.expr("int(if(id < 90000, 7, id))").alias("item"),
        F.col("id").cast("int").alias("value"),
        F.col("id").alias("at"),
    )


def test_a_busy_user_has_the_same_cells_as_others(skewed, tmp_path):
    cells = count_cells(skewed, "userId", "item", "value", "f", "at")
    conf = skewed.sparkSession.conf
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as it is
    overwrite_table(by_row_key(cells), str(tmp_path / "cells"))
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = skewed.sparkSession.read.parquet(str(tmp_path / "cells"))
    busy = stored.where("rowkey = 'userId:0'")
    assert busy.count() == 1 + sum(1 for i in range(90_000, 200_000) if i % 3 == 0)
    assert busy.where("qualifier = '7'").collect()[0]["value"] == "89997"
    # It spans files, and nothing in the plan gathers a user's cells.
    assert busy.select(F.input_file_name()).distinct().count() > 1
    plan = plan_of(by_row_key(cells))
    assert "collect_list" not in plan
    assert all(key.count("#") >= 2 for key in shuffle_keys(plan))


def test_cells_stand_in_row_key_order(skewed):
    laid = by_row_key(count_cells(skewed, "userId", "item", "value", "f", "at"))
    parts = laid.select(F.spark_partition_id().alias("p"), "rowkey", "qualifier").collect()
    assert [tuple(r) for r in parts] == sorted(tuple(r) for r in parts)


def test_recommendations_need_no_shuffle(spark):
    recs = spark.createDataFrame(
        [(7, [(3, 0.5), (1, 0.25)]), (8, [])],
        "userId int, recommendations array<struct<sourceId:int,rating:float>>",
    )
    wide = recommendation_rows(recs)
    assert "Exchange" not in plan_of(wide)
    got = {r["rowkey"]: r["cells"] for r in wide.collect()}
    assert got == {"userId:7": {"3": "0.5", "1": "0.25"}, "userId:8": {}}
    assert cells_in(recommendation_cells(wide, "recommends")) == [
        ("userId:7", "recommends", "1", "0.25"),
        ("userId:7", "recommends", "3", "0.5"),
    ]


def test_overwrite_replaces_and_creates(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in (5, 3, 3):
        overwrite_table(spark.range(n), path)
        assert spark.read.parquet(path).count() == n


def test_dated_overwrite_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "dated")
    for load in (
        [("2024-01-01", 1), ("2024-01-02", 2)],
        [("2024-01-02", 20), ("2024-01-03", 3)],
    ):
        overwrite_dates(spark.createDataFrame(load, "dt string, n int"), path)
    rows = {(str(r["dt"]), r["n"]) for r in spark.read.parquet(path).collect()}
    assert rows == {("2024-01-01", 1), ("2024-01-02", 20), ("2024-01-03", 3)}


def test_preview_is_ordered_and_short(spark):
    frame = spark.range(100).select((F.lit(99) - F.col("id")).alias("id")).repartition(7)
    assert [r["id"] for r in preview(frame, "id").collect()] == list(range(20))
