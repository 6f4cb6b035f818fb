from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from earshot.operators.split import hash_split, random_split, split_counts, time_split
from tests.plans import plan_of


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.range(5000).select(
        (F.col("id") % 71).cast("int").alias("userId"),
        (F.col("id") * 7 % 1009).cast("int").alias("sourceId"),
        F.lit(1.0).cast("float").alias("rating"),
    )


def test_members_follow_from_the_pair(pairs):
    for row in hash_split(pairs).collect():
        digest = hashlib.md5(f"{row['userId']}|{row['sourceId']}".encode()).hexdigest()
        bucket = int(digest[:8], 16) % 10
        assert row["split"] == ("train" if bucket < 6 else "validation" if bucket < 8 else "test")


def test_members_do_not_depend_on_the_layout(pairs):
    one = {tuple(r) for r in hash_split(pairs.repartition(1)).collect()}
    many = {tuple(r) for r in hash_split(pairs.repartition(13)).collect()}
    assert one == many


def test_counts_add_up(pairs):
    counts = {r["split"]: r["n"] for r in split_counts(hash_split(pairs)).collect()}
    assert sum(counts.values()) == 5000
    assert 0.5 < counts["train"] / 5000 < 0.7


def test_other_weights(pairs):
    counts = hash_split(pairs, weights=(0.25, 0.25, 0.5), buckets=4)
    counts = {r["split"]: r["n"] for r in split_counts(counts).collect()}
    assert counts["test"] > counts["train"] and counts["test"] > counts["validation"]
    assert hash_split(pairs, weights=(1.0, 0.0, 0.0)).where("split <> 'train'").isEmpty()


@pytest.mark.parametrize(
    "weights", [(0.65, 0.15, 0.2), (0.6, 0.2), (0.6, 0.2, 0.1), (1.2, -0.4, 0.2)]
)
def test_bad_weights_are_refused(pairs, weights):
    with pytest.raises(ValueError):
        hash_split(pairs, weights=weights)


def test_random_split_is_whole_and_disjoint(pairs):
    numbered = pairs.withColumn("n", F.monotonically_increasing_id())
    parts = random_split(numbered)
    ids = [r["n"] for part in parts.values() for r in part.collect()]
    assert len(ids) == 5000 and len(set(ids)) == 5000


def places(rows, weights=(60, 20, 20)):
    """The plain version: sorted, cut by place."""
    n = len(rows)
    cuts = n * weights[0] // 100, n * (weights[0] + weights[1]) // 100
    return {
        row: "train" if i < cuts[0] else "validation" if i < cuts[1] else "test"
        for i, row in enumerate(sorted(rows, key=lambda r: [(v is not None, v or 0) for v in r]))
    }


@pytest.mark.parametrize(
    "rows",
    [
        [(i * 7919 % 1009, i) for i in range(1009)],
        [(5, i) for i in range(97)],  # one time for all: the keys alone cut
        [(None, i) for i in range(10)] + [(-(1 << 63), 1), ((1 << 63) - 1, 2), (-1, 3), (0, None)],
        [(i // 40, -i) for i in range(200)],
        [(1, 1)],
        [(1, 1), (1, 2)],
        [],
    ],
)
def test_time_split_is_that_of_the_sorted_rows(spark, rows):
    frame = spark.createDataFrame(rows, "at bigint, key bigint").repartition(3)
    found = time_split(frame, "at", ["key"]).collect()
    assert {(r["at"], r["key"]): r["split"] for r in found} == places(rows)


def test_time_split_of_timestamps_and_dates(spark):
    frame = spark.range(500).select(
        F.expr("timestamp_micros(1700000000000000 + id * 999999937 % 7777777)").alias("at"),
        F.expr("date_add(date '1960-01-01', cast(id % 13 * 900 as int))").alias("day"),
        F.col("id").cast("int").alias("key"),
    )
    for time in ("at", "day"):
        found = time_split(frame, time, ["key"]).orderBy(time, "key").collect()
        assert [r["split"] for r in found] == ["train"] * 300 + ["validation"] * 100 + ["test"] * 100


def test_rows_alike_in_time_and_key_stay_together(spark):
    frame = spark.createDataFrame([(1, 1)] * 5 + [(2, 2)] * 5, "at int, key int")
    found = {(r["at"], r["split"]) for r in time_split(frame, "at", ["key"]).collect()}
    assert found == {(1, "train"), (2, "train")}  # the cut at 6 takes all that share its row
    assert time_split(frame, "at", ["key"], (0.0, 1.0, 0.0)).where("split <> 'validation'").isEmpty()


def test_time_split_needs_no_shuffle_of_rows(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(time_split(events, "ts", ["event_id"]).select("event_id", "split"))
    assert "Exchange" not in plan and "Sort" not in plan
    with pytest.raises(ValueError, match="whole number"):
        time_split(events, "ts", ["event_type"])
    with pytest.raises(ValueError, match="add up to 1"):
        time_split(events, "ts", ["event_id"], (0.6, 0.2, 0.1))
