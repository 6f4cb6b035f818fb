from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from earshot.operators.topk import _rated_by_shard, flatten, item_ids, top_k_items
from earshot.operators.topk_kernel import NOTHING, best_items, read_keys, sort_keys
from tests.plans import plan_of, shuffle_keys


def table(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "id int, features array<float>").repartition(3)


def brute_force(user_ids, users, item_ids_, items, k):
    scores = (users.astype(np.float64) @ items.astype(np.float64).T).astype(np.float32)
    expected = {}
    for u, row in zip(user_ids, scores, strict=True):
        order = np.lexsort((item_ids_, -(row + 0.0)))[:k]
        expected[int(u)] = [(int(item_ids_[j]), float(row[j])) for j in order]
    return expected


def found(frame):
    return {
        r["userId"]: [(e["sourceId"], e["rating"]) for e in r["recommendations"]]
        for r in frame.collect()
    }


def check(got, expected):
    assert got.keys() == expected.keys()
    for user, wanted in expected.items():
        assert [i for i, _ in got[user]] == [i for i, _ in wanted], user
        assert [s for _, s in got[user]] == pytest.approx([s for _, s in wanted], rel=1e-6)


def make(kind, rng, n, rank):
    if kind == "signed":
        return rng.normal(size=(n, rank)).astype(np.float32)
    values = np.abs(rng.normal(size=(n, rank))).astype(np.float32)
    if kind == "with zeros and ties":
        values = np.round(values).astype(np.float32)  # many equal vectors and scores
        values[::3] = 0
    return values


@pytest.mark.parametrize("kind", ["signed", "non-negative", "with zeros and ties"])
@pytest.mark.parametrize("sizes", [{}, {"shard_items": 40, "group_users": 25}])
def test_against_brute_force(spark, kind, sizes):
    rng = np.random.default_rng(7)
    users, items = make(kind, rng, 90, 4), make(kind, rng, 310, 4)
    user_ids = rng.permutation(500)[:90] - 20
    ids = rng.permutation(2000)[:310] - 100
    got = found(top_k_items(table(spark, user_ids, users), table(spark, ids, items), 5, **sizes))
    check(got, brute_force(user_ids, users, ids, items, 5))


@pytest.mark.parametrize("sizes", [{}, {"shard_items": 4, "group_users": 3}])
def test_k_above_the_item_count_returns_every_item(spark, sizes):
    rng = np.random.default_rng(3)
    users, items = make("signed", rng, 10, 3), make("signed", rng, 17, 3)
    frame = top_k_items(
        table(spark, range(10), users), table(spark, range(17), items), 500, **sizes
    )
    got = found(frame)
    check(got, brute_force(np.arange(10), users, np.arange(17), items, 500))
    assert all(len(v) == 17 for v in got.values())


def test_one_norm_for_a_third_of_the_items(spark):
    """Equal norms cannot be told apart by range, so their bin is cut by id."""
    rng = np.random.default_rng(5)
    users, items = make("signed", rng, 40, 3), make("signed", rng, 300, 3)
    items[::3] = [0.6, 0.0, 0.8]
    frame = top_k_items(
        table(spark, range(40), users), table(spark, range(300), items), 5, shard_items=30
    )
    check(found(frame), brute_force(np.arange(40), users, np.arange(300), items, 5))


def test_empty_sides(spark):
    some = table(spark, range(3), np.ones((3, 2)))
    none = some.where("id < 0")
    assert top_k_items(none, some, 5).isEmpty()
    assert top_k_items(some, none, 5).isEmpty()
    with pytest.raises(ValueError):
        top_k_items(some, some, 0)


def test_no_cross_join_and_nothing_broadcast(spark):
    some = table(spark, range(300), np.random.default_rng(1).random((300, 3)))
    for sizes in ({}, {"shard_items": 50}):
        plan = top_k_items(some, some, 5, **sizes)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan
        assert "NestedLoop" not in plan


def test_flatten_and_item_ids(spark):
    rng = np.random.default_rng(11)
    users, items = make("signed", rng, 12, 3), make("signed", rng, 30, 3)
    frame = top_k_items(table(spark, range(12), users), table(spark, range(30), items), 4)
    nested = found(frame)
    flat = {(r["userId"], r["sourceId"]) for r in flatten(frame).collect()}
    assert flat == {(u, i) for u, entries in nested.items() for i, _ in entries}
    for row in item_ids(frame).collect():
        assert row["itemIds"] == [str(i) for i, _ in nested[row["userId"]]]


def test_sort_keys_order_and_round_trip():
    scores = np.array([3.5, -0.0, 0.0, -2.0, 3.5, np.float32(1e30), np.float32(-1e30)], np.float32)
    ids = np.array([9, 4, 3, -2147483648, 2147483647, 0, -1], np.int32)
    keys = sort_keys(scores, ids)
    assert keys.min() > NOTHING
    back_scores, back_ids = read_keys(keys)
    assert (back_scores == scores).all() and (back_ids == ids).all()
    best = np.argsort(-keys.astype(object))
    assert list(best) == [5, 0, 4, 2, 1, 3, 6]


@pytest.mark.parametrize("shard_items", [None, 7, 40])
@pytest.mark.parametrize("k", [1, 4])
def test_what_is_rated_is_left_out(spark, k, shard_items):
    rng = np.random.default_rng(5)
    users = rng.normal(size=(30, 3)).astype(np.float32)
    items = rng.normal(size=(90, 3)).astype(np.float32)
    users[3] = 0  # ties on every item, and gets the lowest ids that are left
    users[4] = 0
    items[10:20] = items[10]
    rated = {u: {int(i) for i in rng.choice(90, 15)} for u in range(30)}
    rated[3] = {0, 1, 2, 5}
    rated[4] = set(range(60))
    rated[5] = set(range(90))  # nothing left
    rated[6] = set(range(89))
    rated[7] = set()
    # A user whose best items are all taken must look beyond the first shards.
    rated[8] = {int(i) for i in np.argsort(-np.linalg.norm(items, axis=1))[:70]}

    def factors(rows):
        return spark.createDataFrame(
            [(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id int, features array<float>"
        )

    pairs = [(u, i) for u, chosen in rated.items() for i in chosen] * 2
    pairs += [(1, 5000), (999, 3), (None, 4), (4, None)]
    left_out = spark.createDataFrame(pairs, "userId int, sourceId int")
    found = {
        r["userId"]: [(e["sourceId"], e["rating"]) for e in r["recommendations"]]
        for r in top_k_items(
            factors(users), factors(items), k, shard_items=shard_items, rated=left_out
        ).collect()
    }
    scores = (users.astype(np.float64) @ items.astype(np.float64).T).astype(np.float32)
    for u in range(30):
        order = sorted(
            (i for i in range(90) if i not in rated[u]), key=lambda i: (-scores[u, i], i)
        )[:k]
        assert [i for i, _ in found[u]] == order, u
        assert [s for _, s in found[u]] == pytest.approx([scores[u, i] for i in order], abs=1e-5)


def test_leaving_nothing_out_changes_nothing(spark):
    vectors = spark.range(50).select(
        F.col("id").cast("int").alias("id"),
        F.transform(F.sequence(F.lit(1), F.lit(4)), lambda j: F.sin(F.col("id") * j)).cast("array<float>").alias("features"),
    )
    none = spark.createDataFrame([], "userId int, sourceId int")
    plain = top_k_items(vectors, vectors, 3, shard_items=9)
    same = top_k_items(vectors, vectors, 3, shard_items=9, rated=none)
    assert sorted(map(str, plain.collect())) == sorted(map(str, same.collect()))


def test_a_group_takes_little_more_than_its_tables():
    """Floats stay floats, and few scores are held at a time."""
    rng = np.random.default_rng(3)
    users, items = (rng.normal(size=(n, 64)).astype(np.float32) for n in (600, 30_000))
    ids = np.arange(30_000, dtype=np.int32)
    left = pa.table(
        {
            "id": pa.array(range(600), pa.int32()),
            "features": pa.array(list(users), pa.list_(pa.float32())),
            "floor_key": pa.nulls(600, pa.int64()),
        }
    )
    right = pa.table(
        {
            "ids": pa.array(np.split(ids, 10), pa.list_(pa.int32())),
            "flat": pa.array([part.ravel() for part in np.split(items, 10)], pa.list_(pa.float32())),
        }
    )
    tracemalloc.start()
    try:
        got = best_items(left, right, 5, False)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    want = brute_force(range(600), users, ids, items, 5)
    rows = zip(got["id"].to_pylist(), got["recommendations"].to_pylist(), strict=True)
    check({u: [(e["sourceId"], e["rating"]) for e in found] for u, found in rows}, want)
    assert peak < 10 * items.nbytes


def test_rated_pairs_are_shuffled_for_the_join_and_the_lists_only(spark):
    """Repeats and items that the model does not have go on the way; no shuffle by pair."""
    rows = [(1, 7), (1, 7), (1, 3), (1, 99), (2, 5), (None, 5), (2, None)] * 2
    rated = spark.createDataFrame(rows, "userId int, sourceId int")
    sharded = spark.createDataFrame([(3, 0), (5, 1), (7, 0)], "id int, shard int")
    lists = _rated_by_shard(rated, sharded)
    assert {(r["id"], r["shard"]): r["rated"] for r in lists.collect()} == {
        (1, 0): [3, 7],
        (2, 1): [5],
        (None, 1): [5],
    }
    keys = [k.split(", ")[:-1] for k in shuffle_keys(plan_of(_rated_by_shard(rated, sharded)))]
    by = [[name.split("#")[0] for name in key] for key in keys]
    assert all(key in (["item"], ["id"], ["id", "shard"]) for key in by), by
