"""The two ways to a dot product agree where one takes over from the other."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from earshot.functions.vectors import COMPILED_RANK, dot
from earshot.operators.scoring import score_pairs
from tests.plans import plan_of


@pytest.mark.parametrize("rank", [1, COMPILED_RANK, COMPILED_RANK + 1, 64])
def test_dots_of_sums_that_cancel(spark, rank):
    # Float products are exact in double precision, and so are these sums.
    large = [2.0**20 * (-1) ** i if i < rank - rank % 2 else 0.0 for i in range(rank)]
    small = [1.0 + 2.0**-20 * (i // 2) for i in range(rank)]
    mixed = [(-1.5) ** (i % 7) for i in range(rank)]
    rows = [(large, small), (small, mixed), (large, large), (None, small), ([0.0] * rank, mixed)]
    frame = spark.createDataFrame(rows, "a array<float>, b array<float>")
    found = [r[0] for r in frame.select(dot(F.col("a"), F.col("b"), rank)).collect()]
    want = [None if a is None else math.fsum(x * y for x, y in zip(a, b, strict=True)) for a, b in rows]
    for got, plain in zip(found, want, strict=True):
        if plain is None:
            assert got is None or math.isnan(got)
        else:
            assert got == pytest.approx(plain, rel=1e-12, abs=1e-12)


def test_both_ways_give_the_same_value(spark):
    wide = spark.range(200).select(
        F.transform(
            F.sequence(F.lit(1), F.lit(COMPILED_RANK)), lambda j: F.sin(F.col("id") * j)
        ).cast("array<float>").alias("a"),
        F.transform(
            F.sequence(F.lit(1), F.lit(COMPILED_RANK)), lambda j: F.cos(F.col("id") + j)
        ).cast("array<float>").alias("b"),
    )
    padded = [F.concat(c, F.array(F.lit(0.0).cast("float"))) for c in ("a", "b")]
    both = wide.select(
        dot(F.col("a"), F.col("b"), COMPILED_RANK).alias("spelt"),
        dot(*padded, COMPILED_RANK + 1).alias("batched"),
    )
    gap = F.abs(F.col("spelt") - F.col("batched"))
    assert both.where(~(gap <= 1e-12 * (1 + F.abs("spelt")))).isEmpty()


def test_wide_vectors_stay_in_arrow(spark):
    """Most pairs of a table may be cold: they go to Python as empty lists, which cost nothing."""
    rank = COMPILED_RANK + 1
    vector = [0.5 * i for i in range(rank)]
    with_null = [None, *vector[1:]]
    factors = spark.createDataFrame(
        [(1, vector), (2, with_null), (3, None)], "id int, features array<float>"
    )
    pairs = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 3), (9, 1), (1, 9), (None, 1)], "userId int, sourceId int"
    )
    scored = score_pairs(pairs, factors, factors, rank)
    found = {(r["userId"], r["sourceId"]): r["prediction"] for r in scored.collect()}
    assert found.pop((1, 1)) == sum(x * x for x in vector)
    assert len(found) == 5 and all(math.isnan(score) for score in found.values())
    cold = pairs.where("userId = 9")
    assert math.isnan(score_pairs(cold, factors, factors, rank).first()["prediction"])
    assert "pandas" not in plan_of(scored).lower()
    sent = re.findall(r"THEN (user|item)_features#\d+ ELSE \[\] END", plan_of(scored))
    assert set(sent) == {"user", "item"}
