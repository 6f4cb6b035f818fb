"""Dot products and norms over ``array<float>`` factor columns."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Generated code for this rank stays below the 8,000 bytes that HotSpot compiles.
COMPILED_RANK = 24


def dot(left: Column, right: Column, rank: int) -> Column:
    """Sum of products in double precision.

    Spelt out per position so that it stays inside generated code, up to the rank at which
    that code grows too long for the JVM to compile; wider vectors go to numpy by batches.
    """
    if rank > COMPILED_RANK:
        return _wide_dot(left, right)
    return reduce(
        add,
        (
            F.get(left, F.lit(i)).cast("double") * F.get(right, F.lit(i)).cast("double")
            for i in range(rank)
        ),
    )


def norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
    )


def _wide_dot(left: Column, right: Column) -> Column:
    def matrix(vectors: pa.ListArray) -> np.ndarray:
        """Lists of one length; a null in them is NaN."""
        lengths = pc.unique(pc.list_value_length(vectors)).to_pylist()
        if len(lengths) > 1:
            raise ValueError(f"vectors of lengths {sorted(lengths)}")
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(vectors), *lengths)

    def products(left: pa.Array, right: pa.Array, both: pa.Array) -> pa.Array:
        found = np.full(len(both), np.nan)
        if both.true_count:
            a, b = matrix(left.filter(both)), matrix(right.filter(both))
            found[both.to_numpy(zero_copy_only=False)] = np.einsum("ij,ij->i", a, b)
        return pa.array(found)

    # A vector without its partner does not travel.  In its place goes an empty list, not a null:
    # Spark measures a batch after every row, and goes over all nulls of a list column each time.
    both = left.isNotNull() & right.isNotNull()
    empty = F.array().cast("array<float>")
    sides = [F.when(both, side).otherwise(empty) for side in (left, right)]
    return F.arrow_udf(products, "double")(*sides, both)
