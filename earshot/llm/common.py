"""What several text operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.workspace import ensure_checkpoint_dir

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept(frame: DataFrame) -> DataFrame:
    """The frame, stored once in the shared folder, so that later reads do not recompute it."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's batches; memory that those that are done leave free goes back to the system.

    Python workers live on from stage to stage beside the executor's JVM, and Arrow and the C
    library would hold on to their largest working sets for as long.
    """
    for batch in batches:
        yield batch
        del batch
        hand_back()


def hand_back() -> None:
    """Give memory that is free to Arrow or the C library back to the system."""
    pa.default_memory_pool().release_unused()
    _memory_trim()()


@cache
def _memory_trim() -> Callable[[], object]:
    """What hands the C library's free memory back, where there is such a call."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    return (lambda: trim(0)) if trim else (lambda: None)


def remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32(doc_id as text) mod divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores in front until none is a given column."""
    taken = {c.lower() for c in columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def with_columns_after(frame: DataFrame, *fields: T.StructField) -> T.StructType:
    """The frame's schema followed by ``fields``."""
    return T.StructType([*frame.schema.fields, *fields])


def numbered(frame: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``frame`` (stored) with its rank from 0 in ``order``, without one task that sees all rows.

    A range sort gives each partition its share; only a count per partition is
    gathered.  ``order`` must leave no ties between rows that differ.
    """
    placed = kept(frame.orderBy(*order).withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(  # one row per partition
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return (
        placed.withColumn("__within", within)
        .join(starts, "__part")
        .withColumn(name, F.col("__start") + F.col("__within"))
        .drop("__part", "__within", "__start")
    )


def ranked_within(
    frame: DataFrame, group: Sequence[str], order: Sequence[Column], *names: str
) -> DataFrame:
    """``frame`` (stored) with ``names``: rank from 0 within a group, the group's size, a part.

    A range sort over group and order gives each partition its share of a group of any size,
    and equal rows are spread by where they stand in the input; what is joined back is a row
    for each group and partition it reaches.  ``group`` holds no nulls, ``order`` leaves no ties
    between rows that differ, and ``frame`` must itself be stored: its row numbers must not
    change when a task runs again.
    """
    rank, size, part = names
    spread = [*[F.col(c) for c in group], *order, F.monotonically_increasing_id()]
    placed = kept(frame.orderBy(*spread).withColumn(part, F.spark_partition_id()))
    counts = placed.groupBy(*group, part).agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*group)  # a row for each partition that the group reaches
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *group,
        part,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
        F.sum("__n").over(whole).alias(size),
    )
    within = F.row_number().over(Window.partitionBy(*group, part).orderBy(*order)) - 1
    return (
        placed.withColumn("__within", within)
        .join(starts, [*group, part])
        .withColumn(rank, F.col("__start") + F.col("__within"))
        .select(*frame.columns, *names)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def star_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, root``: the smallest node each linked node can reach, from ``a, b`` edges.

    Alternates two star steps until the edges stop changing: every node's larger
    neighbours hang on its smallest neighbour, then the rest of its neighbours do.
    Each step is a grouped minimum and an equi-join, so a node with any number of
    links is never gathered in one place.
    """
    small, large = F.least("a", "b"), F.greatest("a", "b")
    stars = kept(edges.where("a != b").select(large.alias("a"), small.alias("b")).distinct())
    seen = _digest(stars)
    for _ in range(rounds):
        stars = _hang(stars, both_ways=True)
        stars = kept(_hang(stars, both_ways=False))
        now = _digest(stars)
        if now == seen:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    raise RuntimeError(f"components still change after {rounds} rounds")


def _hang(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One star step over edges ``a > b``."""
    if both_ways:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    lowest = around.groupBy("a").agg(F.min("b").alias("m"))
    # The node itself is a neighbour of its own.
    lowest = lowest.select("a", F.least("a", "m").alias("m"))
    met = around.join(lowest, "a")
    if both_ways:
        hung = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            lowest.select("a", F.col("m").alias("b"))
        )
    return hung.where("a > b").distinct()


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)
