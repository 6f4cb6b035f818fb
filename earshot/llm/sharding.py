"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many of a partition's rows go to each shard is drawn first, as a random permutation
of all rows would have it: partitions are halved again and again, and the number of each
shard's rows that fall into the first half is hypergeometric.  Then each partition permutes its rows and
deals them out by its line of the matrix, rows move once, and every shard permutes what it got.
Column expressions only; counts are drawn in Spark too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.llm.common import free_names, kept, let, read_documents

SHARDS = 8
SEED = 23
LAW = "rows"
# Standard deviations on either side of the likeliest count that a draw looks at; what lies
# beyond has a chance below 1e-17, the last bit of a uniform number is 1e-16.
REACH = 9
# The matrix is copied to every task only when it has at most this many counts.
MOST_COUNTS = 4_000_000
LONGS = "array<bigint>"
# Row numbers are the lower 33 bits of Spark's increasing ids.
ROW_BITS = (1 << 33) - 1


def capacities(total: Column, shards: int) -> Column:
    """Rows of each shard: they differ by one at most, the first ones have more."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda j: F.floor(total / shards) + (j < total % shards).cast("long"),
    )


def uniform(*parts: Column) -> Column:
    """A number from 0 up to 1 that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / float(1 << 53)


def hypergeometric(total: Column, marked: Column, drawn: Column, chance: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, where ``chance`` falls.

    Weights go outward from the likeliest count by their exact ratios; no factorials, so
    any size will do.  Longs in, a long out.
    """
    d = [c.cast("double") for c in (total, marked, drawn)]
    n_, k_, m_ = d
    low, high = F.greatest(F.lit(0), drawn + marked - total), F.least(drawn, marked)
    likely = F.floor((m_ + 1) * (k_ + 1) / (n_ + 2))
    size = F.greatest(n_, F.lit(1.0))
    spread = F.sqrt(m_ * (k_ / size) * (1 - k_ / size) * (n_ - m_) / F.greatest(n_ - 1, F.lit(1.0)))
    reach = F.ceil(REACH * spread) + REACH
    none = F.array().cast(LONGS)

    def outcome(mode: Column) -> Column:
        first, last = F.greatest(low, mode - reach), F.least(high, mode + reach)
        ups = F.when(last > mode, F.sequence(mode, last - 1)).otherwise(none)
        downs = F.when(first < mode, F.sequence(mode, first + 1)).otherwise(none)

        def grow(k: Column) -> Column:
            return (k_ - k) * (m_ - k) / ((k + 1.0) * (n_ - k_ - m_ + k + 1))

        def shrink(k: Column) -> Column:
            return k * (n_ - k_ - m_ + k) / ((k_ - k + 1.0) * (m_ - k + 1))

        def walk(ks: Column, ratio: Callable, step: int, goal: Column) -> Column:
            """Sum of the weights along ``ks`` and the first count at which it passes ``goal``."""
            start = F.struct(
                F.lit(1.0).alias("weight"),
                F.lit(0.0).alias("sum"),
                F.lit(None).cast("long").alias("found"),
            )
            return F.aggregate(
                ks,
                start,
                lambda s, k: let(
                    s["weight"] * ratio(k),
                    lambda w: F.struct(
                        w.alias("weight"),
                        (s["sum"] + w).alias("sum"),
                        F.coalesce(s["found"], F.when(s["sum"] + w > goal, k + step)).alias("found"),
                    ),
                ),
            )

        never = F.lit(float("inf"))
        sums = F.struct(
            walk(ups, grow, 1, never)["sum"].alias("up"),
            walk(downs, shrink, -1, never)["sum"].alias("down"),
        )
        return let(
            sums,
            lambda s: let(
                chance * (1.0 + s["up"] + s["down"]) - 1.0,
                lambda goal: F.when(goal < 0, mode).otherwise(
                    F.coalesce(
                        walk(ups, grow, 1, goal)["found"],
                        walk(downs, shrink, -1, goal - s["up"])["found"],
                        mode,
                    )
                ),
            ),
        )

    return let(F.greatest(low, F.least(high, likely)).cast("long"), outcome)


def _drawn(left: Column, rows: Column, seed: Column) -> Column:
    """How many of each shard's rows, ``left`` of them in all, are among the first ``rows``."""
    start = F.struct(
        F.array().cast(LONGS).alias("out"),
        rows.cast("long").alias("rows"),
        F.aggregate(left, F.lit(0).cast("long"), lambda a, b: a + b).alias("all"),
    )

    def next_shard(s: Column, j: Column) -> Column:
        marked = F.get(left, j)
        count = hypergeometric(s["all"], marked, s["rows"], uniform(seed, j))
        return let(
            count,
            lambda x: F.struct(
                F.concat(s["out"], F.array(x)).alias("out"),
                (s["rows"] - x).alias("rows"),
                (s["all"] - marked).alias("all"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(left) - 1), start, next_shard)["out"]


def communication_matrix(counts: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``part, dealt``: how many rows of each partition go to each shard, from ``part, n``.

    Lines add up to the partitions' rows and columns to the shards' sizes.  One row holds
    all partitions' counts at the start; halving spreads them over tasks.
    """
    parts = F.sort_array(F.collect_list(F.struct("part", F.col("n").cast("long").alias("n"))))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long")
    nodes = counts.agg(parts.alias("parts"), capacities(total, shards).alias("dealt"))
    n_parts = counts.count()
    for level in range(max(0, n_parts - 1).bit_length()):
        half = F.floor(F.size("parts") / 2).cast("int")
        first = F.slice("parts", 1, half)
        rows = F.aggregate(first, F.lit(0).cast("long"), lambda s, p: s + p["n"])
        key = F.xxhash64(F.lit(seed), F.get("parts", F.lit(0))["part"], F.size("parts"))
        drawn = F.when(half > 0, _drawn(F.col("dealt"), rows, key))
        halved = nodes.select("parts", "dealt", F.inline(F.array(F.struct(drawn.alias("drawn")))))
        rest = F.zip_with("dealt", "drawn", lambda a, b: a - b)
        both = F.array(
            F.struct(first.alias("parts"), F.col("drawn").alias("dealt")),
            F.struct(
                F.slice("parts", half + 1, F.size("parts") - half).alias("parts"),
                rest.alias("dealt"),
            ),
        )
        alone = F.array(F.struct("parts", "dealt"))
        nodes = halved.select(F.inline(F.when(half > 0, both).otherwise(alone)))
        if level == 5:  # from 64 nodes on, in many tasks
            nodes = nodes.repartition(256, F.get("parts", F.lit(0))["part"])
    return nodes.where(F.size("parts") == 1).select(
        F.get("parts", F.lit(0))["part"].alias("part"), "dealt"
    )


def shuffled(frame: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``frame`` with ``shard`` and ``slot``, each row's place from 0 in its shard.

    Every order of the rows is as likely as any other (as far as 64-bit hashes of row numbers
    go), whatever they hold: nulls, repeated rows and groups of copies are rows like others.
    Shards differ by one row at most; some stay empty if there are fewer rows than shards.
    The outcome depends on the seed and on how the input is split into partitions, so a
    stored input and equal settings give it again.  A column of ``frame`` of either name stays
    and the new one gets an underscore in front.
    """
    shard, slot = free_names(frame.columns, "shard", "slot")
    given = F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row")
    # A row's number in the input makes it distinct; its hash orders it within its partition.
    row_number = F.monotonically_increasing_id()
    placed = kept(
        frame.select(given, F.spark_partition_id().alias("part"), row_number.alias("number"))
    )
    counts = kept(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    matrix = kept(communication_matrix(counts, shards, seed))
    if counts.count() * shards <= MOST_COUNTS:
        matrix = F.broadcast(matrix)
    # Stored partitions keep their order, so the number of a row in its sorted partition is at hand.
    permuted = (
        placed.withColumn("order", F.xxhash64(F.lit(seed), "number"))
        .sortWithinPartitions("order", "number")
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)))
    )
    passed = F.aggregate(
        "dealt",
        F.struct(F.lit(0).alias("shard"), F.lit(0).cast("long").alias("sum")),
        lambda s, n: F.struct(
            (s["shard"] + (s["sum"] + n <= F.col("at")).cast("int")).alias("shard"),
            (s["sum"] + n).alias("sum"),
        ),
    )["shard"]
    dealt = permuted.join(matrix, "part").select("row", "number", passed.alias("shard"))
    again = [F.col("shard"), F.xxhash64(F.lit(seed + 1), "number"), F.col("number")]
    moved = kept(dealt.orderBy(*again).withColumn("part", F.spark_partition_id()))
    shares = kept(moved.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n")))
    starts = F.broadcast(_starts(shares, shards))  # a row for each partition and shard in it
    index = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    return (
        moved.withColumn("index", index)
        .join(starts, ["part", "shard"])
        .select(
            *[F.col(f"row.`{c}`").alias(c) for c in frame.columns],
            F.col("shard").alias(shard),
            (F.col("index") + F.col("shift")).alias(slot),
        )
    )


def _starts(shares: DataFrame, shards: int) -> DataFrame:
    """``part, shard, shift``: what turns a row's number in its partition into its slot.

    ``shares`` has at most a row for each partition and shard; in order of partition and shard
    they give each group's start in its partition and in its shard.
    """
    in_part = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    return shares.select(
        "part",
        "shard",
        (
            F.coalesce(F.sum("n").over(in_shard), none) - F.coalesce(F.sum("n").over(in_part), none)
        ).alias("shift"),
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32``: UTF-8 bytes plus one, and their CRC-32; a null text has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents, by the law of equal row counts."""
    return shuffled(sized(read_documents(spark, sf_dir))).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
