"""Ratings, counts, lines and factors derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.sources.text_files import scan_lines
from earshot.workspace import scratch_root, shuffles_dropped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who bought which part, one row per order line: ``userId, sourceId, quantity``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("sourceId"),
        F.col("l_quantity").alias("quantity"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (customer, part): the mean quantity."""
    return (
        order_lines(spark, sf_dir)
        .groupBy("userId", "sourceId")
        .agg(F.avg("quantity").cast("float").alias("rating"))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("item"),
        "event_type",
        "value",
    )


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The denser ratings: mean event value per (user, k)."""
    return (
        events(spark, sf_dir)
        .groupBy("userId", F.col("item").alias("sourceId"))
        .agg(F.avg("value").cast("float").alias("rating"))
    )


def counts(spark: SparkSession, sf_dir: str, event_type: str, item: str) -> DataFrame:
    """Events of one type per (user, k)."""
    return (
        events(spark, sf_dir)
        .where(F.col("event_type") == event_type)
        .groupBy("userId", F.col("item").alias(item))
        .agg(F.count(F.lit(1)).cast("int").alias("count"))
    )


def listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir, "view", "ocId")


def sings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir, "click", "sourceId")


def as_lines(rows: DataFrame) -> DataFrame:
    """Rows as pipe-delimited text, ``value string``."""
    return rows.select(
        F.concat_ws("|", *[F.col(c).cast("string") for c in rows.columns]).alias("value")
    )


def mixed_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One count line per event; the event type decides what is wrong with it, if anything."""
    kind, user, item = F.col("event_type"), F.col("userId"), F.col("item")
    id_ = F.col("event_id")
    return events(spark, sf_dir).select(
        F.when(kind == "view", F.concat_ws("|", user, item, id_))
        .when(kind == "click", F.concat_ws("|", user, item, id_, kind))
        .when(kind == "purchase", F.concat_ws("|", user, item, F.concat(id_, F.lit(".5"))))
        .when(kind == "signup", F.concat_ws("|", user, kind))
        .otherwise(F.concat_ws("|", user, item, id_ + 3_000_000_000))
        .alias("value")
    )


def mixed_rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for rating lines."""
    kind, user, item = F.col("event_type"), F.col("userId"), F.col("item")
    id_ = F.col("event_id")
    return events(spark, sf_dir).select(
        F.when(kind == "view", F.concat_ws("|", user, item, F.concat(id_, F.lit(".25"))))
        .when(kind == "click", F.concat_ws("|", user, item, id_, kind))
        .when(kind == "purchase", F.concat_ws("|", user, item, F.concat(id_ + 1, F.lit("e99"))))
        .when(kind == "signup", F.concat_ws("|", user, item, F.lit("NaN")))
        .otherwise(F.concat_ws("|", F.concat(F.lit(" "), user), item, id_))
        .alias("value")
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a factor vector: ``id int, features array<float>``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")
    )


FACTOR_RANK = 64


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a table below the shared folder, so that readers do not derive them anew."""
    path = scratch_root(rows.sparkSession, name)
    with shuffles_dropped(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def written_lines(rows: DataFrame, folder: str) -> str:
    """Write rows as ``part-*`` text into a folder and return it; zipped, as text is long."""
    with shuffles_dropped(rows.sparkSession):
        as_lines(rows).write.mode("overwrite").text(folder, compression="gzip")
    return folder


def scanned_lines(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written as text files and scanned back."""
    return scan_lines(spark, written_lines(rows, scratch_root(spark, "lines")))
