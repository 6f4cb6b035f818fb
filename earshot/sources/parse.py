"""Lines to typed rows, with the bad ones named rather than lost.

A parse is a map over the scan: no shuffle, no Python, no second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.text import looks_float, looks_int, split_fields, to_float, to_int
from earshot.schemas import Record

TOO_FEW = "too few fields"
NOT_A_NUMBER = "not a number"
OUT_OF_RANGE = "out of range"


def classify(lines: DataFrame, record: Record, *carried: str) -> DataFrame:
    """``value, reason`` plus the record's columns; ``reason`` is NULL on good lines.

    ``carried`` names further columns of ``lines`` to keep.
    Fields past the third are ignored.  A number that reads well but does not fit
    (an id past 32 bits, a rating past the largest float) is out of range.
    """
    is_float = isinstance(record.value_type, T.FloatType)
    looks_value, to_value = (looks_float, to_float) if is_float else (looks_int, to_int)

    fields = lines.select("value", *carried, split_fields(F.col("value")).alias("f")).select(
        "value",
        *carried,
        F.get("f", F.lit(0)).alias("user_text"),
        F.get("f", F.lit(1)).alias("item_text"),
        F.get("f", F.lit(2)).alias("value_text"),
    )
    numbers = F.struct(
        to_int(F.col("user_text")).alias(record.user),
        to_int(F.col("item_text")).alias(record.item),
        to_value(F.col("value_text")).alias(record.value),
    )
    # A plain projection would be repeated inside every filter on its outcome, and
    # each line parsed several times over; a generator is evaluated once per line.
    typed = fields.select(
        "value", *carried, "user_text", "item_text", "value_text", F.inline(F.array(numbers))
    )
    good = (
        F.col(record.user).isNotNull()
        & F.col(record.item).isNotNull()
        & F.col(record.value).isNotNull()
    )
    numeric = (
        looks_int(F.col("user_text"))
        & looks_int(F.col("item_text"))
        & looks_value(F.col("value_text"))
    )
    # Good lines leave at the first branch; only bad ones are looked at again.
    reason = (
        F.when(good, F.lit(None).cast("string"))
        .when(F.col("value_text").isNull(), TOO_FEW)
        .when(~numeric, NOT_A_NUMBER)
        .otherwise(OUT_OF_RANGE)
    )
    return typed.select("value", *carried, reason.alias("reason"), *record.columns)


def parse(lines: DataFrame, record: Record, on_bad_line: str = "quarantine") -> DataFrame:
    """The good rows.  ``on_bad_line='fail'`` stops the job at the first bad line."""
    classified = classify(lines, record)
    if on_bad_line == "fail":
        classified = fail_on_bad(classified)
    return classified.where(F.col("reason").isNull()).select(*record.columns)


def quarantine(lines: DataFrame, record: Record) -> DataFrame:
    """The bad lines and why: ``value, reason``."""
    return classify(lines, record).where(F.col("reason").isNotNull()).select("value", "reason")


def fail_on_bad(classified: DataFrame) -> DataFrame:
    return classified.withColumn(
        "reason",
        F.when(
            F.col("reason").isNotNull(),
            F.raise_error(F.concat(F.lit("bad line, "), "reason", F.lit(": "), "value")).cast(
                "string"
            ),
        ),
    )
