"""Quartile bucket digests: counts of hashed byte triplets, by quartile, and the length.

A digest is text: two hexadecimal digits for the length and two bits for each bucket.
Digests compare by a bounded difference score, turned into a likeness from 0 to 1.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import read_documents

BUCKETS = 256
# Triplets: which bytes after the first belong to one.
GAPS = ((1, 2), (1, 3), (2, 4))
# Lengths count in steps of this factor; one step differs like one bucket by one
# quartile, up to a bound.
LENGTH_STEP = 1.15
LENGTH_BOUND = 40
# Two digests of random buckets differ by 1.25 per bucket; from there on nothing is alike.
DIFFERENCE_BOUND = BUCKETS


def counts(data: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """How many triplets fall in each bucket."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    total = np.zeros(buckets, np.int64)
    for kind, (second, third) in enumerate(GAPS):
        n = len(raw) - third
        if n <= 0:
            continue
        code = raw[:n] | raw[second : second + n] << np.uint32(8)
        code |= raw[third : third + n] << np.uint32(16)
        code += np.uint32(kind << 24)
        code *= np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA77)
        code >>= np.uint32(16)
        total += np.bincount(code % np.uint32(buckets), minlength=buckets)
    return total


def digest(data: bytes) -> np.ndarray:
    """Length step, then each bucket's quartile: above how many of the three its count is."""
    found = counts(data)
    quartiles = np.sort(found)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    above = (found[:, None] > quartiles).sum(axis=1)
    step = min(255, round(math.log(len(data) + 1, LENGTH_STEP)))
    return np.append(step, above).astype(np.uint8)


def written(found: np.ndarray) -> str:
    four = found[1:].reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return bytes([found[0], *packed.tolist()]).hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, 0 from the bound of the difference on; symmetric."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16))
    difference = int(apart[1:].sum()) + min(int(apart[0]), LENGTH_BOUND)
    return 1.0 - min(difference, DIFFERENCE_BOUND) / DIFFERENCE_BOUND


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    gone = len(text) // 4
    return text[: len(text) - gone] + following[:gone]


# -- each document with the next one ----------------------------------------------

LOWEST = -(1 << 63)


def with_following(docs: DataFrame) -> DataFrame:
    """``part, tail, place, doc_id, text``: rows in order within parts, for one pass over each.

    Parts are ranges of ``doc_id`` that begin at ids found in the table; the rows of
    such an id also close the part before as its ``tail``, and those of the lowest id
    the last part.  So a pass over a part meets every document's successor, and
    text moves once.
    """
    spark = docs.sparkSession
    placed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("place"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(parts)]
    found = placed.agg(  # one number per part
        F.min("place").alias("low"), F.percentile_approx("place", shares, 50 * parts).alias("at")
    ).first()
    begins = np.array(sorted({found["low"], *(found["at"] or [])} - {None}), np.int64)

    @F.pandas_udf("array<int>")
    def parts_of(place: pd.Series) -> pd.Series:
        own = np.searchsorted(begins, place.to_numpy(), side="right") - 1
        first = begins[own] == place.to_numpy()
        before = (own - 1) % len(begins)
        return pd.Series(
            [[o, -1 - b] if f else [o] for o, f, b in zip(own, first, before, strict=True)]
        )

    signed = placed.withColumn("signed", F.explode(parts_of("place")))
    part = F.when(F.col("signed") < 0, -1 - F.col("signed")).otherwise(F.col("signed"))
    return (
        signed.select(part.alias("part"), (F.col("signed") < 0).alias("tail"), "place", "doc_id", "text")
        .repartitionById(max(1, len(begins)), F.col("part"))
        .sortWithinPartitions("part", "tail", "place", "text")
    )


def compared(docs: DataFrame) -> DataFrame:
    """Every row's digest, its edited text's, and how alike both and the next row's are.

    Rows go by ascending ``doc_id``, null first, repeated ids by text; after the last
    comes the first.  A null text is empty.  Texts below three bytes have no triplets: whatever
    they say, those of one length have one digest, and their likeness is 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose successor is awaited
        rows: list[tuple] = []
        for batch in batches:
            columns = (batch.column(c) for c in ("part", "tail", "doc_id", "text"))
            for part, tail, doc_id, text in zip(*columns, strict=True):
                part, tail, text = part.as_py(), tail.as_py(), text.as_py()
                if tail and (held is None or held[0] != part):
                    continue  # the part before is complete
                own = digest(text.encode())
                if held is not None and held[0] == part:
                    rows.append(_row(held, text, own))
                held = None if tail else (part, doc_id.as_py(), text, own)
            yield _table(rows)
            rows = []

    return with_following(docs).mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def _row(held: tuple, following: str, following_digest: np.ndarray) -> tuple:
    _, doc_id, text, own = held
    data = edited(text, following).encode()
    changed = digest(data)
    return (
        doc_id,
        len(text),
        hashlib.sha256(data).hexdigest(),
        written(own),
        written(changed),
        likeness(own, changed),
        likeness(own, following_digest),
    )


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    kinds += [pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    names += ["near_edited", "near_next"]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def op5_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all documents."""
    return compared(read_documents(spark, sf_dir))
