"""Train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.workspace import ensure_checkpoint_dir

SPLITS = ("train", "validation", "test")
WEIGHTS = (0.6, 0.2, 0.2)
SEED = 12
BUCKETS = 10


def split_bucket(user: str, item: str, buckets: int = BUCKETS) -> Column:
    """A bucket that depends on the (user, item) pair alone.

    Unlike a random sample it does not change with partitioning, file layout or
    a retried task.
    """
    digest = F.md5(F.concat_ws("|", F.col(user), F.col(item)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def split_name(
    user: str, item: str, weights: Sequence[float] = WEIGHTS, buckets: int = BUCKETS
) -> Column:
    """``train``, ``validation`` or ``test`` for each row; a map, so no shuffle."""
    edges = []
    total = 0.0
    for weight in weights:
        total += weight
        edges.append(round(total * buckets))
        if abs(edges[-1] - total * buckets) > 1e-9:
            raise ValueError(f"weights {tuple(weights)} do not fall on {buckets} buckets")
    if len(weights) != len(SPLITS) or edges[-1] != buckets or min(weights) < 0:
        raise ValueError(f"need three weights that add up to 1, got {tuple(weights)}")
    first, second, _ = edges
    names = [SPLITS[(b >= first) + (b >= second)] for b in range(buckets)]
    return F.get(F.array(*[F.lit(name) for name in names]), split_bucket(user, item, buckets))


def hash_split(
    ratings: DataFrame,
    user: str = "userId",
    item: str = "sourceId",
    weights: Sequence[float] = WEIGHTS,
    buckets: int = BUCKETS,
) -> DataFrame:
    return ratings.withColumn("split", split_name(user, item, weights, buckets))


def random_split(
    ratings: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED
) -> dict[str, DataFrame]:
    """Spark's own random split.  Its members change when the partitioning does.

    The input is stored first: recomputed for each part, it could come in another layout,
    and a row fall into two parts or none.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    parts = ratings.checkpoint().randomSplit(list(weights), seed)
    return dict(zip(SPLITS, parts, strict=True))


# A pass over the table tells this many bits of a cut.
BITS = 12


def time_split(
    ratings: DataFrame, time: str, keys: Sequence[str], weights: Sequence[float] = WEIGHTS
) -> DataFrame:
    """``ratings`` with ``split``: the earliest rows train, the latest test.

    Of ``n`` rows in order of ``time``, then ``keys``, nulls first, the first
    ``floor(n * weight)`` train and so on, exactly.  Rows equal in time and keys stay together, in
    the earlier part.  Cuts are found by counting rows by the leading bits of their time, then
    by the next bits of those that share them, and so on through the keys: a few passes over narrow
    columns, 4,096 counts each; nothing is sorted and the split itself is a map.  Time
    and keys are timestamps, dates or whole numbers; pass a stored table.
    """
    if len(weights) != len(SPLITS) or min(weights) < 0 or abs(sum(weights) - 1) > 1e-9:
        raise ValueError(f"need three weights that add up to 1, got {tuple(weights)}")
    digits = [d for name in (time, *keys) for d in _digits(ratings, name)]
    n = ratings.count()
    upto, cuts = Fraction(0), []
    for weight in weights[:-1]:
        upto += Fraction(str(weight))
        cuts.append(_Cut(int(n * upto)))
    open_ = [cut for cut in cuts if 0 < cut.rows < n]
    for digit in range(len(digits)):
        _narrow(ratings, digits, digit, [cut for cut in open_ if not cut.found])
    first, second = (cut.reaches(digits, n) for cut in cuts)
    name = F.when(first, SPLITS[0]).when(second, SPLITS[1]).otherwise(SPLITS[2])
    return ratings.withColumn("split", name)


@dataclass
class _Cut:
    """Where the first ``rows`` rows end: at these leading digits, that row's digits included."""

    rows: int
    below: int = 0  # rows before those that share the digits
    at: tuple[int, ...] = ()
    found: bool = False

    def reaches(self, digits: list[Column], n: int) -> Column:
        """Whether a row is among the first ones."""
        if self.rows <= 0 or self.rows >= n:
            return F.lit(self.rows > 0)
        inside = F.lit(True)
        for digit, value in reversed(list(zip(digits, self.at, strict=False))):
            inside = (digit < value) | ((digit == value) & inside)
        return inside


def _digits(ratings: DataFrame, name: str) -> list[Column]:
    """A column as digits of ``BITS`` bits, leading ones first, in the order of its values."""
    kind = dict(ratings.dtypes)[name]
    column = F.col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        value = F.unix_micros(column.cast("timestamp"))
    elif kind == "date":
        value = F.unix_date(column).cast("long")
    elif kind in ("tinyint", "smallint", "int", "bigint"):
        value = column.cast("long")
    else:
        raise ValueError(f"{name} is of type {kind}, not a time or a whole number")
    # With the sign bit turned the bits stand in the order of the values.
    bits = F.coalesce(value, F.lit(0).cast("long")).bitwiseXOR(F.lit(-(1 << 63)))
    shifts = range(64 - BITS, -BITS, -BITS)
    return [
        column.isNotNull().cast("int"),
        *[
            F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << BITS) - 1))
            if shift >= 0
            else bits.bitwiseAND(F.lit((1 << (BITS + shift)) - 1))
            for shift in shifts
        ],
    ]


def _narrow(ratings: DataFrame, digits: list[Column], digit: int, cuts: list[_Cut]) -> None:
    """Settle one more digit of every cut that is still open; one pass for all of them."""
    if not cuts:
        return
    shares = []
    for number, cut in enumerate(cuts):
        same = F.lit(True)
        for column, value in zip(digits, cut.at, strict=False):
            same = same & (column == value)
        shares.append(F.when(same, F.struct(F.lit(number).alias("cut"), digits[digit].alias("digit"))))
    any_share = F.filter(F.array(*shares), lambda s: s.isNotNull())
    counts = ratings.select(F.inline(any_share)).groupBy("cut", "digit").count()
    found: list[dict[int, int]] = [{} for _ in cuts]
    for row in counts.collect():  # at most 4,096 a cut
        found[row["cut"]][row["digit"]] = row["count"]
    for cut, sizes in zip(cuts, found, strict=True):
        for value in sorted(sizes):
            if cut.below + sizes[value] >= cut.rows:
                break
            cut.below += sizes[value]
        cut.at = (*cut.at, value)
        cut.found = cut.below + sizes[value] == cut.rows  # all that share the digits


def split_counts(split: DataFrame) -> DataFrame:
    """Rows per split in one job: ``split, n``."""
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
