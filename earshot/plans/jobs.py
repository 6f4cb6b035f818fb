"""The jobs: train, recommend, the two count loads, and loads of all days not yet loaded.

Each job reads its text once, writes the parsed rows as a columnar table under
the storage root, and works from that: later passes read a few integer columns
instead of parsing again, and a lost executor costs a re-read, not a re-parse.
Only counts and one metric row reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.text import row_key_text
from earshot.operators import als
from earshot.operators.biases import fill_cold, fit_biases
from earshot.operators.evaluate import metrics
from earshot.operators.split import SPLITS, split_counts, split_name
from earshot.operators.topk import recommend_for_all_users
from earshot.operators.tuning import Trial, choose
from earshot.params import JobParams
from earshot.schemas import LISTEN, RATING, SING, Record
from earshot.sinks.cell_store import lookup, merge_cells
from earshot.sinks.tables import overwrite_dates, overwrite_table
from earshot.sinks.wide_rows import by_row_key, count_cells, dated_cells, recommendation_rows
from earshot.sources.ledger import days_to_load, enter
from earshot.sources.parse import classify, fail_on_bad
from earshot.sources.text_files import scan_days, scan_lines
from earshot.workspace import ensure_checkpoint_dir, shuffles_dropped

BAD = "bad"
GOOD = "good"


@dataclass(frozen=True)
class TrainReport:
    """What a training run found; ``rmse`` is None when no test row was usable."""

    model_path: str
    counts: dict[str, int]
    bad_lines: int
    n_cold: int
    n_eval: int
    rmse: float | None
    # The fits that were compared on the validation split, if any were, and which one won.
    trials: tuple[Trial, ...] = ()
    chosen: int = 0


@dataclass(frozen=True)
class LoadReport:
    table_path: str
    good_lines: int
    bad_lines: int
    days: tuple[str, ...] = ()


def stage_parsed(
    spark: SparkSession, folder: str, record: Record, params: JobParams, good_part: Column
) -> str:
    """Parse a text folder into a table partitioned by ``part``; bad lines get their own.

    Good rows drop the text, bad rows keep it with the reason, so one write (and
    one scan) yields the typed table and the quarantine.
    """
    path = params.parsed_path(record.name)
    parts = _in_parts(scan_lines(spark, folder), record, params, good_part)
    overwrite_table(parts, path, partition_by=["part"])
    return path


def _in_parts(
    lines: DataFrame, record: Record, params: JobParams, good_part: Column, *carried: str
) -> DataFrame:
    classified = classify(lines, record, *carried)
    if params.on_bad_line == "fail":
        classified = fail_on_bad(classified)
    good = F.col("reason").isNull()
    return classified.select(
        *[F.when(good, F.col(c)).alias(c) for c in record.columns],
        F.when(~good, F.col("value")).alias("line"),
        "reason",
        *carried,
        F.when(good, good_part).otherwise(BAD).alias("part"),
    )


def read_parsed(spark: SparkSession, path: str, record: Record) -> DataFrame:
    """The staged table, with its schema given rather than inferred."""
    schema = record.schema.add("line", "string").add("reason", "string").add("part", "string")
    return spark.read.schema(schema).parquet(path)


def read_days(spark: SparkSession, path: str, record: Record) -> DataFrame:
    """The same of days that were merged, with their ``day``."""
    schema = record.schema.add("line", "string").add("reason", "string")
    return spark.read.schema(schema.add("day", "string").add("part", "string")).parquet(path)


def read_quarantine(spark: SparkSession, path: str, record: Record) -> DataFrame:
    return (
        read_parsed(spark, path, record)
        .where(F.col("part") == BAD)
        .select(F.col("line").alias("value"), "reason")
    )


def read_part(spark: SparkSession, params: JobParams, record: Record, part: str) -> DataFrame:
    """The typed rows of one part; other parts are not even listed for reading."""
    staged = read_parsed(spark, params.parsed_path(record.name), record)
    return staged.where(F.col("part") == part).select(*record.columns)


def _part_counts(staged: DataFrame) -> dict[str, int]:
    rows = split_counts(staged.select(F.col("part").alias("split"))).collect()
    return {row["split"]: row["n"] for row in rows}


def train(spark: SparkSession, params: JobParams) -> TrainReport:
    """Ratings text -> split -> model folder, with the error on the test split.

    With a grid the settings with the least error on the validation split are kept; the test
    split judges that one fit and no other.
    """
    ensure_checkpoint_dir(spark, params.checkpoint_path)
    part = split_name("userId", "sourceId", params.weights)
    path = stage_parsed(spark, params.ratings_path, RATING, params, part)
    counts = _part_counts(read_parsed(spark, path, RATING))
    train_rows = read_part(spark, params, RATING, "train")
    n_train = counts.get("train", 0)
    trials, chosen = (), 0
    if params.grid:
        validation = read_part(spark, params, RATING, "validation")
        choice = choose(train_rows, validation, params.grid, n_train)
        model, trials, chosen = choice.model, tuple(choice.trials), choice.best
    else:
        model = als.fit(train_rows, params.als, n_train)
    als.save(model, params.model_path)
    with shuffles_dropped(spark):
        metric = metrics(score_part(spark, params)).first()
    return TrainReport(
        model_path=params.model_path,
        counts={name: counts.get(name, 0) for name in SPLITS},
        bad_lines=counts.get(BAD, 0),
        n_cold=metric["n_cold"],
        n_eval=metric["n_eval"],
        rmse=metric["rmse"],
        trials=trials,
        chosen=chosen,
    )


def score_part(spark: SparkSession, params: JobParams, part: str = "test") -> DataFrame:
    """The test (or validation) split scored by the saved model.

    Saved factors leave no way back into the fit when a task is retried.
    """
    return als.predict(als.load(params.model_path), read_part(spark, params, RATING, part))


def predict_part(spark: SparkSession, params: JobParams, part: str = "test") -> DataFrame:
    """The same with no pair left out: cold ones get the baseline of the training ratings."""
    ensure_checkpoint_dir(spark, params.checkpoint_path)
    biases = fit_biases(read_part(spark, params, RATING, "train"))
    return fill_cold(biases, score_part(spark, params, part))


def recommend(spark: SparkSession, params: JobParams) -> str:
    """Saved model -> top-k for every user -> wide rows; returns the table's path.

    ``exclude_rated`` leaves out the pairs of all parts of the parsed ratings.
    """
    ensure_checkpoint_dir(spark, params.checkpoint_path)
    model = als.load(params.model_path)
    path = params.table_path(params.recommend_table)
    rated = None
    if params.exclude_rated:
        parsed = read_parsed(spark, params.parsed_path(RATING.name), RATING)
        rated = parsed.where(F.col("part") != BAD).select("userId", "sourceId")
    found = recommend_for_all_users(model, params.k, rated)
    overwrite_table(recommendation_rows(found), path)
    return path


def load_listens(spark: SparkSession, params: JobParams) -> LoadReport:
    return _load_counts(spark, params, LISTEN, params.listen_path, params.listen_table)


def load_sings(spark: SparkSession, params: JobParams) -> LoadReport:
    return _load_counts(spark, params, SING, params.sing_path, params.sing_table)


def _load_counts(
    spark: SparkSession, params: JobParams, record: Record, folder: str, table: str
) -> LoadReport:
    """Count text -> cells in row key order, replacing the target table."""
    staged = stage_parsed(spark, folder, record, params, F.lit(GOOD))
    counts = _part_counts(read_parsed(spark, staged, record))
    good = read_part(spark, params, record, GOOD)
    path = params.table_path(table)
    cells = count_cells(good, record.user, record.item, record.value, record.family)
    overwrite_table(by_row_key(cells), path)
    return LoadReport(path, counts.get(GOOD, 0), counts.get(BAD, 0))


def load_new_listens(spark: SparkSession, params: JobParams) -> LoadReport:
    return _load_new_days(spark, params, LISTEN, params.listen_table)


def load_new_sings(spark: SparkSession, params: JobParams) -> LoadReport:
    return _load_new_days(spark, params, SING, params.sing_table)


def _load_new_days(
    spark: SparkSession, params: JobParams, record: Record, table: str
) -> LoadReport:
    """All days whose folders the ledger does not have -> cells merged into the stored table.

    A day's cells count as written on that day, so a late one does not replace what newer days
    wrote.  The ledger is written last: a run that is cut off is done again in full, and merging
    the same day twice changes nothing.
    """
    ensure_checkpoint_dir(spark, params.checkpoint_path)
    path, ledger = params.cells_path(table), params.ledger_path(table)
    folders = {  # a row per day
        row["day"]: row["path"]
        for row in days_to_load(spark, params.dated_folder(record.name), ledger).collect()
    }
    if not folders:
        return LoadReport(path, 0, 0)
    days = tuple(sorted(folders))
    lines = scan_days(spark, folders)
    parsed = params.days_path(record.name)
    overwrite_dates(
        _in_parts(lines, record, params, F.lit(GOOD), "day"), parsed, "day", "part"
    )
    staged = read_days(spark, parsed, record).where(F.col("day").isin(list(days)))
    good = staged.where(F.col("part") == GOOD)
    merge_cells(
        dated_cells(good, record.user, record.item, record.value, record.family, "day"), path
    )
    loaded = spark.createDataFrame([(day,) for day in days], "day string")
    counted = staged.groupBy("day").agg(
        F.count_if(F.col("part") == GOOD).alias("good_lines"),
        F.count_if(F.col("part") == BAD).alias("bad_lines"),
    )
    entries = loaded.join(counted, "day", "left").na.fill(0).checkpoint()
    enter(entries, ledger)
    sums = entries.agg(F.sum("good_lines").alias("good"), F.sum("bad_lines").alias("bad")).first()
    return LoadReport(path, sums["good"], sums["bad"], days)


def cells_of(
    spark: SparkSession, params: JobParams, table: str, users: Sequence[int]
) -> DataFrame:
    """The merged cells of a few users, ``rowkey, family, qualifier, value, day``."""
    return lookup(spark, params.cells_path(table), [row_key_text(user) for user in users])
