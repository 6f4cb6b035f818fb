from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from earshot.operators.topk import top_k_items
from earshot.params import AlsParams, JobParams
from earshot.plans import jobs
from earshot.registered import standins
from earshot.sinks.tables import overwrite_table
from earshot.workspace import DROP_SHUFFLES, shuffles_dropped
from tests.disk import local_folders, shuffles_in, shuffles_left


@pytest.mark.parametrize("way", ["table", "stored", "lines"])
def test_a_write_leaves_no_shuffle_files(spark, tmp_path, way):
    """Nor does it change what the session says about its other queries."""
    setting = spark.conf.get(DROP_SHUFFLES, None)
    before = shuffles_in(local_folders(spark))
    rows = spark.range(4000).groupBy((F.col("id") % 997).alias("k")).count()
    if way == "table":
        assert overwrite_table(rows, str(tmp_path / "t")) == 997
    elif way == "stored":
        assert standins.stored(rows, "rows").count() == 997
    else:
        assert spark.read.text(standins.written_lines(rows, str(tmp_path / "l"))).count() == 997
    assert not shuffles_left(spark, before)
    assert spark.conf.get(DROP_SHUFFLES, None) == setting


def test_the_setting_comes_back_after_a_failure(spark):
    setting = spark.conf.get(DROP_SHUFFLES, None)
    with pytest.raises(RuntimeError), shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        raise RuntimeError
    assert spark.conf.get(DROP_SHUFFLES, None) == setting


def test_jobs_leave_no_shuffle_files(spark, sf_dir, tmp_path):
    params = JobParams(
        storage_root=str(tmp_path), run_date=date(2024, 1, 2), als=AlsParams(max_iter=1), exclude_rated=True
    )
    ratings = standins.stored(standins.ratings(spark, sf_dir), "ratings")
    before = shuffles_in(local_folders(spark))
    standins.written_lines(ratings, params.ratings_path)
    assert jobs.train(spark, params).n_eval > 0
    assert spark.read.parquet(jobs.recommend(spark, params)).count() > 0
    assert not shuffles_left(spark, before)


def test_rounds_of_top_k_leave_only_the_last_one(spark):
    """What a round shuffled goes when its outcome is stored."""
    rows = [(i, [float(i % 7), float(i % 11), 1.0]) for i in range(400)]
    vectors = standins.stored(spark.createDataFrame(rows, "id int, features array<float>"), "vectors")
    rated = vectors.select(F.col("id").alias("userId"), F.col("id").alias("sourceId"))
    before = shuffles_in(local_folders(spark))
    found = top_k_items(vectors, vectors, 5, shard_items=25, rated=rated)
    assert not shuffles_left(spark, before)
    assert found.count() == 400


def test_text_written_for_a_job_is_zipped(spark, tmp_path):
    rows = spark.range(3000).select("id", (F.col("id") % 7).alias("k"))
    folder = standins.written_lines(rows, str(tmp_path))
    parts = list(tmp_path.glob("part-*"))
    assert parts and all(part.name.endswith(".gz") for part in parts)
    assert {r[0] for r in spark.read.text(folder).collect()} == {f"{i}|{i % 7}" for i in range(3000)}
