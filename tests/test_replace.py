"""Tables are replaced without a gap."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from earshot.sinks import tables
from earshot.sinks.tables import overwrite_table, recover_table


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def test_a_failing_load_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "deep" / "table")
    assert overwrite_table(spark.range(5), path) == 5
    failing = spark.range(100).withColumn(
        "id", F.when(F.col("id") == 60, F.raise_error(F.lit("halfway"))).otherwise(F.col("id")).cast("bigint")
    )
    with pytest.raises(Exception, match="halfway"):
        overwrite_table(failing, path)
    assert ids(spark, path) == list(range(5))
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["table"]


def test_a_first_load_that_fails_leaves_nothing(spark, tmp_path):
    path = tmp_path / "table"
    with pytest.raises(Exception, match="no"):
        overwrite_table(spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("id")), str(path))
    assert not list(tmp_path.iterdir())


def test_a_table_may_be_read_by_the_load_that_replaces_it(spark, tmp_path):
    path = str(tmp_path / "table")
    overwrite_table(spark.range(4), path)
    overwrite_table(spark.read.parquet(path).select(F.col("id") * 10), path)
    assert spark.read.parquet(path).count() == 4


def test_a_short_count_is_not_put_in_place(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    overwrite_table(spark.range(4), path)
    monkeypatch.setattr(tables, "_write_counted", lambda df, p, *a: df.write.parquet(p) or 9)
    with pytest.raises(RuntimeError, match="7 rows stored of 9"):
        overwrite_table(spark.range(7), path)
    assert ids(spark, path) == list(range(4))


def test_a_switch_that_was_cut_off_is_put_back(spark, tmp_path):
    path = tmp_path / "table"
    overwrite_table(spark.range(4), str(path))
    path.rename(tmp_path / ".table.old-1")  # the driver was lost between the renames
    spark.range(9).write.parquet(str(tmp_path / ".table.new-1"))
    assert recover_table(spark, str(path))
    assert ids(spark, str(path)) == list(range(4))
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    assert not recover_table(spark, str(path))


def test_a_switch_that_fails_puts_the_old_table_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    overwrite_table(spark.range(4), path)
    rename = tables.Folder.rename

    def refuse(self, to):
        if ".new-" in self.path.getName():
            raise OSError("refused")
        rename(self, to)

    monkeypatch.setattr(tables.Folder, "rename", refuse)
    with pytest.raises(OSError, match="refused"):
        overwrite_table(spark.range(9), path)
    assert ids(spark, path) == list(range(4))


def test_empty_and_partitioned_tables(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(6).withColumn("part", F.col("id") % 2)
    assert overwrite_table(rows, path, ["part"]) == 6
    assert ids(spark, path) == list(range(6))
    assert overwrite_table(rows.limit(0), path, ["part"]) == 0
    assert not list(Path(path).rglob("*.parquet"))
    assert overwrite_table(rows.limit(0), path) == 0
    assert ids(spark, path) == []
