from __future__ import annotations

import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from earshot.sinks import cell_store
from earshot.sinks.cell_store import lookup, merge_cells, read_cells
from tests.plans import plan_of

SCHEMA = "rowkey string, family string, qualifier string, value string, day string"


def cells(spark, *rows):
    return spark.createDataFrame([(u, "f", q, v, d) for u, q, v, d in rows], SCHEMA)


def stored(spark, path):
    return sorted(
        (r["rowkey"], r["qualifier"], r["value"], r["day"]) for r in read_cells(spark, path).collect()
    )


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("bucket=*/*.parquet")}


def test_loads_merge_cell_by_cell(spark, tmp_path):
    path = str(tmp_path / "cells")
    assert merge_cells(cells(spark, ("a", "1", "x", "d1"), ("b", "1", "y", "d1")), path, 8)
    merge_cells(cells(spark, ("a", "2", "z", "d2"), ("b", "1", "w", "d2")), path, 8)
    assert stored(spark, path) == [
        ("a", "1", "x", "d1"), ("a", "2", "z", "d2"), ("b", "1", "w", "d2")
    ]
    # A late day adds what is not there and replaces nothing that is newer.
    merge_cells(cells(spark, ("b", "1", "old", "d0"), ("b", "9", "late", "d0")), path, 8)
    assert ("b", "1", "w", "d2") in stored(spark, path)
    assert ("b", "9", "late", "d0") in stored(spark, path)
    # The same day again: the load at hand wins; of two in it the largest.
    merge_cells(cells(spark, ("b", "1", "a", "d2"), ("b", "1", "b", "d2")), path, 8)
    assert ("b", "1", "b", "d2") in stored(spark, path)


def test_loads_in_any_order_equal_one_load(spark, tmp_path):
    rows = [(f"u{i % 7}", str(i % 5), str(i), f"d{i % 3}") for i in range(200)]
    one = str(tmp_path / "one")
    merge_cells(cells(spark, *rows), one, 4)
    for order in ((0, 1, 2), (2, 0, 1)):
        path = str(tmp_path / f"many{order[0]}")
        for day in order:
            merge_cells(cells(spark, *[r for r in rows if r[3] == f"d{day}"]), path, 4)
            merge_cells(cells(spark, *[r for r in rows if r[3] == f"d{day}"]), path, 4)
        assert stored(spark, path) == stored(spark, one)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "cells")
    merge_cells(cells(spark, *[(f"u{i}", "1", "x", "d1") for i in range(100)]), path, 8)
    before = files(path)
    touched = merge_cells(cells(spark, ("u3", "1", "y", "d2")), path, 8)
    after = files(path)
    assert len(touched) == 1
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert changed == {f"bucket={touched[0]}"}
    assert merge_cells(cells(spark), path, 8) == []
    assert files(path) == after


def test_a_cut_off_merge_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cells")
    rows = [(f"u{i}", "1", "old", "d1") for i in range(40)]
    merge_cells(cells(spark, *rows), path, 4)
    before = stored(spark, path)
    fresh = [(f"u{i}", "1", "new", "d2") for i in range(40)]
    failing = cells(spark, *fresh).withColumn(
        "value",
        F.when(F.col("rowkey") == "u7", F.raise_error(F.lit("cut off"))).otherwise(F.col("value")).cast("string"),
    )
    with pytest.raises(Exception, match="cut off"):
        merge_cells(failing, path, 4)
    assert stored(spark, path) == before

    # Cut off between the buckets, with one of them set aside.
    put, calls = cell_store.put_in_place, []

    def some(spark, new, place):
        calls.append(place)
        if len(calls) == 2:
            Path(place).rename(Path(place).parent / f".{Path(place).name}.old-1")
            raise KeyboardInterrupt
        put(spark, new, place)

    monkeypatch.setattr(cell_store, "put_in_place", some)
    with pytest.raises(KeyboardInterrupt):
        merge_cells(cells(spark, *fresh), path, 4)
    monkeypatch.undo()
    merge_cells(cells(spark, *fresh), path, 4)
    assert stored(spark, path) == [(u, q, v, d) for u, q, v, d in sorted(fresh)]
    assert not [p for p in Path(path).iterdir() if ".old-" in p.name or p.name == ".merge"]


def test_a_table_keeps_its_number_of_buckets(spark, tmp_path):
    path = str(tmp_path / "cells")
    merge_cells(cells(spark, ("a", "1", "x", "d1")), path, 8)
    with pytest.raises(ValueError, match="8 buckets, not 4"):
        merge_cells(cells(spark, ("a", "1", "x", "d1")), path, 4)


def test_odd_cells(spark, tmp_path):
    path = str(tmp_path / "cells")
    odd = [("", "", "", None), ("é😀", "q", None, "d1"), ("a/b=c", "q" * 50_000, "v", "d1"), (None, None, "n", "d1")]
    merge_cells(cells(spark, *odd, *odd), path, 4)
    assert set(map(tuple, read_cells(spark, path).drop("family", "bucket").collect())) == set(odd)
    assert read_cells(spark, str(tmp_path / "nowhere")).count() == 0


@pytest.fixture(scope="module")
def wide_table(spark, tmp_path_factory):
    """400,000 cells of 20,000 users, one of whom has a third of them."""
    path = str(tmp_path_factory.mktemp("store") / "cells")
    rows = spark.range(400_000).select(
        F.expr("concat('userId:', if(id % 3 = 0, 0, id % 20000))").alias("rowkey"),
        F.lit("f").alias("family"),
        F.col("id").cast("string").alias("qualifier"),
        F.md5(F.col("id").cast("string")).alias("value"),
        F.lit("d1").alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as it is
    merge_cells(rows, path, 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return path


def test_a_lookup_finds_all_cells_of_its_keys(spark, wide_table):
    found = lookup(spark, wide_table, ["userId:7", "userId:none"], 4).collect()
    assert {int(r["qualifier"]) for r in found} == {
        i for i in range(400_000) if i % 3 and i % 20000 == 7
    }
    assert lookup(spark, wide_table, ["userId:0"], 4).count() == 133_334 + sum(
        1 for i in range(0, 400_000, 20_000) if i % 3
    )


def test_a_lookup_opens_one_bucket_and_few_row_groups(spark, wide_table):
    frame = lookup(spark, wide_table, ["userId:7"], 4)
    plan = plan_of(frame)
    assert re.search(r"PartitionFilters: \[[^]]*\(bucket#\d+ = \d\)", plan)
    assert "EqualTo(rowkey,userId:7)" in plan
    assert frame.select(F.input_file_name()).distinct().count() <= 1
    groups = hits = 0
    for file in Path(wide_table).glob("bucket=*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_row_groups):
            column = meta.row_group(i).column(0)
            assert column.path_in_schema == "rowkey"
            groups += 1
            hits += column.statistics.min <= "userId:7" <= column.statistics.max
    assert groups >= 16 and hits <= 4  # one of its bucket; others' ranges may span the key


def test_a_busy_user_spans_files(spark, wide_table):
    files = lookup(spark, wide_table, ["userId:0"], 4).select(F.input_file_name()).distinct()
    assert files.count() > 1
