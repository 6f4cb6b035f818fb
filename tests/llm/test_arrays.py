"""Arrays that tasks map into memory: seen whole, or an error."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest

from earshot.llm import arrays, lm, repeats


def test_a_folder_that_is_not_there_raises(spark, tmp_path, sf_dir):
    rows = lm.marked(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20))
    model = lm.learn(rows)
    assert lm.scored(rows, model).count() == 20
    elsewhere = replace(model, folder=str(tmp_path))
    with pytest.raises(Exception, match="the same on all machines"):
        lm.scored(rows, elsewhere).collect()
    rounds = repeats.Rounds(str(tmp_path), 1, {"gram": [3]})
    with pytest.raises(RuntimeError, match="the same on all machines"):
        rounds.repeated("gram", np.array([1], "<u8"))


def test_a_file_that_is_not_whole_raises(tmp_path):
    arrays.store(str(tmp_path), "x", 0, np.arange(4, dtype="<u8"))
    assert arrays.mapped(str(tmp_path), "x", 0, "<u8", 4).tolist() == [0, 1, 2, 3]
    arrays.store(str(tmp_path), "y", 0, np.arange(4, dtype="<u8"))
    with pytest.raises(RuntimeError, match="should hold 5 values"):
        arrays.mapped(str(tmp_path), "y", 0, "<u8", 5)
    assert not len(arrays.mapped(str(tmp_path), "none", 3, "<u8", 0))


def test_only_one_folder_stays_mapped(tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        arrays.store(str(tmp_path / name), "x", 0, np.arange(2, dtype="<u8"))
        arrays.mapped(str(tmp_path / name), "x", 0, "<u8", 2)
    assert list(arrays._MAPS) == [str(tmp_path / "b")]


def test_counts_of_pairs_pass_32_bits(tmp_path):
    arrays.store(str(tmp_path), "pair", 0, np.array([7, 9], "<u8"))
    arrays.store(str(tmp_path), "pair_count", 0, np.array([5_000_000_000, 1], "<u8"))
    model = lm.Model(str(tmp_path), 1, (0, 1), pair_sizes=(2,))
    assert model.of_pairs(np.array([9, 7, 8], np.uint64)).tolist() == [1, 5_000_000_000, 0]


def test_busy_words_are_the_frequent_ones(spark):
    rows = spark.createDataFrame([(i, False, "often " * 900 + f"w{i}") for i in range(20)],
                                 "doc_id bigint, held_out boolean, text string")
    model = lm.learn(rows)
    often = model.ids(lm.tokens([b"often"])[0][:1])
    assert list(model.busy) == often.tolist()
