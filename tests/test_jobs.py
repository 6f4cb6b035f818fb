from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from earshot.__main__ import main
from earshot.operators import als
from earshot.operators.evaluate import rmse
from earshot.params import AlsParams, JobParams, read_properties
from earshot.plans import jobs
from earshot.registered import standins
from earshot.schemas import LISTEN, RATING
from earshot.session import cluster_settings
from earshot.workspace import ensure_checkpoint_dir, shared_folder
from tests.plans import plan_of


def make_params(tmp_path, **changes) -> JobParams:
    return JobParams(storage_root=str(tmp_path), run_date=date(2024, 3, 1), **changes)


def put_lines(folder: str, *lines: str) -> None:
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / "part-00000").write_text("\n".join(lines) + "\n")


def wide(spark, path):
    """Cells by row key, from either form of table."""
    rows = spark.read.parquet(path)
    if "cells" in rows.columns:
        return {r["rowkey"]: r["cells"] for r in rows.collect()}
    found = {}
    for row in rows.collect():
        found.setdefault(row["rowkey"], {})[row["qualifier"]] = row["value"]
    return found


def test_train_then_recommend(spark, tmp_path, sf_dir):
    params = make_params(tmp_path, k=3)
    ratings = standins.ratings(spark, sf_dir)
    bad = spark.createDataFrame([("oops",), ("1|2|NaN",), ("1|2|1e99",)], "value string")
    standins.as_lines(ratings).unionByName(bad).write.text(params.ratings_path)

    report = jobs.train(spark, params)
    assert report.model_path.endswith("model/2024-02-29")
    assert report.bad_lines == 3
    assert sum(report.counts.values()) == ratings.count()
    assert 0 < report.n_eval <= report.counts["test"]
    assert report.n_cold + report.n_eval == report.counts["test"]
    assert report.rmse > 0
    reasons = {
        r["value"]: r["reason"]
        for r in jobs.read_quarantine(spark, params.parsed_path("rating"), RATING).collect()
    }
    assert reasons == {
        "oops": "too few fields",
        "1|2|NaN": "not a number",
        "1|2|1e99": "out of range",
    }

    validation = rmse(jobs.score_part(spark, params, "validation")).first()
    assert 0 < validation["n_eval"] <= report.counts["validation"]

    path = jobs.recommend(spark, params)
    rows = wide(spark, path)
    model = als.load(params.model_path)
    assert set(rows) == {f"userId:{r['id']}" for r in model.userFactors.collect()}
    assert all(len(c) == 3 for c in rows.values())
    jobs.recommend(spark, params)
    assert wide(spark, path) == rows


def test_training_reads_only_its_own_part(spark, tmp_path):
    params = make_params(tmp_path)
    put_lines(params.ratings_path, *(f"{u}|{i}|{u % 5}" for u in range(30) for i in range(20)))
    path = jobs.stage_parsed(spark, params.ratings_path, RATING, params, F.lit("train"))
    assert path == params.parsed_path("rating")
    plan = plan_of(jobs.read_part(spark, params, RATING, "train"))
    assert "PartitionFilters: [isnotnull(part" in plan
    assert "ReadSchema: struct<userId:int,sourceId:int,rating:float>" in plan


def test_all_cold_test_rows_give_no_rmse(spark, tmp_path):
    """Each pair is its own user and item, so no test pair is known."""
    params = make_params(tmp_path, als=AlsParams(max_iter=1))
    put_lines(params.ratings_path, *(f"{n}|{n}|1" for n in range(60)))
    report = jobs.train(spark, params)
    assert report.counts["test"] > 0
    assert report.n_eval == 0 and report.rmse is None


def test_training_on_nothing_is_an_error(spark, tmp_path):
    params = make_params(tmp_path)
    put_lines(params.ratings_path, "oops")
    with pytest.raises(ValueError, match="no training rows"):
        jobs.train(spark, params)


def test_count_loads_have_their_own_targets(spark, tmp_path):
    params = make_params(tmp_path)
    put_lines(params.listen_path, "1|10|3", "1|11|4", "2|10|5", "junk", "2|10|1.5")
    put_lines(params.sing_path, "1|7|2")
    listens, sings = jobs.load_listens(spark, params), jobs.load_sings(spark, params)
    assert (listens.good_lines, listens.bad_lines) == (3, 2)
    assert wide(spark, listens.table_path) == {
        "userId:1": {"10": "3", "11": "4"},
        "userId:2": {"10": "5"},
    }
    assert wide(spark, sings.table_path) == {"userId:1": {"7": "2"}}
    quarantine = jobs.read_quarantine(spark, params.parsed_path("listen"), LISTEN)
    assert {r["value"] for r in quarantine.collect()} == {"junk", "2|10|1.5"}

    put_lines(params.listen_path, "9|9|9")
    jobs.load_listens(spark, params)
    assert wide(spark, listens.table_path) == {"userId:9": {"9": "9"}}
    assert wide(spark, sings.table_path) == {"userId:1": {"7": "2"}}


def test_a_load_without_good_lines_empties_the_table(spark, tmp_path):
    params = make_params(tmp_path)
    put_lines(params.listen_path, "junk")
    report = jobs.load_listens(spark, params)
    assert (report.good_lines, report.bad_lines) == (0, 1)
    assert spark.read.parquet(report.table_path).isEmpty()


def test_missing_input_leaves_the_target_alone(spark, tmp_path):
    params = make_params(tmp_path)
    put_lines(params.listen_path, "1|10|3")
    path = jobs.load_listens(spark, params).table_path
    tomorrow = params.with_(run_date=date(2024, 3, 2))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.load_listens(spark, tomorrow)
    Path(tomorrow.listen_path).mkdir(parents=True)  # a folder without part files is no better
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.load_listens(spark, tomorrow)
    assert wide(spark, path) == {"userId:1": {"10": "3"}}


def test_fail_mode(spark, tmp_path):
    params = make_params(tmp_path, on_bad_line="fail")
    put_lines(params.listen_path, "1|2|3", "junk")
    with pytest.raises(Exception, match="bad line"):
        jobs.load_listens(spark, params)


def test_command_line(spark, tmp_path, monkeypatch, capfd):
    """The whole way from arguments to tables, in this session."""
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    params = make_params(tmp_path)
    put_lines(params.listen_path, "1|10|3", "2|10|5")
    properties = tmp_path / "job.properties"
    properties.write_text(f"# where\nhdfsUrl={tmp_path}\nsparkMaster=ignored\n")
    main(["load-listens", "--run-date", "2024-03-01", "--properties", str(properties), "--show"])
    assert "userId:1" in capfd.readouterr().out
    assert len(wide(spark, params.table_path("recommend_listen"))) == 2

    put_lines(params.ratings_path, *(f"{u}|{i}|{u % 5}" for u in range(30) for i in range(20)))
    main(["train", "--run-date", "2024-03-01", "--show", f"hdfsUrl={tmp_path}"])
    main(["recommend", "--run-date", "2024-03-01", f"hdfsUrl={tmp_path}", "recommendCount=2"])
    rows = wide(spark, params.table_path("recommend_als"))
    assert rows and all(len(c) == 2 for c in rows.values())


# -- parameters ---------------------------------------------------------------


def test_blank_names_mean_yesterday(tmp_path):
    params = make_params(tmp_path, listen_name="  ", sing_name="given.dat")
    assert params.listen_path == f"{tmp_path}/rcmd/listen/2024-02-29.dat"
    assert params.ratings_path == f"{tmp_path}/rcmd/rating/song/2024-02-29.dat"
    assert params.sing_path == f"{tmp_path}/rcmd/sing/given.dat"
    assert params.model_path == f"{tmp_path}/model/2024-02-29"
    assert make_params(tmp_path).with_(run_date=date(2024, 1, 1)).yesterday == "2023-12-31"


def test_properties_set_fields_and_unknown_ones_raise():
    text = "# job\nhdfsUrl = /data/\n\n! old\nrecommendCount=7\nsparkMaster=local\n"
    text += "als.rank=3\nals.nonnegative=False\nweights=0.5,0.2,0.3"
    params = JobParams.from_properties(read_properties(text), date(2024, 3, 1))
    assert (params.storage_root, params.k, params.weights) == ("/data/", 7, (0.5, 0.2, 0.3))
    assert params.als == AlsParams(rank=3, nonnegative=False)
    wrong = ("noSuchName=1", "als.noSuch=1", "als.rank=x", "weights=1", "run_date=2024-01-01")
    for bad in (*wrong, "recommendCount=many", "recommendCount=0"):
        with pytest.raises(ValueError):
            JobParams.from_properties(
                {"hdfsUrl": "/data", **read_properties(bad)}, date(2024, 3, 1)
            )
    with pytest.raises(ValueError):
        read_properties("noseparator")


def test_java_property_text():
    text = """! written by a job
hdfsUrl=hdfs\\://host\\:8020/
name: with spaces \\
   and a second line
empty=
tab\\tname=caf\\u00e9
key\\ one two
"""
    assert read_properties(text) == {
        "hdfsUrl": "hdfs://host:8020/",
        "name": "with spaces and a second line",
        "empty": "",
        "tab\tname": "café",
        "key one": "two",
    }


def test_two_days_stay_apart(spark, tmp_path):
    """The first day's model still meets its own test rows after the second day's training."""
    first = make_params(tmp_path, als=AlsParams(max_iter=2))
    second = first.with_(run_date=date(2024, 3, 2))
    put_lines(first.ratings_path, *(f"{u}|{i}|{u % 5}" for u in range(30) for i in range(20)))
    put_lines(second.ratings_path, *(f"{u}|{i}|1" for u in range(900, 930) for i in range(700, 720)))
    report = jobs.train(spark, first)
    jobs.train(spark, second)
    again = rmse(jobs.score_part(spark, first)).first()
    assert again["n_eval"] == report.n_eval > 0
    assert again["rmse"] == pytest.approx(report.rmse)


def test_tables_must_differ(tmp_path):
    with pytest.raises(ValueError, match="own target table"):
        make_params(tmp_path, sing_table="recommend_listen")


def test_cluster_settings_follow_the_input():
    small = cluster_settings(10**9, 8)
    large = cluster_settings(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert large["spark.sql.shuffle.partitions"] == "60000"
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 1_000_000_000
    assert large["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_the_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    if named:
        assert folder == named.rstrip("/")
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


class Unset:
    """A session that names no shared folder."""

    def __init__(self, master: str) -> None:
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, name: str, default: str | None) -> str | None:
        return default


def test_only_a_local_session_may_go_without_a_shared_folder():
    folder = shared_folder(Unset("local[2]"))
    assert Path(folder).is_dir() and shared_folder(Unset("local[4]")) == folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset("spark://somewhere:7077"))
