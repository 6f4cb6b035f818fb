"""Loads of the days that are not loaded yet."""

from __future__ import annotations

from datetime import date

import pytest

from earshot.__main__ import main
from earshot.functions.dates import dated_input_name, input_name
from earshot.params import JobParams
from earshot.plans import jobs
from earshot.schemas import LISTEN
from earshot.sinks.cell_store import read_cells
from earshot.sources.ledger import days_to_load, read_ledger
from tests.test_jobs import put_lines


@pytest.fixture
def params(tmp_path):
    return JobParams(storage_root=str(tmp_path), run_date=date(2024, 3, 9))


def put_day(params, day, *lines):
    put_lines(f"{params.dated_folder('listen')}/{day}.dat", *lines)


def cells(spark, params):
    rows = read_cells(spark, params.cells_path(params.listen_table)).collect()
    return {(r["rowkey"], r["qualifier"]): (r["value"], r["day"]) for r in rows}


def ledger(spark, params):
    return {tuple(r) for r in read_ledger(spark, params.ledger_path(params.listen_table)).collect()}


def test_each_day_is_loaded_once(spark, params, tmp_path):
    put_day(params, "2024-03-01", "1|10|3", "1|11|4", "oops", "1|11|2")
    put_day(params, "2024-03-03", "1|10|9", "2|10|1")
    (tmp_path / "rcmd" / "listen" / "2024-03-04.dat").mkdir()  # no files yet
    (tmp_path / "rcmd" / "listen" / "notes").mkdir()
    report = jobs.load_new_listens(spark, params)
    assert report.days == ("2024-03-01", "2024-03-03")
    assert (report.good_lines, report.bad_lines) == (5, 1)
    assert ledger(spark, params) == {("2024-03-01", 3, 1), ("2024-03-03", 2, 0)}
    assert cells(spark, params) == {
        ("userId:1", "10"): ("9", "2024-03-03"),
        ("userId:1", "11"): ("4", "2024-03-01"),
        ("userId:2", "10"): ("1", "2024-03-03"),
    }
    assert jobs.load_new_listens(spark, params).days == ()

    put_day(params, "2024-03-02", "1|10|5", "1|12|6")  # a late day, older than a cell it names
    put_day(params, "2024-03-04", "2|10|7")
    assert jobs.load_new_listens(spark, params).days == ("2024-03-02", "2024-03-04")
    assert cells(spark, params) == {
        ("userId:1", "10"): ("9", "2024-03-03"),
        ("userId:1", "11"): ("4", "2024-03-01"),
        ("userId:1", "12"): ("6", "2024-03-02"),
        ("userId:2", "10"): ("7", "2024-03-04"),
    }
    found = jobs.cells_of(spark, params, params.listen_table, [2, 77]).collect()
    assert [(r["rowkey"], r["value"]) for r in found] == [("userId:2", "7")]
    bad = jobs.read_days(spark, params.days_path("listen"), LISTEN).where("part = 'bad'").collect()
    assert [(r["day"], r["line"], r["reason"]) for r in bad] == [("2024-03-01", "oops", "too few fields")]


def test_a_run_cut_off_before_the_ledger_is_done_again(spark, params, monkeypatch):
    put_day(params, "2024-03-01", "1|10|3")
    monkeypatch.setattr(jobs, "enter", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        jobs.load_new_listens(spark, params)
    monkeypatch.undo()
    before = cells(spark, params)
    assert jobs.load_new_listens(spark, params).days == ("2024-03-01",)
    assert cells(spark, params) == before == {("userId:1", "10"): ("3", "2024-03-01")}
    assert len(ledger(spark, params)) == 1


def test_a_day_of_bad_lines_alone_and_no_days(spark, params):
    assert jobs.load_new_sings(spark, params).days == ()
    put_day(params, "2024-03-01", "x|y|z")
    report = jobs.load_new_listens(spark, params)
    assert (report.good_lines, report.bad_lines, report.days) == (0, 1, ("2024-03-01",))
    assert cells(spark, params) == {} and ledger(spark, params) == {("2024-03-01", 0, 1)}
    left = days_to_load(spark, params.dated_folder("listen"), params.ledger_path(params.listen_table))
    assert left.isEmpty()


def test_dated_names_are_the_same_on_the_driver(spark):
    names = [None, "", "  ", "\t\n", "x.dat", " x y \r\n", " ", "　z"]
    days = [date(2024, 3, 1), date(2024, 1, 1), date(1969, 12, 31), date(2000, 2, 29)]
    rows = spark.createDataFrame([(n, d) for n in names for d in days], "name string, day date")
    found = rows.select("name", "day", input_name(rows["name"], rows["day"]).alias("input")).collect()
    for row in found:
        assert row["input"] == dated_input_name(row["name"], row["day"]), row


def test_from_the_command_line(spark, params, tmp_path, capsys, monkeypatch):
    from pyspark.sql import SparkSession

    put_day(params, "2024-03-01", "1|10|3")
    monkeypatch.setattr(SparkSession, "stop", lambda self: None)
    main(["load-new-listens", "--run-date", "2024-03-09", "--show", f"hdfsUrl={tmp_path}"])
    assert "userId:1" in capsys.readouterr().out
