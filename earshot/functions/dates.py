"""Dated input names: the rule that jobs use, as column expressions and for the driver."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as blank around a name.
BLANK = " \t\n\x0b\f\r"


def yesterday(run_date: Column) -> Column:
    return F.date_format(F.date_sub(run_date, 1), "yyyy-MM-dd")


def input_name(name: Column, run_date: Column) -> Column:
    """The given name, or yesterday's ``.dat`` when it is blank or missing."""
    given = F.nullif(F.btrim(name, F.lit(BLANK)), F.lit(""))
    return F.coalesce(given, F.concat(yesterday(run_date), F.lit(".dat")))


# The same two for job parameters, which are known before there is a session; a test holds
# them against the columns.


def yesterday_text(run_date: date) -> str:
    return (run_date - timedelta(days=1)).isoformat()


def dated_input_name(name: str | None, run_date: date) -> str:
    return (name or "").strip(BLANK) or f"{yesterday_text(run_date)}.dat"
