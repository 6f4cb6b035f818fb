"""The physical plan of a frame as text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_of(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffle_keys(plan: str) -> list[str]:
    return re.findall(r"hashpartitioning\(([^)]*)\)", plan)
