from __future__ import annotations

import random
import re
import struct

import pytest

from earshot.schemas import LISTEN, RATING, SING
from earshot.sources.parse import classify, parse, quarantine
from earshot.sources.text_files import scan_lines
from tests.plans import plan_of

# line -> the parsed row, or the reason it is set aside
COUNT_CASES = {
    "1|2|3": (1, 2, 3),
    "1|2": "too few fields",
    "x|2|3": "not a number",
    "1|2|3|9": (1, 2, 3),
    " 7|2|3": "not a number",
    "1|2|1.5": "not a number",
    "": "too few fields",
    "123": "too few fields",
    "1|2|": "not a number",
    "||": "not a number",
    "-4|+5|007": (-4, 5, 7),
    "2147483647|-2147483648|0": (2147483647, -2147483648, 0),
    "2147483648|2|3": "out of range",
    "1|99999999999999999999|3": "out of range",
    "1|2|3\n": "not a number",
    "1|2|3\r": "not a number",
    "1|2|1_0": "not a number",
    "1,2,3": "too few fields",
}
RATING_CASES = {
    "1|2|3": (1, 2, 3.0),
    "1|2|.5": (1, 2, 0.5),
    "1|2|-4.": (1, 2, -4.0),
    "1|2|1e-3": (1, 2, 0.001),
    "1|2|NaN": "not a number",
    "1|2|Infinity": "not a number",
    "1|2|1.5f": "not a number",
    "1|2|0x1p3": "not a number",
    "1|2|1_0": "not a number",
    "1|2|1e99": "out of range",
    "1|2|-1e99": "out of range",
    "1|2| 3": "not a number",
    "1|2": "too few fields",
    "1.0|2|3": "not a number",
}


@pytest.mark.parametrize(
    ("record", "cases"), [(LISTEN, COUNT_CASES), (SING, COUNT_CASES), (RATING, RATING_CASES)]
)
def test_literal_lines(spark, record, cases):
    lines = spark.createDataFrame([(line,) for line in cases], "value string")
    found = {
        r["value"]: r["reason"] or tuple(r[c] for c in record.columns)
        for r in classify(lines, record).collect()
    }
    for line, wanted in cases.items():
        if isinstance(wanted, tuple):
            assert found[line] == pytest.approx(wanted), line
        else:
            assert found[line] == wanted, line
    n_bad = sum(isinstance(w, str) for w in cases.values())
    assert parse(lines, record).count() == len(cases) - n_bad
    assert quarantine(lines, record).count() == n_bad


def test_schema_is_fixed(spark):
    lines = spark.createDataFrame([("1|2|3",)], "value string")
    for record in (RATING, LISTEN, SING):
        fields = [(f.name, f.dataType) for f in parse(lines, record).schema]
        assert fields == [(f.name, f.dataType) for f in record.schema]


def test_fail_mode_stops_at_a_bad_line(spark):
    good = spark.createDataFrame([("1|2|3",), ("4|5|6",)], "value string")
    assert parse(good, LISTEN, on_bad_line="fail").count() == 2
    bad = good.union(spark.createDataFrame([("oops",)], "value string"))
    with pytest.raises(Exception, match="bad line, too few fields: oops"):
        parse(bad, LISTEN, on_bad_line="fail").collect()


def test_scan_reads_only_part_files(spark, tmp_path):
    (tmp_path / "part-00000").write_text("1|2|3\r\n4|5|6\n")
    (tmp_path / "part-00001").write_text("7|8|9")
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "notes.txt").write_text("0|0|0\n")
    rows = {tuple(r) for r in parse(scan_lines(spark, str(tmp_path)), LISTEN).collect()}
    assert rows == {(1, 2, 3), (4, 5, 6), (7, 8, 9)}


def test_each_line_is_parsed_once(spark):
    """The filter on the outcome must not pull the number parsing below itself."""
    lines = spark.createDataFrame([("1|2|3",)], "value string")
    plan = plan_of(parse(lines, LISTEN))
    assert plan.count("try_cast") == len(LISTEN.columns)
    assert plan.count("split(") == 1
    assert "Exchange" not in plan and "Python" not in plan


INT = re.compile(r"[+-]?[0-9]+")
FLOAT = re.compile(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?")


def expected(line, third):
    """The rules of the parse, spelt out for one line."""
    fields = line.split("|")
    if len(fields) < 3:
        return "too few fields"
    patterns = (INT, INT, FLOAT if third is float else INT)
    if not all(p.fullmatch(f) for p, f in zip(patterns, fields, strict=False)):
        return "not a number"
    numbers = [int(fields[0]), int(fields[1]), third(fields[2])]
    fits = [abs(n + 0.5) < 2**31 for n in numbers[: 2 if third is float else 3]]
    if third is float:
        try:
            numbers[2] = struct.unpack("f", struct.pack("f", numbers[2]))[0]
        except OverflowError:
            fits.append(False)
        else:
            fits.append(abs(numbers[2]) != float("inf"))
    return tuple(numbers) if all(fits) else "out of range"


@pytest.mark.parametrize(("record", "third"), [(LISTEN, int), (RATING, float)])
def test_random_lines(spark, record, third):
    rng = random.Random(12)
    pieces = "1,23,2147483648,+4,-5,0.5,.,e,1e3,9e40, ,\t,x,".split(",")
    lines = set()
    while len(lines) < 3000:
        n_fields = rng.choice([2, 3, 3, 3, 4])
        fields = (rng.choices(pieces, k=rng.choice([1, 1, 1, 2])) for _ in range(n_fields))
        lines.add("|".join("".join(field) for field in fields))
    frame = spark.createDataFrame([(line,) for line in sorted(lines)], "value string")
    outcomes = set()
    for row in classify(frame, record).collect():
        got = row["reason"] or tuple(row[c] for c in record.columns)
        wanted = expected(row["value"], third)
        assert got == (wanted if isinstance(wanted, str) else pytest.approx(wanted)), row["value"]
        outcomes.add(wanted if isinstance(wanted, str) else "good")
    assert outcomes == {"too few fields", "not a number", "out of range", "good"}
