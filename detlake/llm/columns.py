"""Column helpers for text operators: values named once inside an expression, and words as arrays. JVM only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def words(text: Column, breaks: str = SPACES) -> Column:
    return F.filter(F.split(text, breaks), lambda w: w != "")


def starts(n: Column, size: int) -> Column:
    """0, 1, ... up to the last start of `size` words among n; empty if there are fewer."""
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
