"""Cells of text tables: integer lists, booleans, names."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_list(cell: Column) -> Column:
    """``[1, 2, 3]`` text as an array; anything else is an empty list.

    Tuples and whole-number floats are accepted like their list forms.
    """
    text = F.regexp_replace(F.trim(cell), r"^\((.*?),?\)$", "[$1]")
    whole = F.from_json(text, "array<double>")
    clean = whole.isNotNull() & ~F.exists(whole, lambda v: v.isNull())
    return F.when(clean, F.transform(whole, lambda v: v.cast("bigint"))).otherwise(
        F.array().cast("array<bigint>"))


def bool_cell(cell: Column) -> Column:
    """true/1/yes and non-zero numbers are true; NULL and the rest are false."""
    text = F.lower(F.trim(cell))
    number = text.try_cast("double")
    return F.coalesce(text.isin("true", "1", "yes") | (number.isNotNull() & ~F.isnan(number) & (number != 0)),
                      F.lit(False))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def first_number(name: Column, which: str = "first") -> Column:
    """An integer in a file name: its first or last run of digits."""
    runs = F.regexp_extract_all(file_name(name), F.lit(r"(\d+)"))
    return F.element_at(F.when(F.size(runs) > 0, runs), 1 if which == "first" else -1).try_cast("bigint")


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")
