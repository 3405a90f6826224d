"""Text predicates and the line parsers of classifier answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_SPACE = r"^\s+|\s+$"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def separators(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))


def all_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def parts(line: Column) -> Column:
    return F.transform(F.split(line, r"\|"), strip)


def blank_to_null(text: Column, tokens: Sequence[str]) -> Column:
    return F.when(~text.isin(list(tokens)), text)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]*)$", 1))
