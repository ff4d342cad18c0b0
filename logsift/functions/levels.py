"""Severity levels as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Levels from low to high, and the two other spellings that count.
LEVELS = ["TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL"]
ALIASES = {"WARNING": "WARN", "CRITICAL": "FATAL"}
#: OTLP severity numbers.
SEVERITY_NUMBER = {"TRACE": 1, "DEBUG": 5, "INFO": 9, "WARN": 13, "ERROR": 17, "FATAL": 21}


def normalize_level(level: Column) -> Column:
    """A level of LEVELS: null, empty and unknown spellings are INFO; case is ignored, blanks are not."""
    up = F.upper(level)
    out = F.when(up.isin(*LEVELS), up)
    for alias, name in ALIASES.items():
        out = out.when(up == alias, F.lit(name))
    return out.otherwise(F.lit("INFO"))


def level_rank(level: Column) -> Column:
    """0 to 5 in the order of LEVELS."""
    return (F.array_position(F.array(*map(F.lit, LEVELS)), normalize_level(level)) - 1).cast("int")


def level_name(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, LEVELS)), rank + 1)


def guess_level(line: Column) -> Column:
    """The first of FATAL, ERROR, WARN, DEBUG that the upper-cased line contains, else INFO."""
    up = F.upper(line)
    out = F.when(F.lit(False), F.lit(""))
    for name in ("FATAL", "ERROR", "WARN", "DEBUG"):
        out = out.when(F.contains(up, F.lit(name)), F.lit(name))
    return out.otherwise(F.lit("INFO"))
