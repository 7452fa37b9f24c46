"""Normal forms under which keys and texts compare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ticker(c: Column | str) -> Column:
    """Trimmed of blanks and tabs, upper case; null stays null."""
    return F.upper(F.btrim(_col(c), F.lit(" \t")))


def group_name(c: Column | str) -> Column:
    """Trimmed of blanks and tabs, lower case."""
    return F.lower(F.btrim(_col(c), F.lit(" \t")))


def cik_digits(c: Column | str) -> Column:
    """The digits without leading zeros; null if there is no digit other than zero."""
    return F.nullif(F.regexp_replace(F.regexp_replace(_col(c), "[^0-9]", ""), "^0+", ""), F.lit(""))


def loose_text(c: Column | str) -> Column:
    """Letters and digits only, lower case: equal for texts that differ in case, spacing or punctuation; null if none is left."""
    return F.nullif(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def day(c: Column | str) -> Column:
    """Calendar day of a date or zone-less timestamp."""
    return _col(c).cast("date")


def iso(c: Column | str) -> Column:
    """A date as ``YYYY-MM-DD``."""
    return F.date_format(_col(c), "yyyy-MM-dd")
