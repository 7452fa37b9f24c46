"""Screen files of high and low lists: names, pairs, lines."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The name that screen files are delivered under.
NAME = "all-us-exchanges-3-month-new-{side}s-{day:%m-%d-%Y}.csv"
_NAME = re.compile(r"3-month-new-(high|low)s-(\d{2}-\d{2}-\d{4})\.csv$", re.IGNORECASE)


def folder(given: str | None, mounted: str, usual: str) -> Path:
    """Where files of a feed lie: what is given, else the mounted folder if its parent is there, else the usual one under the working directory."""
    if given and given.strip():
        return Path(given.strip()).expanduser().resolve()
    return Path(mounted) if Path(mounted).parent.is_dir() else (Path.cwd() / usual).resolve()


def file_names(day: date) -> tuple[str, str]:
    """Names of the high and the low file of a day."""
    return NAME.format(side="high", day=day), NAME.format(side="low", day=day)


def side_and_day(name: str) -> tuple[str, date] | None:
    """What a file's name says, null for other files or dates that are none."""
    found = _NAME.search(name)
    try:
        return (found[1].lower(), datetime.strptime(found[2], "%m-%d-%Y").date()) if found else None
    except ValueError:
        return None


def pair(names: Iterable[str]) -> tuple[date, str, str]:
    """(day, high file, low file) of a folder's names: exactly one of each, of one day; else an error."""
    sides: dict[str, list[tuple[date, str]]] = {"high": [], "low": []}
    for name in names:
        if said := side_and_day(name):
            sides[said[0]].append((said[1], name))
    for side, found in sides.items():
        if len(found) != 1:
            raise ValueError(f"{len(found)} {side} files where one is expected")
    (d1, high), (d2, low) = sides["high"][0], sides["low"][0]
    if d1 != d2:
        raise ValueError(f"the high file is of {d1}, the low file of {d2}")
    return d1, high, low


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line_no, c0) of screen files, numbered from 1 within their file; a file is small and read whole."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("file_name"), "value")
    return text.select("file_name", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("p", "c0")).select("file_name", (F.col("p") + 1).alias("line_no"), "c0")
