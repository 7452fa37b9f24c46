"""A table on shared storage as immutable version folders and numbered pointers to them.

Writers put a new version beside the old one and then publish it by a pointer file of the next number. A pointer is written under another name and renamed,
so it is there whole or not at all; the version in use is the one that the highest pointer names. Nothing is overwritten and nothing is deleted on the way:
a job that dies at any moment leaves the version before in use. Old pointers and versions stay until ``prune``.

A version may consist of parts (one folder per key range); ``write_parts`` writes only the parts that changed and takes over the others by name.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_POINTER = re.compile(r"pointer-(\d{12})\.json")


class Versions:
    """Versions of one table under ``folder``, which all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # --- files -------------------------------------------------------------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}" if name else self.folder

    def _at(self, name: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self) -> list[str]:
        fs, at = self._at("")
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def _text(self, name: str) -> str:
        fs, at = self._at(name)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    # --- pointers ----------------------------------------------------------------------------------------------------------------

    def _pointers(self) -> list[int]:
        return sorted(int(m[1]) for n in self._names() if (m := _POINTER.fullmatch(n)))

    def _said(self, number: int) -> dict:
        return json.loads(self._text(f"pointer-{number:012d}.json"))

    def entry(self) -> dict:
        """What the highest pointer says: ``name`` of the version, its ``parts`` if it has any, and what was published with it; empty if there is none."""
        numbers = self._pointers()
        return self._said(numbers[-1]) if numbers else {}

    def current(self) -> str | None:
        """Name of the version in use."""
        return self.entry().get("name")

    def use(self, name: str, **more: object) -> None:
        """Publishes a finished version. Two writers can't publish the same number: the later one fails and the table stays as the first left it."""
        number = (self._pointers() or [0])[-1] + 1
        fs, hidden = self._at(f".pointer-{uuid.uuid4().hex}")
        out = fs.create(hidden, False)
        out.write(bytearray(json.dumps({"name": name, **more}).encode()))
        out.close()
        _, at = self._at(f"pointer-{number:012d}.json")
        if fs.exists(at) or not fs.rename(hidden, at):
            fs.delete(hidden, False)
            raise RuntimeError(f"pointer {number} of {self.folder} was published by another writer")

    # --- versions ----------------------------------------------------------------------------------------------------------------

    def read(self, name: str | None = None) -> DataFrame | None:
        """A version, or the one in use with all its parts; null if there is none."""
        if name is not None:
            return self.spark.read.parquet(self.path(name))
        said = self.entry()
        if not said:
            return None
        if "parts" not in said:
            return self.spark.read.parquet(self.path(said["name"]))
        return self.read_parts(sorted(said["parts"], key=int))

    def read_parts(self, parts: list[str]) -> DataFrame | None:
        """Some parts of the version in use; null if it has none of them."""
        known = self.entry().get("parts", {})
        folders = [self.path(known[p]) for p in parts if p in known]
        return self.spark.read.parquet(*folders) if folders else None

    def write(self, df: DataFrame, name: str | None = None) -> str:
        """Writes a version without using it yet; a version of that name that was left half written is replaced."""
        name = name or f"v-{uuid.uuid4().hex}"
        if name == self.current():
            raise ValueError(f"{name} is in use")
        df.write.mode("overwrite").parquet(self.path(name))
        return name

    def write_parts(self, df: DataFrame, part: str, name: str, touched: list[str]) -> dict[str, str]:
        """Writes the ``touched`` parts of a version, split by the column ``part``, and returns where all parts of it lie; those not touched are taken over."""
        if name == self.current():
            raise ValueError(f"{name} is in use")
        df.write.mode("overwrite").partitionBy(part).parquet(self.path(name))
        return self.entry().get("parts", {}) | {p: f"{name}/{part}={p}" for p in touched}

    def prune(self, keep: int = 1) -> int:
        """Removes the versions that none of the last ``keep`` pointers needs, and older pointers; returns how many versions went. Readers of older versions
        must have ended."""
        numbers = self._pointers()
        needed: set[str] = set()
        for number in numbers[-keep:]:
            said = self._said(number)
            needed |= {said["name"]} | {folder.split("/")[0] for folder in said.get("parts", {}).values()}
        gone = 0
        for name in self._names():
            fs, at = self._at(name)
            if name.startswith("v-") and name not in needed and numbers:
                fs.delete(at, True)
                gone += 1
            elif (m := _POINTER.fullmatch(name)) and int(m[1]) not in numbers[-keep:]:
                fs.delete(at, False)
        return gone

