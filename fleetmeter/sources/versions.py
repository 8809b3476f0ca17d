"""Tables kept in versions: each write is a new one, and readers see it once it is complete.

A version is a folder under ``versions``. It counts from the moment its pointer exists, an empty
file under ``pointers`` that is made last, in one step. A write that fails, or an executor that is
lost, leaves a folder nobody points to: readers go on with the version before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class VersionConflict(RuntimeError):
    """Another writer committed the same version first."""


class Versions:
    """The versions of one table under ``root``, oldest first."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """Committed versions. Of two with one number the first name counts."""
        folder = self._path(f"{self.root}/pointers")
        if not self._fs.exists(folder):
            return []
        found: dict[str, str] = {}
        for name in sorted(status.getPath().getName() for status in self._fs.listStatus(folder)):
            found.setdefault(name.split("-")[0], name)
        return [found[number] for number in sorted(found)]

    def folder(self, name: str) -> str:
        return f"{self.root}/versions/{name}"

    def current(self) -> str | None:
        """Folder of the newest version, or none."""
        names = self.names()
        return self.folder(names[-1]) if names else None

    def commit(self, write: Callable[[str], object]) -> str:
        """Let ``write`` fill the folder of a new version, then point to it."""
        names = self.names()
        number = int(names[-1].split("-")[0]) + 1 if names else 1
        name = f"{number:012d}-{uuid.uuid4().hex}"
        write(self.folder(name))
        pointer = self._path(f"{self.root}/pointers/{name}")
        self._fs.createNewFile(pointer)
        if self.names()[number - 1 - self._first()] != name:
            self._fs.delete(pointer, False)
            raise VersionConflict(f"version {number} of {self.root} was written by another job")
        return self.folder(name)

    def _first(self) -> int:
        """How many numbers before the oldest version that is kept."""
        return int(self.names()[0].split("-")[0]) - 1

    def keep(self, newest: int) -> None:
        """Delete all but the ``newest`` versions: pointers first, so that no reader starts on them."""
        for name in self.names()[: -newest or None]:
            self._fs.delete(self._path(f"{self.root}/pointers/{name}"), False)
            self._fs.delete(self._path(self.folder(name)), True)
