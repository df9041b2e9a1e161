"""What a folder holds, as numbered manifests: readers go by the latest, and a new one appears as a whole or not at all.

A manifest is a folder of small tables. It is written beside the others under a name that readers do not look for, and
then renamed to the next number, which is a single step of the file system and fails if another writer was first.
Files that no manifest names yet are left-overs of a run that died; they are never read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

NAME = re.compile(r"v(\d{9})$")


class Conflict(RuntimeError):
    """Another writer published first; nothing of this run is visible."""


class Manifests:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path, f"{path}/_manifests"
        self.hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, text: str):
        return self.hadoop.Path(text)

    def _system(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """What lies in a folder; nothing if there is no such folder."""
        path = self._path(folder)
        system = self._system(path)
        return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []

    def delete(self, folder: str) -> None:
        path = self._path(folder)
        self._system(path).delete(path, True)

    def latest(self) -> int:
        """The number of the latest manifest, 0 if there is none."""
        numbers = [int(m[1]) for m in map(NAME.match, self.names(self.folder)) if m]
        return max(numbers, default=0)

    def table(self, name: str, number: int | None = None) -> DataFrame | None:
        """A table of the latest manifest, or of the one with that number; None if it has no such table."""
        number = self.latest() if number is None else number
        if not number:
            return None
        try:
            return self.spark.read.parquet(f"{self.folder}/v{number:09d}/{name}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def publish(self, tables: dict[str, DataFrame], after: int) -> int:
        """The tables as the manifest that follows number `after`."""
        waiting = f"{self.folder}/_new-{uuid.uuid4().hex}"
        for name, rows in tables.items():
            rows.write.parquet(f"{waiting}/{name}")
        self._rename(waiting, f"{self.folder}/v{after + 1:09d}")
        return after + 1

    def _rename(self, source: str, target: str) -> None:
        source, target = self._path(source), self._path(target)
        conf = self.spark._jsc.hadoopConfiguration()
        qualified = self._system(source).makeQualified(source)
        context = self.hadoop.FileContext.getFileContext(qualified.toUri(), conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        # Unlike FileSystem.rename this never moves into a folder that is there already.
        try:
            context.rename(qualified, self._system(target).makeQualified(target), none)
        except Exception as error:
            if "FileAlreadyExists" in str(error) or self._system(target).exists(target):
                raise Conflict(f"{target} was published by another writer") from error
            raise

    def forget(self, keep: int = 1) -> None:
        """Delete all but the last `keep` manifests, and what died before it was published."""
        found = self.names(self.folder)
        numbered = [n for n in found if NAME.match(n)]
        for name in [*numbered[: len(numbered) - keep], *(n for n in found if not NAME.match(n))]:
            self.delete(f"{self.folder}/{name}")
