"""Numbered commits that many writers may add to, one after the other.

A commit is one small file named by its number. It is written beside and renamed, which fails where the number is
taken: then somebody else was faster, and the writer looks at what they did and tries the next number. Every commit
says what came of it as a whole, so a reader lists one folder and opens one file.

The file system's rename must refuse an existing target, as that of a cluster does. Local files need the lock of this
process as well.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from lakesift.session import names_in

_LOCAL = threading.Lock()
_DIGITS = 12
_SUFFIX = ".json"


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    path: str

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _name(self, number: int) -> str:
        return f"{self.path.rstrip('/')}/{number:0{_DIGITS}d}{_SUFFIX}"

    def last(self) -> int:
        """Number of the newest commit; 0 before the first."""
        names = [n.removesuffix(_SUFFIX) for n in names_in(self.spark, self.path) if n.endswith(_SUFFIX)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def read(self, number: int) -> dict[str, Any]:
        path, files = self._files()
        stream = files.open(path(self._name(number)))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def head(self) -> dict[str, Any]:
        """The newest commit; an empty one before the first."""
        number = self.last()
        return self.read(number) if number else {}

    def try_add(self, number: int, commit: dict[str, Any]) -> bool:
        """Write a commit unless its number is taken."""
        path, files = self._files()
        target, beside = path(self._name(number)), path(f"{self.path.rstrip('/')}/.{uuid.uuid4().hex}")
        stream = files.create(beside, False)
        try:
            stream.write(bytearray(json.dumps(commit).encode()))
        finally:
            stream.close()
        with _LOCAL:
            done = not files.exists(target) and files.rename(beside, target)
        if not done:
            files.delete(beside, False)
        return bool(done)

    def add(self, make: Callable[[dict[str, Any]], dict[str, Any]]) -> dict[str, Any]:
        """Add the commit that ``make`` returns for the one before; it is asked again if another came first."""
        while True:
            number = self.last()
            commit = make(self.read(number) if number else {})
            if self.try_add(number + 1, commit):
                return commit
