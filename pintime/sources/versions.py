"""A log of versions beside a set of files: what belongs to a table, and who wrote last.

Files are written first, under names that no other attempt shares; a version then
becomes current by one small JSON file named after its number, made by a rename that
fails if the name is taken. So a writer that dies leaves nothing that a reader sees, and
of two writers that started from the same version the second is refused.
Everything goes through Spark's Hadoop file systems, so the folder may be any that Spark
can write.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionConflict(RuntimeError):
    """Another writer has committed since this one read."""


class Files:
    """The few file operations that Spark's readers and writers don't offer."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self.path(self.root).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at))

    def text(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """The file with this text, complete or not at all; refused if it is there."""
        whole, part = self.path(name), self.path(f"{name}.{uuid.uuid4().hex}.part")
        stream = self._fs.create(part, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        no_options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            fs.FileContext.getFileContext(whole.toUri(), self._conf).rename(
                part, whole, no_options)
        except Py4JJavaError as e:
            self._fs.delete(part, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise VersionConflict(f"{name} is taken") from None
            raise

    def delete(self, name: str) -> bool:
        """Delete a file or a folder with all it holds."""
        return self._fs.delete(self.path(name), True)


class VersionLog:
    """Numbered JSON entries in one folder; the highest number is current."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self.files = Files(spark, self.folder)

    def versions(self) -> list[int]:
        found = [re.fullmatch(r"([0-9]{12})\.json", n) for n in self.files.names(self.folder)]
        return [int(m[1]) for m in found if m]

    def read(self, version: int) -> dict:
        return json.loads(self.files.text(f"{self.folder}/{version:012d}.json"))

    def latest(self) -> tuple[int, dict] | None:
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else None

    def commit(self, version: int, entry: dict) -> None:
        """Make ``entry`` this version; ``VersionConflict`` if somebody else did."""
        self.files.create(f"{self.folder}/{version:012d}.json", json.dumps(entry))
