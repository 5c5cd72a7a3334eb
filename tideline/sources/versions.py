"""Folders whose content is replaced by one commit, and markers that are set once.

A replaced table keeps its data in ``_versions/<number>-<id>`` and names the live one in ``_commits/<number>``. A commit
file is created exclusively: of two writers that started from the same version one wins, the other gets an error. A
commit file without content belongs to a writer that died and does not count. Readers see the old rows or the new ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

COMMITS, VERSIONS = "_commits", "_versions"


class Folder:
    """Files below a path, through Hadoop's file systems (local, HDFS, object stores)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self._path = spark, root.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(self.at(name)))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.at(name)))) if self.exists(name) else []

    def create(self, name: str, text: str) -> bool:
        """Write a new small file; False when it is there already."""
        path = self._path(self.at(name))
        if self._fs.exists(path):
            return False
        try:
            out = self._fs.create(path, False)
        except Exception as error:
            if "already exists" in str(error):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(self.at(name)))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(self.at(name)), True)

    def files(self, name: str) -> list[str]:
        """Data files below ``name``, relative to it."""
        base = self._path(self.at(name))
        found, each = [], self._fs.listFiles(base, True)
        prefix = self._fs.makeQualified(base).toString() + "/"
        while each.hasNext():
            path = each.next().getPath().toString()
            if not path.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append(path.removeprefix(prefix))
        return sorted(found)

    def move(self, name: str, target: str) -> None:
        path = self._path(target)
        self._fs.mkdirs(path.getParent())
        if not self._fs.rename(self._path(self.at(name)), path):
            raise OSError(f"cannot move {self.at(name)} to {target}")


def _commits(folder: Folder) -> list[str]:
    return [n for n in folder.names(COMMITS) if n.isdigit()]


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the live rows: the newest committed version, or ``path`` itself."""
    folder = Folder(spark, path)
    for number in reversed(_commits(folder)):
        named = folder.read(f"{COMMITS}/{number}")
        if named:
            return folder.at(f"{VERSIONS}/{named}")
    return folder.root


class Replacement:
    """A new version in the making: write to ``path``, then ``commit``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.folder = Folder(spark, path)
        self.number = f"{max(map(int, _commits(self.folder)), default=0) + 1:08d}"
        self.name = f"{self.number}-{uuid.uuid4().hex[:12]}"
        self.path = self.folder.at(f"{VERSIONS}/{self.name}")

    def commit(self) -> None:
        """Make the version the live one, unless another writer has committed since this one began."""
        if not self.folder.create(f"{COMMITS}/{self.number}", self.name):
            self.folder.delete(f"{VERSIONS}/{self.name}")
            raise RuntimeError(f"{self.folder.root} was replaced by another writer meanwhile")
        live = {self.name, *[self.folder.read(f"{COMMITS}/{n}") for n in _commits(self.folder)[-2:]]}
        for old in self.folder.names(VERSIONS):
            # Readers of the version before may still be at work; what is older goes.
            if old not in live and old.split("-")[0] < self.number:
                self.folder.delete(f"{VERSIONS}/{old}")


class Journal:
    """Steps of a run that are done, each a marker file; a run that failed goes on after its last one."""

    def __init__(self, spark: SparkSession, path: str, run: str) -> None:
        self.folder, self.run = Folder(spark, path), run

    def done(self, step: str) -> bool:
        return self.folder.exists(f"{self.run}/{step}")

    def mark(self, step: str, text: str = "done") -> None:
        self.folder.create(f"{self.run}/{step}", text)

    def clear(self) -> None:
        self.folder.delete(self.run)
