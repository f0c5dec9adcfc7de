"""Small files of a table's own bookkeeping, through the file system that Spark uses for the path."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Files:
    """Paths are below `root`. JSON files end with a line feed once they are whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._text = spark._jvm.org.apache.commons.io.IOUtils

    def at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, folder: str, folders: bool = False) -> list[str]:
        """Names in a folder that may not be there; folders: only those of folders."""
        if not self._fs.exists(self.at(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self.at(folder)) if s.isDirectory() or not folders]

    def numbers(self, folder: str) -> list[int]:
        """Numbers of a folder's files <number>.json, the greatest first."""
        return sorted((int(n[:-5]) for n in self.names(folder) if n.endswith(".json")), reverse=True)

    def read(self, name: str) -> dict | None:
        """A JSON file; None if it isn't there, or isn't whole (yet)."""
        if not self._fs.exists(self.at(name)):
            return None
        source = self._fs.open(self.at(name))
        try:
            text = self._text.toString(source, "UTF-8")
        finally:
            source.close()
        return json.loads(text) if text.endswith("\n") else None

    def create(self, name: str, value: dict) -> bool:
        """Write a JSON file that must not be there; False if it is."""
        try:
            out = self._fs.create(self.at(name), False)
        except Exception as e:
            if "exist" in str(e).lower():
                return False
            raise
        try:
            out.write(bytearray((json.dumps(value) + "\n").encode()))
        finally:
            out.close()
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)
