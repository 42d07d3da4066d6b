"""Small files and renames in any file system that Spark reaches."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str):
        hadoop = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self._conf), hadoop

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return bool(fs.exists(at))

    def names(self, path: str) -> list[str]:
        fs, at = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def below(self, path: str, limit: int | None = None) -> list[str]:
        """Data files below a folder, as paths relative to it; files and folders that Spark skips are left out."""
        fs, at = self._at(path)
        base, found = f"{fs.makeQualified(at).toUri().getPath()}/", []
        listed = fs.listFiles(at, True)
        while listed.hasNext() and (limit is None or len(found) < limit):
            name = listed.next().getPath().toUri().getPath().removeprefix(base)
            if not any(part.startswith(".") or part.startswith("_") and "=" not in part for part in name.split("/")):
                found.append(name)
        return sorted(found)

    def decoded(self, uri: str) -> str:
        """The path in a URI, as names in the file system."""
        return self._jvm.java.net.URI(uri).getPath()

    def read_json(self, path: str) -> Any:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write_json(self, path: str, value: Any, new: bool = False) -> bool:
        """Write beside the path, then rename, so readers see the old file or the new one; with new, False if the path exists already."""
        fs, at = self._at(path)
        beside = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{self._jvm.java.util.UUID.randomUUID()}.tmp")
        stream = fs.create(beside, True)
        stream.write(bytearray(json.dumps(value, ensure_ascii=False, sort_keys=True).encode()))
        stream.close()
        if new:
            if not fs.exists(at) and fs.rename(beside, at):
                return True
            fs.delete(beside, False)
            return False
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(kinds, 1)
        options[0] = kinds.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(fs.makeQualified(beside), fs.makeQualified(at), options)
        return True

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)
