"""Small files through Hadoop's file systems, so that any store that Spark reads will do."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> bytes:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        """Write beside the target, under a name of its own, then rename: a reader sees the old file or the new one, whoever else writes."""
        fs, p = self._at(path)
        beside = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(beside, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        self._replace(fs, beside, p)

    def create(self, path: str, data: bytes) -> bool:
        """Write a file that is not there yet, whole; False if another writer has made it first."""
        fs, p = self._at(path)
        beside = f"{p.getParent()}/.{p.getName()}.{uuid.uuid4().hex}"
        self.write(beside, data)
        try:
            self._replace(fs, self._at(beside)[1], p, "NONE")
        except Py4JJavaError as e:
            self.delete(beside)
            if self.exists(path):
                return False
            raise e
        return True

    def _replace(self, fs, source, target, option: str = "OVERWRITE") -> None:
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        options = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = self._jvm.java.lang.Enum.valueOf(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), option)
        context.rename(source, target, options)

    def move(self, source: str, target: str) -> None:
        fs, a = self._at(source)
        _, b = self._at(target)
        fs.mkdirs(b.getParent())
        self._replace(fs, a, b)

    def list(self, path: str) -> list[tuple[str, int]]:
        """(path, bytes) of the files below path, sorted; none if it is not there."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        found, it = [], fs.listFiles(p, True)
        while it.hasNext():
            s = it.next()
            found.append((s.getPath().toString(), s.getLen()))
        return sorted(found)

    def names(self, path: str) -> list[str]:
        """Names of what lies directly in a folder, sorted; none if it is not there."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        if fs.exists(p):
            fs.delete(p, True)

    def digest(self, path: str) -> str:
        """SHA-256 of a file, read by the JVM and not held in memory."""
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()
