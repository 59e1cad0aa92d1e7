"""Targets of tables and their side files, on any file system the session knows."""

from __future__ import annotations

import json
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def resolve(target: str) -> str:
    """The path of a table: local paths as they are, ``s3://`` by the session's S3 file system. A bare bucket is refused."""
    if target.startswith(("s3://", "s3a://")):
        u = urlparse(target)
        if not u.netloc or not u.path.strip("/"):
            raise ValueError(f"{target} is the root of a bucket")
        return f"s3a://{u.netloc}/{u.path.strip('/')}"
    return target.rstrip("/") or "/"


class Folder:
    """A folder and its small files, by the session's file systems."""

    def __init__(self, spark: SparkSession, target: str):
        self.path = resolve(target)
        self._jvm = spark._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def exists(self, name: str | None = None) -> bool:
        return self._fs.exists(self._at(name) if name else self._root)

    def delete(self) -> None:
        self._fs.delete(self._root, True)

    def read(self, name: str) -> str:
        if not self.exists(name):
            raise FileNotFoundError(f"{self.path}/{name}")
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def read_json(self, name: str):
        return json.loads(self.read(name))

    def write_json(self, name: str, value) -> None:
        self.write(name, json.dumps(value, indent=4, ensure_ascii=False))

    def copy(self, name: str, other: Folder) -> None:
        """The very text of a side file to another folder."""
        other.write(name, self.read(name))


def decide(folder: Folder, marker: str, overwrite: bool, digest: str | None = None) -> bool:
    """Whether the table must be built.

    No folder: build. A marker written last tells a complete table: it is kept if its ``config_hash`` is ``digest`` (or none is asked
    for), else an error. A folder without marker is a build that broke off: an error. ``overwrite`` deletes what is there and builds.
    """
    if not folder.exists():
        return True
    if overwrite:
        folder.delete()
        return True
    if not folder.exists(marker):
        raise ValueError(f"{folder.path} is incomplete; overwrite it to build it again")
    if digest is not None and folder.read_json(marker).get("config_hash") != digest:
        raise ValueError(f"{folder.path} was built with other settings; overwrite it to build it again")
    return False
