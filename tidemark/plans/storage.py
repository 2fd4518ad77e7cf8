"""Files of the cluster's shared storage, through Hadoop's file systems."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a cluster is
    refused, as its executors would not see the driver's files.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


class Files:
    """Small files and folders under any path that Spark can read."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def names(self, path: str) -> list[str]:
        fs, at = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def text(self, path: str) -> str:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """A new file, whole or not at all; an error if there is one already."""
        fs, at = self._at(path)
        _, draft = self._at(f"{path}.draft")
        stream = fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(at) or not fs.rename(draft, at):
            raise FileExistsError(path)

    def drop(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def move(self, path: str, to: str) -> None:
        fs, at = self._at(path)
        if not fs.rename(at, self._at(to)[1]):
            raise FileExistsError(to)
