"""Small files of a job's own state, through the file system that a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """A few operations on the file system of a root folder, by the driver, on small files only."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        conf = spark._jsc.hadoopConfiguration()
        # an instance of its own, without checksum files beside its small ones on a local disk
        self._fs = self._jvm.org.apache.hadoop.fs.FileSystem.newInstance(self._path("").toUri(), conf)
        self._fs.setWriteChecksum(False)
        self._fs.setVerifyChecksum(False)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(self._path("")).toUri(), conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, in order; none if there is no such folder."""
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, written: str, name: str) -> bool:
        """Move a complete file to its name in one step; False if that name is taken. Nobody sees half a file."""
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        self._fs.mkdirs(self._path(name).getParent())
        try:
            self._context.rename(self._path(written), self._path(name), options)
        except Exception as e:
            if "FileAlreadyExistsException" in str(getattr(e, "java_exception", e)):
                return False
            raise
        return True
