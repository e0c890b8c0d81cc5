from uuid import uuid4

from pyspark.sql import SparkSession


class Folder:
    """Small files and subfolders of a folder on any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def names(self, within: str = ".") -> list[str]:
        """Names of what lies in a subfolder, or in the folder itself; none if it is not there."""
        place = self._at(within)
        return [f.getPath().getName() for f in self._files.listStatus(place)] if self._files.exists(place) else []

    def read(self, name: str) -> str | None:
        """A small file, or None if there is none of that name."""
        if not self._files.exists(self._at(name)):
            return None
        stream = self._files.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write_once(self, name: str, text: str) -> str:
        """Write a file unless there is one of that name; what it then holds. Readers see a whole file or none."""
        if not self._files.exists(self._at(name)):
            draft = self._at(f"_draft-{uuid4().hex}")
            stream = self._files.create(draft, False)
            stream.write(bytearray(text.encode()))
            stream.close()
            self._files.mkdirs(self._at(name).getParent())
            if not self._files.rename(draft, self._at(name)):
                self._files.delete(draft, False)
        return self.read(name)

    def remove(self, name: str) -> None:
        self._files.delete(self._at(name), True)
