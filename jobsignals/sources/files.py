"""Small text files of a table's log, on any file system that Spark can reach."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of small files that the driver reads and writes through Hadoop."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self._gateway, self.path = spark._jvm, spark.sparkContext._gateway, path.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._at().getFileSystem(self._conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, sub: str = "") -> dict[str, int]:
        """Names in the folder and when they were changed (milliseconds); none if it is missing."""
        try:
            found = self._files.listStatus(self._at(sub))
        except Py4JJavaError as error:
            if "FileNotFoundException" in str(error.java_exception):
                return {}
            raise
        return {f.getPath().getName(): f.getModificationTime() for f in found}

    def text(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one of this name already. Others see the
        whole file or none: it is written aside and then given its name, which both a
        hard link (local files) and a rename refuse if the name is taken."""
        aside, target = self._at(f".{uuid.uuid4().hex}"), self._at(name)
        out = self._files.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._files.getUri().getScheme() == "file":
                local = [self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, aside)]
                self._jvm.java.nio.file.Files.createLink(*local)
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
                rename = self._jvm.org.apache.hadoop.fs.Options.Rename
                options = self._gateway.new_array(rename, 1)
                options[0] = rename.NONE
                context.rename(aside, target, options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            return False
        finally:
            self._files.delete(aside, False)
        return True

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)

