"""Names, small texts and removals on whatever file system a path belongs to (Hadoop's public API).

Data is read and written by Spark; this is for the few things a commit needs besides: to list a folder, to
publish a small file only if no one else did, and to remove files by name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._sc = spark.sparkContext
        self._jvm = self._sc._jvm
        self._conf = self._sc._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def qualified(self, name: str = "") -> str:
        """The path as Spark names its files."""
        return self._fs.makeQualified(self._path(name)).toUri().toString()

    def names(self, folder: str) -> list[str]:
        """What stands in ``folder``, in order; nothing if there is no such folder."""
        at = self._path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def matching(self, pattern: str) -> list[str]:
        """The data files that a path or pattern names, as Spark would read them: qualified, in order."""
        found = self._fs.globStatus(self._jvm.org.apache.hadoop.fs.Path(pattern)) or []
        files = [x for f in found for x in (self._fs.listStatus(f.getPath()) if f.isDirectory() else [f])]
        return sorted(f.getPath().toString() for f in files if f.isFile() and not f.getPath().getName().startswith(("_", ".")))

    def first_line(self, path: str, most: int = 1 << 16) -> str:
        """The first line of a text file (unpacked, if its name says that it is packed), of at most ``most`` bytes."""
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        stream = self._fs.open(at)
        try:
            codec = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self._conf).getCodec(at)
            text = stream if codec is None else codec.createInputStream(stream)
            head = self._jvm.org.apache.commons.io.input.BoundedInputStream(text, most)
            lines = self._jvm.org.apache.commons.io.IOUtils.lineIterator(head, "UTF-8")
            return lines.next() if lines.hasNext() else ""
        finally:
            stream.close()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Writes ``name`` as a whole, or not at all if it is there already (False).

        It is written under another name first and renamed without overwriting, as Structured Streaming
        does with its own log: of two that publish the same name, one gets False."""
        hadoop = self._jvm.org.apache.hadoop.fs
        other = self._path(f"_publishing/{uuid.uuid4().hex}")
        stream = self._fs.create(other)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        to = self._path(name)
        self._fs.mkdirs(to.getParent())
        no_overwrite = self._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        no_overwrite[0] = getattr(hadoop, "Options$Rename").NONE
        context = hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(other), self._fs.makeQualified(to), no_overwrite)
            return True
        except Exception as e:
            self._fs.delete(other, False)
            if "FileAlreadyExistsException" in str(e):
                return False
            raise

    def replace(self, source: str, name: str) -> None:
        """Puts a copy of the file ``source`` at ``name``, over what stands there."""
        to = self._path(name)
        self._fs.mkdirs(to.getParent())
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, self._jvm.org.apache.hadoop.fs.Path(source), self._fs, to, False, True, self._conf)

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
