"""The few file-system calls a job needs besides Spark's readers and writers.

They go through Hadoop's ``FileSystem`` so they work wherever Spark can read.
Only names and sizes pass through here, and small texts such as manifests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Renames in flight. Each is one metadata call.
RENAME_THREADS = 16

# No path holds it.
_BETWEEN_PATHS = "\0\0"


class Storage:
    """One file system, chosen by the path it is first used with."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._path = self._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self.root = root

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_directory(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isDirectory()

    def qualified_path(self, path: str) -> str:
        """The absolute path without scheme and authority, encoded as in a URI."""
        return self._fs.makeQualified(self._path(path)).toUri().getRawPath()

    def uri(self, path: str) -> str:
        """The path with scheme, encoded as in a URI: what ``_metadata.file_path`` holds."""
        return self._fs.makeQualified(self._path(path)).toUri().toString()

    def mounted(self, path: str) -> str | None:
        """The path as every process of the machine sees it; None in other stores."""
        uri = self._fs.makeQualified(self._path(path)).toUri()
        return uri.getPath() if uri.getScheme() == "file" else None

    def glob(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(pattern))
        return [] if found is None else self._paths(found)

    def any(self, pattern: str) -> bool:
        """Whether anything matches; the matches stay in the JVM."""
        found = self._fs.globStatus(self._path(pattern))
        return found is not None and len(found) > 0

    def names(self, directory: str) -> list[str]:
        """Names inside a directory, sorted; empty if there is none."""
        if not self.exists(directory):
            return []
        return sorted(path.rsplit("/", 1)[-1] for path in self._paths(self._fs.listStatus(self._path(directory))))

    def _paths(self, statuses) -> list[str]:
        """Paths of a listing, in one text: a call for each file takes longer than the listing."""
        if not len(statuses):
            return []
        jvm, found = self._jvm, self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
        # Py4J finds methods on arrays by the exact class.
        plain = self._gateway.new_array(jvm.java.lang.Object, len(found))
        jvm.java.lang.System.arraycopy(found, 0, plain, 0, len(found))
        return jvm.org.apache.commons.lang3.StringUtils.join(plain, _BETWEEN_PATHS).split(_BETWEEN_PATHS)

    def size(self, path: str) -> tuple[int, int]:
        """(number of files, bytes) below a path."""
        summary = self._fs.getContentSummary(self._path(path))
        return summary.getFileCount(), summary.getLength()

    def write_text(self, path: str, text: str) -> None:
        """Write a small file whole, replacing what is there."""
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> None:
        """Rename, creating the parent. A file of that name is an error."""
        target_path = self._path(target)
        self._fs.mkdirs(target_path.getParent())
        if self._fs.exists(target_path):
            raise FileExistsError(target)
        if not self._fs.rename(self._path(source), target_path):
            raise OSError(f"could not move {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        """Rename over a file of that name, in one step where the file system can.

        Where it cannot, the old file goes first; callers keep a record of what is
        to be done, and the source stays until it has the new name.
        """
        target_path = self._path(target)
        self._fs.mkdirs(target_path.getParent())
        if not self._fs.exists(target_path):
            self.move(source, target)
            return
        hadoop = self._jvm.org.apache.hadoop.fs
        try:
            context = hadoop.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
            options = self._gateway.new_array(hadoop.Options.Rename, 1)
            options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
            context.rename(self._fs.makeQualified(self._path(source)), self._fs.makeQualified(target_path), options)
        except Py4JError as error:
            if "UnsupportedFileSystemException" not in str(error):
                raise
            self._fs.delete(target_path, False)
            self.move(source, target)

    def each(self, task: Callable, items: Iterable) -> list:
        """Run metadata calls side by side; the results in order."""
        with ThreadPoolExecutor(RENAME_THREADS) as pool:
            return list(pool.map(task, items))

    def move_all(self, moves: list[tuple[str, str]]) -> None:
        self.each(lambda pair: self.move(*pair), moves)

    def read_text(self, path: str) -> str:
        """A small file whole."""
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove_file(self, path: str) -> None:
        self._fs.delete(self._path(path), False)

    def remove_folder(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path below the folder every executor can reach.

    That folder is ``spark.checkpoint.dir``. Only a local session may do without.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="firstseen-")
    return f"{root.rstrip('/')}/firstseen-{label}-{uuid.uuid4().hex[:12]}"
