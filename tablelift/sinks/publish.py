"""Atomic publish of an output directory: write to a sibling staging directory, then swap.

Uses the Hadoop ``FileSystem`` of the target path, so it works for any file system the cluster
can write (HDFS, local, mounted shared storage). The old output survives a failing job; a
failed export publishes nothing. Between the two renames the target is briefly absent; on object
stores, where rename is a copy, use ``VersionedPublisher`` (``publish = "versioned"``).
"""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Publisher:
    def __init__(self, spark: SparkSession, target: str):
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self.target = target.rstrip("/")
        self.path = self._Path(self.target)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str | None = None) -> bool:
        return bool(self.fs.exists(self._Path(path) if path else self.path))

    def other_mode(self) -> bool:
        """Whether the target holds versions, which a swap would delete."""
        return self.exists(f"{self.target}/{LATEST}")

    def staging(self) -> str:
        return f"{self.target}.{uuid.uuid4().hex}.tmp"

    def begin(self) -> None:
        """Called when a run has found the target free for it."""

    def succeeded(self, staging: str) -> bool:
        return self.exists(f"{staging}/_SUCCESS")

    def stamp(self, output: str) -> int | None:
        """The time (ms) at which ``output`` was completed: another writer's output has another one."""
        marker = self._Path(f"{output}/_SUCCESS")
        return int(self.fs.getFileStatus(marker).getModificationTime()) if self.fs.exists(marker) else None

    def discard(self, staging: str) -> None:
        p = self._Path(staging)
        if self.fs.exists(p):
            self.fs.delete(p, True)

    def publish(self, staging: str) -> None:
        """Swap ``staging`` into the target; the previous output is restored if the swap fails."""
        src = self._Path(staging)
        if not self.fs.exists(src):
            raise OSError(f"E005 staging output {staging} does not exist")
        if self.other_mode():
            raise OSError(f"E005 {self.target} holds versions; a swap would delete them")
        parent = self.path.getParent()
        if parent is not None and not self.fs.exists(parent):
            self.fs.mkdirs(parent)
        if not self.fs.exists(self.path):
            if not self._rename(src, self.path):
                raise OSError(f"E005 cannot publish {staging} as {self.target}")
            return
        old = self._Path(f"{self.target}.{uuid.uuid4().hex}.old")
        if not self._rename(self.path, old):
            raise OSError(f"E005 cannot move old output {self.target} aside")
        if not self._rename(src, self.path):
            self._rename(old, self.path)
            raise OSError(f"E005 cannot publish {staging} as {self.target}; old output restored")
        self.fs.delete(old, True)

    def _rename(self, src, dst) -> bool:
        try:
            return bool(self.fs.rename(src, dst))
        except Exception:  # noqa: BLE001 - some file systems raise instead of returning False
            return False

    def published(self, staging: str) -> str:
        """Where readers find the output after ``publish``."""
        return self.target


LATEST = "_LATEST"
COMMITS = "_commits"


class CommitLog:
    """Numbered records ``<target>/_commits/<number>``, each naming the version published by it.

    A record is made by creating its file only where there is none, so one number has one writer: on HDFS
    and mounted folders by the file system's exclusive create, on s3a by a conditional put. A record
    counts once its line is whole; a writer that dies before that has used up a number, nothing else.
    """

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.folder = spark, f"{target.rstrip('/')}/{COMMITS}"
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.mounted = self.fs.getUri().getScheme() == "file"

    def _path(self, number: int):
        return self._Path(f"{self.folder}/{number:020d}")

    def numbers(self) -> list[int]:
        """All numbers in use, whole or not, in order."""
        folder = self._Path(self.folder)
        if not self.fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def record(self, number: int) -> tuple[str, str] | None:
        """(version, time) of a whole record."""
        stream = self.fs.open(self._path(number))
        try:
            line = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        version, _, at = line.rstrip("\n").partition("\t")
        return (version, at) if line.endswith("\n") and version else None

    def head(self) -> tuple[int, str] | None:
        """The number and the version of the last whole record."""
        for number in reversed(self.numbers()):
            found = self.record(number)
            if found is not None:
                return number, found[0]
        return None

    def create(self, number: int, version: str) -> bool:
        """Make the record ``number``; False where another writer has it."""
        line = f"{version}\t{datetime.now(timezone.utc).strftime('%Y-%m-%dT%H:%M:%S.%fZ')}\n".encode()
        self.fs.mkdirs(self._Path(self.folder))
        path = self._path(number)
        if self.mounted:
            try:
                handle = os.open(path.toUri().getPath(), os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o644)
            except FileExistsError:
                return False
            with os.fdopen(handle, "wb") as out:
                out.write(line)
                out.flush()
                os.fsync(out.fileno())
            return True
        try:
            out = (self.fs.createFile(path).overwrite(False)
                   .opt("fs.option.create.conditional.overwrite", True).build())
            try:
                out.write(bytearray(line))
            finally:
                out.close()
        except Py4JJavaError:
            if self.fs.exists(path):
                found = self.record(number)
                return found is not None and found[0] == version
            raise
        return True


class VersionedPublisher(Publisher):
    """Publish without renames, for object stores (where a rename is a copy).

    Every run writes into its own ``<target>/v-<utc time>-<id>/``; publishing adds the next record to the
    target's ``CommitLog``. Readers take the version of the last record (``resolve_output``). Where another
    run has published since this one began, a run that may not overwrite is refused, and one that may
    takes the next number: both versions stay listed and the later record is live. A failed run makes
    no record and so leaves the previous version. ``<target>/_LATEST`` names the live version for
    people and for readers of outputs made before there were records; nothing relies on it where there are.
    Old versions stay until removed by retention outside the export.
    """

    def __init__(self, spark: SparkSession, target: str, overwrite: bool = True):
        super().__init__(spark, target)
        self.log, self.overwrite = CommitLog(spark, self.target), overwrite
        self.base = 0

    def exists(self, path: str | None = None) -> bool:
        if path:
            return super().exists(path)
        return self.log.head() is not None or super().exists(f"{self.target}/{LATEST}") or self.other_mode()

    def other_mode(self) -> bool:
        """Whether the target holds anything that is neither a version nor one of their records."""
        if not self.fs.exists(self.path):
            return False
        names = [f.getPath().getName() for f in self.fs.listStatus(self.path)]
        return any(n not in (LATEST, COMMITS) and not n.startswith("v-") and not n.startswith(".") for n in names)

    def begin(self) -> None:
        self.base = (self.log.numbers() or [0])[-1]

    def staging(self) -> str:
        stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
        return f"{self.target}/v-{stamp}-{uuid.uuid4().hex[:8]}"

    def publish(self, staging: str) -> None:
        if not super().exists(f"{staging}/_SUCCESS"):
            raise OSError(f"E005 version {staging} is not complete")
        if self.other_mode():
            raise OSError(f"E005 {self.target} holds output that was not published by versions")
        name = staging.rstrip("/").rsplit("/", 1)[-1]
        number = self.base + 1
        while not self.log.create(number, name):
            if not self.overwrite and any(self.log.record(n) for n in range(self.base + 1, number + 1)):
                raise FileExistsError(f"E005 {self.target} was published by another run meanwhile and overwrite is off")
            number = max(number, self.log.numbers()[-1]) + 1
        self._point()

    def _point(self) -> None:
        """Name the live version in ``_LATEST``; again while others publish. It is a hint only."""
        written = None
        while (head := self.log.head()) is not None and head != written:
            try:
                self._write_pointer(f"{head[1]}\n".encode())
            except (OSError, Py4JJavaError):
                return  # the records hold
            written = head

    def _write_pointer(self, line: bytes) -> None:
        pointer = self._Path(f"{self.target}/{LATEST}")
        if self.log.mounted:
            path = pointer.toUri().getPath()
            fresh = f"{os.path.dirname(path)}/.{LATEST}.{uuid.uuid4().hex}"
            with open(fresh, "wb") as out:
                out.write(line)
            os.replace(fresh, path)
            return
        out = self.fs.create(pointer, True)
        try:
            out.write(bytearray(line))
        finally:
            out.close()

    def published(self, staging: str) -> str:
        return staging


def resolve_output(spark: SparkSession, target: str) -> str:
    """The directory to read for ``target``: the version of its last commit record, the one that ``_LATEST``
    names where there are no records, or the target itself."""
    head = CommitLog(spark, target).head()
    if head is not None:
        return f"{target.rstrip('/')}/{head[1]}"
    jvm = spark._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{LATEST}")
    fs = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(pointer):
        return target
    stream = fs.open(pointer)
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{target.rstrip('/')}/{name}"


def list_versions(spark: SparkSession, target: str) -> DataFrame:
    """(number, version, path, committed_at, live): every published version of ``target``, one row a record."""
    log = CommitLog(spark, target)
    found = [(n, r) for n in log.numbers() if (r := log.record(n)) is not None]
    rows = [(n, r[0], f"{target.rstrip('/')}/{r[0]}", r[1], n == found[-1][0]) for n, r in found]
    return spark.createDataFrame(rows, "number long, version string, path string, committed_at string, live boolean")
