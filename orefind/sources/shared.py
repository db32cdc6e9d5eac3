"""The folder that all executors share, for written tables that cut lineage or hold state, and small files in it."""

from __future__ import annotations

import atexit
import json
import re
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_marked: set[str] = set()


def _at(spark: SparkSession, path: str):
    """The file system of a path, whatever its scheme, and the path as it names it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds, if it is there."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where there is no folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def bytes_in(spark: SparkSession, path: str) -> int:
    """The bytes of all files below a path; 0 where there is none."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def read_file(spark: SparkSession, path: str) -> bytes:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, data: bytes) -> bool:
    """Write a new file; false where there is one of that name."""
    fs, p = _at(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    stream.write(bytearray(data))
    stream.close()
    return True


class Pointer:
    """A JSON value that is kept as numbered files in a folder: readers see the last whole one, and of two writers one fails."""

    def __init__(self, spark: SparkSession, folder: str, name: str) -> None:
        self.spark, self.folder, self.name, self.number = spark, folder.rstrip("/"), name, 0

    def _numbers(self) -> list[int]:
        return sorted(int(m.group(1)) for n in names_in(self.spark, self.folder) if (m := re.fullmatch(rf"{re.escape(self.name)}-(\d+)\.json", n)))

    def load(self, default=None):
        """The value last stored whole, or ``default``. What a writer left unfinished is passed over."""
        numbers = self._numbers()
        self.number = numbers[-1] if numbers else 0
        for number in reversed(numbers):
            try:
                return json.loads(read_file(self.spark, f"{self.folder}/{self.name}-{number}.json"))
            except ValueError:
                continue
        return default

    def store(self, value) -> None:
        """Store a value behind the one that was loaded or stored here; an error if another writer has stored one since."""
        make_folder(self.spark, self.folder)
        if not create_file(self.spark, f"{self.folder}/{self.name}-{self.number + 1}.json", json.dumps(value, indent=1).encode()):
            raise RuntimeError(f"{self.folder}/{self.name} was changed by another session since it was read; read it again")
        self.number += 1
        for old in self._numbers():
            if old < self.number - 2:  # the last ones stay for readers that are late
                remove(self.spark, f"{self.folder}/{self.name}-{old}.json")


def _base(spark: SparkSession) -> str:
    """The application's folder below spark.checkpoint.dir, which goes when the application ends. Where that is unset, a local session
    (tests) has a temporary folder of this process; on a cluster it is an error, as executors would each write to a disk of their own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="orefind-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = "file://" + _own[0]
    folder = f"{base.rstrip('/')}/orefind-{spark.sparkContext.applicationId}"
    if folder not in _marked:
        make_folder(spark, folder)
        fs, p = _at(spark, folder)
        fs.deleteOnExit(p)
        _marked.add(folder)
    return folder


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name that all executors see; it goes when the application ends."""
    return f"{_base(spark)}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete now all tables written by this application, for sessions that live long. Frames that read them can't be used any more."""
    remove(spark, _base(spark))
    make_folder(spark, _base(spark))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table written once to the shared folder and read back, so a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
