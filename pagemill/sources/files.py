"""Whole files as Spark jobs: byte-exact copies with a manifest (IO8).

The driver handles names only: it lists, and it renames a finished folder into
place.  The bytes are read, digested and written in the tasks, in blocks, so a
file may be of any size.  A copy goes to a fresh folder first and takes its
place when every file has arrived; a run that dies leaves the old state.

Paths are whatever Spark reads and ``pyarrow.fs`` opens under the same name
(mounted folders, ``hdfs``, ``s3``/``s3a``, ``gs``).
"""

from __future__ import annotations

import hashlib
import os
import posixpath
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

BLOCK = 1 << 23
MANIFEST = "_manifest"
FILES = "name string, length long, sha256 string"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path within it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    return pafs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path)


def qualified(spark: SparkSession, path: str):
    """Hadoop's file system and the full path, as file listings spell it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(p)


def base_of(spark: SparkSession, path: str) -> str:
    """The folder that file names are relative to: the path, or the folder of
    a path that is one file."""
    system, p = qualified(spark, path)
    folder = system.exists(p) and system.getFileStatus(p).isDirectory()
    return (p if folder else p.getParent()).toString().rstrip("/")


def plain(file: str) -> str:
    """A path without scheme and leading slashes, the same for every spelling."""
    return file.split(":", 1)[-1].lstrip("/") if ":/" in file else file.lstrip("/")


def relative(file: str, base: str) -> str:
    """``file`` below the folder ``base``."""
    return plain(file)[len(plain(base)):].lstrip("/")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``path, name`` of every file that a reader of ``path`` sees, empty ones
    too: the list that the driver makes for any scan."""
    base = base_of(spark, path)
    seen = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()
    return spark.createDataFrame([(f, relative(f, base)) for f in map(unquote, seen)], "path string, name string")


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """``fresh`` takes the place of ``path``: two renames, no copy."""
    system, new = qualified(spark, fresh)
    _, old = qualified(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(fresh.rstrip("/") + ".replaced")
    had = system.exists(old)
    if had and not system.rename(old, aside):
        raise OSError(f"cannot set {path} aside")
    if not system.rename(new, old):
        raise OSError(f"cannot put {fresh} in place of {path}")
    if had:
        system.delete(aside, True)


class Sink:
    """A file that appears under its name when it is closed whole; a task that
    runs again writes the same name again."""

    def __init__(self, folder: str, name: str):
        self.fs, root = open_fs(folder)
        self.path = posixpath.join(root, name)
        self.part = f"{posixpath.dirname(self.path)}/_{posixpath.basename(self.path)}.{os.urandom(6).hex()}"
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.digest, self.length = hashlib.sha256(), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.length += len(data)

    def close(self) -> tuple[int, str]:
        self.out.close()
        self.fs.move(self.part, self.path)
        return self.length, self.digest.hexdigest()


def _blocks(path: str) -> Iterator[bytes]:
    fs, p = open_fs(path)
    with fs.open_input_stream(p, compression=None) as f:
        while data := f.read(BLOCK):
            yield data


def _each_file(files: DataFrame, work) -> DataFrame:
    """``work(path, name) -> (length, sha256)`` for every file, in the tasks."""
    ship_package(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                length, sha = work(path, name)
                yield pa.RecordBatch.from_pydict({"name": [name], "length": [length], "sha256": [sha]})

    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path", "name").repartition(4 * cores).mapInArrow(run, FILES)


def digest_files(spark: SparkSession, path: str) -> DataFrame:
    """``name, length, sha256`` of every file below ``path``."""

    def work(file: str, name: str) -> tuple[int, str]:
        digest, length = hashlib.sha256(), 0
        for data in _blocks(file):
            digest.update(data)
            length += len(data)
        return length, digest.hexdigest()

    return _each_file(listing(spark, path), work)


def copy_files(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Copy every file below ``path`` to the folder ``target``, byte by byte
    and under its name, with a manifest; an earlier ``target`` is replaced.
    Raises unless all files arrived.  Returns the manifest."""
    files = listing(spark, path)
    fresh = f"{target.rstrip('/')}.{os.urandom(6).hex()}"

    def work(file: str, name: str) -> tuple[int, str]:
        sink = Sink(fresh, name)
        for data in _blocks(file):
            sink.write(data)
        return sink.close()

    _each_file(files, work).write.parquet(posixpath.join(fresh, MANIFEST))
    copied = spark.read.schema(FILES).parquet(posixpath.join(fresh, MANIFEST))
    if not files.join(copied, "name", "left_anti").isEmpty():
        raise OSError(f"files of {path} are missing in the copy")
    replace_folder(spark, fresh, target)
    return spark.read.schema(FILES).parquet(posixpath.join(target, MANIFEST))


def verify_files(spark: SparkSession, target: str) -> None:
    """Raise unless the files below ``target`` are those of its manifest."""
    want = spark.read.schema(FILES).parquet(posixpath.join(target, MANIFEST))
    have = digest_files(spark, target)
    changed = (want.withColumn("side", F.lit(1)).unionByName(have.withColumn("side", F.lit(-1)))
               .groupBy("name", "length", "sha256").agg(F.sum("side").alias("n")).filter("n <> 0"))
    if not changed.isEmpty():
        raise OSError(f"{target} does not match its manifest")
