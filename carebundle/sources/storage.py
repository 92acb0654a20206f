"""Files of any Hadoop file system, and the shared folder of the cluster."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple, TypeVar
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

MAX_CONCURRENT_JOBS = 8
Item = TypeVar("Item")
Result = TypeVar("Result")


class FileInfo(NamedTuple):
    path: str
    bytes: int


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the session's checkpoint folder.  A local session without either
    gets one below the folder of its warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-shared"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_folder(spark).rstrip('/')}/carebundle/{label}-{uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: what follows neither computes it again nor loses it with an
    executor."""
    folder = new_folder(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def for_each(spark: SparkSession, action: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Run one action per table with a bounded number of jobs at a time; the first error is raised."""
    with ThreadPoolExecutor(MAX_CONCURRENT_JOBS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(action), list(items)))


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, files = _path(spark, location)
    return files.exists(path)


def file_size(spark: SparkSession, location: str) -> int | None:
    """The bytes of a file; None if there is none."""
    path, files = _path(spark, location)
    return files.getFileStatus(path).getLen() if files.exists(path) else None


def read_text(spark: SparkSession, location: str) -> str:
    path, files = _path(spark, location)
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, location: str) -> str | None:
    """The first line of a text file, compressed or not, without reading on; None for an empty file."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(location))
    settings = spark._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(settings).getCodec(path)
    stream = path.getFileSystem(settings).open(path)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def write_text(spark: SparkSession, location: str, text: str) -> None:
    path, files = _path(spark, location)
    stream = files.create(path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def data_files(spark: SparkSession, folder: str) -> list[FileInfo]:
    """The data files below a folder, relative to it, without markers and hidden files.  Spark lists them, without reading
    any, and returns all names at once."""
    path, files = _path(spark, folder)
    root = files.getFileStatus(path).getPath().toString()
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rows = listed.select("path", "length").collect()
    return sorted(FileInfo(row["path"][len(root) + 1 :], row["length"]) for row in rows)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename inside the file system; the bytes never pass through the driver."""
    source_path, files = _path(spark, source)
    target_path, _ = _path(spark, target)
    if files.exists(target_path):
        raise FileExistsError(f"{target} already exists")
    files.mkdirs(target_path.getParent())
    if not files.rename(source_path, target_path):
        raise OSError(f"cannot rename {source} to {target}")


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)
