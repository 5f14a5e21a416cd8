"""Folders of a shared file system, by way of the file systems that Spark itself uses."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def exists(spark: SparkSession, path: str) -> bool:
    files, name = _file_system(spark, path)
    return bool(files.exists(name))


def drop_folder(spark: SparkSession, path: str) -> None:
    files, name = _file_system(spark, path)
    files.delete(name, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder to where another may be, which goes."""
    files, name = _file_system(spark, target)
    files.delete(name, True)
    files.mkdirs(name.getParent())
    if not files.rename(_file_system(spark, source)[1], name):
        raise OSError(f"{source} could not be moved to {target}")


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """The values of a number column by which the folder is partitioned, from the names of its folders."""
    files, name = _file_system(spark, path)
    if not files.exists(name):
        return []
    names = [status.getPath().getName() for status in files.listStatus(name)]
    found = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted(int(v) for v in found if v.lstrip("-").isdigit())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there with all of its text or not at all."""
    files, name = _file_system(spark, path)
    _, aside = _file_system(spark, f"{path}.aside")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files.delete(name, False)
    files.rename(aside, name)


def read_texts(spark: SparkSession, folder: str) -> list[str]:
    """The texts of the small `.json` files below a folder."""
    files, name = _file_system(spark, folder)
    if not files.exists(name):
        return []
    found = files.listFiles(name, True)
    texts = []
    while found.hasNext():
        path = found.next().getPath()
        if path.getName().endswith(".json"):
            stream = files.open(path)
            try:
                texts.append(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
    return texts


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """A digest of the names, sizes and times of all files below the paths."""
    seen = hashlib.sha256()
    for path in sorted(paths):
        files, name = _file_system(spark, path)
        found = files.listFiles(name, True)
        lines = []
        while found.hasNext():
            status = found.next()
            lines.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}\n")
        seen.update("".join(sorted(lines)).encode())
    return seen.hexdigest()[:16]


def read_if_there(spark: SparkSession, path: str, schema: str, *, nested: bool = False) -> DataFrame | None:
    """A Parquet table, or None where there is no such folder; every other fault is raised.

    With `nested`, all files in the folders below are its rows.
    """
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", nested).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
