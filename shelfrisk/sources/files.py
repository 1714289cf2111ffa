"""Small files and file listings through the cluster's own file systems (local, HDFS or object stores alike)."""

from __future__ import annotations

import hashlib

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of the file, or of the files right below the folder; [] if there is none."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return []
    return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at))


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Changes when a file of the tables comes, goes or is rewritten."""
    return hashlib.sha256(repr([listed(spark, p) for p in paths]).encode()).hexdigest()[:16]


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False if it is there already."""
    fs, at = _file_system(spark, path)
    try:
        stream = fs.create(at, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
