"""Small file-system calls through Spark's Hadoop client, so that any storage Spark can read works.

They need a classic session: Spark Connect has no access to the driver's JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """``(file system, path object, path constructor)`` of a path."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    p = make(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, make


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = file_system(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p, _ = file_system(spark, path)
    return fs.getFileStatus(p).isDirectory()


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Files directly inside a folder, sorted by name."""
    fs, p, _ = file_system(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isFile())


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """Folders directly inside a folder, sorted by name."""
    fs, p, _ = file_system(spark, folder)
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file; None when there is none."""
    fs, p, _ = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = file_system(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file; reads one buffer of it."""
    fs, p, _ = file_system(spark, path)
    io = spark._jvm.java.io
    reader = io.BufferedReader(io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return (reader.readLine() or "").lstrip("﻿")
    finally:
        reader.close()


def first_lines(spark: SparkSession, paths: Sequence[str], threads: int = 16) -> list[str]:
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda p: first_line(spark, p), paths))
