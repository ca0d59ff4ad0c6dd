"""Zip archives to a member table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.hadoop import file_system
from ledgermill.sources.batches import RowBuffer, named_contents

MEMBERS = "archive string, member string, content binary"
_MEMBER_ROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("content", pa.binary())])


def expand_archives(archives: DataFrame, member_pattern: str | None = None) -> DataFrame:
    """Rows ``(archive, member, content)`` of an archive table ``(path, content)``.

    ``member_pattern`` is a regular expression found in the member name; other members are not decompressed. Members
    leave the task in batches of bounded size, so a task holds one archive and a few members.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import re
        import zipfile

        wanted = re.compile(member_pattern) if member_pattern else None
        out = RowBuffer(_MEMBER_ROW)
        for path, content in named_contents(batches):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for info in z.infolist():
                    if info.is_dir() or (wanted and not wanted.search(info.filename)):
                        continue
                    out.add((path, info.filename, z.read(info)), info.file_size)
                    if out.full():
                        yield from out.take()
        yield from out.take()

    return archives.select("path", "content").mapInArrow(expand, MEMBERS)


def document_of(path: str) -> Column:
    """Document id of an archive path: its file name without the suffix."""
    return F.regexp_extract(F.col(path), r"([^/]+?)(?:\.zip)?$", 1)


def _archive_files(spark: SparkSession, paths: str | Sequence[str], glob: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.load(paths)


def scan_named_archives(
    spark: SparkSession, paths: str | Sequence[str], documents: DataFrame, glob: str = "*.zip"
) -> DataFrame:
    """Archive table ``(path, content)`` of the wanted documents (first column of ``documents``) below the paths.

    The folder is listed without reading contents, the names are matched, and only the matching files are opened. Their
    names pass through the driver, which holds the longer list of all files of the folder already, as any scan does.
    """
    wanted = documents.select(F.col(documents.columns[0]).alias("_doc")).distinct()
    listed = _archive_files(spark, paths, glob).select("path", document_of("path").alias("_doc"))
    names = [r["path"] for r in listed.join(wanted, "_doc", "left_semi").select("path").collect()]
    if not names:
        return spark.createDataFrame([], "path string, content binary")
    return spark.read.format("binaryFile").load(names).select("path", "content")


def scan_archives(
    spark: SparkSession, paths: str | Sequence[str], member_pattern: str | None = None, glob: str = "*.zip"
) -> DataFrame:
    """Member table of every archive below the paths."""
    return expand_archives(_archive_files(spark, paths, glob), member_pattern)


def remove_archives(spark: SparkSession, archives: DataFrame) -> int:
    """Delete the archive files named in the ``path`` column; returns how many went. Call it once the members are stored."""
    removed = 0
    for row in archives.select(F.col("path")).distinct().toLocalIterator():
        fs, p, _ = file_system(spark, row["path"])
        removed += bool(fs.delete(p, False))
    return removed
