"""CSV members of zip archives, read inside tasks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from landledger.sources.files import text_schema
from landledger.sources.ranges import csv_batches, list_files, list_members, read_members


def _member_batches(content: bytes, member: str, sep: str, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Stream one member of an archive that is a value."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open(member) as stream:
        yield from csv_batches(stream, member, sep, columns)


def read_zip_members(archives: DataFrame, member: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Rows of ``member`` in each archive of ``archives(content)``, all text.

    The archive is decompressed and parsed block by block, so a task holds one
    archive and one block, never the whole member.
    """
    columns = list(columns)

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                yield from _member_batches(content.as_py(), member, sep, columns)

    return archives.select("content").mapInArrow(parse, text_schema(columns))


def scan_zip_csv(spark: SparkSession, path: str | list[str], member: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """CSV members of every zip archive under ``path``; members run in parallel.

    ``member`` is a name or a pattern of names. Every archive must have one.
    Archives are opened where they lie and members are read as streams, so
    neither has a size limit.
    """
    return read_members(list_members(list_files(spark, path), member, required=True), columns, sep)
