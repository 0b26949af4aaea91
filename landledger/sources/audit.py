"""Audit of raw files: readable, complete, and with which checksum."""

from __future__ import annotations

import gzip
import hashlib
import io
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.operators.snapshot import content_checksum
from landledger.sources.json_text import JsonSyntax
from landledger.sources.ranges import deal, list_files
from landledger.sources.stores import file_system

AUDIT_SCHEMA = "path string, size bigint, is_valid boolean, reason string, sha256 string"
# Files are read in blocks of this size.
BLOCK_BYTES = 1 << 20

EMPTY = "empty file"
BAD = {"gz": "not a valid gzip archive", "zip": "not a valid zip archive", "json": "not valid JSON"}
UNREADABLE = (zlib.error, zipfile.BadZipFile, EOFError, ValueError, OSError, RuntimeError, NotImplementedError)
KIND = r"\.([A-Za-z]+)$"


def _blocks(stream) -> Iterator[bytes]:
    while block := stream.read(BLOCK_BYTES):
        yield block


def _gzip_ok(stream) -> bool:
    with gzip.GzipFile(fileobj=stream) as unpacked:
        for _ in _blocks(unpacked):
            pass
    return True


def _zip_ok(stream) -> bool:
    with zipfile.ZipFile(stream) as archive:
        return archive.testzip() is None


def _json_ok(stream) -> bool:
    document = JsonSyntax()
    return all(document.feed(block) for block in _blocks(stream)) and document.feed(b"", last=True)


_CHECKS = {"gz": _gzip_ok, "zip": _zip_ok, "json": _json_ok}


def check_stream(kind: str, stream) -> str:
    """Reason why the file behind ``stream`` is not a valid one of its kind, else empty text.

    Read in blocks from the beginning; zip archives need a stream that seeks.
    """
    check = _CHECKS.get(kind)
    if check is None:
        return ""
    try:
        ok = check(stream)
    except UNREADABLE:
        ok = False
    return "" if ok else BAD[kind]


def check_content(kind: str, content: bytes) -> str:
    """:func:`check_stream` of a value; an empty one is never valid."""
    return check_stream(kind, io.BytesIO(content)) if content else EMPTY


def audit_contents(files: DataFrame) -> DataFrame:
    """Verdict per row of ``files(path, content)``; the kind is the file suffix.

    Size and checksum are computed by Spark, only the readability check needs
    Python.
    """
    kind = F.lower(F.regexp_extract("path", KIND, 1))
    prepared = files.select(
        "path",
        F.octet_length("content").cast("bigint").alias("size"),
        content_checksum("content").alias("sha256"),
        kind.alias("kind"),
        "content",
    )

    def verdicts(batches):
        for batch in batches:
            kinds, contents = batch.column("kind"), batch.column("content")
            reasons = [check_content(k.as_py(), c.as_py()) for k, c in zip(kinds, contents)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("path"),
                    batch.column("size"),
                    pa.array([not r for r in reasons], pa.bool_()),
                    pa.array(reasons, pa.string()),
                    batch.column("sha256"),
                ],
                names=["path", "size", "is_valid", "reason", "sha256"],
            )

    return prepared.mapInArrow(verdicts, AUDIT_SCHEMA)


def audit_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``(path, size, is_valid, reason, sha256)`` for every file under ``path``.

    gzip and zip archives are read to their end, JSON documents are checked,
    other files only have to be non-empty. Tasks list the folders and then read
    the files in blocks, so a file may have any size and a task holds one block.
    A file is one task, since its checksum depends on all that came before;
    :func:`landledger.sources.ranges.block_checksums` sums its blocks in parallel.
    """
    files = list_files(spark, path, glob).withColumn("kind", F.lower(F.regexp_extract("path", KIND, 1)))

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons, sums = [], []
            for name, kind, size in zip(*(batch.column(c).to_pylist() for c in ("path", "kind", "size"))):
                store, inside = file_system(name)
                total = hashlib.sha256()
                with store.open_input_stream(inside, compression=None) as stream:
                    for block in _blocks(stream):
                        total.update(block)
                sums.append(total.hexdigest())
                if size and kind in _CHECKS:
                    with store.open_input_file(inside) as stream:
                        reasons.append(check_stream(kind, stream))
                else:
                    reasons.append("" if size else EMPTY)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("path"), batch.column("size"), pa.array([not r for r in reasons], pa.bool_()),
                    pa.array(reasons, pa.string()), pa.array(sums, pa.string()),
                ],
                names=["path", "size", "is_valid", "reason", "sha256"],
            )

    return deal(files, "size", "path").mapInArrow(verdicts, AUDIT_SCHEMA)
