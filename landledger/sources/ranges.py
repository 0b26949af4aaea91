"""Files as byte ranges and archives as members, each a piece of work of its own.

Folders are listed by tasks (a data source whose partitions are folders), so
that no list of names passes through the driver. Ranges and members are then
rows, dealt over tasks by a shuffle of names and numbers, and read as streams
of bounded blocks. No value is larger than a block.
"""

from __future__ import annotations

import csv
import fnmatch
import hashlib
import io
import itertools
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from landledger.sources.files import text_schema
from landledger.sources.stores import file_system, named

FORMAT = "raw_listing"
BLOCK_BYTES = 8 << 20
# Bytes of files that one task should read, as Spark's own scans do.
TASK_BYTES = 128 << 20
# Records that one output batch holds.
BATCH = 5_000
LISTED = "path string, size bigint"


@dataclass
class Folder(InputPartition):
    """A folder that a task lists, with or without what lies below it."""

    path: str
    recursive: bool


class ListingReader(DataSourceReader):
    """The driver lists the roots only; each folder in them is a partition."""

    def __init__(self, paths: list[str], glob: str | None):
        self.paths, self.glob = paths, glob

    def partitions(self) -> Sequence[Folder]:
        out: list[Folder] = []
        for path in self.paths:
            root, _ = split_glob(path)
            store, inside = file_system(root)
            out.append(Folder(path, False))
            if store.get_file_info(inside).type == fs.FileType.Directory:
                for entry in store.get_file_info(fs.FileSelector(inside)):
                    if entry.type == fs.FileType.Directory and not hidden(entry.base_name):
                        out.append(Folder(f"{path}\0{entry.path}", True))
        return out

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        path, _, below = partition.path.partition("\0")
        root, pattern = split_glob(path)
        store, inside = file_system(root)
        if below:
            found = store.get_file_info(fs.FileSelector(below, recursive=True))
        else:
            found = [store.get_file_info(inside)]
            if found[0].type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            if found[0].type == fs.FileType.Directory:
                found = store.get_file_info(fs.FileSelector(inside))
        kept = []
        for f in found:
            parts = f.path[len(inside) :].strip("/").split("/")
            if f.type != fs.FileType.File or any(hidden(p) for p in parts):
                continue
            if pattern and not pattern.match(f.path[len(inside) :].strip("/")):
                continue
            if self.glob is None or fnmatch.fnmatchcase(f.base_name, self.glob):
                kept.append((named(path, f.path), f.size))
        for begin in range(0, len(kept), BATCH):
            paths, sizes = zip(*kept[begin : begin + BATCH])
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "size"])


class ListingSource(DataSource):
    """``spark.read.format("raw_listing")``; use :func:`list_files`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LISTED

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options["paths"].split("\n"), self.options.get("glob"))


def hidden(name: str) -> bool:
    """Names that Spark's file scans leave out as well."""
    return name.startswith((".", "_"))


def split_glob(path: str) -> tuple[str, re.Pattern | None]:
    """The folder before the first wildcard, and a pattern for what lies below it.

    As in Spark's paths, ``*`` and ``?`` do not pass a slash, and a matching
    folder stands for all files in it.
    """
    path = path.rstrip("/")
    parts = path.split("/")
    at = next((k for k, p in enumerate(parts) if any(c in p for c in "*?[")), None)
    if at is None:
        return path, None
    below = "/".join(fnmatch.translate(p).replace("(?s:", "(?:").replace(".*", "[^/]*").removesuffix("\\Z").removesuffix("\\z") for p in parts[at:])
    return "/".join(parts[:at]), re.compile(f"(?:{below})(?:/.*)?$")


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``(path, size)`` of every file below ``path``, empty ones too.

    ``glob`` filters file names. Files and folders whose names begin with a dot
    or an underscore are left out, as Spark's scans do. Spark hands out one
    listing task per folder directly below the roots.
    """
    spark.dataSource.register(ListingSource)
    reader = spark.read.format(FORMAT).option("paths", "\n".join([path] if isinstance(path, str) else path))
    return (reader.option("glob", glob) if glob else reader).load()


def deal(df: DataFrame, bytes_column: str, *keys: str) -> DataFrame:
    """Rows over as many tasks as their bytes ask for, by a hash of ``keys``."""
    total = df.agg(F.sum(bytes_column)).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-total // TASK_BYTES)), *keys)


def byte_ranges(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(path, block, offset, length)`` of every range of ``files`` (path, size); an empty file has one of length 0."""
    last = F.greatest(F.ceil(F.col("size") / F.lit(block_bytes)), F.lit(1)) - 1
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("block"))
    offset = F.col("block") * F.lit(block_bytes)
    return ranges.select("path", "block", offset.alias("offset"), F.least(F.lit(block_bytes), F.col("size") - offset).alias("length"))


def read_blocks(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(path, block, offset, content)`` of ``files`` (path, size), the blocks of a file on several tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, stream = None, None
        for batch in batches:
            for k, (path, offset, length) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")))):
                if path != opened:
                    store, inside = file_system(path)
                    stream, opened = store.open_input_file(inside), path
                content = stream.read_at(length, offset) if length else b""
                if len(content) != length:
                    raise OSError(f"{path}: {len(content)} bytes at {offset} instead of {length}")
                row = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays(
                    [row.column("path"), row.column("block"), row.column("offset"), pa.array([content], pa.binary())],
                    names=["path", "block", "offset", "content"],
                )

    dealt = deal(byte_ranges(files, block_bytes), "length", "path", "block").sortWithinPartitions("path", "block")
    return dealt.mapInArrow(read, "path string, block bigint, offset bigint, content binary")


def block_checksums(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(path, block, length, lines, sha256)`` per block, to see which part of a large file has changed."""
    blocks = read_blocks(files, block_bytes)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = [c.as_py() for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("path"), batch.column("block"), pa.array([len(c) for c in contents], pa.int64()),
                    pa.array([c.count(b"\n") for c in contents], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in contents], pa.string()),
                ],
                names=["path", "block", "length", "lines", "sha256"],
            )

    return blocks.mapInArrow(summed, "path string, block bigint, length bigint, lines bigint, sha256 string")


# --- Archives ----------------------------------------------------------------


def list_members(archives: DataFrame, glob: str = "*", required: bool = False) -> DataFrame:
    """``(path, member, compressed, size)`` of the zip archives ``archives`` (path); reads their directories only.

    With ``required`` an archive without a member of that name is an error.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inside = file_system(path)
                with store.open_input_file(inside) as stream, zipfile.ZipFile(stream) as archive:
                    kept = [i for i in archive.infolist() if not i.is_dir() and fnmatch.fnmatchcase(i.filename, glob)]
                if required and not kept:
                    raise KeyError(f"{path} has no member {glob}")
                if kept:
                    yield pa.RecordBatch.from_pydict({
                        "path": [path] * len(kept), "member": [i.filename for i in kept],
                        "compressed": [i.compress_size for i in kept], "size": [i.file_size for i in kept],
                    })

    narrow = archives.select("path")
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return narrow.repartition(n, "path").mapInArrow(members, "path string, member string, compressed bigint, size bigint")


def csv_batches(stream, member: str, sep: str, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Record batches of text columns, by header name, from a binary stream of CSV.

    As permissive as Spark's own reader: a record that ends early is NULL from
    there on, surplus fields are dropped, blank lines are skipped.
    """
    schema = pa.schema([(c, pa.string()) for c in columns])
    records = csv.reader(io.TextIOWrapper(stream, "utf-8-sig", errors="replace", newline=""), delimiter=sep)
    header = next(records, [])
    places = [header.index(c) if c in header else None for c in columns]
    missing = [c for c, at in zip(columns, places, strict=True) if at is None]
    if header and missing:
        raise ValueError(f"{member} has no columns {missing}")
    while batch := list(itertools.islice(records, BATCH)):
        rows = [r for r in batch if r]
        arrays = [pa.array([(r[at] or None) if at < len(r) else None for r in rows], pa.string()) for at in places]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def read_members(members: DataFrame, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Rows of every CSV member of ``members`` (path, member, compressed), all text.

    The members of one archive run on several tasks. Each is read from its place
    in the archive and decompressed as a stream, so archives and members may
    have any size.
    """
    columns = list(columns)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member in zip(batch.column("path").to_pylist(), batch.column("member").to_pylist()):
                store, inside = file_system(path)
                with store.open_input_file(inside) as file, zipfile.ZipFile(file) as archive, archive.open(member) as stream:
                    yield from csv_batches(stream, member, sep, columns)

    dealt = deal(members.select("path", "member", "compressed"), "compressed", "path", "member")
    return dealt.mapInArrow(parse, text_schema(columns))
