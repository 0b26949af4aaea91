"""Publication of a table in one switch.

A published table is a folder of data files that are never changed, and a list
of versions. A version names the files that make up the table, by partition.
Publishing writes new files under names of their own and then creates the next
version, so that readers see all replaced partitions at once or none: a run
that fails leaves the version before it as it was.

The write is Spark's own two-step commit. Each task writes its files and returns
their names; the driver creates the version when all tasks are done, or removes
the files when one has failed. A file of a failed attempt is named by no version.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from landledger.sources.stores import file_system

FORMAT = "published"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# A file is closed and another begun beyond this many rows.
FILE_ROWS = 5_000_000


@dataclass(frozen=True)
class Version:
    """What a table is made of: ``files`` are (partition values, name, rows)."""

    number: int
    partitions: list[str]
    schema: dict
    files: list[tuple[list[str | None], str, int]]
    note: dict

    def by_partition(self) -> dict[tuple, set[str]]:
        found: dict[tuple, set[str]] = {}
        for values, name, _ in self.files:
            found.setdefault(tuple(values), set()).add(name)
        return found


@dataclass
class Written(WriterCommitMessage):
    """The files of one task."""

    files: list[tuple[list[str | None], str, int]]


def _numbers(store: fs.FileSystem, root: str) -> list[int]:
    listed = store.get_file_info(fs.FileSelector(f"{root}/versions", allow_not_found=True))
    names = [f.base_name.removesuffix(".json") for f in listed]
    return sorted(int(n) for n in names if n.isdigit())


def versions(path: str) -> list[int]:
    """Numbers of the versions of a table, oldest first; none where nothing is published."""
    return _numbers(*file_system(path.rstrip("/")))


def read_version(path: str, number: int | None = None) -> Version | None:
    """A version of a table, by default the current one; None where nothing is published."""
    store, root = file_system(path.rstrip("/"))
    known = _numbers(store, root)
    if number is None and not known:
        return None
    number = known[-1] if number is None else number
    if number not in known:
        raise ValueError(f"{path} has no version {number}")
    with store.open_input_stream(f"{root}/versions/{number:08d}.json") as stream:
        found = json.loads(stream.read())
    return Version(number, found["partitions"], found["schema"], [(v, n, r) for v, n, r in found["files"]], found["note"])


def _create(store: fs.FileSystem, root: str, version: Version) -> bool:
    """Create a version whole, unless it exists. Not exclusive on object stores, which need one publisher at a time."""
    target = f"{root}/versions/{version.number:08d}.json"
    draft = f"{root}/versions/draft-{uuid.uuid4().hex}"
    store.create_dir(f"{root}/versions", recursive=True)
    content = {"partitions": version.partitions, "schema": version.schema, "files": version.files, "note": version.note}
    with store.open_output_stream(draft) as stream:
        stream.write(json.dumps(content).encode())
    try:
        if isinstance(store, fs.LocalFileSystem):
            os.link(draft, target)
            store.delete_file(draft)
        elif store.get_file_info(target).type != fs.FileType.NotFound:
            raise FileExistsError(target)
        else:
            store.move(draft, target)
    except FileExistsError:
        store.delete_file(draft)
        return False
    return True


class PublicationWriter(DataSourceArrowWriter):
    """Writes rows that are sorted by the partition columns within each task."""

    def __init__(self, path: str, schema: StructType, partitions: list[str], owned: list[list[str | None]], note: dict):
        self.path, self.schema, self.partitions, self.owned, self.note = path.rstrip("/"), schema, partitions, owned, note

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = file_system(self.path)
        files: list[tuple[list[str | None], str, int]] = []
        out, current, rows = None, None, 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                files[-1] = (*files[-1][:2], rows)
                out = None

        for batch in iterator:
            table = pa.Table.from_batches([batch])
            inside = table.drop_columns(self.partitions)
            for values, begin, length in _runs(table, self.partitions):
                if out is None or values != current or rows >= FILE_ROWS:
                    close()
                    current, rows = values, 0
                    folder = "/".join(f"{k}={NO_VALUE if v is None else _folder_name(v)}" for k, v in zip(self.partitions, values))
                    name = "/".join(p for p in ("data", folder, f"part-{uuid.uuid4().hex}.parquet") if p)
                    store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                    out = pq.ParquetWriter(f"{root}/{name}", inside.schema, filesystem=store, compression="zstd")
                    files.append((values, name, 0))
                out.write_table(inside.slice(begin, length))
                rows += length
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        new = [f for message in messages if message for f in message.files]
        replaced = {tuple(v) for v, _, _ in new} | {tuple(v) for v in self.owned}
        while True:
            old = read_version(self.path)
            if old and old.partitions != self.partitions:
                raise ValueError(f"{self.path} is partitioned by {old.partitions}, not by {self.partitions}")
            kept = [f for f in old.files if tuple(f[0]) not in replaced] if old else []
            version = Version(old.number + 1 if old else 1, self.partitions, self.schema.jsonValue(), kept + new, self.note)
            if _create(store, root, version):
                return
            # another run has published meanwhile; its other partitions are kept

    def abort(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        for message in messages:
            for _, name, _ in message.files if message else []:
                store.delete_file(f"{root}/{name}")


def _folder_name(value: str) -> str:
    """A partition value as Spark reads it back: ASCII characters that are no letter, digit or blank as ``%XX``."""
    return "".join(c if ord(c) > 127 or c.isalnum() or c in " _-." else f"%{ord(c):02X}" for c in value)


def _runs(table: pa.Table, partitions: list[str]) -> Iterator[tuple[list[str | None], int, int]]:
    """(values, begin, length) of each run of rows of one partition."""
    if not table.num_rows:
        return
    if not partitions:
        yield [], 0, table.num_rows
        return
    texts = [pc.cast(table.column(p), pa.string()).to_pylist() for p in partitions]
    rows = [tuple(v or None for v in values) for values in zip(*texts)]  # folders cannot tell empty text from NULL
    begin = 0
    for at in range(1, len(rows) + 1):
        if at == len(rows) or rows[at] != rows[begin]:
            yield list(rows[begin]), begin, at - begin
            begin = at


class PublicationSource(DataSource):
    """``df.write.format("published")``; use :func:`publish`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> PublicationWriter:
        asked = {k: json.loads(self.options[k]) for k in ("partitions", "owned", "note")}
        return PublicationWriter(self.options["path"], schema, asked["partitions"], asked["owned"], asked["note"])


def publish(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    owned: Sequence[Sequence[object]] | None = None,
    note: dict | None = None,
    arranged: bool = False,
) -> int:
    """Replace the partitions that occur in ``df`` in one switch; returns the new version's number.

    Partitions of ``owned`` (values in the order of ``partitions``) that have no
    row in ``df`` are removed in the same switch; others stay. Without
    ``partitions`` the whole table is replaced. ``note`` is kept with the
    version. Rows that are sorted by partition within their tasks already are
    written as they are with ``arranged``. If any task fails, the error is raised
    and nothing changes. Runs
    that publish different partitions at the same time both take effect, where
    the store can create a file exclusively (local, HDFS).
    """
    names = list(partitions)
    others = [] if owned is None else [[None if v is None else str(v) for v in values] for values in owned]
    spark = df.sparkSession
    spark.dataSource.register(PublicationSource)
    # grouped for few files; AQE splits a partition that is too large for one task
    rows = df.hint("rebalance", *names).sortWithinPartitions(*names) if names and not arranged else df
    (
        rows.write.format(FORMAT)
        .option("partitions", json.dumps(names))
        .option("owned", json.dumps(others if names else [[]]))
        .option("note", json.dumps(note or {}))
        .mode("append")
        .save(path)
    )
    return versions(path)[-1]


def read_published(
    spark: SparkSession, path: str, version: int | None = None, only: Sequence[Sequence[object]] | None = None
) -> DataFrame:
    """A version of a table, by default the current one, as a Parquet scan of its files.

    ``only`` names the partitions to read. Partition columns have the type that
    they were published with, so text ``01`` stays text.
    """
    found = read_version(path, version)
    if found is None:
        raise ValueError(f"nothing is published at {path}")
    schema = StructType.fromJson(found.schema)
    asked = None if only is None else {tuple(None if v is None else str(v) for v in values) for values in only}
    root = path.rstrip("/")
    # names as they are: they hold escaped values
    names = [f"{root}/{_escaped(name)}" for values, name, _ in found.files if asked is None or tuple(values) in asked]
    if not names:
        return spark.createDataFrame([], schema)
    inside = [f for f in schema.fields if f.name not in found.partitions]
    ordered = StructType([*inside, *[schema[p] for p in found.partitions]])
    return spark.read.schema(ordered).option("basePath", f"{root}/data").parquet(*names).select(*schema.names)


def _escaped(name: str) -> str:
    """A path as Spark's readers take it: characters of globs stand for themselves."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in name)


def changed_partitions(path: str, since: int | None, now: int | None = None) -> list[tuple]:
    """Partitions whose files differ between two versions; all of them where ``since`` is None."""
    new = read_version(path, now)
    after = new.by_partition() if new else {}
    before = read_version(path, since).by_partition() if since is not None else {}
    return sorted((p for p in {*before, *after} if before.get(p) != after.get(p)), key=str)


def expire_versions(path: str, keep: int = 2) -> int:
    """Remove all but the ``keep`` newest versions, and the files that only those named; returns how many files."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    store, root = file_system(path.rstrip("/"))
    known = versions(path)
    kept = {name for n in known[-keep:] for _, name, _ in read_version(path, n).files}
    gone = {name for n in known[:-keep] for _, name, _ in read_version(path, n).files} - kept
    # versions first: a reader of an old one fails at once and not in the middle
    for n in known[:-keep]:
        store.delete_file(f"{root}/versions/{n:08d}.json")
    for name in gone:
        store.delete_file(f"{root}/{name}")
    return len(gone)
