"""WARC archives with a two-level capture index.

Writing: every page becomes one record, a gzip member of its own. Of pages with
equal payloads the one with the smallest id is a response and the others are
revisits that name it, so a payload is stored once.

Index: captures are sorted by URL key (host labels reversed, then the path).
Runs of ``BLOCK_LINES`` lines are compressed into blocks, one file of blocks
per range of keys. Beside it lies its directory: one line per block with the
block's first and last key and its byte range. A look-up searches the list of
ranges, then the range's directory, then the lines of one block, all by
bisection, and reads only that block and the records found. Many look-ups are
sorted by key first, so that each directory and block is opened once.

Files lie in the shared scratch folder, written by tasks under names of their
own. The table that a task returns names its files, and Spark keeps the table
of one attempt only; a file of a failed attempt is never named.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.llm.shared import table
from landledger.session import materialize, scratch_path

BLOCK_LINES = 1000
ARCHIVE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4
# Records that lie within this distance are read together.
GAP = 1 << 16

CAPTURE = "url_key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def url_key(url: str | None) -> str:
    """``http://blog.example.com/a?b#c`` -> ``com,example,blog)/a?b``; no ``://``: the text itself."""
    scheme, sep, rest = (url or "").partition("://")
    if not sep:
        return scheme
    host = re.match(r"[^/?#]*", rest)[0]
    tail = rest[len(host) :].partition("#")[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + tail


def _file_system(path: str):
    """(file system, path in it): any store that Arrow knows; a bare or file path is local."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    # Arrow knows Hadoop's S3 schemes under one name
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


class _Output:
    """A file that grows, made with its folder at the first byte."""

    def __init__(self, folder: str, prefix: str):
        self.path = f"{folder}/{prefix}-{uuid.uuid4().hex}"
        system, inner = _file_system(self.path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.stream, self.size = system.open_output_stream(inner), 0

    def write(self, data: bytes) -> int:
        offset = self.size
        self.stream.write(data)
        self.size += len(data)
        return offset

    def close(self):
        self.stream.close()


class _Inputs:
    """Open files for range reads, a few at a time."""

    def __init__(self, limit: int = 32):
        self.limit, self.open = limit, OrderedDict()

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path not in self.open:
            system, inner = _file_system(path)
            self.open[path] = system.open_input_file(inner)
            if len(self.open) > self.limit:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(path)
        return self.open[path].read_at(length, offset)

    def size(self, path: str) -> int:
        self.read(path, 0, 0)
        return self.open[path].size()


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def warc_record(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One record; a revisit (``refers_to`` given) has no block but tells size and digest."""
    kind = "response" if refers_to is None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        # JSON keeps line ends and NULL apart from header syntax
        ("WARC-Target-URI", json.dumps(url)),
        ("X-Page-Id", json.dumps(page_id)),
        ("X-Payload-Length", str(size)),
        ("Content-Length", str(len(payload))),
    ]
    if refers_to is not None:
        fields.append(("X-Refers-To-Page", json.dumps(refers_to)))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}\r\n".encode() + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of ``RECORD`` out of one gzip member; size and digest of a
    response are taken from its payload, those of a revisit from its header."""
    raw = zlib.decompress(data, 31)
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = block[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    if kind == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    return {
        "page_id": json.loads(fields["X-Page-Id"]), "url": json.loads(fields["WARC-Target-URI"]),
        "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": json.loads(fields.get("X-Refers-To-Page", "null")), "payload": payload,
    }


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the table of captures.

    A NULL html is an empty payload. Payloads of at least ``least_bytes`` bytes
    are stored once: rows with the smallest page_id among equal payloads are
    responses (all of them, if that id is repeated), the rest are revisits. Rows
    with a NULL page_id are revisits of an equal payload with an id, and
    responses where none has one. Other columns are ignored.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("size", F.octet_length("payload").cast("long"))
    firsts = (
        rows.filter(F.col("size") >= least_bytes)
        .groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n")
    )
    # adaptive execution splits a payload that very many pages share
    known = rows.join(firsts, "sha", "left")
    stored = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    known = known.select(
        "page_id", "url", "size", "sha",
        F.when(stored, F.col("payload")).alias("payload"),
        F.when(~stored, F.col("first")).alias("refers_to"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = None
        for batch in batches:
            found = []
            for page_id, url, size, sha, payload, refers in batch.astype(object).itertuples(index=False, name=None):
                page_id, refers = _integer(page_id), _integer(refers)
                digest = base64.b32encode(sha).decode()
                url = None if url is None or url != url else url
                data = _gzip(warc_record(page_id, url, payload or b"", digest, int(size), refers))
                if out is None:
                    out = _Output(f"{folder}/warc", "archive")
                found.append((url_key(url), page_id, out.path, out.write(data), len(data)))
                if out.size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield _frame(found, ["url_key", "page_id", "file", "offset", "length"], ["page_id"])
        if out is not None:
            out.close()

    return materialize(known.mapInPandas(write, CAPTURE), "captures")


def _integer(value):
    return None if value is None or value != value else int(value)


def _frame(rows: list, columns: list[str], nullable: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    for c in nullable:
        frame[c] = pd.array([r[columns.index(c)] for r in rows], dtype="Int64")
    return frame


@dataclass
class CaptureIndex:
    """``ranges``: one row per file of blocks (at most one per shuffle partition)."""

    ranges: DataFrame
    captures: DataFrame


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort the captures and write blocks and directories."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, lines, directory, first, last = None, [], [], None, None

        def flush():
            nonlocal lines
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), LEVEL)
            offset = blocks.write(data)
            directory.append([lines[0][0], lines[-1][0], offset, len(data), len(lines)])
            lines = []

        for batch in batches:
            for row in batch.astype(object).itertuples(index=False, name=None):
                if blocks is None:
                    blocks, first = _Output(f"{folder}/index", "blocks"), row[0]
                last = row[0]
                lines.append([row[0], _integer(row[1]), row[2], int(row[3]), int(row[4])])
                if len(lines) == block_lines:
                    flush()
        if blocks is not None:
            if lines:
                flush()
            blocks.close()
            listing = _Output(f"{folder}/index", "directory")
            listing.write("\n".join(json.dumps(x) for x in directory).encode())
            listing.close()
            yield pd.DataFrame(
                [(first, last, blocks.path, listing.path, len(directory))],
                columns=["first_key", "last_key", "blocks", "directory", "n_blocks"],
            )

    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["url_key", "page_id", "file", "offset"]
    ordered = captures.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "url_key", "page_id", "file", "offset", "length"
    )
    ranges = ordered.mapInPandas(
        write, "first_key string, last_key string, blocks string, directory string, n_blocks long"
    )
    return CaptureIndex(materialize(ranges, "ranges"), captures)


def _block(inputs: _Inputs, path: str, entry: list) -> list[list]:
    data = zlib.decompress(inputs.read(path, entry[2], entry[3]))
    return [json.loads(line) for line in data.decode().split("\n")]


def _directory(inputs: _Inputs, path: str) -> list[list]:
    return [json.loads(line) for line in inputs.read(path, 0, inputs.size(path)).decode().split("\n")]


def _records(inputs: _Inputs, lines: list[list]) -> Iterator[dict]:
    """The records of index lines. Neighbours in a file are read together."""
    run: list[list] = []

    def read() -> Iterator[dict]:
        begin = run[0][3]
        data = inputs.read(run[0][2], begin, run[-1][3] + run[-1][4] - begin)
        for line in run:
            yield parse_record(data[line[3] - begin : line[3] - begin + line[4]])

    for line in sorted(lines, key=lambda x: (x[2], x[3])):
        if run and (line[2] != run[-1][2] or line[3] - run[-1][3] - run[-1][4] > GAP or line[3] - run[0][3] > 16 * GAP):
            yield from read()
            run = []
        run.append(line)
    if run:
        yield from read()


def _record_frame(records: list[dict]) -> pd.DataFrame:
    names = [f.split()[0] for f in RECORD.split(", ")]
    return _frame([tuple(r[n] for n in names) for r in records], names, ["page_id", "refers_to"])


def read_all(index: CaptureIndex) -> DataFrame:
    """Every record of the archives, found block by block through the index."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs = _Inputs()
        for batch in batches:
            for path, directory in zip(batch["blocks"], batch["directory"]):
                entries = _directory(inputs, directory)
                yield pd.DataFrame({"blocks": path, "offset": [e[2] for e in entries], "length": [e[3] for e in entries]})

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs = _Inputs()
        for batch in batches:
            for path, offset, length in zip(batch["blocks"], batch["offset"], batch["length"]):
                held, size = [], 0
                for record in _records(inputs, _block(inputs, path, [None, None, int(offset), int(length)])):
                    held.append(record)
                    size += len(record["payload"])
                    if size > 8_000_000:
                        yield _record_frame(held)
                        held, size = [], 0
                if held:
                    yield _record_frame(held)

    n = int(index.ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = index.ranges.select("blocks", "directory").mapInPandas(blocks, "blocks string, offset long, length long")
    return listed.repartition(n).mapInPandas(records, RECORD)


def look_up(index: CaptureIndex, urls: DataFrame) -> DataFrame:
    """Records whose URL key equals that of a row of ``urls`` (url), one per such pair.

    Only the list of ranges goes to the tasks; it has at most one row per
    shuffle partition.
    """
    ranges = [tuple(r) for r in index.ranges.orderBy("first_key", "last_key").select("first_key", "last_key", "blocks", "directory").collect()]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs, firsts = _Inputs(), [r[0] for r in ranges]
        for batch in batches:
            for url in batch["url"]:
                key = url_key(url)
                at = bisect.bisect_right(firsts, key)
                while at > 0 and ranges[at - 1][1] >= key:
                    at -= 1
                    entries = _directory(inputs, ranges[at][3])
                    block = bisect.bisect_left([e[1] for e in entries], key)
                    while block < len(entries) and entries[block][0] <= key:
                        lines = _block(inputs, ranges[at][2], entries[block])
                        keys = [x[0] for x in lines]
                        mine = lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
                        if mine:
                            yield _record_frame(list(_records(inputs, mine)))
                        block += 1

    return urls.select("url").mapInPandas(search, RECORD)


def visits(index: CaptureIndex, urls: DataFrame) -> DataFrame:
    """(blocks, offset, length, key) for every block that may hold a key of ``urls`` (url), each key once.

    Keys are sorted and dealt to the tasks by range. A task bisects the list of
    ranges and the sparse directory for each of its keys; as neighbours follow
    each other, it opens every directory once.
    """
    ranges = [tuple(r) for r in index.ranges.orderBy("first_key", "last_key").select("first_key", "last_key", "blocks", "directory").collect()]

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": sorted({url_key(u) for u in batch["url"]})})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs, firsts, opened = _Inputs(), [r[0] for r in ranges], OrderedDict()
        for batch in batches:
            found = []
            for key in batch["key"]:
                at = bisect.bisect_right(firsts, key)
                while at > 0 and ranges[at - 1][1] >= key:
                    at -= 1
                    _, _, blocks, directory = ranges[at]
                    if directory not in opened:
                        entries = _directory(inputs, directory)
                        opened[directory] = entries, [e[1] for e in entries]
                        if len(opened) > 4:
                            opened.popitem(last=False)
                    entries, lasts = opened[directory]
                    block = bisect.bisect_left(lasts, key)
                    while block < len(entries) and entries[block][0] <= key:
                        found.append((blocks, entries[block][2], entries[block][3], key))
                        block += 1
            yield pd.DataFrame(found, columns=["blocks", "offset", "length", "key"])

    n = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = urls.select("url").distinct().mapInPandas(keys, "key string").distinct()
    dealt = distinct.repartitionByRange(n, "key").sortWithinPartitions("key")
    return dealt.mapInPandas(search, "blocks string, offset long, length long, key string")


def look_up_keys(index: CaptureIndex, urls: DataFrame) -> DataFrame:
    """Records whose URL key equals that of some row of ``urls`` (url), each record once.

    The blocks to visit are dealt over all tasks, so a key of very many captures
    is as many pieces of work as it has blocks. A block is read once, and each of
    its keys is bisected in its lines. Records of many keys are handed over together.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs, at, lines, keys = _Inputs(), None, [], []
        held, size = [], 0
        for batch in batches:
            for path, offset, length, key in batch[["blocks", "offset", "length", "key"]].itertuples(index=False, name=None):
                if (path, offset) != at:
                    at, lines = (path, offset), _block(inputs, path, [None, None, int(offset), int(length)])
                    keys = [x[0] for x in lines]
                for record in _records(inputs, lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]):
                    held.append(record)
                    size += len(record["payload"])
                    if size > 8_000_000 or len(held) == 10_000:
                        yield _record_frame(held)
                        held, size = [], 0
        if held:
            yield _record_frame(held)

    n = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = visits(index, urls).repartition(n, "blocks", "offset").sortWithinPartitions("blocks", "offset", "key")
    return wanted.mapInPandas(records, RECORD)


def archive(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> CaptureIndex:
    folder = scratch_path(spark, "captures")
    return build_index(write_archives(pages, folder, least_bytes), folder)


def op6_capture_index(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = look_up_keys(archive(spark, pages), pages)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
