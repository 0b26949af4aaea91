"""Exact duplicates by a tree-merge of sorted digest runs.

*Runs.* Every task hashes its texts and cuts them into runs of bounded length,
sorted by digest, with one entry per different text: the smallest identifier of
the run and how many rows have the text.

*Rounds.* There are 2^bits nodes, and the leading bits of a digest name the node
where its entries must end. In each round the nodes exchange runs in groups of
2^FAN_BITS that differ in one digit of their number (a binomial exchange): each
cuts its run by the next digit of the digests, keeps its own part and sends the
others one part each. Whatever a node receives is merged at once, so a text that
is repeated a million times is one entry per run from the first round on, and
never more than one entry per sender later. After the last round every digest
has one entry.

*Verification.* A key is the SHA-256 of the normalised text, a second digest of
another family (XXH3) and the length in bytes. Entries are merged only where all
three agree.

*The way back.* Results return by (run, key): a run's smallest row asks for its
key, and the rows of that run ask the run. No key is hotter than a run is long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.shared import small_batches, table
from landledger.session import materialize

# Rows of a run at most, entries that a node should end with, and bits of a node's number per round.
RUN_ROWS, NODE_ENTRIES, FAN_BITS = 1 << 17, 1 << 17, 3

# SHA-256, XXH3 and length, big-endian, so that keys sort by their leading bits.
KEY_BYTES = 48
ENTRY = np.dtype([("key", f"S{KEY_BYTES}"), ("missing", "?"), ("id", "<i8"), ("place", "<i8"), ("rows", "<i8")])
LEAF = "run long, place long, doc_id long, key binary, rows long"


def normalised(raw: bytes) -> bytes:
    """A text in UTF-8 with every run of ASCII white space as one space."""
    words = raw.split()  # bytes split at the six ASCII white-space characters only
    if not words:
        return b" " if raw else b""
    return (b" " if raw[:1].isspace() else b"") + b" ".join(words) + (b" " if raw[-1:].isspace() else b"")


def text_key(raw: bytes) -> bytes:
    text = normalised(raw)
    return hashlib.sha256(text).digest() + xxhash.xxh3_64_digest(text) + len(text).to_bytes(8, "big")


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """One sorted run of several: per key the smallest identifier and the sum of the rows.

    The stable sort finds the runs and merges them. NULL identifiers come last;
    rows of one identifier are told apart by their place.
    """
    entries = np.concatenate(runs) if runs else np.empty(0, ENTRY)
    if not len(entries):
        return entries
    entries = entries[np.argsort(entries["key"], kind="stable")]
    new = np.concatenate([[True], entries["key"][1:] != entries["key"][:-1]])
    order = np.lexsort((entries["place"], entries["id"], entries["missing"], np.cumsum(new)))
    least = entries[order][new]
    least["rows"] = np.add.reduceat(entries["rows"], np.flatnonzero(new))
    return least


def _raw_keys(entries: np.ndarray) -> list[bytes]:
    raw = np.ascontiguousarray(entries["key"]).tobytes()
    return [raw[k : k + KEY_BYTES] for k in range(0, len(raw), KEY_BYTES)]


def _ids(entries: np.ndarray) -> pa.Array:
    return pa.array(entries["id"], pa.int64(), mask=np.ascontiguousarray(entries["missing"]))


def leaf_rows(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per document, sorted within its run; ``rows`` is set on the smallest row of each key of a run."""

    def leaves(held: list, run: int) -> pa.RecordBatch:
        entries = np.array(held, ENTRY)
        first = merge_runs([entries])
        entries = entries[np.argsort(entries["key"], kind="stable")]
        rows = np.zeros(len(entries), np.int64)
        # the entry of a key names the place of its smallest row
        at = np.argsort(entries["place"])
        rows[at[np.searchsorted(entries["place"][at], first["place"])]] = first["rows"]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(entries), run)), pa.array(entries["place"]), _ids(entries),
                pa.array(_raw_keys(entries), pa.binary()), pa.array(rows, mask=rows == 0),
            ],
            names=["run", "place", "doc_id", "key", "rows"],
        )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, doc_id in enumerate(ids):
                missing = doc_id is None
                held.append((text_key(texts[i].as_py() or b""), missing, 0 if missing else doc_id, place, 1))
                place += 1
                if len(held) >= run_rows:
                    yield leaves(held, held[0][3])
                    held = []
        if held:
            yield leaves(held, held[0][3])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(hashed, LEAF)


def _digits(bits: int) -> list[tuple[int, int]]:
    """(bits below, width) of each round's digit, counted from the leading bits of a key."""
    return [(max(bits - at - FAN_BITS, 0), min(FAN_BITS, bits - at)) for at in range(0, bits, FAN_BITS)]


def _parts(run: np.ndarray, node: int, bits: int, round_: int) -> pa.RecordBatch:
    """(node, run): a sorted run cut by the digit of this round, each part with the node it goes to."""
    below, width = _digits(bits)[round_]
    at = FAN_BITS * round_  # digits stand in a node's number from the low end
    leading = np.frombuffer(np.ascontiguousarray(run["key"]).tobytes(), ">u8").reshape(-1, KEY_BYTES // 8)[:, 0]
    digit = (leading.astype(np.uint64) >> np.uint64(64 - bits + below)).astype(np.int64) & ((1 << width) - 1)
    nodes, parts = [], []
    for d in np.unique(digit).tolist():
        nodes.append(node & ~(((1 << width) - 1) << at) | (d << at))
        parts.append(run[digit == d].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(parts, pa.binary())], names=["node", "run"])


def first_parts(leaf: DataFrame, bits: int, run_rows: int = RUN_ROWS) -> DataFrame:
    """The first exchange: entries of the leaf runs, read in the order in which they were written."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def send():
            # any node may start with any run; spread them evenly
            node = xxhash.xxh3_64_intdigest(int(held[0]["place"][0]).to_bytes(8, "little")) & ((1 << bits) - 1)
            return _parts(merge_runs(held), node, bits, 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            entries = np.empty(batch.num_rows, ENTRY)
            entries["key"] = np.frombuffer(b"".join(batch.column(2).to_pylist()), f"S{KEY_BYTES}")
            entries["missing"] = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            entries["id"] = batch.column(1).fill_null(0).to_numpy()
            entries["place"], entries["rows"] = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            held.append(entries)
            count += len(entries)
            if count >= run_rows:
                yield send()
                held, count = [], 0
        if held:
            yield send()

    entries = leaf.filter("rows > 0").select("place", "doc_id", "key", "rows")
    return entries.mapInArrow(pack, "node long, run binary")


def merge_round(parts: DataFrame, bits: int, round_: int) -> DataFrame:
    """What each node received becomes one run, which is sent on, or returned as rows after the last round."""
    last = round_ == len(_digits(bits)) - 1

    def merge(group: pa.Table) -> pa.Table:
        node = group.column("node")[0].as_py()
        run = merge_runs([np.frombuffer(raw.as_py(), ENTRY) for raw in group.column("run")])
        if not last:
            return pa.Table.from_batches([_parts(run, node, bits, round_ + 1)])
        return pa.table({
            "key": pa.array(_raw_keys(run), pa.binary()), "keep_id": _ids(run),
            "keep_place": pa.array(run["place"]), "group_size": pa.array(run["rows"]),
        })

    schema = "key binary, keep_id long, keep_place long, group_size long" if last else "node long, run binary"
    return parts.groupBy("node").applyInArrow(merge, schema)


def exact_duplicates(docs: DataFrame, run_rows: int = RUN_ROWS, node_entries: int = NODE_ENTRIES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after each run of ASCII white space has
    become one space; NULL counts as empty. Of equal texts the row of smallest
    doc_id stays. Rows with a NULL doc_id stay only where all rows of the text
    have none, and of rows that repeat doc_id and text the first one read
    stays, so every text keeps exactly one row. Other columns are not read. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        leaf = materialize(leaf_rows(docs, run_rows), "leaves")
    entries = leaf.filter("rows > 0").count()
    nodes = max(2, entries // node_entries, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = (nodes - 1).bit_length()
    runs = first_parts(leaf, bits, run_rows)
    for round_ in range(len(_digits(bits))):
        runs = merge_round(runs, bits, round_)
    repeated = materialize(runs.filter("group_size > 1"), "repeated")
    asked = leaf.filter("rows > 0").select("run", "key").join(repeated, "key")
    return leaf.select("run", "place", "doc_id", "key").join(asked, ["run", "key"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_place") == F.col("place"), F.lit(True)).alias("kept"),
        F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256"),
    )


OP11_SQL = r"""
WITH normal AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM normal JOIN groups USING (text_sha256)
"""


def op11_digest_runs(spark, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
