"""Token counts of documents from flat token files, by scanning for separators.

A token file is nothing but token ids of a fixed width, documents one after the
other, each closed by the end-of-document id. There is no index. Files are read
in blocks of fixed size by independent tasks; each finds the separators of its
block with one vectorised comparison. A document that runs over block borders is
stitched by a prefix scan over one summary row per block: how many separators
lie before a block, and where the last of them is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landledger.llm.capture_index import _Inputs, _Output
from landledger.llm.shared import small_batches, table
from landledger.session import materialize, scratch_path

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the vocabulary's tokenizer cuts a text before it merges bytes (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 20
FILE_BYTES = 1 << 30
# A block of empty documents has a piece per token: pieces are handed over in frames of so many.
PIECE_ROWS = 10_000


# White space of the pattern above (Unicode's White_Space) in runs that, a hundred times
# longer, pass the stack of its engine. Texts below the length have no such run.
LONG_SPACE = re.compile("[\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{1000,}")
LONG_TEXT = 100_000


def encode_whole(encoding, text: str) -> list[int]:
    """Ids of a text by a ``tiktoken`` encoding with PATTERN, also with white space of any length.

    A run of white space is one piece up to its last character, which goes with
    what follows; at the end of the text it is one piece.
    """
    ids, at = [], 0
    for run in LONG_SPACE.finditer(text) if len(text) >= LONG_TEXT else ():
        ids += encoding.encode_ordinary(text[at : run.start()])
        at = run.end() - (run.end() < len(text))
        ids += encoding._encode_single_piece(text[run.start() : at])
    return ids + encoding.encode_ordinary(text[at:]) if at else encoding.encode_ordinary(text)


def token_type(end_of_document: int = END_OF_DOCUMENT) -> str:
    """Two bytes a token where all ids fit, else four; little-endian."""
    return "<u2" if end_of_document < 1 << 16 else "<u4"


def write_token_files(docs: DataFrame, folder: str, ranks: str = RANKS, end: int = END_OF_DOCUMENT) -> DataFrame:
    """Tokenize every text of ``docs`` (doc_id, text) into flat files below ``folder``.

    Returns (file, ordinal, doc_id, file_tokens): which document is the
    ordinal-th of a file; file_tokens is set on a file's last row. A NULL text
    has no tokens. Special strings in texts are ordinary text. The vocabulary
    file is read by the driver and shipped to the tasks.
    """
    with open(ranks, "rb") as f:
        pairs = [line.split() for line in f]
    vocabulary = {base64.b64decode(token): int(rank) for token, rank in pairs}
    kind = token_type(end)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoder = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        out, ordinal, rows = None, 0, []

        def close():
            nonlocal out
            out.close()
            rows[-1] = (*rows[-1][:3], out.size // np.dtype(kind).itemsize)
            out = None

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype(object), batch["text"]):
                if out is None:
                    out, ordinal = _Output(folder, "tokens"), 0
                ids = encode_whole(encoder, text) if text else []
                out.write(np.array([*ids, end], kind).tobytes())
                rows.append((out.path, ordinal, None if doc_id != doc_id or doc_id is None else int(doc_id), None))
                ordinal += 1
                if out.size >= FILE_BYTES:
                    close()
            # the last row waits until it is known whether it closes the file
            if len(rows) > 1:
                yield _frame(rows[:-1])
                del rows[:-1]
        if out is not None:
            close()
        if rows:
            yield _frame(rows)

    written = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        write, "file string, ordinal long, doc_id long, file_tokens long"
    )
    with small_batches(docs.sparkSession):
        return materialize(written, "manifest")


def _frame(rows: list) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["file", "ordinal", "doc_id", "file_tokens"])
    for c in ("doc_id", "file_tokens"):
        frame[c] = pd.array(frame[c].tolist(), dtype="Int64")
    return frame


def scan_block(tokens: np.ndarray, end: int) -> np.ndarray:
    """Lengths of the pieces that separators cut a block into: one more than separators."""
    at = np.flatnonzero(tokens == end)
    return np.diff(np.concatenate([[-1], at, [len(tokens)]])) - 1


def count_tokens(files: DataFrame, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in ``files`` (file, file_tokens).

    Tokens after a file's last separator are a document if there are any. An
    empty file has no document. Repeated files count once.
    """
    kind = token_type(end)
    width = np.dtype(kind).itemsize

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs = _Inputs()
        for batch in batches:
            for file, block, n in zip(batch["file"], batch["block"], batch["tokens"]):
                raw = inputs.read(file, int(block) * block_tokens * width, int(n) * width)
                lengths = scan_block(np.frombuffer(raw, kind), end)
                for at in range(0, len(lengths), PIECE_ROWS):
                    tokens = lengths[at : at + PIECE_ROWS]
                    piece = np.arange(at, at + len(tokens))
                    yield pd.DataFrame({
                        "file": file, "block": block, "piece": piece,
                        "tokens": tokens, "last": piece == len(lengths) - 1,
                    })

    last_block = F.floor((F.col("file_tokens") - 1) / block_tokens)
    blocks = (
        files.select("file", "file_tokens").distinct().filter("file_tokens > 0")
        .select("file", "file_tokens", F.explode(F.sequence(F.lit(0), last_block)).alias("block"))
        .select("file", "block", F.least(F.lit(block_tokens), F.col("file_tokens") - F.col("block") * block_tokens).alias("tokens"))
    )
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one row per block; dealt evenly, since a file may have very many blocks
    pieces = materialize(
        blocks.repartition(n).mapInPandas(scan, "file string, block long, piece long, tokens long, last boolean"), "pieces"
    )
    # the prefix scan: one row per block
    ends = pieces.filter("last").select("file", "block", F.col("piece").alias("separators"), F.col("tokens").alias("tail"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # tokens that wait for their separator: the tail of the last block that has
    # one, and all of the blocks after it
    total = F.sum("tail").over(before)
    # ``tail`` of a block without separators is the whole block
    since = F.max(F.when(F.col("separators") > 0, F.struct("block", F.col("running") - F.col("tail")))).over(before)
    running = F.sum("tail").over(before.rowsBetween(Window.unboundedPreceding, 0))
    scanned = (
        ends.withColumn("running", running)
        .withColumn("first_ordinal", F.coalesce(F.sum("separators").over(before), F.lit(0)))
        .withColumn("waiting", F.coalesce(total, F.lit(0)) - F.coalesce(since.getField("col2"), F.lit(0)))
        .withColumn("final", F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull())
        .select("file", "block", "first_ordinal", "waiting", "final")
    )
    whole = pieces.join(scanned, ["file", "block"]).withColumn(
        "n_tokens", F.col("tokens") + F.when(F.col("piece") == 0, F.col("waiting")).otherwise(0)
    )
    kept = whole.filter(~F.col("last") | (F.col("final") & (F.col("n_tokens") > 0)))
    return kept.select("file", (F.col("first_ordinal") + F.col("piece")).alias("ordinal"), "n_tokens")


def op9_separator_scan(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    manifest = write_token_files(docs, scratch_path(spark, "tokens"))
    counts = count_tokens(manifest.filter("file_tokens IS NOT NULL"))
    return manifest.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
