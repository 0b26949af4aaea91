"""Alignment of two tokenizers over a corpus, with an identity-map fast path.

Every text is encoded by tokenizer A and by tokenizer B. Byte offsets where
tokens of both end cut the text into groups, and all pairs of an A token and a B
token of one group are linked. A pair's count is the number of documents that
hold it.

*Identity map.* One array gives for every A id the B id of the same bytes. A
group of one token on each side that agrees with the map needs no pair: its
documents are counted in a vector over A's vocabulary, kept by the task and
handed on once. Only pairs of other, irregular groups enter the pair shuffle,
combined in the map tasks first.

*Second pass.* Each document kept its distinct ids and pairs with how often it
links them. Identity counts, the highest count of every A id, and the most
frequent irregular pairs (a fixed number at most) are looked up in arrays; what is
left is joined by pair, where no key is hot any more.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.shared import small_batches, table
from landledger.llm.token_counts import PATTERN, encode_whole
from landledger.session import materialize

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
# Irregular pairs that are looked up in an array at most (16 bytes each).
HOT_PAIRS = 1 << 17
# Texts are aligned together up to this many bytes, and groups of more pairs than this by distinct ids.
BLOCK_BYTES, GROUP_PAIRS = 2_000_000, 4096
ID_BITS = 20

ALIGNED = (
    "place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, same_n array<long>, pairs array<long>, pairs_n array<long>, documents array<long>"
)
SUMS = "place long, count_sum long, n_best long, cold array<struct<pair:long,n:long,best:long>>"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the other bytes in order
    for the code points from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE in the JSON format of the ``tokenizers`` library."""

    def __init__(self, raw: bytes):
        self.raw, spec = raw, json.loads(raw)
        letters, vocabulary = byte_letters(), spec["model"]["vocab"]
        self.size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes: list[bytes] = [b""] * self.size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        self.ranked = self._ranked(spec)

    def _ranked(self, spec: dict) -> bool:
        """Whether ids order the merges, so that ids alone define the encoding."""
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(p)] for p in pairs]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        whole = len(made) + 256 == len(model["vocab"]) and sorted(made) == made and (not made or made[0] >= 256)
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        return bool(plain and whole and usual and spec["normalizer"] is None)

    def encoder(self) -> Callable[[list[str]], list[list[int]]]:
        """Function from texts to ids, without special tokens; made in the task."""
        if self.ranked:
            import tiktoken

            ranks = {token: i for i, token in enumerate(self.bytes) if token}
            ranked = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            return lambda texts: [encode_whole(ranked, t) for t in texts]
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(self.raw.decode("utf-8"))
        whole.encode_special_tokens = True
        return lambda texts: [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a ``sentencepiece`` model, which adds a space in front of the text."""

    def __init__(self, raw: bytes):
        import sentencepiece

        self.raw = raw
        model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.size = model.get_piece_size()
        self.bytes: list[bytes] = []
        # byte pieces last, so that a piece of the same bytes is preferred
        self.byte_ids = [i for i in range(self.size) if model.is_byte(i)]
        self.named = [i for i in range(self.size) if model.is_control(i) or model.is_unknown(i)]
        byte_ids = set(self.byte_ids)
        for i in range(self.size):
            piece = model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if i in byte_ids else piece.replace("▁", " ").encode())

    def encoder(self) -> Callable[[list[str]], list[list[int]]]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=self.raw)
        return lambda texts: model.encode(texts, num_threads=1)


def identity_map(a: ByteLevel, b: Pieces) -> np.ndarray:
    """For every A id the B id of the same bytes, or -1."""
    skipped = set(b.named)
    by_bytes = {b.bytes[i]: i for i in b.byte_ids}
    by_bytes |= {token: i for i, token in enumerate(b.bytes) if i not in skipped and i not in set(b.byte_ids)}
    return np.array([by_bytes.get(token, -1) if token else -1 for token in a.bytes], np.int64)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of their numbers."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def group_pairs(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, A id, B id) keys of groups, with how often each is linked.

    ``a`` and ``b`` hold the groups' ids one after the other, ``n_a`` and
    ``n_b`` their numbers. A large group goes by its distinct ids.
    """
    start_a, start_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    large = n_a * n_b > GROUP_PAIRS
    keys, ns = [], []
    small = np.flatnonzero(~large)
    if len(small):
        # every A token of a small group, once per B token of the group
        reps = np.repeat(n_b[small], n_a[small])
        at_a = np.arange(int(n_a[small].sum())) - np.repeat(np.cumsum(n_a[small]) - n_a[small], n_a[small])
        tokens = np.repeat(start_a[small], n_a[small]) + at_a
        pair_group = np.repeat(np.repeat(small, n_a[small]), reps)
        at_b = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
        keys.append((doc[pair_group] << 2 * ID_BITS) | (a[np.repeat(tokens, reps)] << ID_BITS) | b[start_b[pair_group] + at_b])
        ns.append(np.ones(len(pair_group), np.int64))
    for g in np.flatnonzero(large).tolist():
        ids_a, count_a = np.unique(a[start_a[g] : start_a[g] + n_a[g]], return_counts=True)
        ids_b, count_b = np.unique(b[start_b[g] : start_b[g] + n_b[g]], return_counts=True)
        keys.append(((doc[g] << 2 * ID_BITS) | (ids_a[:, None] << ID_BITS) | ids_b[None, :]).ravel())
        ns.append((count_a[:, None] * count_b[None, :]).ravel())
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _summed(np.concatenate(keys), np.concatenate(ns))


class Aligner:
    """Aligns blocks of texts; made once per task."""

    def __init__(self, a: ByteLevel, b: Pieces, same: np.ndarray):
        if max(a.size, b.size) > 1 << ID_BITS:
            raise ValueError(f"vocabularies of more than {1 << ID_BITS} ids are not supported")
        self.a, self.b, self.same = a, b, same
        self.encode_a, self.encode_b = a.encoder(), b.encoder()
        self.length_a = np.array([len(t) for t in a.bytes], np.int64)
        self.length_b = np.array([len(t) for t in b.bytes], np.int64)
        self.shown_a, self.shown_b = self._shown(a.size, ",|"), self._shown(b.size, ",;")
        self.documents = np.zeros(a.size, np.int64)

    @staticmethod
    def _shown(size: int, ends: str) -> np.ndarray:
        """The text of 2 * id (within a side) and of 2 * id + 1 (its last token)."""
        shown = np.empty(2 * size, object)
        shown[:] = [f"{i}{end}" for i in range(size) for end in ends]
        return shown

    def align(self, texts: list[str | None]) -> dict:
        """Columns of ALIGNED from n_a on, as arrays or lists by document."""
        size = len(texts)
        held = [k for k, t in enumerate(texts) if t]
        ids_a = self.encode_a([" " + texts[k] for k in held]) if held else []
        ids_b = self.encode_b([texts[k] for k in held]) if held else []
        docs, flat_a, flat_b = [], [], []
        of_a, of_b = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        for k, x, y in zip(held, ids_a, ids_b):
            raw = b" " + texts[k].encode("utf-8", "replace")
            if b"".join(map(of_a, x)) == raw and b"".join(map(of_b, y)) == raw:
                docs.append(k)
                flat_a.append(np.array(x, np.int64))
                flat_b.append(np.array(y, np.int64))
        out = {c: np.zeros(size, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        out["groups_sha256"] = [""] * size
        if not docs:
            none = np.empty(0, np.int64)
            return out | {"same": (none, none, none), "pairs": (none, none, none)}
        out["n_a"][docs], out["n_b"][docs] = [len(x) for x in flat_a], [len(y) for y in flat_b]
        doc_of_a = np.repeat(docs, [len(x) for x in flat_a])
        a, b = np.concatenate(flat_a), np.concatenate(flat_b)
        # both sides of a document have the same bytes, so all can lie on one axis
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        last_a = end_b[np.searchsorted(end_b, end_a)] == end_a
        last_b = end_a[np.searchsorted(end_a, end_b)] == end_b
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n_a, n_b, doc = np.bincount(group_a), np.bincount(group_b), doc_of_a[last_a]
        out["n_groups"] = np.bincount(doc, minlength=size).astype(np.int64)
        np.add.at(out["n_links"], doc, n_a * n_b)

        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown = np.concatenate([self.shown_a[2 * a + last_a], self.shown_b[2 * b + last_b]])[order].tolist()
        at = 0
        for k, x, y in zip(docs, flat_a, flat_b):
            text = "".join(shown[at : at + len(x) + len(y)])
            out["groups_sha256"][k] = hashlib.sha256(text[:-1].encode()).hexdigest()
            at += len(x) + len(y)

        first_a, first_b = a[np.cumsum(n_a) - n_a], b[np.cumsum(n_b) - n_b]
        regular = (n_a == 1) & (n_b == 1) & (self.same[first_a] == first_b)
        odd_a, odd_b = ~regular[group_a], ~regular[group_b]
        keys, n = group_pairs(a[odd_a], b[odd_b], n_a[~regular], n_b[~regular], doc[~regular])
        # an identity pair inside an irregular group is counted with the others of its id
        id_a, id_b = (keys >> ID_BITS) & ((1 << ID_BITS) - 1), keys & ((1 << ID_BITS) - 1)
        also = self.same[id_a] == id_b
        mine = (doc[regular] << ID_BITS) | first_a[regular]
        more = ((keys[also] >> 2 * ID_BITS) << ID_BITS) | id_a[also]
        mine, mine_n = _summed(np.concatenate([mine, more]), np.concatenate([np.ones(len(mine), np.int64), n[also]]))
        ids = mine & ((1 << ID_BITS) - 1)
        self.documents += np.bincount(ids, minlength=len(self.documents))
        keys, n = keys[~also], n[~also]
        pairs = (id_a[~also] << 32) | id_b[~also]
        return out | {"same": (mine >> ID_BITS, ids, mine_n), "pairs": (keys >> 2 * ID_BITS, pairs, n)}


def _lists(doc: np.ndarray, values: np.ndarray, size: int, kind: pa.DataType) -> pa.ListArray:
    """One list per document from values in document order."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=size))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()).cast(kind))


def aligned_rows(docs: DataFrame, a: ByteLevel, b: Pieces) -> DataFrame:
    """ALIGNED: one row per document, and one row per task with its vector of document counts."""
    same = identity_map(a, b)
    names = [f.split()[0] for f in ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b, same)
        place = TaskContext.get().partitionId() << 33

        def block(ids: list, texts: list) -> pa.RecordBatch:
            nonlocal place
            found = aligner.align(texts)
            size = len(ids)
            places = np.arange(place, place + size)
            place += size
            columns = [pa.array(places), pa.array(ids, pa.int64())]
            columns += [pa.array(found[c]) for c in ("n_a", "n_b", "n_groups", "n_links")]
            columns.append(pa.array(found["groups_sha256"]))
            for name, kind in (("same", pa.int32()), ("pairs", pa.int64())):
                doc, values, n = found[name]
                columns += [_lists(doc, values, size, kind), _lists(doc, n, size, pa.int64())]
            columns.append(pa.nulls(size, pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            ids, texts, begin, held = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0, 0
            for at, text in enumerate(texts):
                held += len(text or "")
                if held >= BLOCK_BYTES:
                    yield block(ids[begin : at + 1], texts[begin : at + 1])
                    begin, held = at + 1, 0
            if begin < len(ids):
                yield block(ids[begin:], texts[begin:])
        if aligner.documents.any():
            row = dict.fromkeys(names) | {"documents": aligner.documents.tolist()}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    kinds = {"groups_sha256": pa.string(), "same": pa.list_(pa.int32())}
    kinds |= dict.fromkeys(("same_n", "pairs", "pairs_n", "documents"), pa.list_(pa.int64()))
    schema = pa.schema([(name, kinds.get(name, pa.int64())) for name in names])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def _by_id(rows: list, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for i, n in rows:
        out[i] = n
    return out


def hot_pairs(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(least count, pairs, counts) of the most frequent pairs, at most ``most`` of them."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(power.alias("power")).count().collect())  # one row per power of two
    kept, total = 64, 0
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > most:
            break
        kept = p
    if kept == 64:
        return 1 << 62, np.empty(0, np.int64), np.empty(0, np.int64)
    found = counts.filter(F.col("n") >= 1 << kept).orderBy("pair").toPandas()
    return 1 << kept, found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def document_sums(aligned: DataFrame, identity: np.ndarray, best: np.ndarray, pairs: np.ndarray, counts: np.ndarray) -> DataFrame:
    """SUMS of every document over what the arrays hold, and its other pairs with the highest count of their A id."""

    def total(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
        running = np.concatenate([[0], np.cumsum(values)])
        return pa.array(running[offsets[1:]] - running[offsets[:-1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            same, same_n, pair, pair_n = (batch.column(k) for k in range(1, 5))

            def flat(column):
                return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

            at_same = same.offsets.to_numpy().astype(np.int64) - same.offsets[0].as_py()
            at_pair = pair.offsets.to_numpy().astype(np.int64) - pair.offsets[0].as_py()
            ids, n, key, m = flat(same), flat(same_n), flat(pair), flat(pair_n)
            known = np.zeros(len(key), np.int64)
            if len(pairs) and len(key):
                at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                known = np.where(pairs[at] == key, counts[at], 0)
            highest = best[key >> 32]
            sums = np.asarray(total(at_same, n * identity[ids])) + np.asarray(total(at_pair, m * known))
            top = np.asarray(total(at_same, n * (identity[ids] == best[ids])))
            top = top + np.asarray(total(at_pair, m * ((known > 0) & (known == highest))))
            cold = known == 0
            left = np.concatenate([[0], np.cumsum(cold)])[at_pair].astype(np.int32)
            struct = pa.StructArray.from_arrays(
                [pa.array(key[cold]), pa.array(m[cold]), pa.array(highest[cold])], names=["pair", "n", "best"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums), pa.array(top), pa.ListArray.from_arrays(pa.array(left), struct)],
                names=["place", "count_sum", "n_best", "cold"],
            )

    return aligned.select("place", "same", "same_n", "pairs", "pairs_n").mapInArrow(run, SUMS)


def align_tokens(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B, most_hot: int = HOT_PAIRS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``a`` and ``b`` are vocabulary files, read by the driver. NULL and empty
    texts, and texts whose tokens do not give their bytes back, have no tokens:
    zeros and an empty groups_sha256. Every row is a document of its own, also
    where rows repeat a doc_id or have none. Special strings in texts are
    ordinary text. Other columns are not read. An empty table gives no rows.
    """
    with open(a, "rb") as f:
        first = ByteLevel(f.read())
    with open(b, "rb") as f:
        second = Pieces(f.read())
    spark = docs.sparkSession
    with small_batches(spark):
        aligned = materialize(aligned_rows(docs, first, second), "aligned")
        rows = aligned.filter("place IS NOT NULL")
        vectors = aligned.filter("documents IS NOT NULL").select(F.posexplode("documents").alias("id", "n")).filter("n > 0")
        # one number per id of a vocabulary
        identity = _by_id(vectors.groupBy("id").agg(F.sum("n").alias("n")).collect(), first.size)
        counts = materialize(
            rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair_counts"
        )
        highest = counts.groupBy(F.shiftright("pair", 32).alias("id")).agg(F.max("n").alias("n"))
        best = np.maximum(identity, _by_id(highest.collect(), first.size))
        least, pairs, known = hot_pairs(counts, most_hot)
        sums = materialize(document_sums(rows, identity, best, pairs, known), "sums")
    cold = sums.select("place", F.explode("cold").alias("c")).select("place", "c.pair", F.col("c.n").alias("times"), "c.best")
    rest = cold.join(counts.filter(F.col("n") < least), "pair").groupBy("place").agg(
        F.sum(F.col("n") * F.col("times")).alias("more"),
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
    )
    whole = rows.drop("same", "same_n", "pairs", "pairs_n", "documents").join(sums.drop("cold"), "place").join(rest, "place", "left")
    none = F.lit(0).cast("long")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", none)).alias("count_sum"),
        "groups_sha256",
    )


def op13_token_alignment(spark, folder: str) -> DataFrame:
    return align_tokens(table(spark, folder, "documents").select("doc_id", "text"))
