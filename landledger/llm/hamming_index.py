"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

*Codes.* A rotation is learned on a bounded sample so that the signs of the
rotated, centred vectors are balanced and lose little: alternate between the
best binary codes for a rotation and the best rotation for the codes (an
orthogonal Procrustes problem).

*Retrieval.* A code is cut into substrings, one table per substring. Vectors
that agree in a whole substring meet in a bucket of that table. With radius 1
every substring gives one bucket per left-out bit, so that substrings that
differ in one bit meet as well. Wider substrings meet less often, and short codes
have few of them, so substrings of further rotations are added until a pair at
the bound is missed with a small, fixed chance at any row count.

*Reranking.* A bucket compares its vectors by cosine in double precision. A pair
that meets in several buckets is settled in the first of them only. A bucket
returns one row per linked vector (how many links, and one vector of its local
component), never its pairs. Large buckets are dealt into chunks, and each pair
of chunks is a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.components import components
from landledger.llm.shared import hashed_sample, table
from landledger.session import materialize

# The rotation is fitted on at most this many vectors; every vector is indexed.
SAMPLE = 10_000
MAX_BITS = 64
ROUNDS = 50
# Rows that a bucket should hold on average, and that a chunk may hold at most or so.
BUCKET_ROWS, CHUNK_ROWS = 200, 1500
# Chance that a pair at the bound meets in no table, if its bits differ independently
# of each other. Low bounds would need very many rotations.
MISSED, MAX_ROTATIONS = 0.07, 12


@dataclass
class Rotation:
    mean: np.ndarray
    axes: np.ndarray  # dimensions x bits


def learn_rotation(sample: np.ndarray, bits: int = MAX_BITS, seed: int = 7) -> Rotation:
    """Iterative quantisation of unit vectors (rows) from the start that ``seed`` draws. Deterministic."""
    dims = sample.shape[1]
    bits = min(bits, dims)
    if not len(sample):
        return Rotation(np.zeros(dims), np.eye(dims)[:, :bits])
    mean = sample.mean(0)
    centred = sample - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    principal = vectors[:, ::-1][:, :bits]
    projected = centred @ principal
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(ROUNDS):
        codes = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(projected.T @ codes)
        rotation = left @ right
    return Rotation(mean, principal @ rotation)


def _substring_width(bits: int, rows: int) -> int:
    """Substrings widen with the logarithm of the row count so that buckets keep their size."""
    return min(max(8, math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS + 1))), 16, bits)


def _left_out(width: int) -> int:
    """Masks per substring: beyond ten bits it is compared with one bit left out in turn."""
    return 1 if width <= 10 else width


def bucket_masks(bits: int, rows: int) -> list[int]:
    """The bits that each table of one rotation compares, substring by substring.

    Bits that the division leaves over are in one more substring, which
    overlaps the one before.
    """
    width = _substring_width(bits, rows)
    starts = list(range(0, bits - width + 1, width))
    if bits % width:
        starts.append(bits - width)
    masks = []
    for start in starts:
        whole = ((1 << width) - 1) << start
        masks += [whole] if _left_out(width) == 1 else [whole & ~(1 << (start + i)) for i in range(width)]
    return masks


def hamming_tables(bits: int, rows: int, least: float) -> list[tuple[int, int]]:
    """(rotation, mask) of every table.

    A bit of a pair at the bound differs with the share that the pair's angle
    has of a half turn. All substrings of the first rotation are used, and as
    many of further ones as MISSED asks for.
    """
    width = _substring_width(bits, rows)
    masks, step = bucket_masks(bits, rows), _left_out(width)
    substrings = [masks[k : k + step] for k in range(0, len(masks), step)]
    same = 1 - math.acos(min(max(least, -1.0), 1.0)) / math.pi
    missed = 1 - same**width - (step > 1) * width * (1 - same) * same ** (width - 1)
    needed = math.log(MISSED) / math.log(missed) if 0 < missed < 1 else 1.0
    found, tables = 0.0, []
    for k in range(MAX_ROTATIONS * len(substrings)):
        rotation, at = divmod(k, len(substrings))
        if rotation and found >= needed:
            break
        tables += [(rotation, mask) for mask in substrings[at]]
        # one that overlaps another counts by its own bits
        found += 1.0 if (at + 1) * width <= bits else bits % width / width
    return tables


def learn_rotations(sample: np.ndarray, count: int) -> list[Rotation]:
    return [learn_rotation(sample, seed=7 + k) for k in range(count)]


def random_rotations(dims: int, bits: int, count: int) -> list[Rotation]:
    """Random directions for vectors of a length that is not learned: their bits differ with the same chance."""
    draws = [np.random.default_rng([7 + k, dims]).standard_normal((dims, bits)) for k in range(count)]
    return [Rotation(np.zeros(dims), axes) for axes in draws]


def vector_codes(unit: np.ndarray, rotations: list[Rotation]) -> np.ndarray:
    """One 64-bit code per unit vector (rows) and rotation."""
    codes = np.empty((len(unit), len(rotations)), np.int64)
    for k, rotation in enumerate(rotations):
        signs = (unit - rotation.mean) @ rotation.axes >= 0
        places = np.uint64(1) << np.arange(signs.shape[1], dtype=np.uint64)
        codes[:, k] = (signs * places).sum(1, dtype=np.uint64).view(np.int64)
    return codes


def coded_rows(vectors: DataFrame, rotations: list[Rotation]) -> DataFrame:
    """(vec_id, dims, hi, lo, vector, code per rotation); NULL from hi on for vectors that link with nothing.

    ``vector`` holds doubles, ``hi`` and ``lo`` are its digest.
    """
    learned, bits = len(rotations[0].mean), rotations[0].axes.shape[1]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = {learned: rotations}
        for batch in batches:
            ids, rows = batch.column(0), [_usable(value) for value in batch.column(1)]
            sizes = np.array([0 if r is None else len(r) for r in rows])
            out: list[tuple] = [(None, None, None, None)] * len(rows)
            for size in np.unique(sizes[sizes > 0]).tolist():
                if size not in by_length:
                    by_length[size] = random_rotations(size, bits, len(rotations))
                at = np.flatnonzero(sizes == size).tolist()
                found = np.array([rows[k] for k in at])
                codes = vector_codes(found / np.linalg.norm(found, axis=1, keepdims=True), by_length[size]).tolist()
                for k, code in zip(at, codes):
                    raw = rows[k].tobytes()
                    out[k] = (*np.frombuffer(xxhash.xxh3_128_digest(raw), "<i8").tolist(), raw, code)
                if len(by_length) > 64:
                    by_length = {learned: rotations}
            hi, lo, raw, code = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(sizes, pa.int32()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                    pa.array(raw, pa.binary()), pa.array(code, pa.list_(pa.int64())),
                ],
                names=["vec_id", "dims", "hi", "lo", "vector", "code"],
            )

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        encode, "vec_id long, dims int, hi long, lo long, vector binary, code array<long>"
    )


def _usable(value) -> np.ndarray | None:
    """The vector scaled by a power of two, so that its norm neither overflows nor vanishes; None if it links with nothing."""
    if not value.is_valid or not len(value) or value.values.null_count:
        return None
    row = value.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # no negative zeros
    largest = float(np.abs(row).max())
    if not math.isfinite(largest) or not largest:
        return None
    return np.ldexp(row, -math.frexp(largest)[1])


def _compare(tables: list[tuple[int, int]], least: float):
    """Function of one pair of chunks of one bucket: (id, links, root) per linked vector."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        own = group.column("chunk").to_numpy()
        first, second = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        number = group.column("number")[0].as_py()
        ids = group.column("id").to_numpy()
        members = group.column("members").to_numpy()
        codes = np.array(group.column("code").to_pylist(), np.int64)
        vectors = np.frombuffer(b"".join(group.column("vector").to_pylist()), np.float64).reshape(len(ids), -1)
        norms = np.sqrt((vectors * vectors).sum(1))
        left = np.flatnonzero(own == first)
        right = left if first == second else np.flatnonzero(own == second)
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        linked = np.zeros(len(ids), bool)

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for begin in range(0, len(left), 512):
            some = left[begin : begin + 512]
            cosine = (vectors[some] @ vectors[right].T) / (norms[some][:, None] * norms[right][None, :])
            a, b = np.nonzero(cosine >= least)
            a, b = some[a], right[b]
            keep = ids[a] < ids[b] if first == second else ids[a] != ids[b]
            a, b = a[keep], b[keep]
            keep = np.ones(len(a), bool)
            for rotation, mask in tables[:number]:
                keep &= ((codes[a, rotation] ^ codes[b, rotation]) & np.int64(_signed(mask))) != 0
            a, b = a[keep], b[keep]
            np.add.at(links, a, members[b])
            np.add.at(links, b, members[a])
            linked[a] = linked[b] = True
            # join each vector to one partner first; then only what still differs
            for x, y in zip(a.tolist(), b.tolist()):
                if root[x] != root[y]:
                    p, q = find(x), find(y)
                    root[max(p, q)] = min(p, q)
        at = np.flatnonzero(linked)
        roots = np.array([ids[find(x)] for x in at.tolist()], np.int64)
        return pa.table({"id": ids[at], "links": links[at], "root": roots})

    return compare


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def near_duplicates(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """Every row of ``vectors`` (vec_id, embedding) with n_links, component_id and kept.

    Vectors are linked when their cosine is at least ``least``. Vectors that are
    NULL, empty, zero, or that hold NULL or non-finite numbers link with nothing,
    as do rows with a NULL vec_id (whose component is NULL and which are not
    kept). Vectors meet only vectors of their own length; the rotation is learned
    for the most common one, others get random directions. Repeated rows are vectors of
    their own and link with each other; rows of one vec_id with different
    vectors share a component. An empty table gives no rows. Links are found
    with a recall that the tests measure; no link below the bound is ever
    reported.
    """
    sizes = vectors.filter("embedding IS NOT NULL").groupBy(F.size("embedding").alias("dims")).count()
    common = sizes.filter("dims > 0").orderBy(F.desc("count"), "dims").first()
    dims = common["dims"] if common else 1
    same_size = vectors.filter(F.col("vec_id").isNotNull() & (F.size("embedding") == dims))
    sampled = hashed_sample(same_size.select("vec_id", "embedding"), "vec_id", SAMPLE)
    rows = [_usable(v) for v in sampled.select("embedding").toArrow().column(0).cast(pa.list_(pa.float64()))]
    sample = np.array([r / np.linalg.norm(r) for r in rows if r is not None]).reshape(-1, dims)
    # rows, not classes, as codes come first: copies can only widen substrings
    tables = hamming_tables(min(MAX_BITS, dims), same_size.count(), least)
    rotations = learn_rotations(sample, 1 + tables[-1][0])

    coded = materialize(coded_rows(vectors, rotations), "coded")
    usable = coded.filter("hi IS NOT NULL AND vec_id IS NOT NULL")
    # equal vectors are one row, that of the smallest vec_id
    classes = materialize(
        usable.groupBy("hi", "lo").agg(
            F.min("vec_id").alias("id"), F.min("dims").alias("dims"), F.count(F.lit(1)).alias("members"),
            F.min("vector").alias("vector"), F.min("code").alias("code"),
        ),
        "classes",
    )
    keys = F.array(*[
        F.struct(F.lit(k).alias("number"), F.col("code")[r].bitwiseAND(F.lit(_signed(m))).alias("key"))
        for k, (r, m) in enumerate(tables)
    ])
    placed = classes.select("dims", F.explode(keys).alias("at")).select("dims", "at.number", "at.key")
    large = materialize(
        placed.groupBy("number", "key", "dims").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
        .withColumn("chunks", F.ceil(F.col("rows") / CHUNK_ROWS).cast("int")),
        "buckets",
    )
    full = classes.select("id", "dims", "code", "members", "vector", F.explode(keys).alias("at"))
    full = full.select("id", "dims", "code", "members", "vector", "at.number", "at.key").join(large, ["number", "key", "dims"])
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    partners = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: k)
    dealt = full.withColumn("chunk", chunk).withColumn("partner", F.explode(partners))
    dealt = dealt.withColumn("i", F.least("chunk", "partner")).withColumn("j", F.greatest("chunk", "partner"))
    dealt = dealt.select("number", "key", "dims", "i", "j", "chunk", "id", "code", "members", "vector")
    found = materialize(
        dealt.groupBy("number", "key", "dims", "i", "j").applyInArrow(_compare(tables, least), "id long, links long, root long"),
        "found",
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    nodes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    by_class = (
        classes.select("hi", "lo", "id", "members")
        .join(links, "id", "left")
        .join(nodes.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "hi", "lo",
            (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    named = F.col("vec_id").isNotNull()
    return (
        coded.select("vec_id", "hi", "lo")
        .join(by_class, ["hi", "lo"], "left")
        .select(
            "vec_id",
            F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
            F.when(named, F.coalesce("component_id", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def op1_hamming_index(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))
