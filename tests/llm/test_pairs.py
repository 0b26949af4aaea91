"""Near-duplicate operators against brute force."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landledger.llm import hamming_index, ngram_join
from landledger.llm.components import components
from landledger.llm.shared import small_batches

DOCS = "doc_id long, text string, n long, row string"


def shingles(text, n=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return set()
    if len(words) < n:
        return {tuple(words)}
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def roots(nodes, linked):
    """Smallest reachable node of each node, by plain search."""
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    return {x: find(x) for x in nodes}


def jaccard_roots(texts, percent=90):
    sets = {k: shingles(t) for k, t in texts.items()}
    keys = sorted(sets)
    links = []
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return {k: len(s) for k, s in sets.items()}, roots(keys, links)


def edited(rng, words, share):
    return [w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words]


def near_copies(seed):
    """Groups of near copies around the bound, a passage that many share, and short texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    passage = [rng.choice(words) for _ in range(30)]
    texts = {}
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, 12)):
            copy = edited(rng, base, rng.choice([0, 0.01, 0.02, 0.05]))
            if rng.random() < 0.3:
                copy += passage
            texts[len(texts)] = " ".join(copy)
    base = [rng.choice(words) for _ in range(150)]
    for _ in range(60):
        texts[len(texts)] = " ".join(edited(rng, base, rng.choice([0.002, 0.01, 0.03, 0.1])))
    for t in ("a", "A", "a b", "a  b", "a b c", "", " \t\n", None, "é É", "É é"):
        texts[len(texts)] = t
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_matches_brute_force(spark, seed, monkeypatch):
    # small chunks, so that clusters are dealt to several tasks
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", 20)
    monkeypatch.setattr(ngram_join, "COLUMN_BLOCK", 64)
    texts = near_copies(seed)
    docs = spark.createDataFrame([(k, t, 7, "x") for k, t in texts.items()], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    sizes, root = jaccard_roots(texts)
    assert got == {k: (sizes[k], root[k]) for k in texts}


def test_jaccard_repeated_null_and_long_rows(spark):
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
    rows = [(5, "a b c d", 1, "r"), (5, "a b c d", 1, "r"), (3, "A B\tc d", 1, "r"), (None, "a b c d", 1, "r"),
            (None, None, 1, "r"), (9, long, 1, "r"), (8, long + " end", 1, "r")]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        [("5", 2, "3"), ("5", 2, "3"), ("3", 2, "3"), ("None", 2, "None"), ("None", 0, "None"),
         ("9", len(shingles(long)), "8"), ("8", len(shingles(long + " end")), "8")]
    )


def test_jaccard_of_nothing(spark):
    assert ngram_join.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(links)
    df = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    nodes = {x for pair in links for x in pair if pair != (7, 7)}
    assert got == roots(nodes, links)


def vector_rows(seed, dims=32):
    rng = np.random.default_rng(seed)
    rows, out = [], []
    for _ in range(25):
        base = rng.standard_normal(dims)
        for _ in range(rng.integers(1, 9)):
            rows.append(base + rng.choice([0.0, 0.02, 0.05, 0.09]) * rng.standard_normal(dims) * 2)
    rows += [rows[0], rows[0] * 3]
    out = [(i, [float(np.float32(x)) for x in r], 1) for i, r in enumerate(rows)]
    n = len(out)
    odd = [None, [0.0] * dims, [math.nan] * dims, [math.inf] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1), [1.0], []]
    return out + [(n + i, v, 1) for i, v in enumerate(odd)], n


def cosine_links(rows, n, least):
    unit = np.array([r[1] for r in rows[:n]])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    return {(i, j) for i in range(n) for j in range(i + 1, n) if unit[i] @ unit[j] >= least}


def test_hamming_index_recall_and_exactness(spark, monkeypatch):
    monkeypatch.setattr(hamming_index, "CHUNK_ROWS", 5)
    rows, n = vector_rows(4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, hi long")
    got = {r.vec_id: r for r in hamming_index.near_duplicates(df).collect()}
    links = cosine_links(rows, n, 0.9)
    degree = {i: sum(i in p for p in links) for i in range(len(rows))}
    found = sum(r.n_links for r in got.values())
    assert all(got[i].n_links <= degree[i] for i in degree)
    assert found >= 0.9 * sum(degree.values()) and found > 50
    root = roots(range(len(rows)), links)
    assert sum(got[i].component_id == root[i] for i in root) >= 0.95 * len(root)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    for i in range(n, len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_hamming_index_repeats_nulls_and_nothing(spark):
    v = [1.0, 2.0, 3.0]
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(4, v), (4, v), (2, v), (None, v), (7, [-1.0, 0.0, 0.0])], schema)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in hamming_index.near_duplicates(df).collect())
    assert got == [("2", 2, "2", True), ("4", 2, "2", False), ("4", 2, "2", False), ("7", 0, "7", True), ("None", 0, "None", False)]
    assert hamming_index.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_rotation_balances_and_keeps_neighbours():
    rng = np.random.default_rng(0)
    sample = rng.standard_normal((2000, 32)) + 2
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    rotation = hamming_index.learn_rotation(sample)
    codes = (sample - rotation.mean) @ rotation.axes >= 0
    assert np.abs(codes.mean(0) - 0.5).max() < 0.08
    assert np.allclose(rotation.axes.T @ rotation.axes, np.eye(32), atol=1e-8)
    masks = hamming_index.bucket_masks(64, 10**8)
    assert all(bin(m).count("1") == 15 for m in masks) and len(masks) == 64


@pytest.mark.parametrize("dims", [64, 24, 10])
@pytest.mark.parametrize("least", [0.90, 0.92])
def test_hamming_recall_at_the_bound_for_every_width(dims, least):
    rng = np.random.default_rng(dims)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    first = unit(rng.standard_normal((4000, dims)))
    across = rng.standard_normal(first.shape)
    across = unit(across - (across * first).sum(1, keepdims=True) * first)
    second = least * first + math.sqrt(1 - least**2) * across
    rotations = hamming_index.learn_rotations(first, hamming_index.MAX_ROTATIONS)
    differ = hamming_index.vector_codes(first, rotations) ^ hamming_index.vector_codes(second, rotations)
    widths = set()
    for rows in [1000, *(hamming_index.BUCKET_ROWS * 2**w - hamming_index.BUCKET_ROWS for w in range(9, 17)), 10**9]:
        tables = hamming_index.hamming_tables(dims, rows, 0.9)
        widths.add(hamming_index._substring_width(dims, rows))
        met = np.zeros(len(first), bool)
        for rotation, mask in tables:
            met |= (differ[:, rotation] & np.int64(hamming_index._signed(mask))) == 0
        assert met.mean() >= 0.9, (rows, met.mean())
        covered = 0
        for rotation, mask in tables:
            covered |= mask if rotation == 0 else 0
        assert covered == (1 << dims) - 1
    assert widths == set(range(8, min(16, dims) + 1))


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_clusters_of_many_chunks(spark, monkeypatch, seed):
    """Chains of near copies whose ends are far apart, in clusters of many chunks."""
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", 4)
    monkeypatch.setattr(ngram_join, "REPRESENTATIVES", 2)
    rng = random.Random(seed)
    texts = near_copies(seed)
    at = max(texts) + 1
    for chain in range(3):
        words = [f"c{chain}x{i}" for i in range(60)]
        for step in range(30):
            texts[at] = " ".join(words)
            at += 1
            # some steps are too wide, so that a chain falls into several components
            for _ in range(rng.choice([1, 1, 1, 3])):
                words[rng.randrange(60)] = f"n{chain}y{rng.randrange(10**6)}"
    sizes, want = jaccard_roots(texts, 80)
    df = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string").repartition(5)
    got = ngram_join.jaccard_components(df, percent=80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == {k: (sizes[k], want[k]) for k in texts}


def test_jaccard_joins_all_texts_of_an_id(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    near = b + " more"
    rows = [(1, a), (5, a), (5, b), (7, near), (5, b), (9, "something else"), (None, a)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect() if r["doc_id"]) == [(1, 1), (5, 1), (5, 1), (5, 1), (7, 1), (9, 9)]


def test_jaccard_leaves_no_table_but_its_result(spark):
    import os

    from landledger.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    df = spark.createDataFrame([(k, t) for k, t in near_copies(1).items()], "doc_id long, text string")
    got = ngram_join.jaccard_components(df)
    assert got.count() == df.count()
    assert len(set(os.listdir(folder)) - before) == 1


def test_components_raise_when_they_are_not_settled(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long")
    with pytest.raises(RuntimeError, match="not settled"):
        components(chain, max_rounds=1)
    assert {r["component"] for r in components(chain).collect()} == {0}


def test_hamming_index_of_other_lengths_and_magnitudes(spark):
    rows = [(k, [math.cos(k / 3), math.sin(k / 3), 0.0, 0.0]) for k in range(20)]
    rows += [(100, [1.0, 2.0]), (101, [1.0, 2.0]), (102, [2.0, 4.01]), (103, [-1.0, 2.0])]
    rows += [(110, [1e200, 0.0, 0.0, 1e199]), (111, [1e200, 0.0, 0.0, 1e199]), (112, [1e-200, 0.0, 0.0, 1e-201])]
    rows += [(120, [0.0, 0.0, 0.0, 5e-324]), (121, [0.0, 0.0, 0.0, 1.0]), (122, []), (123, []), (124, [0.0]), (125, [3.0]), (126, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in hamming_index.near_duplicates(df).collect()}
    assert [got[k] for k in (100, 101, 102, 103)] == [(2, 100), (2, 100), (2, 100), (0, 103)]
    assert got[110] == got[111] and got[110][0] >= 2 and got[112][1] == got[110][1]
    assert got[120] == (1, 120) and got[121] == (1, 120)
    assert got[122] == (0, 122) and got[123] == (0, 123) and got[124] == (0, 124) and got[125] == (1, 125) == got[126]


def test_visitors_of_a_chunk_are_bounded_by_entries(spark, monkeypatch):
    """A cluster of few long rows that all stay apart."""
    monkeypatch.setattr(ngram_join, "CHUNK_ENTRIES", 100)
    monkeypatch.setattr(ngram_join, "REPRESENTATIVES", 2)
    held = []

    def settled(whole, keys, percent, inside):
        blocks = whole.groupBy(*keys).agg(F.sum(F.when(F.col("guest"), F.octet_length("row") / 8)).alias("visitors"))
        held.append([r["visitors"] or 0 for r in blocks.collect()])
        return found(whole, keys, percent, inside)

    found = ngram_join._settled
    monkeypatch.setattr(ngram_join, "_settled", settled)
    texts = {k: " ".join(f"w{k}x{i}" for i in range(42)) for k in range(12)}
    docs = spark.createDataFrame([*texts.items()], "id long, text string")
    clusters = docs.select("id", F.lit(0).cast("long").alias("cluster"), F.lit(40).cast("long").alias("n"))
    links = ngram_join.cluster_links(clusters, lambda ids: ngram_join.shingle_rows(docs, 3), 90)
    assert links.count() == 0
    first, second = held
    assert len(first) > 1 and len(second) > len(first) and max(second) <= 300


def test_small_batches_bound_rows_and_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    wide = spark.range(200).repartition(1).select(F.expr("CAST(repeat('x', 100000) AS BINARY)").alias("row"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    with small_batches(spark):
        got = wide.mapInArrow(sizes, "rows long, bytes long").collect()
        thin = spark.range(0, 2500, 1, 1).mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in got) == 200 and max(r["bytes"] for r in got) < 9_000_000
    assert sorted(r["rows"] for r in thin) == [500, 1000, 1000] and spark.conf.get(key, None) == before
