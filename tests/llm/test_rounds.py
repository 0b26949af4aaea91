"""Digest runs, hyperplane tree and token alignment against brute force."""

import hashlib
import json
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from landledger.llm import digest_runs, hyperplane_tree, token_alignment
from landledger.llm.queries import ORACLES, QUERIES
from tests.conftest import rows

DOCS = "doc_id long, text string, keep_id string, rows string, place string"


def documents(spark, texts, parts=3):
    """Rows (doc_id, text) with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in texts], DOCS).repartition(parts)


# exact duplicates


def expected_copies(texts):
    def normal(text):
        return re.sub("[\x20\x09-\x0d]+", " ", text or "")

    groups = defaultdict(list)
    for i, t in texts:
        groups[normal(t)].append(i)
    out = []
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        spare = 1  # exactly one of the rows that carry the smallest id stays
        for i in ids:
            out.append((i, keep, len(ids), i == keep and spare > 0, digest))
            spare -= i == keep
    return sorted(out, key=str)


def copies(seed):
    rng = random.Random(seed)
    blanks = [" ", "  ", "\t", "\n\x0b", " \r\n\x0c "]
    texts = []
    for k in range(400):
        # a few texts make up most of the rows; no-break spaces and U+0085 are not white space
        words = ["a", "b c", "\u0085", "é"][: 1 + (0 if k % 3 == 0 else rng.randrange(40)) % 4] + [str(k % 3 and rng.randrange(30))]
        texts.append((k if rng.random() > 0.05 else None, rng.choice(["", " "]) + rng.choice(blanks).join(words)))
    edge = [None, "", " ", "\t\n", " x", "x", "x ", "\x00", "\x1c\x1d", "long " * 100_000, "long\n" * 100_000]
    texts += [(1000 + k, t) for k, t in enumerate(edge)]
    return texts + texts[:40] + [(None, "no id"), (None, "no  id")]


@pytest.mark.parametrize("run_rows,node_entries", [(7, 1), (50, 20), (10_000, 10_000)])
def test_exact_duplicates_against_brute_force(spark, run_rows, node_entries):
    texts = copies(run_rows)
    got = digest_runs.exact_duplicates(documents(spark, texts), run_rows, node_entries)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_copies(texts)


def test_exact_duplicates_of_an_empty_table(spark):
    assert digest_runs.exact_duplicates(documents(spark, [])).collect() == []


def test_runs_pass_all_digits_and_end_at_the_node_of_their_digest():
    rng = np.random.default_rng(3)
    bits, senders = 7, 20
    runs = {}
    for s in range(senders):
        held = [(rng.bytes(47) + b"\x00", False, int(rng.integers(9)), s * 100 + k, 1) for k in range(60)]
        held += [(b"same" * 12, False, s, s * 100 + 99, 2)]
        runs[s % (1 << bits)] = [digest_runs.merge_runs([np.array(held, digest_runs.ENTRY)])]
    for round_ in range(len(digest_runs._digits(bits))):
        sent = defaultdict(list)
        for node, parts in runs.items():
            batch = digest_runs._parts(digest_runs.merge_runs(parts), node, bits, round_)
            for target, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                assert bin(target ^ node).count("1") <= digest_runs.FAN_BITS
                sent[target].append(np.frombuffer(raw, digest_runs.ENTRY))
        runs = sent
    ended = [digest_runs.merge_runs(parts) for parts in runs.values()]
    keys = [k for run in ended for k in run["key"].tolist()]
    assert len(keys) == len(set(keys)) == senders * 60 + 1
    same = next(run[run["key"] == b"same" * 12] for run in ended if (run["key"] == b"same" * 12).any())
    assert same["rows"].tolist() == [2 * senders] and same["id"].tolist() == [0]


def test_keys_that_differ_in_one_part_stay_apart():
    key = bytearray(range(48))
    held = []
    for at in (0, 31, 32, 47):
        other = bytearray(key)
        other[at] ^= 1
        held.append((bytes(other), False, at, at, 1))
    assert len(digest_runs.merge_runs([np.array(held, digest_runs.ENTRY)])) == 4


# hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, rank string, score string"


def expected_negatives(given, every=100):
    taken = []
    for i, v, label in given:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for at, (i, v, label) in enumerate(taken):
        if i % every:
            continue
        scored = [(-sum(map(int.__mul__, v, w)), j, k) for k, (j, w, _) in enumerate(taken) if k != at and len(w) == len(v)]
        mine = sorted(s for s in scored if taken[s[2]][2] == label)[:5]
        others = sorted(s for s in scored if taken[s[2]][2] != label)
        for p, positive, _ in mine:
            window = [(s, j) for s, j, _ in others if 30 * -p <= 100 * -s <= 90 * -p][:10]
            out += [(i, positive, r, j, -p, -s) for r, (s, j) in enumerate(window, 1)]
    return sorted(out)


def clustered(seed, count, dims, labels=3):
    """Vectors around a few centres, many copies of one of them, and every odd value."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dims))
    found = []
    for k in range(count):
        v = centres[rng.integers(6)] + 0.3 * rng.standard_normal(dims)
        if k % 4 == 0:
            v = centres[0]
        found.append((k, (v / np.linalg.norm(v)).astype(np.float32).tolist(), int(rng.integers(labels))))
    return found


ODD = [
    (None, [1.0] * 8, 1), (5000, None, 1), (5001, [1.0] * 8, None), (5100, [float("nan")] * 8, 1), (5200, [float("inf")] + [0.0] * 7, 1),
    (5300, [0.0] * 8, 2), (5400, [], 1), (5500, [], 2), (5600, [0.5, 0.5], 1), (5601, [0.5, 0.4], 1), (5603, [0.3, 0.3], 2),
    (5700, [None] + [1.0] * 7, 1), (5800, [-1.0] * 8, 0), (5900, [3000.0] * 8, 1), (5901, [2000.0] * 8, 2), (5902, [2500.0] * 8, 1),
    (6000, [2.0**21] * 8, 1), (6001, [2.0**20 + 1] * 8, 2), (6002, [2.0**21 - 1] * 8, 1),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_against_brute_force(spark, seed):
    given = clustered(seed, 900, 8) + ODD
    df = spark.createDataFrame([(*r, "x", "y") for r in given], VECTORS).repartition(3)
    got = hyperplane_tree.hard_negatives(df, leaf_rows=30, least_chunk=25)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == expected_negatives(given)


def test_repeated_rows_are_others_to_each_other(spark):
    given = clustered(5, 250, 6)
    given += given[100:110] + given[200:201]
    df = spark.createDataFrame([(*r, "x", "y") for r in given], VECTORS).repartition(2)
    got = hyperplane_tree.hard_negatives(df, leaf_rows=20, least_chunk=15)
    assert sorted(tuple(r) for r in got.collect()) == expected_negatives(given)


def test_hard_negatives_of_few_rows(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hyperplane_tree.hard_negatives(empty).collect() == []
    two = spark.createDataFrame([(100, [1.0, 0.0], 1, "", ""), (101, [1.0, 0.1], 1, "", "")], VECTORS)
    assert hyperplane_tree.hard_negatives(two).collect() == []


def test_tree_leaves_out_siblings_and_never_an_answer():
    rng = np.random.default_rng(11)
    centres = 200 * rng.standard_normal((40, 16))
    data = np.floor(centres[rng.integers(40, size=4000)] + 10 * rng.standard_normal((4000, 16)))
    tree = hyperplane_tree.grow(data[:1500], 60)
    leaf, ranges = hyperplane_tree.place(tree, data), {}
    hyperplane_tree.widen(tree, data, leaf, ranges)
    for number, node in enumerate(tree.nodes):
        node.low, node.high, node.norms = ranges[number]
    assert tree.leaves > 20
    seen = []
    for q in data[::200]:
        score = data @ q
        for low, high in ((0.9 * (q @ q), 1e18), (0.3 * (q @ q), 0.6 * (q @ q))):
            found = set(hyperplane_tree.visited(tree, q, [(low, high)]))
            assert set(leaf[(score >= low) & (score <= high)].tolist()) <= found
            seen.append(len(found) / tree.leaves)
    assert np.mean(seen[::2]) < 0.4 and np.mean(seen[1::2]) < 1


# token alignment


def expected_alignment(texts, a_path, b_path):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    letters = {c: v for c, v in token_alignment.byte_letters().items()}

    def ends(tokens):
        return np.cumsum([len(t) for t in tokens]).tolist()

    documents, counts = [], Counter()
    for _, text in texts:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        of_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        raw = b" " + (text or "").encode()
        if not text or b"".join(of_a) != raw or b"".join(of_b) != raw:
            documents.append(None)
            continue
        ends_a, ends_b = ends(of_a), ends(of_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [([], []) for _ in cuts]
        for side, (ids, at) in enumerate(((x, ends_a), (y, ends_b))):
            g = 0
            for i, e in zip(ids, at):
                while e > cuts[g]:
                    g += 1
                groups[g][side].append(i)
        links = Counter((i, j) for left, right in groups for i in left for j in right)
        counts.update(set(links))
        documents.append((len(x), len(y), groups, links))
    best = Counter()
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = []
    for (doc_id, _), d in zip(texts, documents):
        if d is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        shown = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        n_best = sum(n for p, n in links.items() if counts[p] == best[p[0]])
        total = sum(n * counts[p] for p, n in links.items())
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), n_best, total, hashlib.sha256(shown.encode()).hexdigest()))
    return sorted(out, key=str)


def texts_to_align():
    rng = random.Random(4)
    words = "the of and reading unalignable tokenizers naïve straße 日本語 тест 123 4567 don't we'll x_y -- ... 😀 ﬁ".split()
    texts = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for k in range(120)]
    edge = [
        None, "", " ", "  two  spaces ", "\n\ttabs\n", "<|endoftext|> <s> </s> <unk>", "a▁b", "▁", "ﬀ", "́", "\x00", "=" * 3000, "a" * 5001,
        "ab1" * 4000, "word " * 20_000, "é" * 10,
    ]
    return texts + [(1000 + k, t) for k, t in enumerate(edge)] + texts[:5] + [(None, "no id at all")]


@pytest.mark.parametrize("most_hot", [0, 40, 1 << 17])
def test_alignment_against_brute_force(spark, most_hot):
    texts = texts_to_align()
    got = token_alignment.align_tokens(documents(spark, texts), most_hot=most_hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = expected_alignment(texts, token_alignment.TOKENIZER_A, token_alignment.TOKENIZER_B)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_alignment_of_an_empty_table(spark):
    assert token_alignment.align_tokens(documents(spark, [])).collect() == []


def test_alignment_with_a_vocabulary_whose_ids_do_not_order_its_merges(spark, tmp_path):
    with open(token_alignment.TOKENIZER_A) as f:
        spec = json.load(f)
    vocabulary = spec["model"]["vocab"]
    the, of = "Ġthe", "Ġof"
    vocabulary[the], vocabulary[of] = vocabulary[of], vocabulary[the]
    path = tmp_path / "swapped.json"
    path.write_text(json.dumps(spec))
    assert not token_alignment.ByteLevel(path.read_bytes()).ranked
    texts = [(k, t) for k, t in texts_to_align() if k is not None and k < 40]
    got = token_alignment.align_tokens(documents(spark, texts), a=str(path))
    want = expected_alignment(texts, str(path), token_alignment.TOKENIZER_B)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_large_groups_are_linked_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(9)
    n_a, n_b = rng.integers(1, 30, 50), rng.integers(1, 30, 50)
    a, b = rng.integers(0, 9, n_a.sum()), rng.integers(0, 9, n_b.sum())
    doc = np.sort(rng.integers(0, 5, 50))
    want = token_alignment.group_pairs(a, b, n_a, n_b, doc)
    monkeypatch.setattr(token_alignment, "GROUP_PAIRS", 60)
    got = token_alignment.group_pairs(a, b, n_a, n_b, doc)
    assert all((x == y).all() for x, y in zip(got, want))


@pytest.mark.parametrize("name", ["op11_digest_runs", "op12_hyperplane_tree"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from tools.check_oracles import plain

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    assert plain(QUERIES[name](spark, folder).toArrow()) == plain(con.sql(ORACLES[name]).to_arrow_table())


def test_alignment_query_covers_its_table(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op13_token_alignment"](spark, folder)
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(got) == rows_of(expected_alignment(texts, token_alignment.TOKENIZER_A, token_alignment.TOKENIZER_B))


def rows_of(tuples):
    return sorted(tuples, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_white_space_of_any_length_is_encoded():
    from tokenizers import Tokenizer

    with open(token_alignment.TOKENIZER_A, "rb") as f:
        raw = f.read()
    encode = token_alignment.ByteLevel(raw).encoder()
    whole = Tokenizer.from_str(raw.decode())
    for text in ["x" + " " * 1_500_000 + "y z", " " * 1_200_000, "q " + "\n \u3000" * 400_000 + " k" + " " * 3000 + "\u00e9", "\t" * 1_200_000 + "'s"]:
        assert encode([text]) == [whole.encode(text, add_special_tokens=False).ids]
