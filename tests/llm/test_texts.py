"""Quality, decontamination, mixing, token counts and the whole pipeline."""

import base64
import os
import random
import zlib

import numpy as np
import pytest

from landledger.llm import edit_matching, line_crf, mixing, token_counts
from landledger.session import scratch_path
from tests.llm.test_pairs import jaccard_roots, near_copies, roots, shingles

SMALL = "/root/testdata/sf0.001"


# --- Line labeller -----------------------------------------------------------


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    model = line_crf.Model(np.zeros(3), 0.4, rng.standard_normal((2, 2)))
    scores = rng.standard_normal((2, 5))
    lengths = np.array([5, 3])
    p = line_crf._marginals(scores, lengths, model)[0]
    for doc, n in enumerate(lengths):
        total, good = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            s = sum(scores[doc, i] * y[i] for i in range(n)) + model.start * y[0]
            s += sum(model.coupling[y[i], y[i + 1]] for i in range(n - 1))
            total += np.exp(s)
            good += np.exp(s) * np.array(y)
        assert np.allclose(p[doc, :n], good / total)


def test_crf_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = line_crf.with_quality(docs, line_crf.fit(docs, labels))
    rows = scored.join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95


def test_crf_odd_rows(spark):
    schema = "doc_id long, text string, score string, label int, x int"
    rows = [(1, None, "s", 1, 1), (2, "", "s", 1, 1), (None, "a\n\n\nb", "s", 1, 1), (3, "\n" * 5000, "s", 1, 1),
            (4, "w " * 200_000, "s", 1, 1), (4, "w " * 200_000, "s", 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (4, 0, 1), (4, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = line_crf.fit(docs, labels)
    got = line_crf.with_quality(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.doc_id: r.held_out for r in got if r.doc_id} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2, 3, 4)}
    assert got[0].score == got[1].score and got[4].score == got[5].score
    none = spark.createDataFrame([], schema)
    model = line_crf.fit(none, labels.filter("false"))
    assert line_crf.with_quality(none, model).collect() == []
    assert line_crf.score_texts(["any"], model)[0] == pytest.approx(0.5)


# --- Decontamination ---------------------------------------------------------


def distance_table(pattern, text):
    """Fewest edits of ``pattern`` against any substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def mutated(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        kind = rng.randrange(3)
        text = text[:i] + (rng.choice("abcxyz") if kind else "") + text[i + (kind != 1) :]
    return text


def test_myers_against_table():
    rng = random.Random(2)
    for _ in range(200):
        pattern = "".join(rng.choice("ab c") for _ in range(rng.randrange(1, 70)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 90)))
        if rng.random() < 0.7:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + mutated(rng, pattern, rng.randrange(0, 4)) + text[at:]
        least = distance_table(pattern, text)
        budget = rng.randrange(0, 6)
        got = edit_matching.best_end(pattern, text, budget)
        assert (got is None) == (least > budget)
        if got:
            assert got[0] == least
            distance, width = edit_matching.best_end(pattern[::-1], text[: got[1]][::-1], least, bound=True)
            assert distance == least
            assert distance_table(pattern, text[got[1] - width : got[1]]) == least


def test_every_item_within_budget_is_found():
    rng = random.Random(5)
    letters = "abcdefghij "
    items = [(i, edit_matching.normalise("".join(rng.choice(letters) for _ in range(rng.randrange(40, 260))))) for i in range(30)]
    matcher = edit_matching.Matcher(items)
    for i, item in items:
        budget = edit_matching.edit_budget(len(item))
        for edits in {0, 1, budget}:
            text = edit_matching.normalise("before it " + mutated(rng, item, edits) + " and after it")
            found = {m[0]: m for m in matcher.matches(text)}
            if distance_table(item, text) <= budget:
                assert found[i][1] == distance_table(item, text)
            assert set(found) <= {i}
    assert matcher.matches("nothing of this kind " * 50) == []


def test_edit_budget_is_a_tenth():
    assert [edit_matching.edit_budget(n) for n in (17, 39, 81, 100, 200, 394)] == [0, 3, 8, 10, 20, 39]
    for n in (20, 39, 100, 394):
        parts = edit_matching.pieces("x" * n)
        assert len(parts) == edit_matching.edit_budget(n) + 1 and min(len(p) for _, p in parts) >= 6
        for steps in edit_matching.ladder(parts):
            assert steps[-1] == (0, n, edit_matching.edit_budget(n))


def test_items_at_the_full_budget_are_found():
    """Edits spread so that one piece is left alone, and edits in one half only."""
    rng = random.Random(8)
    for trial in range(60):
        item = edit_matching.normalise("".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(40, 200))))
        budget = edit_matching.edit_budget(len(item))
        parts = edit_matching.pieces(item)
        spared = rng.randrange(len(parts))
        places = [offset + rng.randrange(len(p)) for k, (offset, p) in enumerate(parts) if k != spared]
        if trial % 2:
            places = rng.sample(range(len(item) // 2), budget)
        text = "".join("Z" if k in places else c for k, c in enumerate(item))
        text = "some words before " + text.replace("Z", "#") + " and some behind"
        found = edit_matching.Matcher([(1, item)]).matches(text)
        assert [m[:2] for m in found] == [(1, distance_table(item, edit_matching.normalise(text)))]


def test_short_items_are_found_between_words():
    matcher = edit_matching.Matcher([(1, "exactly 17 chars."), (2, "it"), (3, "½ cup")])
    assert matcher.matches("this is exactly 17 chars. long")[0][:2] == (1, 0)
    assert [m[0] for m in matcher.matches("with items as bits, sit")] == []
    assert [m[0] for m in matcher.matches("take it: ½ cup")] == [2, 3]


def test_leaks_of_odd_rows(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away"
    schema = "doc_id long, text string, leaks string, item_id long"
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, item.upper(), "x", 1), (3, "so\n the  quick brown fox jumps over\tthe lazy dog and runs away!", "x", 1),
            (4, "clean text", "x", 1), (5, "short one", "x", 1), (6, "not a short one", "x", 1), (7, ("pad " * 30_000) + item, "x", 1), (7, ("pad " * 30_000) + item, "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(10, item), (10, item), (11, None), (12, ""), (13, "short one"), (None, item[:-1] + "x")], "item_id long, text string")
    for chars in (10**6, 60):  # one block of items, several blocks
        got = edit_matching.with_leaks(docs, items, chars)
        found = sorted((str(r.doc_id), sorted({str(m.item_id) for m in r.leaks})) for r in got.collect())
        both = ["10", "None"]
        assert found == sorted([("1", []), ("2", []), ("None", both), ("3", both), ("4", []), ("5", ["13"]), ("6", ["13"]), ("7", both), ("7", both)])
    assert sorted(r.doc_id for r in edit_matching.without_leaks(docs, items).collect()) == [1, 2, 4]
    assert edit_matching.with_leaks(docs.filter("false"), items).collect() == []
    assert edit_matching.without_leaks(docs, items.filter("false")).count() == 9


# --- Mixing ------------------------------------------------------------------


def wanted_targets(sums, weights=(5, 2, 1)):
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sums.values()), set()
    while True:
        rest = total - sum(2 * sums[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] * rest / share > 2 * sums[s]} if share else set()
        if not over:
            return {s: float(2 * sums[s]) if s in capped else weight[s] * rest / share for s in names}
        capped |= over


def test_mix_meets_targets_and_reruns_agree(spark):
    rng = random.Random(6)
    sources = ["a", "B", "é", None, "z", "hot"]
    rows = []
    for i in range(1500):
        source = "hot" if rng.random() < 0.33 else rng.choice(sources)
        text = None if i % 50 == 0 else " \t".join(["w"] * int(rng.lognormvariate(3, 1.2)))
        rows.append((i, source, text, 1.0, "x", True))
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, tilt double, offset string, large boolean")
    mixed = mixing.entropy_mix(docs).collect()
    assert len(mixed) == len(rows) and [c for c in docs.columns] == list(mixed[0].asDict())[:6]
    sizes = {i: len((t or "").split()) for i, _, t, *_ in rows}
    sums = {s: sum(sizes[r[0]] for r in rows if r[1] == s) for s in {r[1] for r in rows}}
    targets = wanted_targets(sums)
    taken = dict.fromkeys(sums, 0)
    for r in mixed:
        assert r.size == sizes[r.doc_id] and r.source_size == sums[r.source]
        assert r.target == pytest.approx(targets[r.source]) and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 0.02 * t + 5
    again = mixing.entropy_mix(docs.repartition(7)).collect()
    assert {r.doc_id: r.taken for r in again} == {r.doc_id: r.taken for r in mixed}


def test_mix_tilt_solves_the_dual(spark):
    sizes = spark.createDataFrame([("s", k) for k in (1, 2, 3, 10, 40)] + [("t", 5), ("t", 50)], "source string, size long")
    targets = spark.createDataFrame([("s", 56, 40, 5.0, 30.0), ("t", 55, 50, 2.0, 80.0)], "source string, source_size long, largest long, weight double, target double")
    got = {r.source: r.tilt for r in mixing._tilts(sizes, targets, 2).collect()}
    for name, values, largest, target in (("s", (1, 2, 3, 10, 40), 40, 30.0), ("t", (5, 50), 50, 80.0)):
        words = sum(k * min(2.0, np.exp(got[name] * k / largest)) for k in values)
        assert words == pytest.approx(target, rel=1e-5)


def test_mix_of_little(spark):
    schema = "doc_id long, source string, text string"
    rows = [(1, "a", None), (2, "a", ""), (None, None, "x y"), (None, None, "x y")]
    got = sorted((str(r.doc_id), r.size, r.copies, r.taken) for r in mixing.entropy_mix(spark.createDataFrame(rows, schema)).collect())
    assert got[:2] == [("1", 0, 1, 0), ("2", 0, 1, 0)] and got[2] == got[3] and got[2][1] == 2
    assert mixing.entropy_mix(spark.createDataFrame([], schema)).collect() == []


# --- Token counts ------------------------------------------------------------


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_token_counts_stitch_blocks(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    expected, paths = {}, []
    for f in range(3):
        lengths = rng.choice([0, 0, 1, 5, 30], 20)
        ids = [x for n in lengths for x in (*rng.integers(0, 9, n), 50256)]
        tail = int(rng.integers(0, 3))
        ids += [1] * tail
        path = str(tmp_path / f"t{f}")
        np.array(ids, "<u2").tofile(path)
        paths.append((path, len(ids)))
        expected |= {(path, k): int(n) for k, n in enumerate([*lengths, *([tail] if tail else [])])}
    empty = str(tmp_path / "empty")
    open(empty, "w").close()
    files = spark.createDataFrame([*paths, paths[0], (empty, 0)], "file string, file_tokens long")
    got = {(r.file, r.ordinal): r.n_tokens for r in token_counts.count_tokens(files, block_tokens=block).collect()}
    assert got == expected


def test_token_files_round_trip(spark):
    import tiktoken

    schema = "doc_id long, text string, file string, ordinal long"
    rows = [(1, "Hello there, world", "f", 1), (2, None, "f", 1), (3, "", "f", 1), (None, "<|endoftext|> text", "f", 1), (4, "long text " * 30_000, "f", 1), (4, "long text " * 30_000, "f", 1)]
    docs = spark.createDataFrame(rows, schema)
    manifest = token_counts.write_token_files(docs, scratch_path(spark, "tokens"))
    counts = token_counts.count_tokens(manifest.filter("file_tokens IS NOT NULL"), block_tokens=1000)
    got = sorted((str(r.doc_id), r.n_tokens) for r in manifest.join(counts, ["file", "ordinal"]).collect())
    with open(token_counts.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoder = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == sorted((str(r[0]), len(encoder.encode_ordinary(r[1] or ""))) for r in rows)
    nothing = token_counts.write_token_files(docs.filter("false"), scratch_path(spark, "tokens"))
    assert token_counts.count_tokens(nothing).collect() == []


def test_token_counts_hand_over_bounded_batches(spark, tmp_path, monkeypatch):
    """Neither the texts of a task nor the pieces of a block of empty documents are in a worker all at once."""
    kind, taken, given = type(spark.range(0)), str(tmp_path / "taken"), str(tmp_path / "given")
    mapped = kind.mapInPandas

    def watched(df, func, schema):
        def noted(frames, path):
            for frame in frames:
                with open(path, "a") as f:
                    f.write(f"{len(frame)}\n")
                yield frame

        return mapped(df, lambda batches: noted(func(noted(batches, taken)), given), schema)

    monkeypatch.setattr(kind, "mapInPandas", watched)
    docs = spark.range(0, 25_001, 1, 1).selectExpr("id AS doc_id", "CAST(NULL AS string) AS text")
    manifest = token_counts.write_token_files(docs, scratch_path(spark, "tokens"))
    counts = token_counts.count_tokens(manifest.filter("file_tokens IS NOT NULL"))
    got = manifest.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == [(k, 0) for k in range(25_001)]
    with open(taken) as f, open(given) as g:
        assert max(map(int, f)) <= 1000 and max(map(int, g)) <= 10_000


# --- Pipeline ----------------------------------------------------------------


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [edit_matching.normalise(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    model = line_crf.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = docs.collect()
    good = dict(zip([r.doc_id for r in rows], line_crf.score_texts([r.text for r in rows], model) >= 0.3))
    texts = {r.doc_id: r.text for r in rows if good[r.doc_id]}
    root = jaccard_roots(texts)[1]
    texts = {k: t for k, t in texts.items() if root[k] == k}
    clean = {k: t for k, t in texts.items() if not any(i in edit_matching.normalise(t) for i in items)}
    mixed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in mixed} <= set(clean) and all(r.text == clean[r.doc_id] for r in mixed)
    left_out = set(clean) - {r.doc_id for r in mixed}
    source = {r.doc_id: r.source for r in rows}
    sums = {}
    for k, t in clean.items():
        sums[source[k]] = sums.get(source[k], 0) + len(t.encode().split())
    targets = wanted_targets(sums)
    largest = max(len(t.split()) for t in clean.values())
    for s, t in targets.items():
        assert abs(sum(r.taken for r in mixed if r.source == s) - t) <= max(0.05 * t, largest / 2)
    assert len(left_out) < len(clean) / 2


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "some words of a usual document. they go on\nand on"
    rows = [(1, text, None, None, None), (1, text, None, None, None), (2, None, "en", "s", 1), (None, "", None, "s", 0), (None, text, "en", "s", 3), (3, "long words " * 20_000, "en", "s", 1)]
    folder = str(tmp_path)
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(9, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
    once = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect()]
    assert sorted(map(str, once)) == ["1", "2", "3", "None", "None"]
    # columns that are called like those of the stages keep their values
    clashing = ["score", "held_out", "predicted", "leaks", "n_shingles", "component_id", "id", "row"]
    named = docs.selectExpr("*", *[f"'own' AS {c}" for c in clashing])
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, named, folder)
        assert out.columns == named.columns, name
        assert {v for r in out.select(*clashing).collect() for v in r} <= {"own"}, name
    assert corpus_pipeline.run(spark, folder).count() > 0
    docs.filter("false").write.mode("overwrite").parquet(f"{folder}/none/documents.parquet")
    for t in ("benchmark", "labels"):
        os.symlink(f"{folder}/{t}.parquet", f"{folder}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").collect() == []


def five_word_roots(texts):
    """Components at similarity 0.8 on five-word shingles, by comparing all pairs."""
    sets = {k: shingles(t, 5) for k, t in texts.items()}
    keys = sorted(sets)
    near = [
        (a, b) for i, a in enumerate(keys) for b in keys[i + 1 :]
        if sets[a] & sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    ]
    return roots(keys, near)


def test_pipeline_drops_near_copies_by_the_general_rule(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(50)]
    texts = near_copies(3)
    first = len(texts)
    texts |= {first: " ".join(words), first + 1: " ".join([*words[:25], "other", *words[26:]])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    root = five_word_roots(texts)
    assert kept == {k for k in texts if root[k] == k} and first in kept and first + 1 not in kept


def test_pipeline_keeps_what_the_general_rule_keeps(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    root = five_word_roots(texts)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()}
    assert kept == {k for k in texts if root[k] == k}
