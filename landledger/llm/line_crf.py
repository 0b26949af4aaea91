"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. The score of a line's label comes from features of
the line and of the lines before and after it; a second score couples the
labels of neighbouring lines. Forward-backward gives each line's marginal
probability of being good, the marginals are averaged with the lines' lengths
as weights, and a logistic curve fitted on the same training documents turns
the average into a probability.

The model is trained on the driver from a bounded sample of labelled documents
(``MAX_DOCS`` whole documents); each line of a training
document carries its document's label. Scoring is a map over whole texts: Arrow
batches in, one probability per document out, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.shared import table

# Bounds of the training sample; scoring has none.
MAX_DOCS = 3000
THRESHOLD = 0.3
STEPS, RATE, PENALTY = 250, 0.05, 1e-3

# Byte classes: letters A-Z, a-z, digits, white space, sentence marks, other marks.
_CLASS = np.full(256, 5, dtype=np.uint8)
_CLASS[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = 0
_CLASS[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)] = 1
_CLASS[128:] = 1  # parts of letters beyond ASCII
_CLASS[np.frombuffer(b"0123456789", np.uint8)] = 2
_CLASS[np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8)] = 3
_CLASS[np.frombuffer(b".,;:'\"?-()", np.uint8)] = 4
OWN = 10


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x OWN features, length in bytes plus one) of the lines of a text.

    NULL and empty texts are one empty line.
    """
    raw = (text or "").encode("utf-8", "replace")
    lines = raw.split(b"\n")
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    kinds = _CLASS[np.frombuffer(raw + b"\n", np.uint8)]
    counts = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(6)], axis=1)
    words = np.empty(len(lines))
    repeats = np.empty(len(lines))
    distinct = np.empty(len(lines))
    for i, line in enumerate(lines):
        split = line.split()
        n = len(split)
        words[i] = n
        repeats[i] = sum(map(bytes.__eq__, split, split[1:])) if n > 1 else 0
        distinct[i] = len(set(split))
    w = np.maximum(words, 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)
    features = np.stack(
        [
            np.ones(len(lines)),
            words == 0,
            np.log1p(words) / 5,
            counts[:, 0] / letters,
            np.minimum(counts[:, 5] / w, 4),
            np.minimum(counts[:, 4] / w, 2),
            np.minimum(counts[:, 2] / w, 4),
            repeats / w,
            1 - distinct / w,
            np.minimum(letters / w, 20) / 10,
        ],
        axis=1,
    ).astype(np.float32)
    return features, lengths + 1


def with_neighbours(features: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it."""
    out = np.zeros((len(features), 3 * OWN), np.float32)
    out[:, :OWN] = features
    out[1:, OWN : 2 * OWN] = features[:-1]
    out[:-1, 2 * OWN :] = features[1:]
    return out


@dataclass
class Model:
    """``emission`` and ``start`` favour good; ``coupling[a, b]`` goes from label a to b."""

    emission: np.ndarray
    start: float
    coupling: np.ndarray
    slope: float = 1.0
    offset: float = 0.0


def _softplus_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, model: Model):
    """Log messages over padded chains.

    ``scores`` is documents x lines, the good label's score (the bad label's is
    0). Returns (alpha, beta, log normaliser); positions past a chain's end
    pass its last message on.
    """
    n, t = scores.shape
    c = model.coupling
    alpha, beta = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    alpha[:, 0, 1] = scores[:, 0] + model.start
    for i in range(1, t):
        live = (i < lengths)[:, None]
        to_bad = _softplus_pair(alpha[:, i - 1, 0] + c[0, 0], alpha[:, i - 1, 1] + c[1, 0])
        to_good = _softplus_pair(alpha[:, i - 1, 0] + c[0, 1], alpha[:, i - 1, 1] + c[1, 1]) + scores[:, i]
        alpha[:, i] = np.where(live, np.stack([to_bad, to_good], 1), alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        live = (i + 1 < lengths)[:, None]
        good = beta[:, i + 1, 1] + scores[:, i + 1]
        from_bad = _softplus_pair(beta[:, i + 1, 0] + c[0, 0], good + c[0, 1])
        from_good = _softplus_pair(beta[:, i + 1, 0] + c[1, 0], good + c[1, 1])
        beta[:, i] = np.where(live, np.stack([from_bad, from_good], 1), 0.0)
    return alpha, beta, np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])


def _marginals(scores, lengths, model):
    alpha, beta, log_z = forward_backward(scores, lengths, model)
    return 1 / (1 + np.exp(np.clip(alpha[..., 0] + beta[..., 0] - alpha[..., 1] - beta[..., 1], -500, 500))), alpha, beta, log_z


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), lengths.max(), *rows[0].shape[1:]), rows[0].dtype)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, lengths


def _batches(order: np.ndarray, lengths: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """Documents of like length together, so that padding and memory stay small."""
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and (end - begin + 1) * lengths[order[end]] <= cells:
            end += 1
        yield order[begin:end]
        begin = end


def train(documents: list[np.ndarray], weights: list[np.ndarray], labels: np.ndarray) -> Model:
    """Maximise the conditional likelihood of all lines' labels by Adam steps.

    Each document counts with the square root of its lines, classes count
    alike. Without documents, or with one class only, the model is flat: its
    score is the share of good documents (one half without any).
    """
    size = 3 * OWN
    model = Model(np.zeros(size), 0.0, np.zeros((2, 2)))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    if len(set(labels.tolist())) < 2:
        model.slope, model.offset = 0.0, float(np.log(share / (1 - share)))
        return model
    lengths = np.array([len(d) for d in documents])
    groups = []
    for chosen in _batches(np.argsort(lengths, kind="stable"), lengths, 20_000):
        x, n = _padded([documents[i] for i in chosen])
        groups.append((x, n, labels[chosen].astype(float)))
    balance = {c: 0.5 / max((labels == c).mean(), 1e-9) for c in (0, 1)}
    theta = np.zeros(size + 5)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        model.emission, model.start, model.coupling = theta[:size], theta[size], theta[size + 1 :].reshape(2, 2)
        gradient = np.zeros_like(theta)
        for x, n, y in groups:
            scores = x @ model.emission
            p, alpha, beta, log_z = _marginals(scores, n, model)
            inside = np.arange(x.shape[1])[None, :] < n[:, None]
            scale = np.where(y == 1, balance[1], balance[0]) / np.sqrt(n)
            off = (y[:, None] - p) * inside * scale[:, None]
            gradient[:size] += np.einsum("ntf,nt->f", x, off)
            gradient[size] += off[:, 0].sum()
            if x.shape[1] > 1:
                live = (inside[:, 1:] * scale[:, None])[..., None, None]
                tail = np.stack([beta[:, 1:, 0], beta[:, 1:, 1] + scores[:, 1:]], -1)
                joint = alpha[:, :-1, :, None] + model.coupling + tail[:, :, None, :] - log_z[:, None, None, None]
                expected = (np.exp(np.minimum(joint, 0)) * live).sum((0, 1))
                seen = np.zeros((2, 2))
                steps = (n - 1) * scale
                seen[0, 0], seen[1, 1] = steps[y == 0].sum(), steps[y == 1].sum()
                gradient[size + 1 :] += (seen - expected).ravel()
        gradient = gradient / len(labels) - PENALTY * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model.emission, model.start, model.coupling = theta[:size], float(theta[size]), theta[size + 1 :].reshape(2, 2)
    means = np.array([mean_marginal(d, w, model) for d, w in zip(documents, weights)])
    _calibrate(model, _logit(means), labels)
    return model


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _calibrate(model: Model, x: np.ndarray, labels: np.ndarray) -> None:
    """Logistic curve by Newton steps with a small ridge."""
    design = np.stack([x, np.ones_like(x)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (labels - p) - 1e-2 * theta)
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.offset = float(max(theta[0], 0.0)), float(theta[1])


def mean_marginal(features: np.ndarray, weights: np.ndarray, model: Model) -> float:
    """Length-weighted mean of the lines' probabilities of being good."""
    scores = (features @ model.emission)[None, :]
    p = _marginals(scores, np.array([len(features)]), model)[0]
    return float((p[0] * weights).sum() / weights.sum())


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    """Probability that each document is good. Chains of like length run together."""
    documents, weights = [], []
    for text in texts:
        own, length = line_features(text)
        documents.append(with_neighbours(own) @ model.emission)
        weights.append(length)
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    means = np.empty(len(documents))
    for chosen in _batches(np.argsort(lengths, kind="stable"), lengths, 50_000):
        scores, n = _padded([documents[i] for i in chosen])
        weight, _ = _padded([weights[i] for i in chosen])
        means[chosen] = (_marginals(scores, n, model)[0] * weight).sum(1) / weight.sum(1)
    return 1 / (1 + np.exp(-(model.slope * _logit(means) + model.offset)))


def _held_out():
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return F.coalesce(fold == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Train on at most ``max_docs`` labelled documents outside the held-out fold, each of them whole.

    The sample is the documents whose hashed id is smallest, and of rows that
    repeat an id the one whose hashed text is. Several labels of a document
    count as their mean, rounded half up; NULL labels do not count.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .filter(~_held_out())
        .groupBy("doc_id")
        .agg(F.floor(F.avg("quality") + 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
    )

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, label in zip(batch["doc_id"], batch["text"], batch["label"]):
                own, lengths = line_features(text)
                rows.append((doc_id, label, with_neighbours(own).tobytes(), lengths.astype("<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "x", "w"])

    # at most max_docs labels, so the broadcast is bounded
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    # one row per id, chosen in the map tasks
    chosen = chosen.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).getField("text").alias("text"))
    rows = chosen.mapInPandas(sampled, "doc_id long, label int, x binary, w binary").collect()
    rows = sorted(rows, key=lambda r: r.doc_id)
    x = [np.frombuffer(r.x, np.float32).reshape(-1, 3 * OWN) for r in rows]
    w = [np.frombuffer(r.w, "<i8") for r in rows]
    return train(x, w, np.array([r.label for r in rows], dtype=int))


def with_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Documents with ``held_out``, ``score`` and ``predicted``.

    Only the text is scored. Repeated rows get equal scores; NULL and empty
    texts are scored as one empty line. Columns that clash are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # a few thousand texts may be gigabytes: score them in small portions
            out, portion, size = [], [], 0
            for text in texts:
                portion.append(text)
                size += len(text or "")
                if size > 4_000_000:
                    out.append(score_texts(portion, model))
                    portion, size = [], 0
            if portion:
                out.append(score_texts(portion, model))
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return (
        docs.withColumn("held_out", _held_out())
        .withColumn("score", score("text"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def op5_line_crf(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, folder, "labels"))
    return with_quality(docs, model).select("doc_id", "held_out", "score", "predicted")
