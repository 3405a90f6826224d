"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled good; all documents are unlabelled web text, good and bad mixed. A logistic
model on surface features minimises the non-negative unbiased risk: with class prior p, losses of positives as
positives count p, and unlabelled losses as negatives less p times the positives' ones as negatives, never below zero;
where that part falls below zero its gradient is turned round. The prior is estimated first, from a discriminator of
positives against unlabelled text: of no part that is found by its score alone can the unlabelled share be below the
prior times the positive share, so the least ratio is the prior.

Features are the square roots of the shares of ASCII characters, of hashed short words, and of a few counts of words
and lines (repeats, distinct words, lengths). They are written once. All documents are dealt by hash into groups of
about `GROUP_ROWS`, whatever their number; each group estimates its prior and fits a model against the trusted
positives, and the model is the mean of theirs, on features scaled by the moments of all documents. No task holds
more than a group. Of the labelled positives at most `POSITIVE_ROWS` are used, those with the smallest id hash.

Defined cases: NULL text is empty; an empty text has features zero and a score like any other; labels other than 1 are
not used; without a positive label every score is 0; rows that repeat id and text count once in the fit and give repeated rows; empty tables give empty tables;
other columns are ignored.
"""

from __future__ import annotations

import io
import operator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_bytes, map_texts, picked, pieces, send
from segmentry.llm.toxicity import label_rows, smallest_hashes
from segmentry.session import cut

#: Labelled positives that training reads at most, and documents that are fitted together, on average.
POSITIVE_ROWS, GROUP_ROWS = 6000, 9000
#: Tasks that merge the sums of all others.
MERGERS = 16
SHORT_WORD, WORD_BUCKETS = 4, 256
STEPS, RATE = 400, 0.05
#: Weight decay for n positives is DECAY_ROWS / n, and more for the discriminator of the prior, which must not overfit.
DECAY_ROWS, PRIOR_DECAY_ROWS = 5.0, 30.0
#: The prior looks at scores that at least this share of the positives reach.
LEAST_REACH = 0.5
N_FEATURES = 128 + WORD_BUCKETS + 8


def features(text: bytes, buckets: dict[bytes, int]) -> np.ndarray:
    out = np.zeros(N_FEATURES, np.float32)
    if not text:
        return out
    out[:128] = np.bincount(np.frombuffer(text, np.uint8), minlength=256)[:128] / len(text)
    words = text.lower().split()
    n = len(words)
    if n:
        short = [w for w in words if len(w) <= SHORT_WORD]
        hashed = []
        for w in short:
            b = buckets.get(w)
            if b is None:
                b = buckets[w] = xxhash.xxh32_intdigest(w) % WORD_BUCKETS
            hashed.append(b)
        out[128 : 128 + WORD_BUCKETS] = np.bincount(hashed, minlength=WORD_BUCKETS) / n if hashed else 0
        distinct = len(set(words))
        lines = text.split(b"\n")
        lengths = np.fromiter(map(len, words), np.int64, n)
        out[128 + WORD_BUCKETS :] = (
            distinct / n,
            sum(map(operator.eq, words, words[1:])) / n,
            len(set(lines)) / len(lines),
            len(short) / n,
            min(1.0, float(lengths.mean()) / 32),
            min(1.0, float(lengths.std()) / 32),
            min(1.0, n / len(lines) / 256),
            min(1.0, np.log1p(n) / 16),
        )
    return np.sqrt(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float, prior: float):
        self.mean, self.scale, self.weights, self.bias, self.prior = mean, scale, weights, bias, prior

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((rows - self.mean) / self.scale, -6, 6) @ self.weights + self.bias)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, mean=self.mean, scale=self.scale, weights=self.weights, bias=self.bias, prior=self.prior)
        return out.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> Model:
        x = np.load(io.BytesIO(raw))
        return Model(x["mean"], x["scale"], x["weights"], float(x["bias"]), float(x["prior"]))


def empty_model() -> Model:
    return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), -40.0, 0.0)


def _descend(n: int, gradient, decay: float, steps: int = STEPS) -> np.ndarray:
    """Adam on the weights and the bias (the last entry)."""
    w, mean, square = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        g = gradient(w)
        g[:-1] += decay * w[:-1]
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        w -= RATE * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return w


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Least ratio of the unlabelled to the positive share above a score, each fold scored by the other's discriminator."""
    ratios = []
    random = np.random.default_rng(11)  # rows may come in an order that says something about them
    positive, unlabelled = (x[random.permutation(len(x))] for x in (positive, unlabelled))
    for fold in (0, 1):
        p, u = positive[fold::2], unlabelled[fold::2]
        ones_p, ones_u = np.column_stack((p, np.ones(len(p)))), np.column_stack((u, np.ones(len(u))))

        def gradient(w, ones_p=ones_p, ones_u=ones_u):
            miss_p, miss_u = _sigmoid(ones_p @ w) - 1, _sigmoid(ones_u @ w)
            return ones_p.T @ miss_p / len(ones_p) + ones_u.T @ miss_u / len(ones_u)

        w = _descend(p.shape[1], gradient, PRIOR_DECAY_ROWS / max(1, len(p)), STEPS // 2)
        other_p, other_u = positive[1 - fold :: 2] @ w[:-1], unlabelled[1 - fold :: 2] @ w[:-1]
        if not len(other_p) or not len(other_u):
            continue
        at = np.quantile(other_p, np.linspace(0, 1 - LEAST_REACH, 101))
        reach_p = np.array([(other_p >= t).mean() for t in at])
        reach_u = np.array([(other_u >= t).mean() for t in at])
        # One standard error is added, or the least of many ratios would be too small.
        noise = np.sqrt(reach_u * (1 - reach_u) / len(other_u)) / reach_p
        ratios.append(float((reach_u / reach_p + noise).min()))
    return float(np.clip(np.mean(ratios), 0.05, 0.98)) if ratios else 0.5


def train(positive: np.ndarray, unlabelled: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Model:
    """Fit one group of unlabelled rows, on features scaled by the moments of all."""
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    prior = class_prior(p, u)
    p, u = np.column_stack((p, np.ones(len(p)))), np.column_stack((u, np.ones(len(u))))

    def gradient(w):
        at_p, at_u = p @ w, u @ w
        as_positive = p.T @ (_sigmoid(at_p) - 1) / len(p)
        negative_risk = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        as_negative = u.T @ _sigmoid(at_u) / len(u) - prior * (p.T @ _sigmoid(at_p) / len(p))
        return prior * as_positive + as_negative if negative_risk >= 0 else -as_negative

    w = _descend(p.shape[1] - 1, gradient, DECAY_ROWS / len(p))
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def _featured(docs: DataFrame) -> DataFrame:
    """`doc_id`, `x` (features, float32 numbers as bytes)."""

    def start():
        buckets: dict[bytes, int] = {}

        def work(batch):
            if len(buckets) > 1_000_000:
                buckets.clear()
            rows = [features(t, buckets).tobytes() for t in as_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "x"])

        return work

    return map_texts(docs, "doc_id long, x binary", start)


def _matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float32).reshape(-1, N_FEATURES)


def _summed(parts: DataFrame) -> np.ndarray | None:
    """The sum of all `part`, arrays of float64 as bytes; only one such array comes to the driver."""

    def merged(batches):
        total = None
        for batch in batches:
            for part in batch.column("part").to_pylist():
                own = np.frombuffer(part, np.float64)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    for tasks in (MERGERS, 1):
        parts = parts.repartition(tasks).mapInArrow(merged, "part binary")
    found = parts.collect()
    return np.frombuffer(bytes(found[0].part), np.float64) if found else None


def moments(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, and mean and scale of their features."""

    def partial(batches):
        total = np.zeros(1 + 2 * N_FEATURES)
        for batch in batches:
            for piece in pieces(batch):
                x = _matrix(piece.column("x").to_pylist()).astype(np.float64)
                total += np.concatenate(([len(x)], x.sum(0), np.square(x).sum(0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    total = _summed(rows.select("x").mapInArrow(partial, "part binary"))
    if total is None or not total[0]:
        return 0, np.zeros(N_FEATURES), np.ones(N_FEATURES)
    mean, square = total[1:].reshape(2, -1) / total[0]
    return int(total[0]), mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-3


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", positive_rows: int = POSITIVE_ROWS, group_rows: int = GROUP_ROWS
) -> Model:
    """Fit on documents of `docs` that `labels` calls good, and on all documents of `docs` as unlabelled text."""
    good = smallest_hashes(label_rows(labels, label).filter("label = 1").select("doc_id"), positive_rows)
    rows = cut(_featured(picked(docs)).dropDuplicates(["doc_id", "x"]))
    found = rows.join(F.broadcast(good), "doc_id").select("doc_id", "x").orderBy("doc_id", "x").collect()
    if not found:
        return empty_model()
    # Texts that differ under one id are one document, the first by its features.
    texts = {r.doc_id: bytes(r.x) for r in reversed(found)}
    n, mean, scale = moments(rows)
    groups = max(1, round(n / group_rows))
    shared = send(rows, (_matrix([texts[i] for i in sorted(texts)]), mean, scale))

    def fit(batches):
        positive, mean, scale = shared()
        held, last, total = [], None, np.zeros(N_FEATURES + 3)

        def fitted():
            model = train(positive, _matrix(held), mean, scale)
            return np.concatenate((model.weights, [model.bias, model.prior, 1]))

        for batch in batches:
            for group, x in zip(batch.column("group").to_pylist(), batch.column("x").to_pylist(), strict=True):
                if group != last and held:
                    total, held = total + fitted(), []
                last = group
                held.append(x)
        if held:
            total = total + fitted()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "x"), F.lit(groups)).alias("group"), "doc_id", "x")
    # The number of partitions is given, so that adaptive execution does not put many small groups into one task.
    dealt = dealt.repartition(groups, "group").sortWithinPartitions("group", "doc_id", "x").select("group", "x")
    total = _summed(dealt.mapInArrow(fit, "part binary"))
    *weights, bias, prior = total[:-1] / total[-1]
    return Model(mean, scale, np.array(weights), float(bias), float(prior))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id`, `score` (0 to 1, higher is better)."""
    shared = send(docs, model)

    def start():
        model, buckets = shared(), {}

        def work(batch):
            if len(buckets) > 1_000_000:
                buckets.clear()
            rows = np.array([features(t, buckets) for t in as_bytes(batch)], np.float32).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(rows))], ["doc_id", "score"])

        return work

    return map_texts(picked(docs, id_column, text_column), "doc_id long, score double", start)
