"""Toxicity scores: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the weighted sum of the vectors of the whole word and of its character n-grams (with borders), all
hashed to one table; a document's vector is the mean over its words; two logits are linear in it. Table and softmax are
trained together by gradient descent on a bounded sample of labelled documents. An unseen misspelling shares most of its n-grams
with words that were seen. As all is linear until the softmax, scoring needs one number per table row and word.

The sample is at most `SAMPLE_ROWS` labelled documents of each class, the ones with the smallest id hash; class
weights bring back the shares of all labelled documents. Training runs in one task on this sample.

Defined cases: labels other than 0 and 1, NULL labels and NULL ids of labels are left out, a document with both labels
is toxic; a text without words scores as the share of toxic labels among documents without a hint; without labels of both
classes every score is the share of toxic ones (0 if there are none); repeated rows give repeated rows; empty tables
give empty tables; other columns are ignored.
"""

from __future__ import annotations

import io
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_text, column, map_texts, picked, send

#: Labelled documents of each class that training reads at most.
SAMPLE_ROWS = 3000
BUCKETS, WIDTH, LEAST_GRAM, MOST_GRAM = 1 << 17, 12, 3, 6
STEPS, RATE = 300, 0.02
#: Documents of the sample that must use a table row (counted by word); other rows stay zero.
LEAST_USE = 12
#: Words of a text are averaged as if there were at least so many.
LEAST_WORDS = 40
CACHE_WORDS, CACHE_LENGTH = 300_000, 40

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    return _words(text.lower())


def weights_of(sizes: np.ndarray) -> np.ndarray:
    """Weights of the rows of words with so many rows: one half for the whole word; its k n-grams weigh half a root of k
    together, so that both parts learn equally fast and neither leaves all evidence to the other."""
    weights = np.repeat(0.5 / np.sqrt(np.maximum(sizes - 1, 1)), sizes)
    weights[np.cumsum(sizes) - sizes] = 0.5
    return weights


def subwords(word: str) -> list[int]:
    """Table rows of the whole word and its character n-grams."""
    raw = f"<{word}>"
    grams = [raw]
    for n in range(LEAST_GRAM, MOST_GRAM + 1):
        grams += [raw[i : i + n] for i in range(len(raw) - n + 1)]
    return [xxhash.xxh32_intdigest(g.encode()) % BUCKETS for g in grams]


class Bags:
    """Documents as counted words and words as table rows, flat."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        bags = [Counter(words_of(t)) for t in texts]
        self.word = np.array([numbers.setdefault(w, len(numbers)) for bag in bags for w in bag], np.int64)
        count = np.array([n for bag in bags for n in bag.values()], np.float32)
        self.doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        totals = np.maximum(np.bincount(self.doc, count, len(bags)), LEAST_WORDS)
        self.share = (count / totals[self.doc]).astype(np.float32)
        rows = [subwords(w) for w in numbers]
        sub = np.array([x for r in rows for x in r], np.int64)
        sizes = np.array([len(r) for r in rows], np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        self.n_words, self.n_docs = len(rows), len(bags)
        use = np.bincount(sub, np.bincount(self.word, minlength=self.n_words)[owner], BUCKETS)
        self.used = np.flatnonzero(use >= LEAST_USE)
        kept = use[sub] >= LEAST_USE
        self.sub, self.owner = np.searchsorted(self.used, sub[kept]), owner[kept]
        self.part = weights_of(sizes)[kept]

    def logits(self, row_values: np.ndarray) -> np.ndarray:
        words = np.bincount(self.owner, row_values[self.sub] * self.part, self.n_words)
        return np.bincount(self.doc, words[self.word] * self.share, self.n_docs)

    def row_gradient(self, doc_gradient: np.ndarray) -> np.ndarray:
        words = np.bincount(self.word, doc_gradient[self.doc] * self.share, self.n_words)
        return np.bincount(self.sub, words[self.owner] * self.part, len(self.used))


class Momentum:
    """Gradient steps with momentum; each array's step is scaled by the size of its whole gradient, not entry by entry,
    so that rows with consistent evidence move far and rows with noise hardly at all."""

    def __init__(self, *values: np.ndarray):
        self.values = values
        self.mean = [np.zeros_like(v) for v in values]
        self.square = [0.0 for _ in values]
        self.step = 0

    def move(self, rate: float, *gradients: np.ndarray) -> None:
        self.step += 1
        for i, (value, mean, g) in enumerate(zip(self.values, self.mean, gradients, strict=True)):
            mean += 0.1 * (g - mean)
            self.square[i] += 0.05 * (float((g * g).mean()) - self.square[i])
            size = np.sqrt(self.square[i] / (1 - 0.95**self.step)) + 1e-12
            value -= rate * mean / (1 - 0.9**self.step) / size


class Model:
    """Value of each table row for the toxic class, and the bias."""

    def __init__(self, rows: np.ndarray, bias: float):
        self.rows, self.bias = rows, bias

    def word_values(self, words: list[str]) -> np.ndarray:
        rows = [subwords(w) for w in words]
        sizes = np.fromiter(map(len, rows), np.int64)
        flat = np.fromiter((x for r in rows for x in r), np.int64)
        return np.add.reduceat(self.rows[flat] * weights_of(sizes), np.cumsum(sizes) - sizes)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, rows=self.rows.astype(np.float32), bias=self.bias)
        return out.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> Model:
        loaded = np.load(io.BytesIO(raw))
        return Model(loaded["rows"].astype(np.float64), float(loaded["bias"]))


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Model:
    """Fit the table and the softmax together; `weights` make the sample stand for all labelled documents."""
    share = float((weights * labels).sum() / max(weights.sum(), 1e-12))
    if not 0 < share < 1:
        return Model(np.zeros(BUCKETS), 40.0 if share else -40.0)
    bags = Bags(texts)
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.01, (len(bags.used), WIDTH)).astype(np.float32)
    softmax = random.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    bias = np.log([1 - share, share]).astype(np.float32)
    weights = weights / weights.sum()
    moves = Momentum(table, softmax, bias)
    for step in range(STEPS):
        toward = softmax[:, 1] - softmax[:, 0]
        logit = bags.logits(table @ toward) + (bias[1] - bias[0])
        miss = (1 / (1 + np.exp(-logit)) - labels) * weights
        rows = bags.row_gradient(miss).astype(np.float32)
        pull = table.T @ rows
        rate = RATE * (1 - step / STEPS)
        moves.move(
            rate, np.outer(rows, toward), np.column_stack((-pull, pull)), np.array([-miss.sum(), miss.sum()], np.float32)
        )
    values = np.zeros(BUCKETS)
    values[bags.used] = table @ (softmax[:, 1] - softmax[:, 0])
    return Model(values, float(bias[1] - bias[0]))


def label_rows(labels: DataFrame, label: str, id_column: str = "doc_id") -> DataFrame:
    """`doc_id`, `label` (0 or 1), one row per document; the larger label counts."""
    rows = labels.select(column(id_column).cast("long").alias("doc_id"), column(label).cast("int").alias("label"))
    return rows.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))


def smallest_hashes(rows: DataFrame, n: int) -> DataFrame:
    """n rows with the smallest id hash, the same ones on every run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "toxic") -> Model:
    """Train on at most `sample_rows` documents per class of `docs` that `labels` marks."""
    known = label_rows(labels, label)
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = [
        smallest_hashes(known.filter(F.col("label") == k), sample_rows).withColumn("weight", F.lit(n / min(n, sample_rows)))
        for k, n in sorted(sizes.items())
    ]
    if not chosen:
        return Model(np.zeros(BUCKETS), -40.0)
    ids = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    sample = picked(docs).join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])

    def fit(batches):
        texts, marks, weights = [], [], []
        for batch in batches:
            order = np.argsort(batch.column("doc_id").to_numpy(zero_copy_only=False))
            found = as_text(batch)
            texts += [found[i] for i in order]
            marks += batch.column("label").take(pa.array(order)).to_pylist()
            weights += batch.column("weight").take(pa.array(order)).to_pylist()
        model = train(texts, np.array(marks, np.float64), np.array(weights)) if texts else Model(np.zeros(BUCKETS), -40.0)
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], ["model"])

    # A bounded sample, in one task and in one order, so that the model is the same on every run.
    one = sample.select("doc_id", "text", "label", "weight").repartition(1).sortWithinPartitions("doc_id")
    found = one.mapInArrow(fit, "model binary").collect()
    return Model.from_bytes(bytes(found[0].model)) if found else Model(np.zeros(BUCKETS), -40.0)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id`, `score` (0 to 1, higher is more toxic), `n_words`."""
    shared = send(docs, model)

    def start():
        model = shared()
        known: dict[str, float] = {}
        find = known.get

        def work(batch):
            scores, sizes = [], []
            for text in as_text(batch):
                words = words_of(text)
                new = [w for w in dict.fromkeys(words) if w not in known]
                if len(known) + len(new) > CACHE_WORDS:
                    known.clear()
                    new = list(dict.fromkeys(words))
                own = dict(zip(new, model.word_values(new).tolist(), strict=True)) if new else {}
                known.update((w, v) for w, v in own.items() if len(w) <= CACHE_LENGTH)
                total = sum([v if (v := find(w)) is not None else own[w] for w in words])
                logit = total / max(len(words), LEAST_WORDS) + model.bias
                scores.append(float(1 / (1 + np.exp(-np.clip(logit, -50, 50)))))
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())], ["doc_id", "score", "n_words"]
            )

        return work

    return map_texts(picked(docs, id_column, text_column), "doc_id long, score double, n_words long", start)


def predicted(value: Column, threshold: float) -> Column:
    return (value >= threshold).cast("int")
