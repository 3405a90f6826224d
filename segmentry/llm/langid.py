"""Language identification: mixtures of languages by expectation-maximisation.

Training counts hashed letter trigrams of words per language over all training documents. A document is a bag of
words; each word is drawn from one of the languages with the product of its trigram probabilities. For each
document EM estimates the share of every language, starting with all of them; then the least language is taken out
and EM runs again, down to one. The set with the best likelihood less a penalty per language is kept.

Defined cases: a NULL or empty text and a text without a letter get `und`, no languages and score 0, as does every
text if nothing could be learned; equal shares go to the language that is first by name; repeated rows give
repeated rows; empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_text, column, map_texts, picked, send

UNDETERMINED = "und"
BUCKET_BITS = 16
#: Smoothing of a trigram count, steps of EM, and log-likelihood that one more language must win per log(words).
SMOOTHING, STEPS, PENALTY = 0.5, 12, 2.0
#: Weight of one trigram, below 1 as overlapping trigrams repeat each other's evidence.
TEMPER = 0.5
#: Words whose likelihoods a task remembers; longer words are never kept.
CACHE_WORDS, CACHE_LENGTH = 200_000, 40
#: Languages whose counts a training task holds at a time.
HELD_LANGUAGES = 64

_words = re.compile(r"[^\W\d_]+").findall


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of each word with its borders, word after word, and how many each word has."""
    codes = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (codes[2:] * np.uint64(0x165667B19E3779F9))) * np.uint64(0xD6E8FEB86659FD93)
    inside = codes[1:-1] != 32  # the middle letter tells the word
    return (mixed[inside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.fromiter(map(len, words), np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def count_trigrams(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> DataFrame:
    """`lang`, `bucket`, `n` over all documents with a language."""
    rows = docs.filter(column(lang_column).isNotNull()).select(
        column(lang_column).cast("string").alias("lang"), column(text_column).cast("string").alias("text")
    )

    def start():
        held: dict[str, np.ndarray] = {}

        def flush():
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at].astype(np.int64))],
                    ["lang", "bucket", "n"],
                )
            held.clear()

        def work(batch):
            if batch is None:
                yield from flush()
                return
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), as_text(batch), strict=True):
                by_lang.setdefault(lang, Counter()).update(_words(text.lower()))
            for lang, words in by_lang.items():
                if not words:
                    continue
                if lang not in held and len(held) >= HELD_LANGUAGES:
                    yield from flush()
                buckets, lengths = trigrams(list(words))
                weights = np.repeat(np.fromiter(words.values(), np.int64), lengths)
                counts = np.bincount(buckets, weights, 1 << BUCKET_BITS)
                held[lang] = held[lang] + counts if lang in held else counts

        return work

    counted = map_texts(rows, "lang string, bucket long, n long", start, finish=True)
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities of the trigram buckets for each language; 256 KB a language."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in counts})
        rows = {lang: i for i, lang in enumerate(self.langs)}
        table = np.full((len(self.langs), 1 << BUCKET_BITS), SMOOTHING)
        for lang, bucket, n in counts:
            table[rows[lang], bucket] += n
        self.log = np.log(table / table.sum(1, keepdims=True)).astype(np.float32).T.copy()

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row per word: its likelihood in each language, relative to the likeliest."""
        buckets, lengths = trigrams(words)
        scores = np.add.reduceat(self.log[buckets], np.cumsum(lengths) - lengths, axis=0) * TEMPER
        return np.exp(scores - scores.max(1, keepdims=True))


def mixtures(scores: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each language for each document, and the number of languages kept.

    Rows of `scores` and `counts` are the distinct words, document after document from `starts`.
    """
    n_docs, n_langs = len(starts), scores.shape[1]
    doc = np.repeat(np.arange(n_docs), np.diff(np.append(starts, len(scores))))
    totals = np.add.reduceat(counts, starts)
    shares = np.full((n_docs, n_langs), 1 / n_langs, np.float32)
    best, best_value, kept = shares, np.full(n_docs, -np.inf), np.full(n_docs, n_langs)
    for size in range(n_langs, 0, -1):
        for _ in range(STEPS if size > 1 else 0):
            parts = scores * shares[doc]
            parts *= (counts / parts.sum(1))[:, None]
            shares = np.add.reduceat(parts, starts, axis=0) / totals[:, None]
            shares = np.maximum(shares, 1e-30 * (shares > 0))
        mixed = np.maximum((scores * shares[doc]).sum(1), 1e-30)
        value = np.add.reduceat(counts * np.log(mixed), starts) - PENALTY * (size - 1) * np.log(totals + 1)
        better = value >= best_value
        best, best_value, kept = np.where(better[:, None], shares, best), np.where(better, value, best_value), np.where(better, size, kept)
        if size > 1:  # the least share goes; of equal ones the last by name
            shares = shares.copy()
            order = np.argsort(-shares, axis=1, kind="stable")
            shares[np.arange(n_docs), order[:, size - 1]] = 0
            shares /= np.maximum(shares.sum(1, keepdims=True), 1e-30)
    return best, kept


def learn(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> Model:
    """Count over all documents with a language; only the bounded table per language comes to the driver."""
    return Model([(r.lang, r.bucket, r.n) for r in count_trigrams(docs, lang_column, text_column).collect()])


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id`, `lang_pred`, `score` (share of that language), `languages` (kept ones, largest first), `shares`."""
    shared = send(docs, model)

    def start():
        model = shared()
        known: dict[str, int] = {}
        table = np.empty((0, len(model.langs)), np.float32)

        def work(batch):
            nonlocal table
            texts = as_text(batch)
            bags = [Counter(_words(t.lower())) if model.langs and has_letter(t) else {} for t in texts]
            if len(known) > CACHE_WORDS:
                known.clear()
                table = table[:0]
            new = list({w for bag in bags for w in bag if w not in known})
            kept = [w for w in new if len(w) <= CACHE_LENGTH]
            new = kept + [w for w in new if len(w) > CACHE_LENGTH]
            rows = table
            if new:
                rows = np.concatenate([table, model.word_scores(new)])
            at = {w: len(table) + i for i, w in enumerate(new)}
            full = [i for i, bag in enumerate(bags) if bag]
            out_lang, out_score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            out_set: list[list[str]] = [[]] * len(texts)
            out_shares: list[list[float]] = [[]] * len(texts)
            if full:
                lengths = np.fromiter((len(bags[i]) for i in full), np.int64)
                find = known.get
                ids = np.fromiter((k if (k := find(w)) is not None else at[w] for i in full for w in bags[i]), np.int64)
                counts = np.fromiter((n for i in full for n in bags[i].values()), np.float64)
                shares, sizes = mixtures(rows[ids], counts, np.cumsum(lengths) - lengths)
                order = np.argsort(-shares, axis=1, kind="stable")
                for k, i in enumerate(full):
                    own = order[k, : sizes[k]]
                    out_lang[i], out_score[i] = model.langs[own[0]], min(1.0, float(shares[k, own[0]]))
                    out_set[i], out_shares[i] = [model.langs[x] for x in own], [float(shares[k, x]) for x in own]
            table = rows[: len(table) + len(kept)]
            known.update((w, at[w]) for w in kept)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(out_lang), pa.array(out_score),
                    pa.array(out_set, pa.list_(pa.string())), pa.array(out_shares, pa.list_(pa.float64())),
                ],
                ["doc_id", "lang_pred", "score", "languages", "shares"],
            )

        return work

    schema = "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>"
    return map_texts(picked(docs, id_column, text_column), schema, start)


def is_known(prediction: Column) -> Column:
    return prediction != UNDETERMINED
