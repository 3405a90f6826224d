"""Document fingerprints by Order MinHash.

The k-mers of a text (code points) are numbered by occurrence, so a repeated k-mer counts as often as it stands there.
Each of `functions` hash functions selects the `picks` smallest numbered k-mers, puts them back into text order and
hashes the tuple of k-mers. The share of equal tuples is high only if the texts have much in common in the same
order, which follows edit distance; it falls when parts are moved, unlike with plain MinHash.

Defined cases: NULL text is empty; an empty text has the tuple hash zero throughout and likeness 1 to another one; a
text shorter than k is one k-mer; fewer numbered k-mers than `picks` are all selected; repeated rows give repeated
rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_text, map_texts, picked, pieces
from segmentry.llm.repeats import gram_hashes, with_ids, without_ids
from segmentry.operators.ordering import split_points, with_piece

K, FUNCTIONS, PICKS = 8, 24, 2
#: Numbered k-mers that are hashed at a time.
_BLOCK = 1 << 15


class OrderMinHash:
    def __init__(self, k: int = K, functions: int = FUNCTIONS, picks: int = PICKS, seed: int = 42):
        if k & (k - 1):
            raise ValueError("k is a power of two")
        self.k, self.functions, self.picks = k, functions, picks
        random = np.random.default_rng(seed)
        self.masks = random.integers(0, 1 << 63, (functions, 1), np.uint64)
        self.factors = random.integers(0, 1 << 62, (functions, 1), np.uint64) * np.uint64(2) + np.uint64(1)

    def numbered(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each k-mer, and of each k-mer with the number of its occurrence."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        points *= np.uint64(0xC2B2AE3D27D4EB4F)
        if len(points) < self.k:
            grams = gram_hashes(np.append(points, np.zeros(self.k - len(points), np.uint64)), self.k)
        else:
            grams = gram_hashes(points, self.k)
        n = len(grams)
        bits = np.uint64(max(1, (n - 1).bit_length()))
        keys = np.sort(((grams >> bits) << bits) | np.arange(n, dtype=np.uint64))
        place = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        keys >>= bits
        fresh = np.zeros(n, np.int64)
        fresh[1:] = np.where(keys[1:] != keys[:-1], np.arange(1, n), 0)
        number = np.empty(n, np.uint64)
        number[place] = np.arange(n) - np.maximum.accumulate(fresh)
        with_number = (grams ^ (number * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        return grams, with_number ^ (with_number >> np.uint64(32))

    def smallest(self, values: np.ndarray) -> np.ndarray:
        """Places of the smallest numbered k-mers under each function, in text order."""
        n, picks = len(values), min(self.picks, len(values))
        rows = np.arange(self.functions)
        best, best_at = np.empty((self.functions, 0), np.uint64), np.empty((self.functions, 0), np.int64)
        for begin in range(0, n, _BLOCK):
            mixed = (values[begin : begin + _BLOCK] ^ self.masks) * self.factors
            own, own_at = [], []
            for _ in range(min(picks, mixed.shape[1])):
                at = mixed.argmin(1)
                own.append(mixed[rows, at])
                own_at.append(at + begin)
                mixed[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
            best, best_at = np.column_stack((best, *own)), np.column_stack((best_at, *own_at))
            order = np.argsort(best, axis=1, kind="stable")[:, :picks]
            best, best_at = np.take_along_axis(best, order, 1), np.take_along_axis(best_at, order, 1)
        return np.sort(best_at, axis=1)

    def __call__(self, text: str) -> np.ndarray:
        """One 32-bit tuple hash per function."""
        if not text:
            return np.zeros(self.functions, np.uint32)
        grams, values = self.numbered(text)
        out = np.full(self.functions, 0x165667B19E3779F9, np.uint64)
        for column in grams[self.smallest(values)].T:
            out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return (out >> np.uint64(32)).astype(np.uint32)


def as_hex(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuple hashes."""
    return float((a == b).mean())


def with_next_part(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """`doc_id`, `n_chars`, `fingerprint` (hex of the tuple hashes)."""

    def start():
        sketch = OrderMinHash(**options)

        def work(batch):
            texts = as_text(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([as_hex(sketch(t)) for t in texts])],
                ["doc_id", "n_chars", "fingerprint"],
            )

        return work

    return map_texts(picked(docs, id_column, text_column), "doc_id long, n_chars long, fingerprint string", start)


def in_order(docs: DataFrame) -> DataFrame:
    """Rows in pieces by id, each row in order, and after each piece the first document of the next (`is_next`).

    One shuffle of the texts. Only the pieces' first ids, as many as shuffle partitions, come to the driver. After
    the last piece comes the first document of all.
    """
    pieces_of = with_piece(docs, "doc_id", split_points(docs, "doc_id"), "piece")
    firsts = sorted((r.piece, r.first) for r in pieces_of.groupBy("piece").agg(F.min("doc_id").alias("first")).collect())
    following = [(piece, firsts[(i + 1) % len(firsts)][1]) for i, (piece, _) in enumerate(firsts)]
    ends = docs.sparkSession.createDataFrame(following, "piece int, doc_id long")
    extra = docs.join(F.broadcast(ends), "doc_id").select("doc_id", "text", "piece", F.lit(True).alias("is_next"))
    rows = pieces_of.select("doc_id", "text", "piece", F.lit(False).alias("is_next")).unionByName(extra)
    return rows.repartition("piece").sortWithinPartitions("piece", "is_next", "doc_id", "text")


Compare = Callable[[int, str, str, Callable[[str], np.ndarray]], tuple]


def edited_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Fingerprints of each text and of the text with its last quarter taken from the next document, by ascending id.

    `doc_id`, `n_chars`, `edited`, `fingerprint`, `edited_fingerprint`, `near_edited`, `near_next`. Documents
    without an id come first; rows that share an id are in the order of their texts; after the last comes the first.
    """
    schema = (
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, "
        "near_next double"
    )

    def run(batches):
        sketch = OrderMinHash(**options)
        held = None
        for batch in batches:
            for piece in pieces(batch):
                out = []
                columns = (piece.column("piece").to_pylist(), piece.column("is_next").to_pylist(), piece.column("doc_id").to_pylist())
                for number, is_next, doc_id, text in zip(*columns, as_text(piece), strict=True):
                    if held is None and is_next:
                        continue  # a further row of the id that ended the piece
                    own = sketch(text)
                    if held is not None:
                        old_id, old_text, old, _ = held
                        edited = with_next_part(old_text, text)
                        changed = sketch(edited)
                        out.append(
                            (old_id, len(old_text), edited, as_hex(old), as_hex(changed), likeness(old, changed), likeness(old, own))
                        )
                    held = None if is_next else (doc_id, text, own, number)
                if out:
                    names = [x.split()[0] for x in schema.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    ordered = in_order(with_ids(picked(docs, id_column, text_column)))
    return without_ids(ordered.mapInArrow(run, schema))
