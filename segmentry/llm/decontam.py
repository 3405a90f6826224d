"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of consecutive words. The shingles of a window (word pairs) are ordered by
rarity, counted over all documents. A document that holds the whole window holds all its shingles, so one shingle
is the necessary prefix: the rarest. Documents are joined on these prefix shingles. A match must leave room for the
words of the window before and after it (length and position bound); what is left is compared word by word.

The items are used in blocks of at most `BLOCK_BYTES` of text, each sent to all tasks, and documents pass block
after block in one job without a shuffle; only the counts of the shingles of one block come to the driver.

Defined cases: NULL texts have no words; an item with fewer words than a window is one window, an item without
words is none; a NULL item id counts as the empty string; repeated items count once, repeated documents each get a
row; empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_bytes, column, map_texts, picked, send

#: Text of the benchmark items that is broadcast at a time.
BLOCK_BYTES = 8 << 20
#: Candidates that are compared at a time.
_COMPARE = 1 << 16

_LETTERS = bytes(
    b if b > 127 or chr(b).isdigit() or chr(b).islower() else (b + 32 if chr(b).isupper() else 32) for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all bytes beyond ASCII; A-Z in lower case."""
    return text.translate(_LETTERS).split()


class Block:
    """Windows of some items, and for each its prefix shingle. Word 0 is any word that no item has."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), set()).add(item_id)
        self.width = len(self.vocabulary) + 1
        windows = sorted(found)
        self.items = [sorted(found[w]) for w in windows]
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.words = np.zeros((len(windows), window), np.int32)
        for row, w in enumerate(windows):
            self.words[row, : len(w)] = w
        self.window = window
        codes = self.codes(self.words.ravel()).reshape(self.words.shape)  # a pair past a row's end is masked below
        single = self.lengths == 1
        inside = np.arange(window) < np.maximum(self.lengths - 1, single)[:, None]
        codes[single, 0] = self.words[single, 0]
        self.row_codes = np.where(inside, codes, -1)
        self.shingles = np.unique(self.row_codes[inside])
        self.has_single = bool(single.any())

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Code of the word pair at each word, 0 where either word is in no item. Codes below `width` are single words."""
        out = np.zeros(len(ids), np.int64)
        left, right = ids[:-1].astype(np.int64), ids[1:]
        out[:-1] = np.where((left > 0) & (right > 0), left * self.width + right, 0)
        return out

    def ids(self, words: list[bytes]) -> np.ndarray:
        find = self.vocabulary.get
        return np.array([find(w, 0) for w in words], np.int32)

    def count(self, texts: list[bytes]) -> np.ndarray:
        """How often each shingle occurs."""
        total = np.zeros(len(self.shingles), np.int64)
        for text in texts:
            ids = self.ids(words_of(text))
            for codes in (self.codes(ids), ids) if self.has_single else (self.codes(ids),):
                at = self.find(self.shingles, codes)
                total += np.bincount(at[at >= 0], minlength=len(total))
        return total

    @staticmethod
    def find(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Place of each code in a sorted table, -1 where it is not there or zero."""
        if not len(table):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
        return np.where((table[at] == codes) & (codes > 0), at, -1)

    def choose(self, counts: np.ndarray) -> None:
        """Order the shingles by rarity and keep the rarest of each window as its prefix, with its place in it."""
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((self.shingles, counts))] = np.arange(len(counts))
        ranks = np.where(self.row_codes >= 0, rank[np.searchsorted(self.shingles, np.maximum(self.row_codes, 0)) % max(1, len(rank))], np.iinfo(np.int64).max) if len(rank) else self.row_codes
        self.offsets = ranks.argmin(1) if len(ranks) else np.empty(0, np.int64)
        chosen = self.row_codes[np.arange(len(ranks)), self.offsets]
        self.by_prefix = np.argsort(chosen, kind="stable")
        self.prefixes, self.first = np.unique(chosen[self.by_prefix], return_index=True)
        self.last = np.append(self.first[1:], len(chosen))

    def search(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Windows that occur in the document, and the word at which each occurrence starts."""
        ids = self.ids(words)
        out = []
        for codes in (self.codes(ids), ids.astype(np.int64)) if self.has_single else (self.codes(ids),):
            prefix = self.find(self.prefixes, codes)
            at = np.flatnonzero(prefix >= 0)
            for begin in range(0, len(at), _COMPARE):
                out.append(self.verify(ids, at[begin : begin + _COMPARE], prefix))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])

    def verify(self, ids: np.ndarray, at: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, sizes = self.first[prefix[at]], (self.last - self.first)[prefix[at]]
        windows, starts = [], []
        for begin, end in _parts(sizes):
            size = sizes[begin:end]
            place = np.repeat(at[begin:end], size)
            turn = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            w = self.by_prefix[np.repeat(first[begin:end], size) + turn]
            start = place - self.offsets[w]
            room = (start >= 0) & (start + self.lengths[w] <= len(ids))
            w, start = w[room], start[room]
            for step in range(self.window):
                inside = step < self.lengths[w]
                same = ~inside | (ids[np.minimum(start + step, len(ids) - 1)] == self.words[w, step])
                w, start = w[same], start[same]
            windows.append(w)
            starts.append(start)
        return np.concatenate(windows), np.concatenate(starts)


def _parts(sizes: np.ndarray):
    """Runs whose sizes sum to about _COMPARE."""
    group = np.cumsum(sizes) // _COMPARE
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _blocks(items: DataFrame, id_column: str, text_column: str, window: int, block_bytes: int) -> list[Block]:
    rows = items.select(
        F.coalesce(column(id_column).cast("string"), F.lit("")).alias("item_id"), column(text_column).cast("binary").alias("text")
    ).filter(F.length("text") > 0).distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = math.ceil(size / block_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [Block([(r.item_id, bytes(r.text)) for r in rows.filter(block == i).collect()], window) for i in range(n)]


def _count(texts: DataFrame, block: Block) -> np.ndarray:
    shared = send(texts, block)

    def start():
        block = shared()
        total = np.zeros(len(block.shingles), np.int64)

        def work(batch):
            nonlocal total
            if batch is not None:
                total += block.count(as_bytes(batch))
                return
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["shingle", "n"])

        return work

    counted = map_texts(texts.select("text"), "shingle long, n long", start, finish=True)
    counts = np.zeros(len(block.shingles), np.int64)
    for row in counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect():
        counts[row.shingle] = row.n
    return counts


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`doc_id`, `n_words`, `spans` (array of [start, end) in words that items cover), `items` (sorted ids)."""
    texts = picked(docs, id_column, text_column)
    blocks = _blocks(items, item_column, item_text_column, window, block_bytes) or [Block([], window)]
    marked = texts.withColumn("marks", F.expr("cast(array() as array<long>)")).withColumn("items", F.expr("cast(array() as array<string>)"))
    for block in blocks:
        block.choose(_count(texts, block) if len(block.shingles) else np.empty(0, np.int64))
        marked = _mark(marked, block)
    spans = F.transform("marks", lambda m: F.struct(F.shiftright(m, 32).alias("start"), m.bitwiseAND(F.lit(0xFFFFFFFF)).alias("end")))
    return marked.select("doc_id", F.col("n_words"), spans.alias("spans"), F.array_sort("items").alias("items"))


def _mark(marked: DataFrame, block: Block) -> DataFrame:
    """Add the spans (start and end packed in a long) and items of one block."""
    shared = send(marked, block)

    def start():
        block = shared()

        def work(batch):
            marks, items, sizes = [], [], []
            for text, old, names in zip(as_bytes(batch), batch.column("marks").to_pylist(), batch.column("items").to_pylist(), strict=True):
                words = words_of(text)
                windows, starts = block.search(words) if len(block.shingles) else (np.empty(0, np.int64),) * 2
                if len(windows):
                    lengths = block.lengths[windows]
                    old = np.array(old, np.int64)
                    mask = covered(np.append(old >> 32, starts), np.append((old & 0xFFFFFFFF) - (old >> 32), lengths), len(words))
                    begin, end = spans_of(mask)
                    old = (begin << 32 | end).tolist()
                    names = list({*names, *(x for w in np.unique(windows) for x in block.items[w])})
                marks.append(old)
                items.append(names)
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text"), pa.array(marks, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string())), pa.array(sizes, pa.int64()),
                ],
                ["doc_id", "text", "marks", "items", "n_words"],
            )

        return work

    schema = "doc_id long, text string, marks array<long>, items array<string>, n_words long"
    return map_texts(marked.select("doc_id", "text", "marks", "items"), schema, start)


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
