"""Where may a window of tokens occur again? Anchors shared by the two substring operators.

A window of `window` tokens holds `window - k + 1` k-grams; its anchor is the leftmost one with the smallest hash, so
equal windows have equal anchors at equal offsets. Consecutive windows with the same anchor are one run, and the
tokens of a run are its context. A window can only occur again where its anchor does: all else needs no comparison.

Runs are counted by anchor with partial aggregation, and only runs whose anchor occurs twice or more go on
(`candidates`). Equal contexts are told by a second hash, so that later steps compare each distinct one once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_bytes, map_texts
from segmentry.session import cut

#: Tokens of the documents that are hashed together; a longer document is hashed in parts.
BLOCK = 1 << 17
_PLACE_BITS = 24
#: Ids from here on are real ones; smaller numbers stand for texts without an id, which so come before all others.
LEAST_ID = -(1 << 62)


def gram_hashes(tokens: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of k token hashes; k is a power of two."""
    out, size = tokens, 1
    while size < k:
        out = out[:-size] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + out[size:]
        size *= 2
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def runs(tokens: np.ndarray, ends: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, offset of the anchor and its hash for every run of windows.

    `tokens` are those of some documents in a row (or a part of one), `ends` where each document ends.
    """
    n = len(tokens) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    hashes = gram_hashes(tokens, k)
    places = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (hashes & ~places) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (window_minima(packed, window - k + 1) & places).astype(np.int64)[:n]
    # Windows that cross the end of a document are no windows.
    lengths = np.diff(np.concatenate(([0], ends)))
    document = np.repeat(np.arange(len(ends)), lengths)
    inside = np.arange(n) + window <= ends[document[:n]]
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(anchor[1:], anchor[:-1], out=change[1:])
    change[1:] |= (inside[1:] != inside[:-1]) | (document[1:n] != document[: n - 1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n))
    first, count = first[inside[first]], count[inside[first]]
    at = anchor[first]
    return first, count, at - first, hashes[at]


def document_runs(tokens: list[np.ndarray], window: int, k: int) -> Iterable[tuple[int, int, np.ndarray, tuple[np.ndarray, ...]]]:
    """Documents in blocks: first document, end of the block, its tokens and its runs. Long ones come in parts joined again."""
    at = 0
    while at < len(tokens):
        if len(tokens[at]) > BLOCK:
            parts = []
            for start in range(0, len(tokens[at]) - window + 1, BLOCK):
                part = tokens[at][start : start + BLOCK + window - 1]
                first, *rest = runs(part, np.array([len(part)]), window, k)
                parts.append((first + start, *rest))
            yield at, at + 1, tokens[at], tuple(map(np.concatenate, zip(*parts, strict=True)))
            at += 1
            continue
        end, size = at, 0
        while end < len(tokens) and size + len(tokens[end]) <= BLOCK:
            size += len(tokens[end])
            end += 1
        joined = np.concatenate(tokens[at:end])
        yield at, end, joined, runs(joined, np.cumsum([len(t) for t in tokens[at:end]]), window, k)
        at = end


def pack(start: np.ndarray, count: np.ndarray, offset: np.ndarray, again: np.ndarray) -> np.ndarray:
    """Start in the document, windows (below 256), offset of the anchor (below 128), and whether it repeats one before in it."""
    return (start << 16) | (count << 8) | (again.astype(np.int64) << 7) | offset


def unpacked(place: Column) -> dict[str, Column]:
    return {
        "start": F.shiftright(place, 16),
        "windows": F.shiftright(place, 8).bitwiseAND(F.lit(255)).cast("int"),
        "again": place.bitwiseAND(F.lit(128)) != 0,
        "offset": place.bitwiseAND(F.lit(127)).cast("int"),
    }


Tokenizer = Callable[[], Callable[[bytes], np.ndarray]]


def occurrences(texts: DataFrame, tokenizer: Tokenizer, window: int, k: int) -> DataFrame:
    """`key` (hash of the anchor), `context` (hash of the tokens of the run), `doc_id`, `place`, for every run of windows."""
    if window - k + 1 > 128 or window < k:
        raise ValueError("window - k + 1 is 1 to 128")

    def start():
        tokens_of, digest = tokenizer(), xxhash.xxh64_intdigest

        def work(batch):
            tokens = [tokens_of(t) for t in as_bytes(batch)]
            ids = batch.column("doc_id")
            for at, end, joined, (first, count, offset, key) in document_runs(tokens, window, k):
                if not len(first):
                    continue
                raw, step = joined.tobytes(), joined.itemsize
                stops = ((first + count + (window - 1)) * step).tolist()
                context = np.array(
                    [digest(raw[i:j], o) for i, j, o in zip((first * step).tolist(), stops, offset.tolist(), strict=True)], np.uint64
                )
                ends = np.cumsum([len(t) for t in tokens[at:end]])
                document = np.searchsorted(ends, first, side="right")
                begin = first - np.concatenate(([0], ends))[document]
                order = np.lexsort((begin, context, key, document))
                again = np.zeros(len(first), bool)
                same = np.ones(len(first) - 1, bool)
                for column in (document, key, context):
                    same &= column[order][1:] == column[order][:-1]
                again[order[1:]] = same
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)), pa.array(context.view(np.int64)),
                        ids.take(pa.array(document + at)), pa.array(pack(begin, count, offset, again)),
                    ],
                    ["key", "context", "doc_id", "place"],
                )

        return work

    return map_texts(texts, "key long, context long, doc_id long, place long", start)


def anchors(texts: DataFrame, tokenizer: Tokenizer, window: int, k: int) -> DataFrame:
    """`key` of the `occurrences` alone."""

    def start():
        tokens_of = tokenizer()

        def work(batch):
            for *_, (_, _, _, key) in document_runs([tokens_of(t) for t in as_bytes(batch)], window, k):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

        return work

    return map_texts(texts, "key long", start)


def candidates(texts: DataFrame, tokenizer: Tokenizer, window: int, k: int, also: Sequence[Column] = ()) -> DataFrame:
    """The occurrences whose anchor occurs at least twice, with aggregates over its occurrences (`also`). Written once.

    The anchors are written first, so that both sides of the join come straight from a shuffle and adaptive
    execution can split the part of an anchor that many documents share.
    """
    found = occurrences(texts, tokenizer, window, k)
    counted = found if also else anchors(texts, tokenizer, window, k)
    keys = cut(counted.groupBy("key").agg(F.count("*").alias("n"), *also).filter("n > 1").drop("n"))
    return cut(found.join(keys, "key"))


def with_ids(docs: DataFrame) -> DataFrame:
    """A text without an id gets a number below all ids, by its hash."""
    number = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(-(1 << 63))
    return docs.withColumn("doc_id", F.coalesce("doc_id", number))


def without_ids(results: DataFrame) -> DataFrame:
    return results.withColumn("doc_id", F.when(F.col("doc_id") >= LEAST_ID, F.col("doc_id")))


def covered_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as disjoint, non-touching spans in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.empty(len(starts), bool)
    fresh[:1] = True
    np.greater(starts[1:], ends[:-1], out=fresh[1:])
    at = np.flatnonzero(fresh)
    return starts[at], ends[np.append(at[1:] - 1, len(ends) - 1)] if len(at) else ends
