"""Remove repeated substrings: every byte of a string of `length` bytes that also starts earlier in the corpus.

Runs of windows whose anchor occurs once are settled by counting (`repeats`). A run whose context occurs earlier is
removed whole. What is left, the first occurrence of each distinct context that shares its anchor with other
contexts, is dealt by anchor to shards. Windows are classed by the anchor's place in them: all of a class hold the same
stretch around the anchor, so a class whose stretch no other context of the shard has holds no string that recurs. A
shard writes the rest of its contexts into one text on its own disk and sorts all suffixes by external induced sorting
with common prefixes (`suffixes`). Neighbours with a common prefix of `length` or more are the same string; the
earliest of them stays, the others are removed.

An anchor's distinct contexts meet in one shard, so time, disk and memory of a shard grow with a passage that very
many documents share with different bytes around it. Hot copies never meet: counting is partially aggregated and each
distinct context goes to a shard once.

Defined cases: NULL text is empty; documents without an id come before all others, in an order of their own; rows
that share an id hold the same text, and strings at the same place of one are not earlier than each other, so
repeated rows get equal results; texts shorter than `length` stay whole; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm import repeats
from segmentry.llm.common import as_bytes, column, map_texts, picked
from segmentry.llm.suffixes import RUN, Disk, suffix_groups
from segmentry.session import cut

#: Bytes of the anchor. Shards for each shuffle partition: small ones need less disk at a time.
ANCHOR, SHARDS = 32, 2
#: Classes of windows by the anchor's place in them.
CLASSES = 4


def anchor_size(length: int) -> int:
    return min(ANCHOR, 1 << (length.bit_length() - 1))


def _byte_tokenizer():
    table = np.random.default_rng(0).integers(0, 1 << 63, 256, np.uint64, endpoint=True)
    return lambda text: table[np.frombuffer(text, np.uint8)]


def _lists(values: pa.Array, *names: str) -> list[np.ndarray]:
    """Where the rows of a column of lists of structs begin and end (NULL is empty), and the fields of all structs."""
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    flat = values.flatten()
    return [np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), *[flat.field(x).to_numpy(zero_copy_only=False) for x in names]]


def cut_contexts(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """`key`, `doc_id`, `start`, `offset` (of the anchor), `context` (bytes of the run) for each wanted `key`, `doc_id`, `place`."""
    per_document = wanted.groupBy("doc_id").agg(F.collect_set(F.struct("place", "key")).alias("runs"))
    rows = texts.join(per_document, "doc_id")

    def start():
        def work(batch):
            edges, place, keys = _lists(batch.column("runs"), "place", "key")
            at, offset = place >> 16, place & 127
            stop = (at + (place >> 8 & 255) + (length - 1)).tolist()
            first, contexts = at.tolist(), []
            for text, i, j in zip(as_bytes(batch), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                contexts += [text[x:y] for x, y in zip(first[i:j], stop[i:j], strict=True)]
            ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(edges))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), ids, pa.array(at), pa.array(offset), pa.array(contexts, pa.binary())],
                ["key", "doc_id", "start", "offset", "context"],
            )

        return work

    return map_texts(rows, "key long, doc_id long, start long, offset long, context binary", start)


def class_borders(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset of the anchor in each class of windows."""
    edges = np.unique(np.linspace(0, length - anchor_size(length) + 1, CLASSES + 1).astype(np.int64))
    return edges[:-1], edges[1:] - 1


def stretches(raw: bytes, sizes: np.ndarray, offsets: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each class: the contexts that have windows of it, and a hash of what all these windows hold.

    `raw` are the contexts one after the other, `offsets` the anchor's place in each.
    """
    anchors = np.cumsum(sizes) - sizes + offsets
    out = []
    for low, high in zip(*class_borders(length), strict=True):
        rows = np.flatnonzero(np.maximum(offsets - high, 0) <= np.minimum(offsets - low, sizes - length))
        begin, end = (anchors[rows] - low).tolist(), (anchors[rows] + (length - high)).tolist()
        found = [xxhash.xxh64_intdigest(raw[i:j]) for i, j in zip(begin, end, strict=True)]
        out.append((rows, np.array(found, np.uint64)))
    return out


def shared_runs(classes: list[tuple[np.ndarray, np.ndarray]], sizes: np.ndarray, offsets: np.ndarray, length: int):
    """Number of the context, first and last window of the runs of windows whose stretch another context has too."""
    shared = np.zeros((len(sizes), len(classes) + 2), bool)  # windows go down through the classes; a false column at both ends
    for k, (rows, hashes) in enumerate(classes):
        order = np.argsort(hashes)
        equal = hashes[order[1:]] == hashes[order[:-1]]
        shared[rows[order[1:][equal]], len(classes) - k] = True
        shared[rows[order[:-1][equal]], len(classes) - k] = True
    inner = shared[:, 1:-1]
    own, head = np.nonzero(inner & ~shared[:, :-2])
    tail = np.nonzero(inner & ~shared[:, 2:])[1]
    low, high = class_borders(length)
    first = np.maximum(offsets[own] - high[::-1][head], 0)
    return own, first, np.minimum(offsets[own] - low[::-1][tail], sizes[own] - length)


def shard_text(disk: Disk, parts: list[np.ndarray], begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of bytes of `parts` (in a row, one ends where the next begins) as one text for sorting, and where each begins in it."""
    to = np.cumsum(sizes + 1) - (sizes + 1)
    text = disk.array(int((sizes + 1).sum()) + 1, np.uint16)
    text[to + sizes] = 1
    text[-1] = 0
    at = 0
    for part in parts:
        i, j = np.searchsorted(begin, [at, at + len(part)])
        if i < j:
            inner = np.arange(sizes[i:j].sum()) - np.repeat(np.cumsum(sizes[i:j]) - sizes[i:j], sizes[i:j])
            text[inner + np.repeat(to[i:j], sizes[i:j])] = part[inner + np.repeat(begin[i:j] - at, sizes[i:j])].astype(np.uint16) + 2
        at += len(part)
    return text, to


def later_windows(disk: Disk, text: np.ndarray, begin: np.ndarray, sizes: np.ndarray, ids: np.ndarray, starts: np.ndarray, length: int):
    """First and last place in the text of every run of windows of a shard that also start earlier."""
    marks = disk.array(len(text), bool)
    for positions, prefixes in suffix_groups(disk, text, 258, length):
        # Suffixes that are no windows have an end among their first symbols, and equal ones have it at the same place.
        fresh = prefixes < length
        fresh[0] = True
        several = ~(fresh & np.append(fresh[1:], True))
        positions, fresh = positions[several], fresh[several]
        own = np.searchsorted(begin, positions, side="right") - 1
        inner = positions - begin[own]
        is_window = inner + length <= sizes[own]
        positions, own, inner, fresh = positions[is_window], own[is_window], inner[is_window], fresh[is_window]
        if not len(positions):
            continue
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        doc, place = ids[own], starts[own] + inner
        low_doc = np.minimum.reduceat(doc, first)[group]
        low_place = np.minimum.reduceat(np.where(doc == low_doc, place, np.iinfo(np.int64).max), first)[group]
        marks[positions[(doc > low_doc) | (place > low_place)]] = True
    changes = [np.flatnonzero(marks[:1])]
    for at in range(0, len(marks), RUN):
        part = marks[at : at + RUN + 1]
        changes.append(np.flatnonzero(part[1:] != part[:-1]) + (at + 1))
    first, end = np.concatenate(changes).reshape(-1, 2).T
    return first, end - 1


def later_spans(contexts: DataFrame, length: int) -> DataFrame:
    """`doc_id`, `start`, `end`: bytes of the contexts under windows that also start earlier, sorted shard by shard."""

    def shard(batches):
        with Disk() as disk:
            parts, tables, classes, n = [], [], [], 0
            for batch in batches:  # the bytes go to disk, batch after batch
                if not batch.num_rows:
                    continue
                each = batch.column("context").cast(pa.binary()).to_pylist()
                raw, sizes = b"".join(each), np.fromiter(map(len, each), np.int64)
                parts.append(disk.keep(np.frombuffer(raw, np.uint8)))
                ids, starts, offsets = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("doc_id", "start", "offset"))
                tables.append((sizes, ids, starts, offsets))
                classes.append([(rows + n, hashes) for rows, hashes in stretches(raw, sizes, offsets, length)])
                n += batch.num_rows
            if not n:
                return
            sizes, ids, starts, offsets = map(np.concatenate, zip(*tables, strict=True))
            classes = [tuple(map(np.concatenate, zip(*x, strict=True))) for x in zip(*classes, strict=True)]
            own, first, last = shared_runs(classes, sizes, offsets, length)
            begin = (np.cumsum(sizes) - sizes)[own] + first
            ids, starts, sizes = ids[own], starts[own] + first, last - first + length
            text, begin = shard_text(disk, parts, begin, sizes)
            first, last = later_windows(disk, text, begin, sizes, ids, starts, length)
            own = np.searchsorted(begin, first, side="right") - 1
            span = starts[own] + first - begin[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[own]), pa.array(span), pa.array(span + (last - first) + length)], ["doc_id", "start", "end"]
            )

    n = SHARDS * int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contexts.repartition(n, "key").mapInArrow(shard, "doc_id long, start long, end long")


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """`doc_id`, `start`, `end` of strings that also start earlier; spans may overlap."""
    found = repeats.candidates(texts, _byte_tokenizer, length, anchor_size(length))
    # Written, as it is used twice and joined with rows of hot contexts.
    firsts = cut(found.groupBy("key", "context").agg(F.min("doc_id").alias("first_id")))
    several = firsts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    found = found.join(firsts, ["key", "context"])
    run = repeats.unpacked(F.col("place"))
    is_first = (F.col("doc_id") == F.col("first_id")) & ~run["again"]
    whole = found.filter(~is_first).select(
        "doc_id", run["start"].alias("start"), (run["start"] + run["windows"] + (length - 1)).alias("end")
    )
    wanted = found.filter(is_first).select("key", "doc_id", "place").join(several, "key")
    return whole.unionByName(later_spans(cut_contexts(wanted, texts, length), length))


def _disjoint(spans: pa.Array) -> list[np.ndarray]:
    """The spans of each row as disjoint ones in order: where the rows begin and end among them, their starts and ends."""
    edges, starts, ends = _lists(spans, "start", "end")
    sizes = np.maximum.reduceat(np.append(ends, 0), edges[:-1]) if len(ends) else np.zeros(len(edges) - 1, np.int64)
    sizes[edges[:-1] == edges[1:]] = 0
    base = np.concatenate(([0], np.cumsum(sizes + 1)))  # rows are laid side by side with a gap
    shift = np.repeat(base[:-1], np.diff(edges))
    starts, ends = repeats.covered_spans(starts + shift, ends + shift)
    edges = np.searchsorted(starts, base)
    shift = np.repeat(base[:-1], np.diff(edges))
    return [edges, starts - shift, ends - shift]


def _kept(text: bytes, begin: list[int], end: list[int]) -> bytes:
    """The bytes outside of disjoint spans in order."""
    return b"".join([text[i:j] for i, j in zip([0, *end], [*begin, len(text)], strict=True)])


def _gathered(texts: DataFrame, length: int) -> DataFrame:
    """`doc_id`, `_spans`: all spans of a document, which may overlap."""
    return repeated_spans(texts, length).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("_spans"))


def cleaned(docs: DataFrame, length: int = 100) -> DataFrame:
    """The documents with all their columns; `text` without the repeated strings, and `n_chars`, if there, counted again.

    Parts of letters that are left at the cuts go. Untouched rows stay as they are, NULL texts too.
    """
    numbered = repeats.with_ids(docs)
    columns = docs.columns  # carried by number, whatever their names are
    text_at, size_at = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None
    spans = _gathered(picked(numbered), length).withColumnRenamed("doc_id", "id")
    named = numbered.select(column("doc_id").alias("id"), *[column(c).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = named.join(spans, "id", "left").select(*[f"c{i}" for i in range(len(columns))], "_spans")

    def start():
        def work(batch):
            arrays = [batch.column(i) for i in range(len(columns))]
            texts, (edges, begin, end) = arrays[text_at].to_pylist(), _disjoint(batch.column("_spans"))
            changed = np.flatnonzero(np.diff(edges)).tolist()
            for i in changed:
                own = slice(edges[i], edges[i + 1])
                texts[i] = _kept(texts[i].encode(), begin[own].tolist(), end[own].tolist()).decode("utf-8", "ignore")
            arrays[text_at] = pa.array(texts, arrays[text_at].type)
            if size_at is not None:
                sizes = arrays[size_at].to_pylist()
                for i in changed:
                    sizes[i] = len(texts[i])
                arrays[size_at] = pa.array(sizes, arrays[size_at].type)
            yield pa.RecordBatch.from_arrays(arrays, [f"c{i}" for i in range(len(columns))])

        return work

    back = map_texts(rows, rows.drop("_spans").schema, start).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
    return repeats.without_ids(back).select(*map(column, columns))


def deduplicate(docs: DataFrame, length: int = 100, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id`, `n_bytes`, `spans` (array of removed [start, end) in bytes, disjoint, in order), `kept` (binary)."""
    texts = repeats.with_ids(picked(docs, id_column, text_column))
    rows = texts.join(_gathered(texts, length), "doc_id", "left")

    def start():
        def work(batch):
            edges, begin, end = _disjoint(batch.column("_spans"))
            kept = texts = as_bytes(batch)
            if len(begin):
                rows, first, last = edges.tolist(), begin.tolist(), end.tolist()
                kept = [_kept(t, first[i:j], last[i:j]) if i < j else t for t, i, j in zip(texts, rows, rows[1:], strict=False)]
            span = pa.StructArray.from_arrays([pa.array(begin, pa.int64()), pa.array(end, pa.int64())], ["start", "end"])
            removed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), span)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()), removed, pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

        return work

    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return repeats.without_ids(map_texts(rows, schema, start))


def n_removed(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
