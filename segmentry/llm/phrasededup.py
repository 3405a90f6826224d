"""Remove recurring passages: every word under a window of words that also starts anywhere else.

Only runs of windows whose anchor occurs elsewhere can recur (`repeats`); each distinct context of such an anchor is
taken once, with the number of its occurrences. Three steps follow, the same for every anchor:

1. Confirm: the windows of all contexts are counted with partial sums. A window that recurs keeps the smallest context
   that holds it, and a mark that stands for all its places. Windows that follow each other in a context, at the same
   places everywhere, form one passage, a text without places. An anchor with a single context has it as its passage.
2. Compile: the passages of some anchors go into an Aho-Corasick automaton over words.
3. Locate: all contexts of these anchors are streamed through it; only what it finds is removed. The places go back
   to every document that holds the context.

Passages and contexts of an anchor are parted by hash into blocks of about `BLOCK_WORDS` words, and every block of
passages meets every part of the contexts, so that no task holds a whole anchor, however hot it is.

Defined cases: NULL text has no words; texts shorter than a window stay whole; rows that repeat another row repeat
all its windows; rows that share an id hold the same text; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm import repeats
from segmentry.llm.common import as_bytes, map_texts, picked
from segmentry.session import cut

#: Words of the anchor, and words whose hashes a task remembers.
ANCHOR, CACHE_WORDS, CACHE_LENGTH = 8, 300_000, 40
#: Words of the passages of one automaton, and of the contexts that are dealt to it together.
BLOCK_WORDS = 400_000
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def word_tokenizer():
    known: dict[bytes, int] = {}
    find, digest = known.get, xxhash.xxh64_intdigest

    def tokens(text: bytes) -> np.ndarray:
        words = text.split()
        if len(known) > CACHE_WORDS:
            known.clear()
        out = []
        for w in words:
            h = find(w)
            if h is None:
                h = digest(w)
                if len(w) <= CACHE_LENGTH:
                    known[w] = h
            out.append(h)
        return np.array(out, np.uint64)

    return tokens


def window_digests(words: list[bytes], window: int) -> list[int]:
    """A 128-bit hash of every window."""
    joined = b" ".join(words)
    edges = np.cumsum([0, *[len(w) + 1 for w in words]])
    return [
        xxhash.xxh3_128_intdigest(joined[i:j])
        for i, j in zip(edges[: len(words) - window + 1].tolist(), (edges[window:] - 1).tolist(), strict=True)
    ]


def _halves(digests: list[int]) -> np.ndarray:
    """Both halves of 128-bit hashes as signed numbers, one row each."""
    raw = b"".join([d.to_bytes(16, "little") for d in digests])
    return np.frombuffer(raw, np.int64).reshape(-1, 2)


def place_marks(context: int, n: int) -> np.ndarray:
    """A mark for each window of a context: the hash of the context, turned by the place.

    The marks of a window at all its places are joined by XOR. Turning commutes with that, so a window starts one word
    after another one at all places of both if its joined mark is the other's, turned once more.
    """
    turn = np.arange(n, dtype=np.uint64) % np.uint64(64)
    value = np.full(n, context & (1 << 64) - 1, np.uint64)
    return ((value << turn) | (value >> (np.uint64(64) - turn) % np.uint64(64))).view(np.int64)


def passages_of(words: list[bytes], marks: dict[int, int], window: int) -> set[bytes]:
    """Passages of a context that hold its windows in `marks` (digest -> joined mark); windows with the same places go together."""
    own = window_digests(words, window)
    out, begin = set(), None
    for i, h in enumerate(own):
        mark = marks.get(h)
        if mark is None:
            continue
        if begin is None:
            begin = i
        after = marks.get(own[i + 1]) if i + 1 < len(own) else None
        turned = (mark << 1 | mark >> 63) & (1 << 64) - 1
        # Marks repeat after 64 places, so longer contexts give one passage a window.
        if after != turned or len(own) > 64:
            out.add(b" ".join(words[begin : i + window]))
            begin = None
    return out


def located(contexts: list[list[bytes]], passages: list[list[bytes]]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Stream contexts through the automaton of the passages: context and the spans of words that passages cover."""
    numbers: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for words in passages:
        automaton.add_word(tuple([numbers.setdefault(w, len(numbers) + 1) for w in words]), len(words))
    if not len(automaton):
        return
    automaton.make_automaton()
    for i, words in enumerate(contexts):
        spans: list[tuple[int, int]] = []
        for last, size in automaton.iter(tuple([numbers.get(w, 0) for w in words])):
            begin = last + 1 - size
            while spans and spans[-1][1] >= begin:
                begin = min(begin, spans.pop()[0])
            spans.append((begin, last + 1))
        if spans:
            yield i, spans


def windows_of(contexts: DataFrame, window: int) -> DataFrame:
    """`key`, `high`, `low` (hash of the window), `n`, `context`, `mark` for every window of every context."""

    def start():
        def work(batch):
            names = ("key", "n", "context")
            keys, counts, ids = (batch.column(c).to_numpy() for c in names)
            digests = [window_digests(w.split(b" "), window) for w in as_bytes(batch, "words")]
            size = np.array([len(d) for d in digests], np.int64)
            halves = _halves([d for own in digests for d in own])
            marks = [place_marks(c, n) for c, n in zip(ids.tolist(), size.tolist(), strict=True)]
            repeated = [pa.array(np.repeat(x, size)) for x in (keys, counts, ids)]
            marks = pa.array(np.concatenate(marks) if marks else np.empty(0, np.int64))
            columns = [*repeated, pa.array(halves[:, 1].copy()), pa.array(halves[:, 0].copy()), marks]
            yield pa.RecordBatch.from_arrays(columns, [*names, "high", "low", "mark"])

        return work

    return map_texts(contexts, "key long, n long, context long, high long, low long, mark long", start)


def confirmed(contexts: DataFrame, window: int) -> DataFrame:
    """`key`, `words`, `size` (in words) of the passages that recur; passages do not tell where."""
    several = contexts.filter("NOT alone").select("key", "context", "n", "words")
    again = windows_of(several, window).groupBy("key", "high", "low").agg(
        F.sum("n").alias("n"), F.min("context").alias("context"), F.expr("bit_xor(mark)").alias("mark")
    )
    held = again.filter("n > 1").groupBy("key", "context").agg(F.collect_list(F.struct("high", "low", "mark")).alias("windows"))
    rows = several.select("key", "context", "words").join(held, ["key", "context"])

    def start():
        whole = (1 << 64) - 1

        def work(batch):
            keys, out = [], []
            windows = batch.column("windows").to_pylist()
            for key, words, own in zip(batch.column("key").to_pylist(), as_bytes(batch, "words"), windows, strict=True):
                marks = {(w["high"] & whole) << 64 | w["low"] & whole: w["mark"] & whole for w in own}
                found = passages_of(words.split(b" "), marks, window)
                keys += [key] * len(found)
                out += sorted(found)
            sizes = pa.array([w.count(b" ") + 1 for w in out], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.binary()), sizes], ["key", "words", "size"])

        return work

    parts = map_texts(rows, "key long, words binary, size long", start)
    return parts.unionByName(contexts.filter("alone").select("key", "words", "size"))


def _parts(rows: DataFrame) -> DataFrame:
    """Parts of about BLOCK_WORDS words, for the keys that need more than one."""
    total = rows.groupBy("key").agg(F.sum("size").alias("size")).filter(F.col("size") > BLOCK_WORDS)
    return total.select("key", F.ceil(F.col("size") / BLOCK_WORDS).alias("parts"))


def located_contexts(contexts: DataFrame, passages: DataFrame) -> DataFrame:
    """`key`, `context`, `spans` (words of the context under passages); a context has a row for each block that hits it."""
    wide = cut(_parts(passages).withColumnRenamed("parts", "blocks").join(_parts(contexts), "key", "full"))
    blocks, parts = (F.coalesce(c, F.lit(1)).cast("long") for c in ("blocks", "parts"))

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    patterns = passages.join(wide, "key", "left").withColumn("block", F.pmod(F.xxhash64("words"), blocks))
    patterns = patterns.select("key", "block", every(parts).alias("part"), F.lit(None).cast("long").alias("context"), "words")
    streams = contexts.join(wide, "key", "left").withColumn("part", F.pmod(F.xxhash64("context"), parts))
    streams = streams.select("key", every(blocks).alias("block"), "part", "context", "words")
    dealt = ["key", "block", "part"]
    # Contexts are never NULL, so the passages of an anchor come before the contexts they are sought in.
    rows = patterns.unionByName(streams).repartition(*dealt).sortWithinPartitions(*dealt, F.col("context").asc_nulls_first())

    def shard(batches):
        for keys, ids, texts, found in _shards(batches):
            hits = list(located(texts, found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i, _ in hits], pa.int64()),
                    pa.array([ids[i] for i, _ in hits], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in spans] for _, spans in hits], SPANS),
                ],
                ["key", "context", "spans"],
            )

    return rows.mapInArrow(shard, "key long, context long, spans array<struct<start: int, end: int>>")


def _shards(batches) -> Iterator[tuple[list[int], list[int], list[list[bytes]], list[list[bytes]]]]:
    """Keys, numbers and words of contexts, and passages, of whole (key, block, part) in a row, about BLOCK_WORDS words together."""
    keys, ids, texts, found, size, last = [], [], [], [], 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "block", "part", "context", "words")]
        for key, block, part, context, words in zip(*columns, strict=True):
            if size >= BLOCK_WORDS and (key, block, part) != last:
                yield keys, ids, texts, found
                keys, ids, texts, found, size = [], [], [], [], 0
            last = key, block, part
            words = words.split(b" ")
            size += len(words)
            if context is None:
                found.append(words)
                continue
            keys.append(key)
            ids.append(context)
            texts.append(words)
    if texts:
        yield keys, ids, texts, found


def cut_contexts(wanted: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """`key`, `context`, `n`, `alone`, `words` (joined by a space), `size` for each wanted `key`, `context`, `n`, `alone`, `doc_id`, `place`."""
    per_document = wanted.groupBy("doc_id").agg(F.collect_set(F.struct("place", "key", "context", "n", "alone")).alias("runs"))
    rows = texts.join(per_document, "doc_id", "left")

    def start():
        def work(batch):
            out: list[tuple] = []
            for text, own in zip(as_bytes(batch), batch.column("runs").to_pylist(), strict=True):
                words = text.split() if own else ()
                for run in own or ():
                    at, size = run["place"] >> 16, (run["place"] >> 8 & 255) + window - 1
                    out.append((run["key"], run["context"], run["n"], run["alone"], b" ".join(words[at : at + size]), size))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64()]
            names = ["key", "context", "n", "alone", "words", "size"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        return work

    return map_texts(rows, "key long, context long, n long, alone boolean, words binary, size long", start)


def one_row_each(texts: DataFrame) -> DataFrame:
    """One row for each `doc_id`. Only rows whose id repeats are grouped; the others stay where they are."""
    repeated = cut(texts.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"))
    once = texts.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return texts.join(repeated, "doc_id", "left_anti").unionByName(once)


def recurring_spans(texts: DataFrame, window: int) -> DataFrame:
    """`doc_id`, `start`, `end` in words, for every place of every recurring passage; spans may overlap."""
    anchor = min(ANCHOR, 1 << (window.bit_length() - 1))
    alone = (F.min("context") == F.max("context")).alias("alone")
    found = repeats.candidates(texts, word_tokenizer, window, anchor, [alone])
    # Each distinct context once, from its first place in the first document that holds it.
    counted = cut(found.groupBy("key", "context", "alone").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")))
    firsts = found.drop("alone").filter(~repeats.unpacked(F.col("place"))["again"]).join(counted, ["key", "context", "doc_id"])
    contexts = cut(cut_contexts(firsts.select("key", "context", "n", "alone", "doc_id", "place"), one_row_each(texts), window))
    spans = cut(located_contexts(contexts, cut(confirmed(contexts, window))))
    start = F.col("place_start") + F.col("span.start")
    return (
        found.join(spans, ["key", "context"])
        .select("doc_id", repeats.unpacked(F.col("place"))["start"].alias("place_start"), F.explode("spans").alias("span"))
        .select("doc_id", start.alias("start"), (F.col("place_start") + F.col("span.end")).alias("end"))
    )


def deduplicate(docs: DataFrame, window: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id`, `n_words`, `spans` (array of removed [start, end) in words, disjoint, in order), `kept` (text)."""
    texts = repeats.with_ids(picked(docs, id_column, text_column))
    spans = recurring_spans(texts, window).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = texts.join(spans, "doc_id", "left")

    def start():
        def work(batch):
            sizes, kept, removed = [], [], []
            for text, own in zip(as_bytes(batch), batch.column("spans").to_pylist(), strict=True):
                words = text.split()
                sizes.append(len(words))
                begin = np.array([x["start"] for x in own or ()], np.int64)
                end = np.array([x["end"] for x in own or ()], np.int64)
                begin, end = repeats.covered_spans(begin, end)
                removed.append([{"start": i, "end": j} for i, j in zip(begin.tolist(), end.tolist(), strict=True)])
                edges = [0, *np.column_stack((begin, end)).ravel().tolist(), len(words)]
                kept.append(b" ".join([w for i, j in zip(edges[::2], edges[1::2], strict=True) for w in words[i:j]]))
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.list_(span)),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "spans", "kept"],
            )

        return work

    schema = "doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept string"
    return repeats.without_ids(map_texts(rows, schema, start))


def n_removed(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
