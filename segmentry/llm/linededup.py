"""Line dedup: of every longer line only the copies in the document with the smallest id stay.

Lines become (hash, document, position) rows that are dealt out by ranges of all three and sorted inside a range, so a
line that a third of all documents hold is parted over many tasks. Each task streams its range: the first document
of a hash is its keeper, every later one loses the line. Where a hash began in an earlier range, one border row per
task tells its keeper. The result is a compressed bitmap of kept lines per document; no text is moved for it.

Defined cases: a NULL or empty text is one empty line. A NULL id comes before all ids, and all rows without an id are
one document (as for the smallest long). Rows that repeat an id with another text are parts of one document and get a
bitmap each. Keys meet by 128-bit hash. An empty table gives an empty table; other columns are left aside.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_bytes, as_text, map_texts, picked
from segmentry.session import cut

#: What a key loses at both ends (fixed values: space and the five control characters 9 to 13).
BLANKS = b" \t\n\x0b\x0c\r"
NO_ID = -(2**63)


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z in lower case (bytes.lower changes nothing else)."""
    return line.strip(BLANKS).lower()


def is_long(key: bytes, least: int) -> bool:
    """At least `least` code points; a code point has 1 to 4 bytes."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _split_worker(least: int):
    """Per document: number of lines, and hash and position of its long lines."""

    def start():
        from xxhash import xxh3_128_digest

        def work(batch):
            n_lines, ends, digests, places = [], [0], [], []
            for text in as_bytes(batch):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                for place, line in enumerate(lines):
                    if is_long(key := line_key(line), least):
                        digests.append(xxh3_128_digest(key))
                        places.append(place)
                ends.append(len(places))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            lines = pa.StructArray.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(places, pa.int32())], ["high", "low", "place"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_hash"), pa.array(n_lines, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines)],
                ["doc", "text_hash", "n_lines", "lines"],
            )

        return work

    return start


#: Rows that a streamed range gives: a line to drop; a line that a keeper in an earlier range would drop; the range's last hash.
DROP, PENDING, BORDER = 0, 1, 2
_STREAMED = "kind int, high long, low long, doc long, text_hash long, place int"


def _stream_start():
    """Streams rows sorted by hash, document and place; keeps the running hash and its first document only."""
    before = {"first": None, "hash": None, "keeper": None}

    def rows(kind, high, low, doc, text_hash, place):
        columns = [np.full(len(doc), kind, np.int32), high, low, doc, text_hash, place]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in _STREAMED.split(", ")])

    def work(batch):
        if batch is None:
            if before["hash"] is not None:
                (high, low), none = before["hash"], np.zeros(1, np.int64)
                yield rows(BORDER, np.array([high]), np.array([low]), np.array([before["keeper"]]), none, none.astype(np.int32))
            return
        high, low, doc, text_hash, place = (batch.column(c).to_numpy() for c in ("high", "low", "doc", "text_hash", "place"))
        if not len(doc):
            return
        old = before["hash"]
        is_new = np.empty(len(doc), bool)
        is_new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        is_new[0] = old != (high[0], low[0])
        at = np.maximum.accumulate(np.where(is_new, np.arange(len(doc)), -1))
        keeper = np.where(at >= 0, doc[at], doc[0] if old is None else before["keeper"])
        if before["first"] is None:
            before["first"] = (high[0], low[0])
        before["hash"], before["keeper"] = (high[-1], low[-1]), keeper[-1]
        is_dropped = doc > keeper
        is_pending = ~is_dropped & (high == before["first"][0]) & (low == before["first"][1])
        for kind, chosen in ((DROP, is_dropped), (PENDING, is_pending)):
            if chosen.any():
                yield rows(kind, high[chosen], low[chosen], doc[chosen], text_hash[chosen], place[chosen])

    return work


def pack(n_lines: int, dropped: list[int]) -> bytes:
    """Bits of the lines, 1 for kept, the first line in the lowest bit of the first byte; compressed."""
    bits = np.ones(n_lines, np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes())


def unpack(n_lines: int, keep: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines, bitorder="little").astype(bool)


def _pack_start():
    def work(batch):
        n_lines = batch.column("n_lines").to_pylist()
        dropped = [set(x) for x in batch.column("dropped").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("text_hash"), pa.array(n_lines, pa.int64()),
             pa.array([len(x) for x in dropped], pa.int64()),
             pa.array([pack(n, list(x)) for n, x in zip(n_lines, dropped)], pa.binary())],
            ["doc", "text_hash", "n_lines", "n_dropped", "keep"],
        )

    return work


def _marked(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    texts = picked(docs, id_column, text_column).withColumn("text", F.coalesce("text", F.lit("")))
    return texts.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text")


def _id(doc: Column) -> Column:
    return F.when(doc != NO_ID, doc)


def line_bitmaps(docs: DataFrame, least: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document and text: `doc_id`, `text_hash`, `n_lines`, `n_dropped`, `keep` (see `pack`).

    A key of at least `least` code points stays in the smallest document that holds it, with all its lines there.
    """
    found = cut(
        map_texts(
            _marked(docs, id_column, text_column).drop("doc_id"),
            "doc long, text_hash long, n_lines int, lines array<struct<high: long, low: long, place: int>>",
            _split_worker(least),
        )
    )
    order = ["high", "low", "doc", "place"]
    lines = found.select("doc", "text_hash", F.inline("lines"))
    streamed = cut(map_texts(lines.repartitionByRange(*order).sortWithinPartitions(*order), _STREAMED, lambda: _stream_start(), finish=True), ["kind"])
    borders = streamed.filter(F.col("kind") == BORDER).groupBy("high", "low").agg(F.min("doc").alias("keeper"))
    late = streamed.filter(F.col("kind") == PENDING).join(borders, ["high", "low"]).filter(F.col("doc") > F.col("keeper"))
    dropped = streamed.filter(F.col("kind") == DROP).unionByName(late.drop("keeper"))
    rows = found.select("doc", "text_hash", "n_lines", F.lit(None).cast("int").alias("place")).unionByName(
        dropped.select("doc", "text_hash", F.lit(0).alias("n_lines"), "place")
    )
    documents = rows.groupBy("doc", "text_hash").agg(F.max("n_lines").alias("n_lines"), F.collect_list("place").alias("dropped"))
    packed = map_texts(documents, "doc long, text_hash long, n_lines long, n_dropped long, keep binary", lambda: _pack_start())
    return packed.select(_id(F.col("doc")).alias("doc_id"), "text_hash", "n_lines", "n_dropped", "keep")


def _apply_start():
    def work(batch):
        kept = []
        for text, n_lines, keep in zip(as_text(batch), batch.column("n_lines").to_pylist(), batch.column("keep").to_pylist()):
            kept.append("\n".join(itertools.compress(text.split("\n"), unpack(n_lines, keep))))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "n_lines", "n_dropped")), pa.array(kept, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept"],
        )

    return work


def kept_lines(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_lines`, `n_dropped`, `kept` (the lines of its bitmap, joined)."""
    marks = bitmaps.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text_hash", "n_lines", "n_dropped", "keep")
    both = _marked(docs, id_column, text_column).join(marks, ["doc", "text_hash"])
    return map_texts(
        both.select("doc_id", "n_lines", "n_dropped", "text", "keep"),
        "doc_id long, n_lines long, n_dropped long, kept string", lambda: _apply_start(),
    )


def deduplicate(docs: DataFrame, least: int = 10, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`kept_lines` of the documents' own bitmaps."""
    return kept_lines(docs, line_bitmaps(docs, least, id_column, text_column), id_column, text_column)
