"""Helpers shared by the document operators: column picking, Arrow passes over texts, digests, row splits."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of Arrow data that one step of a pass holds at a time; a longer document is one step of its own.
PIECE_BYTES = 4 << 20

Worker = Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def picked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Just `doc_id` (as long) and `text`, whatever else the table holds."""
    return docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about PIECE_BYTES."""
    rows = max(1, batch.num_rows * PIECE_BYTES // max(batch.nbytes, 1))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def map_texts(df: DataFrame, schema: str, start: Callable[[], Worker], finish: bool = False) -> DataFrame:
    """Run a worker over every piece of every task. With `finish` it is called once more with None at the end."""

    def run(batches):
        work = start()
        for batch in batches:
            for piece in pieces(batch):
                yield from work(piece)
        if finish:
            yield from work(None)

    return df.mapInArrow(run, schema)


def send(df: DataFrame, value: object) -> Callable[[], object]:
    """Broadcast a value of bounded size with its class, so that executors need no copy of this package."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(shared.value)


def as_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes; NULL is empty."""
    values = batch.column(name)
    return [b"" if x is None else x for x in values.cast(pa.binary() if pa.types.is_string(values.type) else pa.large_binary()).to_pylist()]


def as_text(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as str; NULL is empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fold_of(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds
