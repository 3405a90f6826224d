"""Near-duplicate documents by SimHash and a byte-position inverted index with count filtering.

The 64-bit fingerprint is eight bytes in eight positions. Two fingerprints with at most `max_bits` different bits
differ in at most `max_bits` positions, so they share at least `8 - max_bits` positional bytes. Lists of the index
are kept by several positions at once (the intersection of the lists of these positions): the positions are cut into
`max_bits + 2` runs and a list is kept for every choice of all but `max_bits` runs, so each pair that can pass meets
in a list, and lists stay short at any size. In a list each pair tallies its shared positional bytes; pairs below
the guaranteed minimum go, the others are verified bit by bit.

A list with more than `LIST_PAIRS` fingerprints (many near copies of one text) is not paired. Its fingerprints agree
on the bytes of the list, so within it they are filed under every value that differs by `max_bits / 2` bits or
fewer in the other positions; two that are close meet under a value between them, and all that meet are close. Each
is linked to the smallest one there: no pair of neighbours loses its connection and no pairs are listed.

Only distinct fingerprints are compared; copies share one.

Defined cases: NULL, empty and white-space texts have fingerprint zero, linked like any other; fewer words than a
shingle make one shingle; repeated rows give repeated rows; a NULL id keeps its row and is never a component's
name unless all its members are NULL; empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_bytes, map_texts, picked
from segmentry.llm.components import components
from segmentry.session import cut

SEED = 42
#: Distinct fingerprints of a list that are still compared pair by pair.
LIST_PAIRS = 32
#: Hashes whose bits are counted at a time.
_BLOCK = 1 << 14


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every shingle of words, repeats included. A-Z is lower-cased; words end at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-size].tolist()]
    return np.array([digest(joined[i:j], SEED) for i, j in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64)


def fingerprint(text: bytes, size: int = 3) -> int:
    """Bit i is set if it is set in over half the shingle hashes."""
    hashes = shingle_hashes(text, size)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        block = hashes[at : at + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big") if len(hashes) else 0


def fingerprints(docs: DataFrame, size: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id`, `bits`: the fingerprint as a signed long."""

    def start():
        def work(batch):
            bits = np.array([fingerprint(t, size) for t in as_bytes(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits)], ["doc_id", "bits"])

        return work

    return map_texts(picked(docs, id_column, text_column), "doc_id long, bits long", start)


def _mask(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << 8 * p for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _runs(max_bits: int) -> list[tuple[int, ...]]:
    """Choices of byte positions; whichever `max_bits` positions differ, one choice avoids them all."""
    parts = [tuple(int(p) for p in x) for x in np.array_split(np.arange(8), max_bits + 2)]
    return [sum(chosen, ()) for chosen in combinations(parts, 2)]


def shared_bytes(x: Column) -> Column:
    """Number of byte positions in which two fingerprints with XOR `x` agree."""
    return sum((x.bitwiseAND(F.lit(_mask((p,)))) == 0).cast("int") for p in range(8))


def links(bits: DataFrame, max_bits: int = 2) -> DataFrame:
    """`a`, `b`: links between distinct fingerprints (`bits`) that join all within `max_bits` bits of each other."""
    if not 0 < max_bits <= 3:
        raise ValueError("max_bits is 1, 2 or 3")
    chosen = _runs(max_bits)
    masks = F.array(*[F.lit(_mask(c)) for c in chosen])
    filed = bits.select("bits", F.posexplode(masks).alias("list", "mask")).select(
        "bits", "list", F.col("bits").bitwiseAND(F.col("mask")).alias("key")
    )
    sizes = filed.groupBy("list", "key").agg(F.count("*").alias("n")).filter("n > 1")
    filed = cut(filed.join(sizes, ["list", "key"]))
    short = filed.filter(F.col("n") <= LIST_PAIRS).select("list", "key", "bits")
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (
        short.withColumnRenamed("bits", "a").join(short.withColumnRenamed("bits", "b"), ["list", "key"])
        .filter((F.col("a") < F.col("b")) & (shared_bytes(x) >= 8 - max_bits) & (F.bit_count(x) <= max_bits))
        .select("a", "b")
    )
    long = filed.filter(F.col("n") > LIST_PAIRS)
    return pairs.unionByName(_star_links(long, chosen, max_bits)).distinct()


def _star_links(filed: DataFrame, chosen: list[tuple[int, ...]], max_bits: int) -> DataFrame:
    """Links of the long lists: each fingerprint to the smallest one under a value between them.

    For an odd `max_bits` one end of a pair is a step nearer to the value; the smallest of these is the hub.
    """
    steps = (max_bits + 1) // 2
    values = []
    for positions in chosen:
        free = [8 * p + b for p in range(8) if p not in positions for b in range(8)]
        flips = [0] + [sum(1 << b for b in c) for k in range(1, steps + 1) for c in combinations(free, k)]
        values.append(F.array(*[F.lit(f - (1 << 64) if f >> 63 else f) for f in flips]))
    flips = F.element_at(F.array(*values), F.col("list") + 1)
    spread = filed.select("list", "bits", F.explode(flips).alias("flip")).select(
        "list", "bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("value"), F.bit_count("flip").alias("d")
    )
    near = spread if max_bits % 2 == 0 else spread.filter(F.col("d") < steps)
    hubs = near.groupBy("list", "value").agg(F.min("bits").alias("hub"))
    met = spread.join(hubs, ["list", "value"]).select(F.col("hub").alias("a"), F.col("bits").alias("b"))
    return met.filter("a <> b")


def near_duplicates(
    docs: DataFrame, size: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits), `component_id` (the smallest id reachable by links)."""
    marked = cut(fingerprints(docs, size, id_column, text_column))
    distinct = cut(marked.groupBy("bits").agg(F.min("doc_id").alias("first")))
    roots = cut(components(links(distinct.select("bits"), max_bits)))
    reached = distinct.join(roots, distinct.bits == roots.node, "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    names = reached.groupBy("root").agg(F.min("first").alias("component_id"))
    named = reached.join(names, "root").select("bits", "component_id")
    return marked.join(named, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
