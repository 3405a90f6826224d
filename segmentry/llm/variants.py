"""Spelling variants: words that are one edit apart, and the frequent word that a rare one stands for.

Every word is marked with an end sign and turned in all ways; turned to `rest$begin`, an edited character comes last.
So words that differ by a replaced character share a rotation up to its last character, and a shorter word's whole
rotation equals a longer one's without its last character. All rotations, with and without the last character,
are sorted by that prefix; a scan sees each prefix range once. A range holds at most one whole rotation and one word per
letter (90 letters), so ranges are bounded whatever the data; neighbours are counted and ranked inside a range without
listing pairs. A pair is found once: replacements have one place, and an inserted character counts only as the first
of a run of equal ones.

Defined cases: a NULL text has no words; a NULL id reads as empty text. Ties between forms go to the smaller word in
code-point order. A form has `ratio` times the word's occurrences, so chains of forms end; they are followed by
doubling. An empty table gives an empty table; other columns are left aside.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import as_bytes, map_texts, picked
from segmentry.session import cut

#: Counts that a task holds before it hands them on.
HELD_WORDS = 200_000
END = "$"

Runs = Callable[[int | None, str], Iterator[tuple[str, int]]]


def lower_ascii(text: bytes) -> str:
    return text.lower().decode()


def sparse_typos(doc_id: int | None, run: str, every: int = 199) -> str:
    """The run, or the run without one code point where the crc32 of `doc_id:run` is a multiple of `every`."""
    crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if crc % every else run[: (at := crc % len(run))] + run[at + 1 :]


def _count_worker(pattern: str, least_chars: int, every: int | None):
    def start():
        find, held = re.compile(pattern).findall, Counter()

        def handed_on():
            words, counts = list(held), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

        def work(batch):
            if batch is not None:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch)):
                    own = Counter(run for run in find(lower_ascii(text)) if len(run) >= least_chars)
                    if every:
                        begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                        for run in [run for run in own if zlib.crc32(run.encode(), begin) % every == 0]:
                            changed, n = sparse_typos(doc_id, run, every), own.pop(run)
                            if len(changed) >= least_chars:
                                held[changed] += n
                    held.update(own)
                    if len(held) > HELD_WORDS:
                        yield handed_on()
            elif held:
                yield handed_on()

        return work

    return start


def word_counts(
    docs: DataFrame, least_chars: int = 6, least_n: int = 5, every: int | None = None,
    pattern: str = "[a-zÀ-ÿ]+", id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """`word`, `n` of the runs of letters of all texts, A-Z lowered; with `every` the runs have `sparse_typos`.

    Each task adds up what it reads before the shuffle.
    """
    counted = map_texts(picked(docs, id_column, text_column), "word string, n long", _count_worker(pattern, least_chars, every), finish=True)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def rotations(words: DataFrame) -> DataFrame:
    """`prefix`, `last`, `n`: each rotation whole (`last` empty) and, where it ends in a letter, without that letter."""
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    parts = turned.select(
        "n", F.expr("substring(word, at + 1)").alias("rest"), F.expr("substring(word, 1, at)").alias("begin"), "at",
        F.expr("substring(word, at, 1)").alias("letter"), F.expr("substring(word, 1, at - 1)").alias("shorter"),
    )
    whole = F.struct(F.concat("rest", F.lit(END), "begin").alias("prefix"), F.lit("").alias("last"))
    without = F.struct(F.concat("rest", F.lit(END), "shorter").alias("prefix"), F.col("letter").alias("last"))
    return parts.select(F.inline(F.when(F.col("at") > 0, F.array(whole, without)).otherwise(F.array(whole))), "n")


def neighbours_in_range(prefix: str, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """Of the members (last letter, n) of one range: word, number of near words, and the best of them (n, word)."""
    rest, begin = prefix.split(END)
    words = [(-n, begin + last + rest, last) for last, n in members]
    whole = [x for x in words if not x[2]]
    letters = sorted(x for x in words if x[2])
    inserted = [x for x in letters if not begin.endswith(x[2])]
    for x in letters:
        near, best = len(letters) - 1, [y for y in letters[:2] if y is not x][:1]
        if whole and not begin.endswith(x[2]):
            near, best = near + 1, best + whole
        if near:
            n, word, _ = min(best)
            yield x[1], near, -n, word
    for x in whole:
        if inserted:
            yield x[1], len(inserted), -inserted[0][0], inserted[0][1]


def _scan_start():
    """Scans rows sorted by prefix; the last range of a batch waits for the next batch."""
    waiting = []

    def near_words(batch, ends):
        starts = np.concatenate([[0], ends[:-1]])
        found = []
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            part = batch.slice(a, b - a)
            members = list(zip(part.column("last").to_pylist(), part.column("n").to_pylist()))
            found += neighbours_in_range(part.column("prefix")[0].as_py(), members)
        columns = list(zip(*found)) or [[], [], [], []]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "near", "best_n", "best"])

    def work(batch):
        rows = pa.Table.from_batches([*waiting, *([] if batch is None else [batch])]).combine_chunks() if waiting or batch is not None else None
        waiting.clear()
        if rows is None or not rows.num_rows:
            return
        rows = rows.to_batches()[0]
        prefix = rows.column("prefix")
        ends = 1 + np.flatnonzero(pc.not_equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False))
        if batch is None:
            ends = np.append(ends, rows.num_rows)
        else:
            waiting.append(rows.slice(ends[-1] if len(ends) else 0))
        if len(ends):
            yield near_words(rows, ends)

    return work


def near_words(words: DataFrame) -> DataFrame:
    """`word`, `n`, `n_near`, and the near word of largest n (`best`, `best_n`; ties: the smallest word)."""
    order = ["prefix", "last"]
    sorted_rotations = rotations(words).repartitionByRange("prefix").sortWithinPartitions(*order)
    found = map_texts(sorted_rotations, "word string, near long, best_n long, best string", lambda: _scan_start(), finish=True)
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("minus"), "best"))
    rows = found.select("word", F.lit(None).cast("long").alias("n"), "near", best.alias("best")).unionByName(
        words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("struct<minus: long, best: string>").alias("best"))
    )
    merged = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return merged.select("word", "n", "n_near", (-F.col("best.minus")).alias("best_n"), "best.best")


def roots(forms: DataFrame) -> DataFrame:
    """`word`, `root`: the end of each word's chain of forms. Links double in length until none can be prolonged."""
    links = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("is_open"))
    while True:
        links = cut(links)
        if links.filter("is_open").isEmpty():
            return links.select("word", "root")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("is_open")
        )


def spelling_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Per row of `words` (`word`, `n`): `form`, `root`, `n`, `n_near`, `form_n`.

    The form is the best near word if it has at least `ratio` times the word's occurrences.
    """
    if ratio < 2:
        raise ValueError("chains of forms end only if a form is at least twice as frequent")
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = cut(
        near_words(cut(words.select("word", "n"))).select(
            "word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
        )
    )
    ends = roots(found.filter(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
