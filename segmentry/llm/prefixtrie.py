"""Prefix trie of conversations, built as a burst trie.

A conversation is a sequence of turn ids. Equal sequences are one entry. All entries start in one container under the root;
a container that holds more than `limit` turn ids bursts: its entries move on past the turns they all share and are
dealt to new containers by their next turn id, under a longer head. What is left is small: containers are dealt over the
tasks, sorted, and swept into nodes with a stack. The nodes of the heads, above the containers, are summed up from what the
containers report for each of their heads.

Every member list is hashed in order: ids are sorted by ranges, each range writes its part of a list as pieces of text,
and one stream per list hashes the pieces, so that a conversation that very many share is no long list anywhere.

Defined cases: turns are ordered by number, NULL first; equal numbers go by turn id. A NULL role or text is empty. Repeated
rows are turns of their own. Rows without a conversation id belong to no conversation. Without conversations there are
no nodes; a conversation without turns is a member of the root. Other columns are left aside. One conversation's
turn ids (16 bytes a turn, no texts) are held by a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import column, map_texts
from segmentry.session import cut

#: Characters of a member list that one row holds.
PIECE_CHARS = 1 << 20


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of role and text; the role's length keeps them apart."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def sequences(
    turns: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """One row per conversation: `conv_id`, `turns` (id and code points of the last text, in order)."""
    role, text = (F.coalesce(column(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    rows = turns.select(
        column(id_column).cast("long").alias("conv_id"),
        F.struct(column(turn_column).cast("long").alias("turn"), turn_id(role, text).alias("id"), F.length(text).alias("chars")).alias("t"),
    ).filter(F.col("conv_id").isNotNull())
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select("conv_id", F.transform("ts", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def rebuilt(convs: DataFrame, block: int = 100, folds: int = 6) -> DataFrame:
    """Each conversation with its first h turns taken from the first conversation of its block of ids; h = crc32(id) % folds."""
    donors = convs.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("donor"), F.slice("turns", 1, max(folds - 1, 1)).alias("lent")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % folds).cast("int")
    both = convs.withColumns({"donor": F.col("conv_id") - F.col("conv_id") % block, "h": h}).join(donors, "donor", "left")
    own = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    lent = F.when(F.col("h") > 0, F.slice("lent", F.lit(1), F.greatest("h", F.lit(1))))
    none = F.slice("turns", 1, 0)
    return both.select("conv_id", F.concat(F.coalesce(lent, none), F.coalesce(own, none)).alias("turns"))


def _prefix(ids: Column, depth: Column) -> Column:
    """Name of the node that the first `depth` turn ids lead to."""
    return F.unhex(F.md5(F.array_join(F.transform(F.slice(ids, F.lit(1), depth), F.hex), "").cast("binary")))


def _pieces_start():
    """Rows sorted by key and conversation; gives each key's ids as comma-joined pieces."""
    now = {"key": None, "ids": [], "chars": 0}

    def flushed():
        ids, key = now["ids"], now["key"]
        now.update(ids=[], chars=0)
        return key, ids[0], len(ids), ",".join(map(str, ids))

    def work(batch):
        found = []
        if batch is None:
            found += [flushed()] if now["ids"] else []
        else:
            for key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if now["ids"] and (key != now["key"] or now["chars"] > PIECE_CHARS):
                    found.append(flushed())
                now["key"] = key
                now["ids"].append(conv_id)
                now["chars"] += len(str(conv_id)) + 1
        if found:
            keys, firsts, sizes, texts = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(texts, pa.string())],
                ["key", "start", "n", "piece"],
            )

    return work


def _digest_start():
    """Pieces sorted by key and start; hashes each key's pieces in order."""
    now = {"key": None}

    def ended():
        return now["key"], now["first"], now["n"], now["sha"].hexdigest()

    def work(batch):
        found = []
        if batch is None:
            found += [ended()] if now["key"] is not None else []
        else:
            for key, start, n, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "start", "n", "piece"))):
                if key != now["key"]:
                    found += [ended()] if now["key"] is not None else []
                    now.update(key=key, first=start, n=0, sha=hashlib.sha256())
                else:
                    now["sha"].update(b",")
                now["n"] += n
                now["sha"].update(piece.encode())
        if found:
            keys, firsts, sizes, shas = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())],
                ["key", "first", "n", "ends"],
            )

    return work


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """Each distinct sequence once: `ids`, `chars`, `n` members, `first` (smallest), `ends` (SHA-256 of the sorted ids)."""
    keyed = cut(
        convs.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"))
        .withColumn("key", _prefix(F.col("ids"), F.size("ids")))
    )
    members = keyed.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = map_texts(members, "key binary, start long, n long, piece string", lambda: _pieces_start(), finish=True)
    streams = pieces.repartition("key").sortWithinPartitions("key", "start")
    digests = map_texts(streams, "key binary, first long, n long, ends string", lambda: _digest_start(), finish=True)
    of_first = keyed.select(F.col("conv_id").alias("first"), "ids", "chars")
    return digests.join(of_first, "first").select("ids", "chars", "n", "first", "ends")


def burst(entries: DataFrame, limit: int) -> tuple[list[DataFrame], DataFrame]:
    """Containers of at most `limit` turn ids (or of one entry), and the entries that end at a head.

    Both have `head` (name of the container), `depth` (turns of the head) and the columns of the entries.
    """
    open_ = cut(entries.withColumns({"head": F.unhex(F.md5(F.lit("").cast("binary"))), "depth": F.lit(0)}))
    settled, ended = [], [open_.limit(0)]
    while True:
        sizes = open_.groupBy("head").agg(
            F.count("*").alias("entries"), F.sum(F.size("ids") - F.col("depth")).alias("weight"),
            F.min("ids").alias("least"), F.max("ids").alias("most"),
        )
        same = F.zip_with("least", "most", lambda a, b: a.eqNullSafe(b))
        oversized = cut(
            sizes.filter((F.col("entries") > 1) & (F.col("weight") > limit))
            .select("head", (F.array_position(same, False) - 1).cast("int").alias("shared"))
        )
        if oversized.isEmpty():
            return [*settled, open_], reduce(DataFrame.unionByName, ended)
        settled.append(open_.join(oversized, "head", "left_anti"))
        moved = open_.join(oversized, "head").withColumns({"ends_here": F.size("ids") == F.col("shared")})
        depth = F.col("shared") + F.when(F.col("ends_here"), 0).otherwise(1)
        moved = cut(
            moved.withColumn("depth", depth.cast("int")).withColumn("head", _prefix(F.col("ids"), F.col("depth"))).drop("shared"), ["ends_here"]
        )
        ended.append(moved.filter("ends_here").drop("ends_here"))
        open_ = moved.filter("not ends_here").drop("ends_here")


_NODES = (
    "name binary, depth int, first long, parent_first long, n long, children long, leaves long, saved long, ends string, "
    "path array<binary>, chars array<int>"
)
_EMPTY = hashlib.sha256(b"").hexdigest()


def swept(entries: list[tuple[list[bytes], list[int], int, int, str]], depth: int) -> Iterator[dict]:
    """Nodes of a container from its entries (ids, chars, n, first, ends), sorted by ids; the top node comes last."""

    def node(at, chars):
        return {"depth": at, "chars": chars, "n": 0, "first": None, "children": [], "leaves": 0, "saved": 0, "ends": _EMPTY}

    def close(done):
        done["leaves"] += not done["children"]
        done["saved"] += (done["n"] - 1) * done["chars"]
        for child in done["children"]:
            child["parent_first"] = done["first"]
        return done["children"]

    def add(parent, child):
        parent["children"].append(child)
        parent["n"] += child["n"]
        parent["first"] = child["first"] if parent["first"] is None else min(parent["first"], child["first"])
        parent["leaves"] += child["leaves"]
        parent["saved"] += child["saved"]

    stack, before = [node(depth, entries[0][1][depth - 1] if depth else 0)], None
    for ids, chars, n, first, ends in entries:
        shared = depth
        if before is not None:
            while shared < min(len(ids), len(before)) and ids[shared] == before[shared]:
                shared += 1
        while len(stack) - 1 > shared - depth:
            done = stack.pop()
            yield from close(done)
            add(stack[-1], done)
        for at in range(shared, len(ids)):
            stack.append(node(at + 1, chars[at]))
        last = stack[-1]
        last["n"] += n
        last["first"] = first if last["first"] is None else min(last["first"], first)
        last["ends"] = ends
        before = ids
    while len(stack) > 1:
        done = stack.pop()
        yield from close(done)
        add(stack[-1], done)
    top = stack.pop()
    yield from close(top)
    yield top


def _path(ids: list[bytes], depth: int) -> list[bytes]:
    """Names of the nodes from the root to `depth`."""
    running, names = hashlib.md5(), []
    names.append(running.digest())
    for turn in ids[:depth]:
        running.update(turn.hex().upper().encode())
        names.append(running.digest())
    return names


def _sweep_start():
    now = {"head": None, "entries": [], "depth": 0}

    def nodes():
        entries, depth = now["entries"], now["depth"]
        ids, chars = entries[0][:2]
        path = _path(ids, depth)
        for node in swept(entries, depth):
            node["children"] = len(node["children"])
            node["path"] = node["name"] = None
            if "parent_first" not in node:  # the top: it reports to the heads above
                node |= {"parent_first": None, "path": path, "name": path[-1], "chars": [0, *chars[:depth]]}
            else:
                node["chars"] = None
            yield node
        now["entries"] = []

    names = [c.split()[0] for c in _NODES.split(", ")]
    schema = pa.schema(
        [("name", pa.binary()), ("depth", pa.int32()), ("first", pa.int64()), ("parent_first", pa.int64()), ("n", pa.int64()),
         ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()),
         ("path", pa.list_(pa.binary())), ("chars", pa.list_(pa.int32()))]
    )

    def work(batch):
        found = []
        if batch is None:
            found += nodes() if now["entries"] else []
        else:
            for head, depth, *entry in zip(*(batch.column(c).to_pylist() for c in ("head", "depth", "ids", "chars", "n", "first", "ends"))):
                if head != now["head"]:
                    found += nodes() if now["entries"] else []
                    now.update(head=head, depth=depth)
                now["entries"].append(tuple(entry))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], schema.field(c).type) for c in names], schema=schema)

    return work


def sweep(containers: list[DataFrame]) -> DataFrame:
    """All nodes of the containers; a container's top also has its `path` (names from the root) and the `chars` on it."""
    rows = reduce(DataFrame.unionByName, containers).select("head", "depth", "ids", "chars", "n", "first", "ends")
    return map_texts(rows.repartition("head").sortWithinPartitions("head", "ids"), _NODES, lambda: _sweep_start(), finish=True)


def head_nodes(tops: DataFrame, ended: DataFrame) -> DataFrame:
    """The nodes above the containers, with the columns of the others, from the containers' tops and the ended entries."""
    names = F.transform(F.sequence(F.lit(0), F.col("depth")), lambda d: _prefix(F.col("ids"), d))
    none = F.lit(None)
    reports = tops.select("path", "chars", F.lit(False).alias("is_end"), "n", "first", "leaves", "saved", none.cast("string").alias("ends")).unionByName(
        ended.select(
            names.alias("path"), F.concat(F.array(F.lit(0)), F.slice("chars", F.lit(1), F.col("depth"))).alias("chars"), F.lit(True).alias("is_end"),
            "n", "first", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "ends",
        )
    )
    length = F.size("path") - F.when(F.col("is_end"), 0).otherwise(1)  # a top is a node of its container
    above = reports.filter(length > 0).select(
        F.explode(F.sequence(F.lit(0), length - 1)).alias("depth"), "path", "chars", "is_end", "n", "first", "leaves", "saved", "ends"
    )
    per_child = above.select(
        F.get("path", F.col("depth")).alias("name"), F.get("path", F.col("depth") + 1).alias("child"), "depth",
        F.slice("path", F.lit(1), F.col("depth") + 1).alias("path"), F.slice("chars", F.lit(1), F.col("depth") + 1).alias("chars"),
        "n", "first", "leaves", "saved", F.when(F.col("child").isNull(), F.col("ends")).alias("ends"),
    )
    totals = [F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")]
    same = [F.any_value(c).alias(c) for c in ("depth", "path", "chars")]
    heads = cut(
        per_child.groupBy("name", "child").agg(*totals, *same).groupBy("name").agg(*totals, *same, F.count("child").alias("children"))
    )
    own = heads.select(
        F.explode("path").alias("name"), ((F.col("n") - 1) * F.get("chars", F.col("depth"))).alias("own")
    ).groupBy("name").agg(F.sum("own").alias("own"))
    parents = heads.select(F.col("name").alias("parent"), F.col("first").alias("parent_first"))
    return (
        heads.withColumn("parent", F.when(F.col("depth") > 0, F.get("path", F.col("depth") - 1)))
        .join(own, "name").join(parents, "parent", "left")
        .select("name", "depth", "first", "parent_first", "n", "children", "leaves", (F.col("saved") + F.col("own")).alias("saved"),
                F.coalesce("ends", F.lit(_EMPTY)).alias("ends"))
    )


def trie(convs: DataFrame, limit: int = 5000) -> DataFrame:
    """The nodes of the trie of `conv_id`, `turns` (see `sequences`): `conv_id` (smallest member), `depth`,
    `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`."""
    containers, ended = burst(distinct_sequences(convs), limit)
    nodes = cut(sweep(containers))
    tops = nodes.filter(F.col("path").isNotNull())
    heads = cut(head_nodes(tops, ended))
    parents = heads.select(F.col("name").alias("parent"), F.col("first").alias("head_first"))
    columns = ["depth", "first", "parent_first", "n", "children", "leaves", "saved", "ends"]
    hung = (
        tops.withColumn("parent", F.when(F.col("depth") > 0, F.get("path", F.col("depth") - 1))).join(parents, "parent", "left")
        .withColumn("parent_first", F.col("head_first")).select(columns)
    )
    everything = nodes.filter(F.col("path").isNull()).select(columns).unionByName(hung).unionByName(heads.select(columns))
    return everything.select(
        F.col("first").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_first").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
