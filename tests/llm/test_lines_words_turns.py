"""Line dedup, spelling variants and the prefix trie against plain calculations."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import prose, table

from segmentry.llm import linededup, prefixtrie, variants

# --- lines


def plain_line_dedup(rows, least=10):
    """(id, text) rows -> sorted (id, number of lines, number dropped, kept text)."""
    low = lambda i: -(2**63) if i is None else i
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    keeper = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                keeper[key(line)] = min(low(i), keeper.get(key(line), low(i)))
    found = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(key(line)) < least or keeper[key(line)] == low(i)]
        found.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


def line_rows():
    rng = random.Random(5)
    common = [prose(rng, 4) for _ in range(6)] + ["ÀÉ" * 5, "é" * 9, "short", "", "x" * 10, "日本語の行" * 2]
    rows = []
    for i in range(120):
        lines = [rng.choice(common) if rng.random() < 0.7 else prose(rng, 3) for _ in range(rng.randint(1, 12))]
        lines = [rng.choice(["", " ", "\t", "\r"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", "\x0b ", "\r"]) for x in lines]
        rows.append((i * 7 % 131, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "\n".join([common[0]] * 3)), (1, "\n".join(common)), (None, common[0]), (None, "b\n" + common[1])]
    rows += [rows[3], rows[3], (600, "\n".join(f"line number {n % 5000}" for n in range(20_000)))]
    return rows


@pytest.mark.parametrize("partitions", ["1", "4", "61"])
def test_line_dedup_equals_plain(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that a hash begins in an earlier range
    try:
        rows = line_rows()
        got = linededup.deduplicate(table(spark, rows).withColumnsRenamed({"key": "doc", "bits": "text_hash", "words": "keep"})).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((tuple(r) for r in got), key=repr) == plain_line_dedup(rows)


def test_hot_line_over_many_ranges(spark):
    rows = [(i, f"the same line\nown line of {i}\nthe same line") for i in range(3000)]
    got = linededup.line_bitmaps(table(spark, rows).repartition(7)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped) for r in got} == {i: (3, 2 if i else 0) for i in range(3000)}
    assert all(linededup.unpack(r.n_lines, r.keep).tolist() == ([False, True, False] if r.doc_id else [True] * 3) for r in got)


def test_line_dedup_of_an_empty_table(spark):
    assert linededup.deduplicate(table(spark, [])).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 3000).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.integers(0, n - 1), max_size=40))))
def test_bitmaps_round_trip(case):
    n, dropped = case
    assert linededup.unpack(n, linededup.pack(n, dropped)).tolist() == [i not in set(dropped) for i in range(n)]
    assert len(linededup.pack(100_000, dropped)) < 400


# --- words


def plain_words(rows, least_chars, least_n, every):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_chars:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_n}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(words, ratio=5):
    form, near = {}, {}
    for w, n in words.items():
        close = [x for x in words if is_near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        near[w], form[w] = len(close), best if best and words[best] >= ratio * n else None
    found = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return sorted(found)


def word_rows():
    rng = random.Random(9)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["aaaaaaa", "aaaaaa", "abababab", "ÀÀÀÀÀÀ", "àààààà"]
    rows = []
    for i in range(150):
        words = []
        for w in rng.choices(base, [1 / (k + 1) for k in range(len(base))], k=60):
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "b", w[at] * 2]) + w[at + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1", ", "]).join(words)))
    return rows + [(None, "abcabcab " * 7), (200, None), (201, ""), (202, "straße ×÷×÷×÷ Ünder ünder"), (rows[0]), (300, "longer" * 3000 + " ")]


@pytest.mark.parametrize("every", [None, 7, 199])
def test_word_counts_and_groups_equal_plain(spark, every, monkeypatch):
    monkeypatch.setattr(variants, "HELD_WORDS", 50)
    rows = word_rows()
    counted = variants.word_counts(table(spark, rows).withColumnsRenamed({"words": "word", "key": "n"}), 6, 5, every)
    words = plain_words(rows, 6, 5, every)
    assert {r.word: r.n for r in counted.collect()} == words
    got = sorted(tuple(r) for r in variants.spelling_groups(counted).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == plain_groups(words)
    assert any(r[1] and r[2] != r[1] for r in got) or every  # a chain


def test_long_chains_end_at_their_root(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(23)] + [("x", "w20"), ("y", "z")], "word string, form string")
    assert {r.word: r.root for r in variants.roots(forms).collect()} == {f"w{i}": "w23" for i in range(23)} | {"x": "w23", "y": "z"}


def test_no_words(spark):
    assert variants.spelling_groups(variants.word_counts(table(spark, []))).collect() == []
    assert variants.spelling_groups(variants.word_counts(table(spark, [(1, None), (2, "once only")]))).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=5), min_size=2, max_size=12), st.randoms())
def test_ranges_find_every_pair_once(words, rng):
    counts = {w: rng.randint(1, 3) for w in words}
    ranges = defaultdict(list)
    for w in words:
        for at in range(len(w) + 1):
            ranges[w[at:] + "$" + w[:at]].append(("", counts[w]))
            if at:
                ranges[w[at:] + "$" + w[: at - 1]].append((w[at - 1], counts[w]))
    near, best = Counter(), {}
    for prefix, members in ranges.items():
        for word, n, best_n, other in variants.neighbours_in_range(prefix, members):
            near[word] += n
            best[word] = min(best.get(word, (1, "")), (-best_n, other))
    for w in words:
        close = sorted((-counts[x], x) for x in words if is_near(w, x))
        assert near[w] == len(close) and best.get(w) == (close[0] if close else None)


# --- turns


def plain_sequences(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[conv_id].append(((turn is not None, turn or 0, name), role, text))
    return {c: [(role, text) for _, role, text in sorted(turns)] for c, turns in convs.items()}


def plain_rebuilt(convs):
    found = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        found[c] = convs.get(donor, [])[:h] + own[h:]
    return found


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(ids) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            (ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), children[node], leaves[node], saved[node],
             hashlib.sha256(",".join(str(c) for c in ids if len(convs[c]) == len(node)).encode()).hexdigest())
            for node, ids in members.items()
        ),
        key=repr,
    )


def turn_rows():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 40), *range(95, 130), *range(205, 330), -3, -100, -150]:
        n = rng.randint(1, 9)
        for t in range(n):
            text = rng.choice(["hello", "é" * 4, "long text " * 3, None, ""]) if rng.random() < 0.8 else prose(rng, 3)
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]) if rng.random() < 0.3 else "user", text))
    for c in range(1000, 1060):  # copies, among them prefixes of each other
        rows += [(c, t, "user", f"turn {t}") for t in range(3 + c % 5)]
    rows += [(2000, 1, "user", "a"), (2000, 1, "user", "a"), (2000, 1, "user", "b"), (None, 1, "user", "nobody"), (3000, t := 0, "system", "x" * 9000)]
    rows += [(4000 + k, i, "user", f"deep {i}") for k in range(3) for i in range(60 + k)]
    rng.shuffle(rows)
    return rows


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("limit", [5, 100, 100_000])
def test_trie_equals_plain(spark, limit):
    rows = turn_rows()
    df = spark.createDataFrame([(*r, 1, b"h", 2) for r in rows], TURNS + ", ids long, head binary, depth int").repartition(5)
    convs = prefixtrie.rebuilt(prefixtrie.sequences(df))
    got = sorted((tuple(r) for r in prefixtrie.trie(convs, limit).collect()), key=repr)
    assert got == plain_trie(plain_rebuilt(plain_sequences(rows)))


def test_bursting_bounds_the_containers(spark):
    rows = [(c, t, "user", f"{t}" if t < 20 else f"{t} {c >> (t - 20)}") for c in range(64) for t in range(26)]
    entries = prefixtrie.distinct_sequences(prefixtrie.sequences(spark.createDataFrame(rows, TURNS)))
    containers, ended = prefixtrie.burst(entries, 30)
    sizes = [r for df in containers for r in df.groupBy("head").agg({"*": "count", "depth": "max"}).collect()]
    assert sum(r["count(1)"] for r in sizes) == 64 and ended.isEmpty()
    assert all(r["count(1)"] * (26 - r["max(depth)"]) <= 30 or r["count(1)"] == 1 for r in sizes)


def test_member_lists_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE_CHARS", 20)
    convs = prefixtrie.sequences(spark.createDataFrame([(c, 0, "user", "hot" if c % 3 else "cold") for c in range(5000)], TURNS))
    got = {r.first: r.ends for r in prefixtrie.distinct_sequences(convs).collect()}
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got == {0: digest(c for c in range(5000) if c % 3 == 0), 1: digest(c for c in range(5000) if c % 3)}


def test_trie_of_nothing(spark):
    nothing = spark.createDataFrame([], TURNS)
    assert prefixtrie.trie(prefixtrie.rebuilt(prefixtrie.sequences(nothing))).collect() == []
    alone = prefixtrie.trie(prefixtrie.rebuilt(prefixtrie.sequences(spark.createDataFrame([(1, 0, "user", "gone")], TURNS)))).collect()
    h = zlib.crc32(b"1") % 6  # no donor: the first h turns are lost
    assert [(r.conv_id, r.depth, r.n_convs) for r in alone if r.depth == 0] == [(1, 0, 1)] and len(alone) == (1 if h else 2)
