"""Each operator against a plain calculation of its definition, over copies, odd texts, repeated rows and extra columns."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from llm_cases import prose, table
from segmentry.llm import bpe, components, decontam, ordermin, phrasededup, repeats, simhash, suffixdedup, suffixes


def by_id(rows, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in rows}


def lower_ascii(text):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")


# SimHash


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower_ascii(text).encode())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits, max_bits):
    """Smallest index reachable over links of at most max_bits."""
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(bits))]


def test_near_duplicates_equal_the_pairwise_search(spark, cases):
    got = by_id(simhash.near_duplicates(table(spark, cases)).collect(), "fingerprint", "component_id")
    rows = sorted({r[0]: r[1] for r in cases}.items())
    bits = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(bits, 2)
    assert got == {i: (f"{b:016x}", rows[r][0]) for (i, _), b, r in zip(rows, bits, roots, strict=True)}
    assert got[80] == got[81][:1] + (80,) == got[82][:1] + (80,) == ("0" * 16, 80)


def test_repeated_rows_and_missing_ids_keep_their_rows(spark, cases):
    docs = table(spark, [*cases, (None, "no id here"), (None, None)])
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(cases) + 2
    assert Counter(r.component_id for r in got if r.doc_id is None) == {None: 1, 80: 1}


@pytest.mark.parametrize("max_bits", [1, 2, 3])
@pytest.mark.parametrize("limit", [2, 1000])
def test_long_lists_lose_no_link(spark, monkeypatch, max_bits, limit):
    """Fingerprints around a few centres; lists above the limit go by values between neighbours."""
    monkeypatch.setattr(simhash, "LIST_PAIRS", limit)
    rng = np.random.default_rng(max_bits)
    bits = set()
    for centre in rng.integers(0, 1 << 63, 5).tolist():
        for _ in range(40):
            value = centre
            for b in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                value ^= 1 << b
            bits.add(value)
    bits = sorted(bits)
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    found = simhash.links(spark.createDataFrame([(b,) for b in signed], "bits long"), max_bits).collect()
    for r in found:
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= max_bits
    place = {b: i for i, b in enumerate(signed)}
    root = list(range(len(bits)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in found:
        a, b = sorted((find(place[r.a]), find(place[r.b])))
        root[b] = a
    assert [find(i) for i in range(len(bits))] == plain_components(bits, max_bits)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (7, None), (101, 100)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).isEmpty()


# Substring dedup


def plain_substring_dedup(rows, length):
    out, seen = {}, set()
    for doc_id, text in sorted({r[0]: r[1] or "" for r in rows}.items()):
        raw = text.encode()
        mask = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                mask[i : i + length] = True
            seen.add(w)
        kept = bytes(b for b, m in zip(raw, mask, strict=True) if not m)
        out[doc_id] = (len(raw), int(mask.sum()), int(np.sum(np.diff(np.concatenate(([0], mask.astype(int)))) == 1)), kept)
    return out


@pytest.mark.parametrize("length", [100, 40])
def test_substring_dedup_equals_the_plain_scan(spark, cases, length):
    rows = [r for r in cases if r[0] != 90] + [(90, "ab" * 1500)]
    found = suffixdedup.deduplicate(table(spark, rows), length).collect()
    expected = plain_substring_dedup(rows, length)
    assert len(found) == len(rows)
    for r in found:
        spans = [(s.start, s.end) for s in r.spans]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert (r.n_bytes, sum(b - a for a, b in spans), len(spans), bytes(r.kept)) == expected[r.doc_id], r.doc_id


def test_substring_dedup_of_a_very_long_period_and_missing_ids(spark, cases):
    rows = [(90, "ab" * 30_000), (None, "q" * 150), (None, None), (1, "q" * 120)]
    got = suffixdedup.deduplicate(table(spark, rows), 100).collect()
    by = {(r.doc_id, r.n_bytes): len(r.kept) for r in got}
    assert by == {(90, 60_000): 2, (None, 150): 1, (None, 0): 0, (1, 120): 0}  # overlaps count


def _letters(rng, n):
    return "".join(rng.choice(list("abcdefghijklmnop"), n))


def test_substring_dedup_around_a_short_passage_of_many_documents(spark):
    """Contexts share an anchor; only some share a string of the length, of one byte less or one more."""
    rng = np.random.default_rng(8)
    core, left, right = (_letters(rng, n) for n in (50, 60, 60))
    rows = [(i, _letters(rng, 90) + core + _letters(rng, 90)) for i in range(120)]
    for i, (a, b) in enumerate((a, total - 50 - a) for total in (99, 100, 101, 120) for a in (0, 1, 17, 25, 33, 34, 49)):
        if b <= 60:
            a = min(a, 60)
            rows.append((200 + i, _letters(rng, 40) + "<" + left[60 - a :] + core + right[:b] + ">" + _letters(rng, 40)))
    found = {r.doc_id: r for r in suffixdedup.deduplicate(table(spark, rows), 100).collect()}
    expected = plain_substring_dedup(rows, 100)
    assert any(e[1] for e in expected.values())
    assert {k: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for k, r in found.items()} == expected


@pytest.mark.parametrize("length", [100, 40, 33, 3])
def test_windows_are_left_out_only_where_no_other_context_has_them(length):
    rng = np.random.default_rng(length)
    k = suffixdedup.anchor_size(length)
    anchor = rng.integers(0, 256, k, np.uint8).tobytes()
    sides = [rng.integers(0, 2, length - k, np.uint8).tobytes() if i % 3 else rng.bytes(length - k) for i in range(60)]
    contexts, offsets = [], []
    for _ in range(80):
        a, b = (int(x) for x in rng.integers(0, length - k + 1, 2))
        if a + b < length - k:
            a = length - k - b
        i, j = (sides[x] for x in rng.integers(0, 60, 2))
        contexts.append(i[len(i) - a :] + anchor + j[:b])
        offsets.append(a)
    sizes, offsets = np.array(list(map(len, contexts))), np.array(offsets)
    own, first, last = suffixdedup.shared_runs(suffixdedup.stretches(b"".join(contexts), sizes, offsets, length), sizes, offsets, length)
    kept = {(c, w) for c, i, j in zip(own.tolist(), first.tolist(), last.tolist(), strict=True) for w in range(i, j + 1)}
    windows = [(c, w) for c, x in enumerate(contexts) for w in range(len(x) - length + 1)]
    texts = {(c, w): (offsets[c] - w, contexts[c][w : w + length]) for c, w in windows}
    n = Counter(texts.values())
    assert kept <= set(windows) and all(x in kept for x in windows if n[texts[x]] > 1)
    assert len(kept) < len(windows)


def test_spans_of_a_shard_are_merged(spark):
    rng = np.random.default_rng(9)
    passage = _letters(rng, 130)
    rows = [(i, _letters(rng, 200) + passage + _letters(rng, 200)) for i in (1, 2)]
    texts = table(spark, rows).select("doc_id", "text")
    spans = [(r.doc_id, r.start, r.end) for r in suffixdedup.repeated_spans(texts, 100).collect()]
    assert {x[0] for x in spans} == {2} and min(x[1] for x in spans) == 200 and max(x[2] for x in spans) == 330
    assert len(spans) <= 4  # runs, not windows


def test_names_of_substrings_take_few_scans(monkeypatch):
    text = np.append(np.random.default_rng(6).integers(1, 30, 100_000), 0).astype(np.uint16)
    n, push = 0, suffixes.Queue.push

    def counted(*args):
        nonlocal n
        n += 1
        push(*args)

    monkeypatch.setattr(suffixes.Queue, "push", counted)
    with suffixes.Disk() as disk:
        assert sum(len(p) for p, _ in suffixes.suffix_groups(disk, text, 31, 20)) == len(text) - 1
    assert n < 500


@pytest.mark.parametrize("small", [0, 4, 1 << 19])
def test_names_are_sorted_alike_in_memory_and_by_recursion(monkeypatch, small):
    monkeypatch.setattr(suffixes, "SMALL", small, raising=False)
    rng = np.random.default_rng(3)
    for trial in range(30):
        text = rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 150)))
        text = np.append(np.tile(text, 1 + trial % 4), 0).astype(np.uint16)
        with suffixes.Disk() as disk:
            got = np.concatenate([p for p, _ in suffixes.suffix_groups(disk, text, 6, 100)]).tolist()
        assert got == sorted(range(len(text) - 1), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.int32])
def test_small_orders_and_common_prefixes_of_any_pair(kind):
    rng = np.random.default_rng(5)
    for trial in range(60):
        text = np.append(np.tile(rng.integers(1, 4, int(rng.integers(1, 40))), 1 + trial % 5), 0).astype(kind)
        assert suffixes.small_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        left, right = rng.integers(0, len(text), (2, 30))
        left, right = left[left != right], right[left != right]
        for limit in (1, 3, 4, 9, 100):
            expected = []
            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                n = 0
                while n < limit and text[i + n] == text[j + n]:
                    n += 1
                expected.append(n)
            assert suffixes.common_prefixes(text, left, right, limit).tolist() == expected


@pytest.mark.parametrize("run", [5, 1 << 16])
def test_suffixes_and_common_prefixes(monkeypatch, run):
    monkeypatch.setattr(suffixes, "RUN", run)
    rng = np.random.default_rng(0)
    for trial in range(40):
        letters = int(rng.integers(1, 6))
        text = rng.integers(1, letters + 1, int(rng.integers(0, 90)))
        text = np.append(np.tile(text, 1 + trial % 3), 0).astype(np.uint16)
        with suffixes.Disk() as disk:
            parts = list(suffixes.suffix_groups(disk, text, letters + 1, 10))
            got = [(int(p), int(c)) for ps, cs in parts for p, c in zip(ps, cs, strict=True)]
        order = sorted(range(len(text) - 1), key=lambda i: text[i:].tolist())
        common = [0]
        for a, b in zip(order, order[1:], strict=False):
            n = 0
            while n < 10 and text[a + n] == text[b + n]:
                n += 1
            common.append(n)
        assert got == list(zip(order, common if order else [], strict=True))


def test_long_texts_have_wide_positions(monkeypatch):
    """Positions past 32 bits need a wider type; here all that are past 20 count as such."""
    monkeypatch.setattr(suffixes, "NARROW", 20, raising=False)
    text = np.append(np.tile(np.random.default_rng(2).integers(1, 4, 70), 3), 0).astype(np.uint16)
    with suffixes.Disk() as disk:
        parts = list(suffixes.suffix_groups(disk, text, 4, 10))
        assert {ps.dtype for ps, _ in parts} == {np.dtype(np.int64)}
        got = np.concatenate([ps for ps, _ in parts]).tolist()
    assert got == sorted(range(len(text) - 1), key=lambda i: text[i:].tolist())


def test_suffix_types_are_found_in_runs():
    """Less memory than a byte per symbol, whatever lies on disk."""
    text = np.append(np.random.default_rng(4).integers(1, 3, 4_000_000, np.uint16), 0).astype(np.uint16)
    with suffixes.Disk() as disk:
        tracemalloc.start()
        types = suffixes._s_types(disk, text)
        leftmost = suffixes._s_leftmost(disk, types, np.int32)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < len(text)
        differs = np.flatnonzero(text[:-1] != text[1:])
        following = differs[np.searchsorted(differs, np.arange(len(text) - 1))]
        assert np.array_equal(types, np.append(text[following] < text[following + 1], True))
        assert np.array_equal(leftmost, np.flatnonzero(types[1:] & ~types[:-1]) + 1)


# Phrase dedup


def plain_phrase_dedup(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    counts = Counter(tuple(w[k : k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = {}
    for i, w in words:
        mask = [False] * len(w)
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k : k + window])] > 1:
                mask[k : k + window] = [True] * window
        out[i] = (len(w), sum(mask), " ".join(x for x, m in zip(w, mask, strict=True) if not m))
    return out


@pytest.mark.parametrize("window, block", [(35, 400_000), (10, 50)])
def test_phrase_dedup_equals_the_plain_count(spark, cases, monkeypatch, window, block):
    monkeypatch.setattr(phrasededup, "BLOCK_WORDS", block)
    found = phrasededup.deduplicate(table(spark, cases), window).collect()
    expected = plain_phrase_dedup(cases, window)
    assert len(found) == len(cases)
    for r in found:
        assert (r.n_words, sum(s.end - s.start for s in r.spans), r.kept) == expected[r.doc_id], r.doc_id


def test_contexts_of_a_hot_anchor_are_not_held_together(spark, monkeypatch):
    """A passage with other words around it in each document: workers see a bounded part of its contexts at a time."""
    rng = random.Random(5)
    passage = prose(rng, 40)
    rows = [(i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for i in range(120)]
    rows += [(200, rows[0][1]), (201, prose(rng, 90)), (202, f"{passage} {passage}")]
    located = phrasededup.located

    def bounded(contexts, passages):
        # Parts are dealt by hash, so one may hold somewhat more than BLOCK_WORDS words of either kind.
        assert sum(map(len, contexts)) <= 2400 and sum(map(len, passages)) <= 2400
        yield from located(contexts, passages)

    monkeypatch.setattr(phrasededup, "BLOCK_WORDS", 800)
    monkeypatch.setattr(phrasededup, "located", bounded)
    found = phrasededup.deduplicate(table(spark, rows), 35).collect()
    expected = plain_phrase_dedup(rows, 35)
    assert len(found) == len(rows) and sum(len(r.spans) > 0 for r in found) >= 121
    for r in found:
        assert (r.n_words, sum(s.end - s.start for s in r.spans), r.kept) == expected[r.doc_id], r.doc_id


def test_only_what_the_automata_find_is_removed(spark, cases, monkeypatch):
    monkeypatch.setattr(phrasededup, "located", lambda contexts, passages: iter(()))
    assert all(r.spans == [] for r in phrasededup.deduplicate(table(spark, cases), 35).collect())


def test_windows_with_the_same_places_form_one_passage(spark):
    """Passages break where the places of their windows differ, so that each is found whole wherever a window of it is."""
    words = [b"w%d" % i for i in range(12)]
    contexts = {5: words, 9: [b"x", *words[2:9]], 11: [*words[4:7], b"y"]}
    marks, held = {}, Counter()
    for context, own in contexts.items():
        digests = phrasededup.window_digests(own, 3)
        turned = phrasededup.place_marks(context * 0x9E3779B97F4A7C15, len(digests)).tolist()
        for h, mark in zip(digests, turned, strict=True):
            held[h] += 1
            marks[h] = marks.get(h, 0) ^ mark & (1 << 64) - 1
    again = {h: m for h, m in marks.items() if held[h] > 1}
    found = phrasededup.passages_of(words, again, 3)
    assert found == {b" ".join(words[i:j]) for i, j in ((2, 6), (4, 7), (5, 9))}
    spans = dict(phrasededup.located(list(contexts.values()), [p.split(b" ") for p in sorted(found)]))
    assert spans == {0: [(2, 9)], 1: [(1, 8)], 2: [(0, 3)]}


def test_repeated_rows_do_not_hide_where_a_passage_breaks(spark):
    rng = random.Random(8)
    passage, left, right = prose(rng, 60), prose(rng, 30), prose(rng, 30)
    ends = [" ".join(passage.split()[:40]), " ".join(passage.split()[20:])]
    rows = [(i, f"{left if i % 2 else prose(rng, 30)} {t} {right if i % 3 else prose(rng, 30)}") for i, t in enumerate(ends * 3)]
    rows = rows + rows[:2] + [(9, passage), (9, passage), (9, passage)]
    expected = plain_phrase_dedup(rows, 35)
    for r in phrasededup.deduplicate(table(spark, rows), 35).collect():
        assert (r.n_words, sum(s.end - s.start for s in r.spans), r.kept) == expected[r.doc_id], r.doc_id


def test_runs_cover_each_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 300)
    rng = np.random.default_rng(1)
    tokens = [rng.integers(0, 1 << 60, n, np.uint64) for n in (0, 5, 39, 40, 41, 150, 1000, 299)]
    seen = Counter()
    for at, end, joined, (first, count, offset, key) in repeats.document_runs(tokens, 40, 8):
        ends = np.cumsum([len(t) for t in tokens[at:end]])
        for f, n, o, k in zip(first.tolist(), count.tolist(), offset.tolist(), key.tolist(), strict=True):
            d = int(np.searchsorted(ends, f, side="right"))
            begin = f - (int(ends[d - 1]) if d else 0)
            assert k == repeats.gram_hashes(joined[f + o : f + o + 8], 8)[0]
            seen.update((at + d, begin + i) for i in range(n))
    assert seen == Counter((d, i) for d, t in enumerate(tokens) for i in range(len(t) - 39))


# BPE


@pytest.fixture(scope="module")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


def test_encoding_equals_the_library(spark, cases, vocabulary):
    texts = "İstanbul ΑΣ ΣΑΣ ǅ|don't WE'LL <|startoftext|>x<|endoftext|> <|startoftext|a\x1cb\u0085c d ﬁ½²٣ é 👨‍👩‍👧 𐾴".split("|")
    rows = [*cases, *((200 + i, t) for i, t in enumerate(["|".join(texts), *texts]))]
    found = bpe.encode_documents(table(spark, rows), vocabulary).collect()
    library = Tokenizer.from_file(vocabulary)
    expected = {i: library.encode(t or "", add_special_tokens=False).ids for i, t, *_ in rows}
    assert len(found) == len(rows)
    for r in found:
        assert r.ids == expected[r.doc_id]
        assert r.decoded == library.decode(expected[r.doc_id], skip_special_tokens=False)
    digests = by_id(bpe.encoding_digests(bpe.encode_documents(table(spark, rows), vocabulary)).collect(), "n_tokens", "ids_sha256")
    assert digests[81] == (0, hashlib.sha256(b"").hexdigest())
    assert digests[84] == (len(expected[84]), hashlib.sha256(" ".join(map(str, expected[84])).encode()).hexdigest())


def test_the_leftmost_lowest_pair_goes_first():
    ranks = {1 << 32 | 1: 0, 2 << 32 | 2: 1, 2 << 32 | 1: 2}
    assert bpe.merge_word([1] * 5, ranks, [2, 3, 4]) == [3, 1]
    rng = np.random.default_rng(2)
    ranks = {a << 32 | b: r for r, (a, b) in enumerate((a, b) for a in range(6) for b in range(6) if (a * b) % 3 != 1)}
    merged = [6 + r % 4 for r in range(len(ranks))]
    for n in (1, 2, 15, 16, 17, 40, 300):
        symbols = rng.integers(0, 6, n).tolist()
        slow = list(symbols)
        while found := [(ranks[a << 32 | b], i) for i, (a, b) in enumerate(zip(slow, slow[1:], strict=False)) if a << 32 | b in ranks]:
            rank, i = min(found)
            slow[i : i + 2] = [merged[rank]]
        assert bpe.merge_word(list(symbols), ranks, merged) == slow


# Order MinHash


def plain_order_minhash(sketch, text):
    points = [ord(c) for c in text]
    if not points:
        return [0] * sketch.functions
    padded = np.array(points, np.uint64) + np.uint64(1)
    padded = np.append(padded * np.uint64(0xC2B2AE3D27D4EB4F), np.zeros(max(0, sketch.k - len(points)), np.uint64))
    grams = [int(repeats.gram_hashes(padded[i : i + sketch.k], sketch.k)[0]) for i in range(len(padded) - sketch.k + 1)]
    seen, numbered, mask = Counter(), [], (1 << 64) - 1
    for g in grams:
        x = (g ^ seen[g] * 0x9E3779B97F4A7C15 & mask) * 0xD6E8FEB86659FD93 & mask
        numbered.append(x ^ x >> 32)
        seen[g] += 1
    out = []
    for m, f in zip(sketch.masks.ravel().tolist(), sketch.factors.ravel().tolist(), strict=True):
        picked = sorted(sorted(range(len(grams)), key=lambda i: ((numbered[i] ^ m) * f & mask, i))[: sketch.picks])
        h = 0x165667B19E3779F9
        for i in picked:
            h = (h ^ grams[i]) * 0x9E3779B97F4A7C15 & mask
            h ^= h >> 29
        out.append(h >> 32)
    return out


def test_order_minhash_equals_the_plain_selection(monkeypatch, cases):
    monkeypatch.setattr(ordermin, "_BLOCK", 64)
    sketch = ordermin.OrderMinHash(functions=6)
    for _, text, *_ in cases:
        text = (text or "")[:700]
        assert sketch(text).tolist() == plain_order_minhash(sketch, text)
    same, moved = "abcdefgh ijklmnop " * 3 + "qrstuvwx", "qrstuvwx" + "abcdefgh ijklmnop " * 3
    assert ordermin.likeness(sketch(same), sketch(same)) == 1 > ordermin.likeness(sketch(same), sketch(moved))


def test_edited_texts_take_from_the_next_document(spark, cases):
    rows = {r[0]: r[1] for r in cases}
    docs = table(spark, rows.items())
    found = {r.doc_id: r for r in ordermin.edited_fingerprints(docs).collect()}
    ids, sketch = sorted(rows), ordermin.OrderMinHash()
    assert sorted(found) == ids
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, other, r = rows[i] or "", rows[following] or "", found[i]
        n = len(text) // 4
        edited = text[: len(text) - n] + other[:n]
        assert (r.n_chars, r.edited, r.fingerprint) == (len(text), edited, ordermin.as_hex(sketch(text)))
        assert r.edited_fingerprint == ordermin.as_hex(sketch(edited))
        assert r.near_edited == ordermin.likeness(sketch(text), sketch(edited))
        assert r.near_next == ordermin.likeness(sketch(text), sketch(other))
    plain = by_id(ordermin.fingerprints(docs).collect(), "n_chars", "fingerprint")
    assert plain == {i: (r.n_chars, r.fingerprint) for i, r in found.items()}


def test_edited_texts_of_one_of_repeated_and_of_missing_ids(spark):
    one = ordermin.edited_fingerprints(table(spark, [(4, "only this")])).collect()
    assert [(r.edited, r.near_next) for r in one] == [("only thon", 1.0)]
    rows = [(2, "bbbbbbbb"), (1, "aaaaaaaa"), (1, "aaaaaaaa"), (None, "cccccccc"), (None, None)]
    got = ordermin.edited_fingerprints(table(spark, rows)).collect()
    assert len(got) == 5 and sum(r.doc_id is None for r in got) == 2
    assert sorted(r.edited for r in got if r.doc_id == 1) == ["aaaaaaaa", "aaaaaabb"]


# Decontamination


def plain_hits(rows, items, window):
    def words(text):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text).encode())

    out = {}
    for i, t, *_ in rows:
        own = words(t)
        mask, names = [False] * len(own), set()
        for name, text in items:
            item = words(text)
            size = min(window, len(item))
            windows = {tuple(item[k : k + size]) for k in range(len(item) - size + 1)} if item else set()
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in windows:
                    mask[k : k + size] = [True] * size
                    names.add("" if name is None else str(name))
        out[i] = (len(own), sum(mask), sorted(names))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination_equals_the_plain_search(spark, cases, block_bytes):
    shared = next(t for i, t in cases if i == 60)
    items = [
        (1, shared[40:300].upper()), (2, "never seen words at all"), (3, None), (4, "-- !!"), (5, "one"), (6, "two, words!"),
        (None, shared[200:420]), (1, shared[40:300]), (7, "x " * 12), (8, "日本語 テスト 日本語"), (90, "zz " + shared[100:160]),
    ]
    bench = spark.createDataFrame([(i, t, "k", 1) for i, t in items], "item_id long, text string, marks string, doc_id long")
    found = decontam.find_items(table(spark, cases), bench, 10, block_bytes=block_bytes).collect()
    expected = plain_hits(cases, items, 10)
    assert len(found) == len(cases)
    for r in found:
        spans = [(s.start, s.end) for s in r.spans]
        assert (r.n_words, sum(b - a for a, b in spans), r["items"]) == expected[r.doc_id], r.doc_id
    assert expected[61][1] > 0 and expected[83][1] == 1 and expected[80] == (0, 0, [])


def test_no_items_hit_nothing(spark, cases):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontam.find_items(table(spark, cases), none).collect()
    assert len(found) == len(cases) and not any(r.spans for r in found)


# Empty tables


def test_empty_tables_give_empty_tables(spark, vocabulary):
    none = table(spark, [])
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for frame in (
        simhash.near_duplicates(none), suffixdedup.deduplicate(none), phrasededup.deduplicate(none), bpe.encode_documents(none, vocabulary),
        ordermin.edited_fingerprints(none), ordermin.fingerprints(none), decontam.find_items(none, items),
    ):
        assert frame.isEmpty()




def test_repeated_strings_stage_keeps_clashing_columns(spark):
    passage = "a passage that is long enough to be a repeated string of its own, word by word, until it has a hundred bytes "
    rows = [(1, "x " + passage, "s", [1]), (2, "y " + passage, None, None), (3, None, "t", [2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _spans string, id array<int>")
    got = sorted(map(tuple, suffixdedup.cleaned(docs, 100).collect()))
    assert [(r[0], r[2], r[3]) for r in got] == [(1, "s", [1]), (2, None, None), (3, "t", [2])]
    assert got[0][1] == rows[0][1] and len(got[1][1]) < 10 and got[2][1] is None
