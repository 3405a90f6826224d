"""Byte-pair encoding and decoding with a public vocabulary file.

Words are merged on a segment tree with 16 children a node. Leaf i holds the rank of the pair that starts at
symbol i, packed with i, so the root is the lowest rank and, among equal ranks, the leftmost pair. A merge changes
at most three leaves, each in logarithmic time, until the root says that no pair can be merged; a word of n bytes
takes O(n log n), however long it is.

Defined cases: NULL text is empty; an empty text has no ids and decodes to an empty text; repeated rows give
repeated rows; an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from segmentry.llm.common import as_text, map_texts, picked

#: Pieces and words whose ids a task remembers; the memory is emptied when it is full, long ones are never kept.
CACHE_PIECES = 600_000
CACHE_LENGTH = 40
_CONTROLS = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")
_NEVER = 1 << 62
#: Children of a node of the segment tree; one call of min() then handles a node.
_SHIFT = 4
_WIDTH = 1 << _SHIFT


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where printable, else the next free code point."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(spare)) for b in range(256)}


def latin_pattern(pattern: str) -> str:
    """The pattern with its Unicode classes written out for Latin-1, for Python's own engine."""
    latin = [chr(i) for i in range(256)]
    spaces = [x for x in latin if x.isspace() and x not in "\x1c\x1d\x1e\x1f"]
    for name, members in ("\\p{L}", filter(str.isalpha, latin)), ("\\p{N}", filter(str.isnumeric, latin)), ("\\s", spaces):
        pattern = pattern.replace(name, "".join(map(re.escape, members)))
    return pattern


def merge_word(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """Merge the pairs of one word, lowest rank first, leftmost first.

    `ranks` has the rank of each pair under `left << 32 | right`, `merged` the symbol that a rank makes.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    leaves = [_NEVER] * n
    rank_of = ranks.get
    left = symbols[0]
    for i in range(n - 1):
        right = symbols[i + 1]
        if (rank := rank_of(left << 32 | right)) is not None:
            leaves[i] = rank << 32 | i
        left = right
    levels = [leaves]
    while len(level := levels[-1]) > _WIDTH:
        levels.append([min(level[k : k + _WIDTH]) for k in range(0, len(level), _WIDTH)])
    top, uppers = levels[-1], levels[1:]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (root := min(top)) != _NEVER:
        i = root & 0xFFFFFFFF
        j = after[i]
        k = after[i] = after[j]
        symbols[i] = new = merged[root >> 32]
        symbols[j] = -1
        leaves[i] = leaves[j] = _NEVER
        if k < n:
            before[k] = i
            if (rank := rank_of(new << 32 | symbols[k])) is not None:
                leaves[i] = rank << 32 | i
        if (p := before[i]) >= 0:
            rank = rank_of(symbols[p] << 32 | new)
            leaves[p] = _NEVER if rank is None else rank << 32 | p
        if uppers:
            for at in (i, j) if p < 0 else (i, j, p):
                below = leaves
                for level in uppers:
                    at >>= _SHIFT
                    lowest = min(below[at << _SHIFT : (at + 1) << _SHIFT])
                    if level[at] == lowest:
                        break
                    level[at] = lowest
                    below = level
    return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder of a BPE file with byte letters, a word-end suffix and dropped white space.

    Texts are cut at white space, which no token crosses. Pieces within Latin-1 are lower-cased and split by the
    pattern of the file; other pieces use the normalizer and the splitter of the file's library, whose Unicode
    tables then count. All merging is done here.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        self.ranks, self.merged = {}, []
        for rank, (a, b) in enumerate(map(tuple, model["merges"])):
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        letters = byte_letters()
        self.byte_of = {x: b for b, x in letters.items()}
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.last = [vocab[letters[b] + suffix] for b in range(256)]
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.latin_words = re.compile(latin_pattern(pattern)).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.known: dict[str | bytes, list[int]] = {}

    def words(self, piece: str) -> list[bytes]:
        """The words of a piece without special tokens."""
        if not piece.isascii():
            try:
                piece.encode("latin-1")
            except UnicodeEncodeError:
                return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.split(self.normalize(piece))]
        return [w.encode() for w in self.latin_words(piece.lower())]

    def word(self, word: bytes) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            inner = self.inner
            symbols = [inner[b] for b in word]
            symbols[-1] = self.last[word[-1]]
            ids = self.remember(word, merge_word(symbols, self.ranks, self.merged))
        return ids

    def remember(self, key: str | bytes, ids: list[int]) -> list[int]:
        if len(key) <= CACHE_LENGTH:
            if len(self.known) >= CACHE_PIECES:
                self.known.clear()
            self.known[key] = ids
        return ids

    def piece(self, piece: str) -> list[int]:
        """Ids of text without white space."""
        if "<" not in piece or not self.cut:
            parts = [piece]
        else:
            parts = self.cut(piece)
        ids: list[int] = []
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
            else:
                for word in self.words(part):
                    ids += self.word(word)
        return self.remember(piece, ids)

    def encode(self, text: str) -> list[int]:
        # str.split also cuts at four control characters that are no white space for the file's pattern.
        parts = text.split() if text.isprintable() or not _CONTROLS.search(text) else _SPACE.split(text)
        known, ids = self.known.get, []
        for part in parts:
            found = known(part)
            ids += self.piece(part) if found is None else found
        return ids

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder, so tokens are joined by a space; unknown ids are left out."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id`, `ids` (array of int) and `decoded` (the text that the ids decode to). `path` is on every executor."""

    def start():
        codec = Codec(path)

        def work(batch):
            ids = [codec.encode(t) for t in as_text(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(x) for x in ids])],
                ["doc_id", "ids", "decoded"],
            )

        return work

    return map_texts(picked(docs, id_column, text_column), "doc_id long, ids array<int>, decoded string", start)


def encoding_digests(encoded: DataFrame) -> DataFrame:
    """Count of the ids and digests of ids and decoded text, from the output of `encode_documents`."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
