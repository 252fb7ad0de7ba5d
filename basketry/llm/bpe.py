"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a word's tree hold the rank of each adjacent pair, so the root yields the leftmost
pair of lowest rank; one merge updates three leaves and their paths.  Where many words are of one
size, each is a row of a matrix and all merge at the same time, one merge each per step; few long
ones have a tree each.  A tokenizer file that normalises, splits or decodes in another way is an
error.

Defined results: a null or empty text has no tokens, empty ids and empty decoded text.  Other
columns of the input are ignored; repeated rows give repeated results; ids may be null.
"""

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from basketry import shared
from basketry.llm import words

shared.ship(__name__)

#: Words whose encoding a task remembers; beyond it the memory starts anew.
CACHE_WORDS = 200_000
#: Bytes of text that are worked on together: as words they need some 30 times as much.
_SLICE = 1 << 20
#: Bounds of a tokenizer that may be sent to every task.
MAX_TOKENIZER_MB = 64

_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# The same pieces for texts of Latin characters, where the standard library is faster.
_LATIN_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|[\d\xb2\xb3\xb9\xbc-\xbe]|(?:[^\s\w]|_)+"
)
_NOT_LATIN = re.compile("[\x1c-\x1f\u0250-\U0010ffff]")
_RARE = re.compile("[\u0558-\U0010ffff]")
_NEW_LETTER = regex.compile(r"[\p{L}\p{N}]")
_NONE = np.iinfo(np.int64).max
#: From so many words of one size on they merge as rows of a matrix.
_ROWS = 64
# What this module does with texts, as tokenizer files describe it (fixed values).
_DESCRIBED = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _PIECES.pattern}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "decoder": None,
}
_MODEL = {
    "type": "BPE",
    "dropout": None,
    "unk_token": None,
    "continuing_subword_prefix": None,
    "byte_fallback": False,
    "ignore_merges": False,
}
_ADDED = ("single_word", "lstrip", "rstrip", "normalized")


def _check(described: dict) -> None:
    """Raise where a tokenizer file asks for what this module doesn't do."""
    model = described["model"]
    other = [part for part, wanted in _DESCRIBED.items() if described.get(part) != wanted]
    other += [part for part, wanted in _MODEL.items() if (model.get(part) or None) != (wanted or None)]
    other += ["added_tokens"] if any(token.get(f) for token in described["added_tokens"] for f in _ADDED) else []
    if other:
        raise ValueError(f"not a tokenizer of lower-case words with byte-level pieces: {', '.join(other)}")


def _byte_characters() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Pair ranks and token names of a word-end byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        if len(text) > MAX_TOKENIZER_MB << 20:
            raise ValueError(f"tokenizer files of over {MAX_TOKENIZER_MB} MB aren't broadcast")
        described = json.loads(text)
        _check(described)
        model = described["model"]
        end = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        size = 1 + max([*ids.values(), *self.added.values()])
        self.names = [""] * size
        for name, number in [*ids.items(), *self.added.items()]:
            self.names[number] = name
        shown = _byte_characters()
        self.inner = np.array([ids[c] for c in shown], np.int64)
        self.last = np.array([ids[c + end] for c in shown], np.int64)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]
        left, right, merged = np.array(pairs, np.int64).reshape(-1, 3).T
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        self.merged_list = merged.tolist()
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``_NONE`` where they never merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)


def split_words(text: str, added: dict[str, int]) -> list:
    """Words of a text in order; an added token stands as its id."""
    if added and any(name in text for name in added):
        parts = re.split("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")", text)
        return [
            word
            for part in parts
            for word in ([added[part]] if part in added else split_words(part, {}))
        ]
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    text = text.lower()
    if not _NOT_LATIN.search(text):
        return _LATIN_PIECES.findall(text)
    if _RARE.search(text):
        # Characters newer than the tokenizer's own tables count as symbols there.
        plain = _NEW_LETTER.sub(
            lambda m: "" if unicodedata.category(m[0]) == "Cn" else m[0], text
        )
        return [text[m.start() : m.end()] for m in _PIECES.finditer(plain)]
    return _PIECES.findall(text)


def _merge_all(symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Merge every row to its end; places that were merged away hold -1."""
    count, width = symbols.shape
    ranks = np.full((count, width), _NONE)
    if width > 1:
        inside = np.arange(1, width) < lengths[:, None]
        rows, at = np.nonzero(inside)
        found = vocabulary.rank(symbols[rows, at], symbols[rows, at + 1])
        ranks[rows, at] = np.where(found == _NONE, _NONE, found * width + at)
    tree = np.empty((count, 2 * width), np.int64)
    tree[:, width:] = ranks
    level = width
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half
    following = np.broadcast_to(np.arange(1, width + 2), (count, width + 1)).copy()
    following[np.arange(count), lengths - 1] = width
    before = np.broadcast_to(np.arange(-1, width), (count, width + 1)).copy()

    def put(rows, leaf, value):
        node = leaf + width
        tree[rows, node] = value
        while width > 1 and node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pair_key(rows, left, right):
        found = vocabulary.rank(symbols[rows, left], symbols[rows, right])
        return np.where(found == _NONE, _NONE, found * width + left)

    rows = np.flatnonzero(tree[:, 1] != _NONE)
    while len(rows):
        best = tree[rows, 1]
        at = best % width
        gone = following[rows, at]
        after = following[rows, gone]
        symbols[rows, at] = vocabulary.merged[best // width]
        symbols[rows, gone] = -1
        following[rows, at] = after
        before[rows, after] = at
        put(rows, gone, np.full(len(rows), _NONE))
        last = after >= width
        put(rows, at, np.where(last, _NONE, pair_key(rows, at, np.where(last, at, after))))
        left = before[rows, at]
        has = np.flatnonzero(left >= 0)
        if len(has):
            put(rows[has], left[has], pair_key(rows[has], left[has], at[has]))
        rows = rows[tree[rows, 1] != _NONE]
    return symbols


def _merge_one(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """As ``_merge_all`` for one word: what is left of it."""
    length, ranks, merged = len(symbols), vocabulary.rank_of, vocabulary.merged_list
    width = 1 << max(length - 1, 1).bit_length()
    none = len(merged) * width

    def key(left: int, right: int) -> int:
        rank = ranks.get(symbols[left] << 32 | symbols[right])
        return none if rank is None else rank * width + left

    tree = [none] * width + [key(i, i + 1) for i in range(length - 1)]
    tree += [none] * (2 * width - len(tree))
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(leaf: int, value: int) -> None:
        node = leaf + width
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            value = other if other < value else value
            node >>= 1
            if tree[node] == value:
                return
            tree[node] = value

    following, before = list(range(1, length + 1)), list(range(-1, length))
    while (best := tree[1]) < none:
        rank, at = divmod(best, width)
        gone = following[at]
        after = following[gone]
        symbols[at], symbols[gone] = merged[rank], -1
        following[at], before[after] = after, at
        put(gone, none)
        put(at, key(at, after) if after < length else none)
        if before[at] >= 0:
            put(before[at], key(before[at], at))
    return [s for s in symbols if s >= 0]


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Token ids of each word."""
    lengths = np.array([len(w) for w in words], np.int64)
    widths = 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
    out: list = [None] * len(words)
    for width in np.unique(widths):
        members = np.flatnonzero(widths == width)
        if len(members) < _ROWS:
            for i in members.tolist():
                symbols = vocabulary.inner[np.frombuffer(words[i], np.uint8)].tolist()
                symbols[-1] = int(vocabulary.last[words[i][-1]])
                out[i] = _merge_one(symbols, vocabulary)
            continue
        for start in range(0, len(members), step := max(1, 2_000_000 // int(width))):
            some = members[start : start + step]
            size = lengths[some]
            inside = np.arange(width) < size[:, None]
            values = np.frombuffer(b"".join([words[i] for i in some.tolist()]), np.uint8)
            symbols = np.full(inside.shape, -1, np.int64)
            symbols[inside] = vocabulary.inner[values]
            ends = np.cumsum(size) - 1
            symbols[np.arange(len(some)), size - 1] = vocabulary.last[values[ends]]
            symbols = _merge_all(symbols, size, vocabulary)
            left = symbols >= 0
            flat = symbols[left].tolist()
            begin = 0
            for i, end in zip(some.tolist(), np.cumsum(left.sum(1)).tolist(), strict=True):
                out[i] = flat[begin:end]
                begin = end
    return out


class Encoder:
    """Encodes texts; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.number_texts = [str(i) for i in range(len(vocabulary.names))]
        self.ids: dict = {}
        self.names: dict = {}

    def _learn(self, words: set) -> None:
        names, numbers = self.vocabulary.names, self.number_texts
        plain = [w for w in words if isinstance(w, str)]
        for word in words.difference(plain):
            self.ids[word], self.names[word] = numbers[word], names[word]
        for word, ids in zip(plain, encode_words([w.encode() for w in plain], self.vocabulary), strict=True):
            self.ids[word] = " ".join([numbers[i] for i in ids])
            self.names[word] = " ".join([names[i] for i in ids])

    def texts(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of tokens, ids joined by spaces, decoded text) of each text."""
        if len(self.ids) > CACHE_WORDS:
            self.ids, self.names = {}, {}
        split = [split_words(t, self.vocabulary.added) if t else [] for t in texts]
        self._learn(set().union(*split).difference(self.ids))
        ids_of, names_of = self.ids.__getitem__, self.names.__getitem__
        out = []
        for words in split:
            ids = " ".join(map(ids_of, words))
            out.append((ids.count(" ") + 1 if words else 0, ids, " ".join(map(names_of, words))))
        return out


def encode(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row: ids and names of tokens joined by spaces.

    With ``carry`` the whole input row follows as ``row``.  ``tokenizer`` is a file of the ``tokenizers`` library, with word ends and byte-level pieces.
    It is sent to every task, which its checked size allows.
    """
    spark = docs.sparkSession
    sent = shared.send(spark, Vocabulary(tokenizer))

    def run(batches):
        encoder = Encoder(shared.received(sent))
        for batch in batches:
            for start, end in words.column_slices(batch.column(1), _SLICE):
                done = encoder.texts(batch.column(1).slice(start, end - start).to_pylist())
                made = {
                    "n_tokens": pa.array([d[0] for d in done], pa.int64()),
                    "ids": pa.array([d[1] for d in done], pa.string()),
                    "decoded": pa.array([d[2] for d in done], pa.string()),
                }
                yield words.result(batch, start, end, made)

    own = words.picked(docs, id_col, text_col, carry)
    kind = words.kind_of(own, "doc_id")
    return own.mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids string, decoded string{words.carried(own)}"
    )
