"""Byte-pair encoding with a public vocabulary: texts to token ids and back.

``bpe_encode`` adds each text's ids, ``bpe_decode`` the text of a column of ids; both are
Arrow functions in tasks, without a shuffle.  The vocabulary is a ``tokenizers`` JSON file
with word ends (byte-level symbols, NFC, lower case, white space dropped), whose path is a
parameter.  It is of a fixed size, is read once on the driver and broadcast.

Words are held as rows of contiguous arrays: their parts and the merge ranks of adjacent
parts.  In each row the least rank (the leftmost of equals) is found by a scan, the boundary
there deleted, and the ranks on both sides refreshed, until no pair has a rank; numpy does a
step for all new words of some texts at once.  Words of more than ``SHORT_WORD`` bytes take
the same merges in the same order from a heap, since a scan per merge is quadratic.  Texts
are whole; encoded words are kept, and dropped when there are more than ``KEPT_WORDS``.

Rows: a null text is an empty one (no ids); ids or decoded texts of equal rows are equal;
an empty table gives an empty table; every other column stays, and a clash of names
lengthens the added column's name (see ``added_column``).  Decoding joins the tokens'
symbols by single blanks, as a vocabulary file without a decoder prescribes; null ids
decode to an empty text, an id outside the vocabulary is an error.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import fresh, q

#: Words of more bytes are merged by a heap instead of scans.
SHORT_WORD = 128
#: Encoded words kept in a Python worker, and the characters of texts encoded together.
KEPT_WORDS, TOGETHER = 1 << 18, 1 << 20
#: Largest vocabulary file that is broadcast.
LARGEST_FILE = 64 << 20

# Code points that the vocabulary's letter and number classes (Unicode 16) don't know yet.
LATER = (
    "\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    "\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2\U00016ff3"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    "\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    "\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5"
    "\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e"
    "\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
# Lower-case forms newer than Python's tables.
LATER_LOWER = {
    "\u1c89": "\u1c8a", "\ua7cb": "\u0264", "\ua7cc": "\ua7cd", "\ua7ce": "\ua7cf", "\ua7d2": "\ua7d3",
    "\ua7d4": "\ua7d5", "\ua7da": "\ua7db", "\ua7dc": "\u019b",
    **{chr(c): chr(c + 0x20) for c in range(0x10D50, 0x10D66)},
    **{chr(c): chr(c + 0x1B) for c in range(0x16EA0, 0x16EB9)},
}


def byte_symbols() -> list[str]:
    """The symbol of each byte: printable Latin-1 as itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Numbers(dict):
    """Words by the number in which they came; ``new`` holds those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Vocabulary:
    """Merge ranks and ids of a vocabulary file (its JSON text)."""

    def __init__(self, content: str):
        import regex

        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE vocabulary with an end of word suffix is needed")
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        keys = np.array([self.ids[left] * len(self.ids) + self.ids[right] for left, right in pairs], dtype=np.int64)
        self._rank_order = np.argsort(keys, kind="stable")
        self._pair_keys = keys[self._rank_order]
        self._merged = np.array([self.ids[left + right] for left, right in pairs], dtype=np.int64)
        self._inner, self._last = (
            np.array([self.ids[x + end] for x in byte_symbols()], dtype=np.int64) for end in ("", self.suffix)
        )
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.tokens: list[str | None] = [None] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        known = rf"[{LATER}]"
        self._pieces = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--{known}]+|[\p{{N}}--{known}]|[^\s[\p{{L}}\p{{N}}--{known}]]+", regex.V1
        )
        # the same for texts of ASCII letters only; there \s is the six blanks
        self._ascii_pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
        self._later_lower = regex.compile("[" + "".join(LATER_LOWER) + "]")
        self._forget()

    def _forget(self) -> None:
        self._kept = _Numbers()  # words by number
        self._ends = np.zeros(1, np.int64)  # where each word's ids end in
        self._word_ids = np.zeros(0, np.int32)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Token ids of whole texts; special tokens in them are one id each."""
        out, waiting, size = [], [], 0
        for text in texts:
            waiting.append(text or "")
            size += len(waiting[-1])
            if size >= TOGETHER:
                out += self._encode_some(waiting)
                waiting, size = [], 0
        return out + self._encode_some(waiting)

    def _encode_some(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._kept) > KEPT_WORDS:
            self._forget()
        number = self._kept.__getitem__
        words = [np.fromiter(map(number, self._words(t)), dtype=np.int64) for t in texts]
        if self._kept.new:
            ids, counts = self._encode_words(self._kept.new)
            self._kept.new = []
            self._word_ids = np.concatenate([self._word_ids, ids.astype(np.int32)])
            self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(counts)])
        out = []
        for w in words:
            first, counts = self._ends[w], self._ends[w + 1] - self._ends[w]
            upto = np.cumsum(counts)
            places = np.arange(upto[-1] if len(w) else 0) + np.repeat(first - (upto - counts), counts)
            out.append(self._word_ids[places])
        return out

    def _words(self, text: str) -> list[str]:
        """A text's words, normalised (white space is in none), and special tokens, marked by a leading blank."""
        if not self._special or not self._special.search(text):
            return self._plain_words(text)
        out = []
        for i, part in enumerate(self._special.split(text)):
            out += [" " + part] if i % 2 else self._plain_words(part)  # the split's group is a special token
        return out

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return self._ascii_pieces.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a sigma has no final form here
        if self._later_lower.search(text):
            text = text.translate({ord(c): x for c, x in LATER_LOWER.items()})
        return self._pieces.findall(text.lower())

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one behind the other, and how many each has."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(x) for x in raw])
        found: list = [None] * len(words)
        short = []
        for i, (word, size) in enumerate(zip(words, sizes.tolist())):
            if word[0] == " ":
                found[i] = np.array([self.special[word[1:]]])
            elif size > SHORT_WORD:
                found[i] = self.merged_by_heap(raw[i])
            else:
                short.append(i)
        short.sort(key=lambda i: len(raw[i]))
        while short:  # words of similar length, so that rows are not much longer than words
            width = max(8, 2 * len(raw[short[0]]))
            block = [i for i in short if len(raw[i]) <= width]
            short = short[len(block) :]
            for i, ids in zip(block, self.merged([raw[i] for i in block])):
                found[i] = ids
        return np.concatenate(found), np.array([len(x) for x in found])

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of parts; ``len(self.ranks)`` where they have none (-1 is no part)."""
        keys = left * len(self.ids) + right
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        known = (left >= 0) & (right >= 0) & (self._pair_keys[at] == keys)
        return np.where(known, self._rank_order[at], len(self.ranks))

    def merged(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of some words after all merges, by scans of each row for the least adjacent rank."""
        sizes = np.array([len(w) for w in words])
        width, none = int(sizes.max()), len(self.ranks)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        inside = np.arange(width) < sizes[:, None]
        parts = np.full((len(words), width), -1, dtype=np.int64)
        parts[inside] = self._inner[flat]
        ends = np.cumsum(sizes) - 1
        parts[np.arange(len(words)), sizes - 1] = self._last[flat[ends]]
        ranks = np.full((len(words), width), none, dtype=np.int64)  # of each part and the next
        ranks[:, :-1] = self._ranks_of(parts[:, :-1], parts[:, 1:])
        done, rows = parts.copy(), np.arange(len(words))
        while True:
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            more = least < none
            done[rows[~more], : parts.shape[1]] = parts[~more]
            done[rows[~more], parts.shape[1] :] = -1
            if not more.any():
                break
            rows, parts, ranks, at, least = rows[more], parts[more], ranks[more], at[more], least[more]
            row = np.arange(len(rows))
            parts[row, at] = self._merged[least]
            # every row loses a boundary, so all are one part narrower
            columns = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            padded = np.pad(parts, ((0, 0), (1, 1)), constant_values=-1)
            ranks[row, at] = self._ranks_of(parts[row, at], padded[row, at + 2])
            before = self._ranks_of(padded[row, at], parts[row, at])
            ranks[row[at > 0], at[at > 0] - 1] = before[at > 0]
        return [ids[ids >= 0] for ids in done]

    def merged_by_heap(self, word: bytes) -> np.ndarray:
        """The same ids for a long word: pairs wait in a heap by rank, then place."""
        n = len(word)
        part = [int(self._inner[x]) for x in word[:-1]] + [int(self._last[word[-1]])]
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap: list[tuple] = []

        def offer(a: int) -> None:
            b = after[a]
            if b >= 0:
                rank = self.ranks.get((self.tokens[part[a]], self.tokens[part[b]]))
                if rank is not None:
                    heapq.heappush(heap, (rank, a, part[a], part[b]))

        for a in range(n):
            offer(a)
        while heap:
            rank, a, left, right = heapq.heappop(heap)
            b = after[a]
            if part[a] != left or b < 0 or part[b] != right:  # a part of this pair has been merged since
                continue
            part[a], part[b] = int(self._merged[rank]), -1
            after[a] = after[b]
            if after[a] >= 0:
                before[after[a]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return np.array([x for x in part if x >= 0])

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' symbols, joined by blanks (special tokens as they are)."""
        return " ".join(self.tokens[i] for i in ids)


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(content) -> Vocabulary:
    """The broadcast vocabulary, parsed once in a Python worker."""
    key = content.bid if hasattr(content, "bid") else id(content)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(content.value)
    return _LOADED[key]


def load_vocabulary(path: str) -> str:
    """The file's content; a file of more than ``LARGEST_FILE`` bytes is an error."""
    if os.path.getsize(path) > LARGEST_FILE:
        raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


def added_column(df: DataFrame, name: str) -> str:
    """The name under which ``bpe_encode`` / ``bpe_decode`` add their column to ``df``."""
    return fresh(df, name)[0]


def bpe_encode(df: DataFrame, vocabulary: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` and each text's token ids (``array<int>``) by the vocabulary file ``vocabulary``."""
    spark = df.sparkSession
    ship_package(spark)
    content = spark.sparkContext.broadcast(load_vocabulary(vocabulary))

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        vocab = _vocabulary(content)
        ids = vocab.encode_all(t.as_py() for t in texts)
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    # as if not deterministic: Spark would otherwise run it once for each use of its result
    return df.withColumn(added_column(df, out), encode.asNondeterministic()(q(text_col)))


def bpe_decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` and the text of each array of token ids."""
    spark = df.sparkSession
    ship_package(spark)
    content = spark.sparkContext.broadcast(load_vocabulary(vocabulary))

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        tokens = pa.array(_vocabulary(content).tokens, pa.string())
        lists = pc.fill_null(lists, pa.scalar([], lists.type))
        offsets = pc.subtract(lists.offsets, lists.offsets[0])
        words = pa.ListArray.from_arrays(offsets, tokens.take(lists.flatten()))
        return pc.binary_join(words, " ")

    return df.withColumn(added_column(df, out), decode(q(ids_col)))
