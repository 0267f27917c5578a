"""Toxicity score: a weighted lexicon matched by Aho-Corasick in folded text.

Texts and lexicon are folded alike: compatibility forms (full-width, mathematical
letters) by NFKC, lower case, look-alike letters of other scripts to Latin, digits
and signs that stand for letters to those letters (``1``, ``l``, ``!`` and ``|`` all
become ``i``).  An entry matches as a whole word or, if so marked, as the beginning
of a word; entries inside an exception phrase don't count.

The lexicon is a fixed list of insults plus entries learned from labelled rows:
words and word beginnings that mark texts labelled toxic.  A text's score is a
logistic function of the summed weights, of the heaviest entry and of the sum
normalised by length, fitted on the same rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .common import bounded_labelled_ids, one_text_per_id, q

# Insults with no harmless everyday sense, English.
INSULTS = ["idiot", "moron", "imbecile", "scum", "stupid", "pathetic", "worthless", "disgusting", "loser"]

# Phrases in which a lexicon word is harmless.
EXCEPTIONS = [
    "trash can", "trash bin", "trash collection", "clown fish", "circus clown", "class clown",
    "pond scum", "sore loser", "stupid mistake", "worthless check",
]

# Letters of other scripts that look like a Latin letter.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "х": "x", "ԛ": "q", "ԝ": "w", "н": "h", "г": "r",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "m", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ս": "u", "օ": "o", "ո": "n",
}

# Digits and signs that stand for letters; l shares i's, so l itself is folded to i.
STAND_INS = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGN_STAND_INS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "+": "t"}

_FOLD = str.maketrans({**LOOK_ALIKES, **STAND_INS})
_SIGN = re.compile(r"(?<=[^\W_])[" + re.escape("".join(SIGN_STAND_INS)) + r"](?=[^\W_])|(?<!\S)[@$](?=[^\W\d_])")
_HIDDEN = re.compile("[­​-‏⁠﻿]")  # zero-width characters inside words
_TOKEN = re.compile(r"[^\W_]+")

PREFIX_LENGTHS = (3, 4, 5, 6, 7, 8)


def fold(text: str | None) -> str:
    if not text:
        return ""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    text = text.lower()
    if any(s in text for s in SIGN_STAND_INS):
        text = _SIGN.sub(lambda m: SIGN_STAND_INS[m[0]], text)
    return text.translate(_FOLD)


@dataclass
class Lexicon:
    """Entries (folded) with weights; ``*`` at an entry's end: any word that begins so."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=lambda: list(EXCEPTIONS))

    def __post_init__(self):
        self._build()

    def _build(self):
        self.machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            begins = entry.endswith("*")
            word = fold(entry.rstrip("*"))
            if word:
                old = self.machine.get(word, (0, 0.0, 0.0, False))
                self.machine.add_word(word, (len(word), max(old[1], 0 if begins else weight), max(old[2], weight if begins else 0), False))
        for phrase in self.exceptions:
            word = fold(phrase)
            if word and word not in self.machine:
                self.machine.add_word(word, (len(word), 0.0, 0.0, True))
        if len(self.machine):
            self.machine.make_automaton()

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._build()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Spans of matched entries with their weights, outside exception phrases; one for each word."""
        if not len(self.machine):
            return []
        found: dict[int, tuple[int, float]] = {}
        harmless = []
        size = len(folded)
        for end, (length, whole, begins, exception) in self.machine.iter(folded):
            start, end = end - length + 1, end + 1
            if start and folded[start - 1].isalnum():
                continue
            closed = end == size or not folded[end].isalnum()
            if exception:
                if closed:
                    harmless.append((start, end))
                continue
            weight = max(begins, whole if closed else 0.0)
            if weight > found.get(start, (0, 0.0))[1]:
                found[start] = (end, weight)
        return [
            (a, b, w) for a, (b, w) in sorted(found.items()) if not any(x <= a and b <= y for x, y in harmless)
        ]


def features(lexicon: Lexicon, text: str | None) -> tuple[float, float, float]:
    """(log of the summed weights, heaviest entry, summed weights per 100 words): zero for a text without a hit."""
    folded = fold(text)
    found = lexicon.hits(folded)
    if not found:
        return 0.0, 0.0, 0.0
    total = sum(w for _, _, w in found)
    words = len(folded.split())
    return float(np.log1p(total)), max(w for _, _, w in found), float(np.log1p(100 * total / words))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    coefficients: np.ndarray  # bias, then one per feature

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(self.lexicon, t) for t in texts], dtype=float).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(self.coefficients[0] + x @ self.coefficients[1:], -30, 30)))


def marker_counts(sample: DataFrame) -> DataFrame:
    """``(token, toxic, clean)``: texts of ``sample(_text, _y)`` with each word and word beginning (``*``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: Counter) -> pa.RecordBatch:
            keys = list({t for t, _ in counts})
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string())] + [pa.array([counts[t, y] for t in keys], pa.int64()) for y in (1, 0)],
                ["token", "toxic", "clean"],
            )

        counts: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1), strict=True):
                words = set(_TOKEN.findall(fold(text.as_py())))
                tokens = words | {w[:k] + "*" for k in PREFIX_LENGTHS for w in words if len(w) > k}
                for token in tokens:
                    counts[token, y.as_py()] += 1
            if len(counts) > 500_000:
                yield out(counts)
                counts = Counter()
        yield out(counts)

    parts = sample.select("_text", "_y").mapInArrow(count, "token string, toxic long, clean long")
    return parts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_entries(
    presence: list[tuple[int, frozenset[int]]], tokens: list[str], min_texts: int, min_odds: float
) -> dict[str, float]:
    """Markers with weights, by covering: the token of the largest log-likelihood ratio first.

    ``presence``: each sampled text's label and the candidate tokens in it.  A token
    must mark ``min_texts`` toxic texts that no chosen one marks yet, with odds of
    ``min_odds`` against the sample's; so the many rare words of one toxic text, or a
    longer beginning of a chosen one, add nothing.
    """
    labels = np.array([y for y, _ in presence], dtype=bool)
    total = np.array([labels.sum(), (~labels).sum()], dtype=float) + 1
    open_ = np.ones(len(presence), dtype=bool)
    rows: dict[int, list[int]] = {}
    for row, (_, held) in enumerate(presence):
        for token in held:
            rows.setdefault(token, []).append(row)
    held_by = {t: np.array(r) for t, r in rows.items()}
    chosen: dict[str, float] = {}
    while held_by:
        best, gain = None, 0.0
        for token, r in held_by.items():
            left = r[open_[r]]
            toxic = int(labels[left].sum())
            clean = int((~labels[r]).sum())
            if toxic < min_texts or (toxic + 0.5) / total[0] < min_odds * (clean + 0.5) / total[1]:
                continue
            value = toxic * np.log(((toxic + 0.5) / total[0]) / ((clean + 0.5) / total[1]))
            # of equals the shorter, then the first by code point
            if value > gain or (value == gain and best is not None and (len(tokens[token]), tokens[token]) < (len(tokens[best]), tokens[best])):
                best, gain = token, value
        if best is None:
            break
        r = held_by.pop(best)
        toxic, clean = int(labels[r].sum()), int((~labels[r]).sum())
        chosen[tokens[best]] = float(np.log(((toxic + 0.5) / total[0]) / ((clean + 0.5) / total[1])))
        open_[r] = False
    return chosen


def logistic_fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method: bias, then coefficients."""
    x = np.c_[np.ones(len(x)), x]
    beta = np.zeros(x.shape[1])
    ridge = np.diag([0.0] + [penalty * max(1, len(x))] * (x.shape[1] - 1)) / 100
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge @ beta
        hessian = (x.T * (p * (1 - p) + 1e-6)) @ x + ridge
        move = np.linalg.solve(hessian + 1e-9 * np.eye(len(beta)), gradient)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    is_held_out,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 12_000,
    max_candidates: int = 4_000,
    min_texts: int = 6,
    min_odds: float = 20.0,
) -> ToxicityModel:
    """Lexicon and score function from at most ``sample_rows`` labelled rows outside the held-out fold.

    The bound makes everything that reaches the driver bounded: the sampled ids, the
    ``max_candidates`` strongest tokens and, of each sampled text, which of them it
    holds.  Rows that share an id count as one (the text of least hash), and so do
    near-copies among the sampled texts (equal least shingle hash); null ids have no label.
    Without labelled rows, or with one class only, the fixed insults score alone.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    ids = bounded_labelled_ids(labels, id_col, label_col, is_held_out, sample_rows)
    texts = one_text_per_id(docs, ids, id_col, text_col).withColumn("_key", _least_shingle(F.col("_text")))
    # of near-copies the one of least label and text hash, whatever the partitioning
    first = F.min_by(F.struct("_text", "_y"), F.struct("_y", F.xxhash64("_text"), "_text")).alias("first")
    sample = scratch.save(texts.groupBy("_key").agg(first).select("first._text", "first._y"), "sample")
    share = sample.agg(F.avg("_y")).first()[0]
    weights = {word: 4.0 for word in INSULTS}
    if share is None or share in (0.0, 1.0):
        scratch.drop(sample)
        return ToxicityModel(Lexicon(weights), np.array([-3.0, 1.0, 1.0, 0.0]))
    odds = share / (1 - share)
    marked = marker_counts(sample).where(F.col("toxic") >= min_texts)
    ranked = marked.where((F.col("toxic") + 0.5) >= F.lit(min_odds * odds) * (F.col("clean") + 0.5)).orderBy(
        (F.col("toxic") * F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5) / odds)).desc(), F.length("token"), "token"
    )
    tokens = [r["token"] for r in ranked.limit(max_candidates).select("token").collect()]
    learned = choose_entries(_presence(sample, tokens), tokens, min_texts, min_odds) if tokens else {}
    lexicon = Lexicon({**weights, **learned})
    table = _sample_features(sample, lexicon)
    scratch.drop(sample)
    return ToxicityModel(lexicon, logistic_fit(table[:, :3], table[:, 3]))


def _least_shingle(text):
    """Least hash of the text's runs of eight words: near-copies mostly share it, other texts don't."""

    @F.arrow_udf("long")
    def least(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for text in batch:
                words = (text.as_py() or "").lower().split()
                runs = (" ".join(words[i : i + 8]) for i in range(max(1, len(words) - 7)))
                out.append(min(map(xxhash.xxh64_intdigest, runs)) >> 1)
            yield pa.array(out, pa.int64())

    return least(text)


def _presence(sample: DataFrame, tokens: list[str]) -> list[tuple[int, frozenset[int]]]:
    number = {t: i for i, t in enumerate(tokens)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0):
                words = set(_TOKEN.findall(fold(text.as_py())))
                found = {number[w] for w in words if w in number}
                found |= {number[t] for k in PREFIX_LENGTHS for w in words if len(w) > k and (t := w[:k] + "*") in number}
                rows.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int32()), pa.array(rows, pa.list_(pa.int32()))], ["y", "held"]
            )

    found = sample.select("_text", "_y").mapInArrow(held, "y int, held array<int>").collect()
    return [(r["y"], frozenset(r["held"])) for r in found]


def _sample_features(sample: DataFrame, lexicon: Lexicon) -> np.ndarray:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(lexicon, t.as_py()) for t in batch.column(0)], dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(x[:, 2]), batch.column(1).cast(pa.float64())],
                ["a", "b", "c", "y"],
            )

    rows = sample.select("_text", "_y").mapInArrow(compute, "a double, b double, c double, y double").collect()
    return np.array([tuple(r) for r in rows], dtype=float).reshape(-1, 4)


def toxicity_score(text, model: ToxicityModel):
    """Column: the text's score, from 0 to 1; null and empty texts score as texts without a hit."""

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(model.scores([t.as_py() for t in batch]))

    return scores(text)
