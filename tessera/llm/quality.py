"""Quality classifier: random-indexing word vectors, pooled, then a two-layer network in numpy.

* Tokens: lower-cased words, runs of punctuation, and marks for what lower-casing and
  tokenising lose (a capitalised word, a word wholly in capitals, a word that repeats
  the one before, the end of a line).
* Every token has a sparse ternary index vector drawn from a hash of the token; a
  token's word vector is the sum of the index vectors around it, over the sampled
  corpus, scaled to unit length.  Tokens not met there keep their index vector.
* A text is the mean of its tokens' word vectors, the mean of its tokens' index
  vectors for marks and punctuation, and its log length.
* The network (tanh layer, logistic output) is trained on a part of the sample;
  the rest sets the temperature that divides its logit, by least log loss.

Everything learned comes from at most ``sample_rows`` labelled rows outside the
held-out fold.  Scoring reads every text whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .common import bounded_labelled_ids, one_text_per_id, q

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|\n")
CAPITALS, CAPITAL, REPEAT, LINE = "<capitals>", "<capital>", "<repeat>", "<line>"
MARKS = (CAPITALS, CAPITAL, REPEAT, LINE)
NONZERO = 8
PIECE = 1 << 16  # tokens pooled at a time
SAMPLE_PARTS = 12
ROWS_TOGETHER = 1000  # word vectors in one row of the sums


def tokens(text: str | None) -> tuple[list[str], Counter]:
    """Lower-cased tokens of the text, and how often each mark applies."""
    raw = TOKEN.findall(text) if text else []
    low = [t.lower() for t in raw]
    marks = Counter()
    marks[CAPITALS] = sum(len(t) > 1 and t.isupper() for t in raw)
    marks[CAPITAL] = sum(t[0].isupper() for t in raw) - marks[CAPITALS]
    marks[REPEAT] = sum(a == b for a, b in zip(low, low[1:], strict=False))
    marks[LINE] = raw.count("\n")
    return low, marks


def index_vector(token: str, size: int) -> np.ndarray:
    """Ternary vector with ``NONZERO`` entries, from a hash of the token; the same everywhere."""
    rng = np.random.default_rng(xxhash.xxh64_intdigest(token.encode(), 0))
    out = np.zeros(size, dtype=np.float32)
    out[rng.choice(size, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out / np.sqrt(NONZERO)


@dataclass
class WordVectors:
    """Vectors of the vocabulary's tokens; any other token falls back to one of ``buckets`` index vectors."""

    size: int
    row_of: dict[str, int]
    matrix: np.ndarray
    buckets: int = 4096
    _fallback: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_fallback": None}

    @property
    def table(self) -> np.ndarray:
        if self._fallback is None:
            other = [index_vector(f"<bucket {i}>", self.size) for i in range(self.buckets)]
            self._fallback = np.vstack([self.matrix, np.array(other, dtype=np.float32)])
        return self._fallback

    def rows(self, words: list[str]) -> np.ndarray:
        get, first, n = self.row_of.get, len(self.matrix), self.buckets
        digest = xxhash.xxh64_intdigest
        return np.array([r if (r := get(w)) is not None else first + digest(w) % n for w in words], dtype=np.int64)

    def pooled(self, text: str | None) -> np.ndarray:
        """The text's features."""
        words, marks = tokens(text)
        n = max(1, len(words))
        total = np.zeros(self.size)
        for i in range(0, len(words), PIECE):
            count = np.bincount(rows := self.rows(words[i : i + PIECE]))
            used = np.unique(rows)
            total += count[used] @ self.table[used]
        signs = sum(not w[0].isalnum() for w in words)
        distinct = len(set(words)) / n
        share = [marks[m] / n for m in MARKS]
        return np.r_[total / n, share, signs / n, distinct, np.log1p(len(words)) / 5]


def learn_vectors(texts: DataFrame, size: int, window: int, min_count: int, max_words: int) -> WordVectors:
    """Random indexing over ``texts(_text)``: at most ``max_words`` tokens, the most frequent.

    A task adds up whole-number index vectors for its texts, so the sums don't depend on
    the order; what leaves it is one table of the vocabulary's size, in pieces.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(tokens(text.as_py())[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["w", "n"])

    words = texts.select("_text").mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    top = words.where(F.col("n") >= min_count).orderBy(F.col("n").desc(), "w").limit(max_words)
    row_of = {r["w"]: i for i, r in enumerate(top.select("w").collect())}
    index = np.array([index_vector(w, size) for w in row_of], dtype=np.float32).reshape(-1, size)
    signs = np.vstack([np.sign(index), np.zeros((1, size))]).astype(np.int64)  # last row: not in the vocabulary

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(row_of) + 1, size), dtype=np.int64)
        none = len(row_of)
        for batch in batches:
            ids = [none] * window
            for text in batch.column(0):
                ids += [row_of.get(w, none) for w in tokens(text.as_py())[0]] + [none] * window
                if len(ids) > PIECE:
                    _add_neighbours(total, signs, np.array(ids), window, none)
                    ids = [none] * window
            _add_neighbours(total, signs, np.array(ids), window, none)
        for i in range(0, len(row_of), ROWS_TOGETHER):
            part = total[i : min(i + ROWS_TOGETHER, none)]
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part.tobytes()], pa.binary())], ["first", "v"])

    def add_up(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), dtype=np.int64) for v in parts["v"])
        return pa.table({"first": parts["first"][:1], "v": pa.array([total.tobytes()], pa.binary())})

    matrix = np.zeros((len(row_of), size), dtype=np.float32)
    parts = texts.select("_text").mapInArrow(sums, "first long, v binary")
    for r in parts.groupBy("first").applyInArrow(add_up, "first long, v binary").toLocalIterator():
        part = np.frombuffer(r["v"], dtype=np.int64).reshape(-1, size)
        matrix[r["first"] : r["first"] + len(part)] = part
    # half context, half the token's own index vector: what surrounds a word, and which word it is
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = matrix / np.where(norm > 0, norm, 1) + index
    return WordVectors(size, row_of, matrix.astype(np.float32))


def _add_neighbours(total: np.ndarray, signs: np.ndarray, ids: np.ndarray, window: int, none: int) -> None:
    """Add to each token's row the index vectors of the tokens up to ``window`` places away."""
    for step in range(1, window + 1):
        for at, other in ((ids[:-step], ids[step:]), (ids[step:], ids[:-step])):
            both = (at != none) & (other != none)
            order = np.argsort(at[both], kind="stable")
            rows = at[both][order]
            if len(rows):
                starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                total[rows[starts]] += np.add.reduceat(signs[other[both][order]], starts, axis=0)


@dataclass
class Network:
    """tanh layer, then one logit, divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train_network(
    x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, batch: int = 128, rate: float = 5e-3, decay: float = 1e-4, seed: int = 5
) -> Network:
    """Adam on the log loss; every fifth row is kept from training and sets the temperature."""
    rng = np.random.default_rng(seed)
    kept = np.arange(len(x)) % 5 == 4
    if not (0 < y[kept].sum() < kept.sum()):
        kept[:] = False
    xt, yt = x[~kept], y[~kept]
    scale = xt.std(axis=0)
    net = Network(
        xt.mean(axis=0),
        np.where(scale > 1e-9, scale, 1.0),
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        rng.normal(0, 1 / np.sqrt(hidden), hidden),
        0.0,
    )
    z = (xt - net.mean) / net.scale
    values = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for i in range(0, len(z), batch):
            rows = order[i : i + batch]
            h = np.tanh(z[rows] @ values[0] + values[1])
            p = 1 / (1 + np.exp(-np.clip(h @ values[2] + values[3][0], -30, 30)))
            error = (p - yt[rows]) / len(rows)
            back = np.outer(error, values[2]) * (1 - h**2)
            slopes = [z[rows].T @ back + decay * values[0], back.sum(axis=0), h.T @ error + decay * values[2], np.array([error.sum()])]
            step += 1
            for v, g, m, s in zip(values, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    if kept.any():
        logits, target = net.logits(x[kept]), y[kept]
        loss = lambda t: np.mean(np.logaddexp(0, -np.where(target == 1, 1, -1) * logits / t))
        net.temperature = float(min(np.geomspace(0.25, 8, 101), key=loss))
    return net


@dataclass
class QualityModel:
    vectors: WordVectors | None
    network: Network | None
    prior: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.network is None or not texts:
            return np.full(len(texts), self.prior)
        return self.network.probabilities(np.array([self.vectors.pooled(t) for t in texts]))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    is_held_out,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = 8_000,
    size: int = 64,
    window: int = 2,
    min_count: int = 5,
    max_words: int = 20_000,
) -> QualityModel:
    """The model, from at most ``sample_rows`` labelled rows outside the held-out fold.

    The driver receives the vocabulary, its vectors and one row of features for each
    sampled text, all bounded by the parameters; rows that share an id count as one (the
    text of least hash), null ids have no label.  Without labelled rows every score is
    0.5; with one class only, that class's share.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    ids = bounded_labelled_ids(labels, id_col, label_col, is_held_out, sample_rows)
    texts = one_text_per_id(docs, ids, id_col, text_col).select("_id", "_text", "_y")
    sample = scratch.save(texts.repartition(SAMPLE_PARTS, "_id"), "sample")
    share = sample.agg(F.avg("_y")).first()[0]
    if share is None or share in (0.0, 1.0):
        scratch.drop(sample)
        return QualityModel(None, None, 0.5 if share is None else share)
    vectors = learn_vectors(sample, size, window, min_count, max_words)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [vectors.pooled(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), pa.array(x, pa.list_(pa.float64())), batch.column(2).cast(pa.float64())],
                ["id", "x", "y"],
            )

    pooled = sample.select("_id", "_text", "_y").mapInArrow(pool, "id string, x array<double>, y double").toArrow()
    scratch.drop(sample)
    order = np.argsort(np.array([xxhash.xxh64_intdigest(i) for i in pooled["id"].to_pylist()], dtype=np.uint64), kind="stable")
    x, y = np.array(pooled["x"].to_pylist())[order], pooled["y"].to_numpy()[order]
    return QualityModel(vectors, train_network(x, y), share)


def quality_score(text, model: QualityModel):
    """Column: the probability of label 1; null and empty texts are scored as texts without tokens."""

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(model.scores([t.as_py() for t in batch]))

    return scores(text)
