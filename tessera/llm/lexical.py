"""Ranked lexical search: each item's best documents by an integer term-weight formula.

Terms are the maximal runs of ASCII letters and digits and of all other letters outside
ASCII; only A-Z is lower-cased.  A term weighs ``floor(1000 ln((2N+2)/(2df+1)))``; a
document's score sums, over the item's terms (repeats included), weight times
``(10^9 tf) div (1000 tf + 8m)`` with ``m = 25 + (75 n N) div L``.

Items are handled in blocks of at most ``block_words`` terms, so what goes to the driver
and to the tasks is bounded; a block takes one pass over the documents, which writes each
document's postings for the block's terms (numbers of terms and counts) to the shared
folder.  Document counts and N, L come from that table.  The postings are then searched in
shards of bounded size, each by accumulator-limited term-at-a-time evaluation
(``Shard.best``): an item's terms are taken rarest first; every document met opens an
accumulator until the k-th best partial score exceeds what all terms left could add to a
new document; from then on only open accumulators are updated, exactly, so the k best
scores of the shard are exact.  Shard results are merged by rank, after a limit in each
task.

Rows: a null or empty text has no terms and is never found; ``N`` doesn't count it.  Rows
that repeat an id are documents of their own; ids are whole numbers (others are cast), a null id
ranks behind all others of its score.  Equal scores rank by ascending id.  An item without
terms, or whose terms no document holds, gets no rows; items that repeat an id are
searched each, and both get ranks from 1.  Empty tables give no rows.  Extra columns are
not read.  A very long text is one row of postings, never longer than a block's vocabulary.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .common import q

#: Separators become blanks, A-Z becomes a-z, all other bytes (letters beyond ASCII) stay.
_TO_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return (text or "").encode().translate(_TO_TERMS).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to a document's score."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norms(lengths: list[int], n_docs: int, n_terms: int) -> np.ndarray:
    """``m`` of each document; Python's integers, as the product may pass 64 bits."""
    return np.array([25 + (75 * n * n_docs) // max(n_terms, 1) for n in lengths], dtype=np.int64)


class Shard:
    """An inverted index of some documents: postings by term, in document order."""

    def __init__(self, doc_ids: np.ndarray, no_id: np.ndarray, m: np.ndarray, docs: np.ndarray, terms: np.ndarray, tf: np.ndarray):
        self.doc_ids, self.no_id = doc_ids, no_id
        order = np.argsort(terms, kind="stable")
        self.docs, self.impact = docs[order], impacts(tf[order], m[docs[order]])
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(terms))
        self.highest = np.maximum.reduceat(self.impact, starts) if len(starts) else np.zeros(0, np.int64)

    def best(self, item: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best documents (places in the shard) and their scores.

        ``item`` lists (term, weight times its occurrences), rarest first.
        """
        score = np.zeros(len(self.doc_ids), dtype=np.int64)
        at = np.searchsorted(self.terms, [t for t, _ in item])
        held = [(i, w) for i, (t, w) in zip(at.tolist(), item) if w > 0 and i < len(self.terms) and self.terms[i] == t]
        rest = np.append(np.cumsum([self.highest[i] * w for i, w in reversed(held)])[::-1], 0).astype(np.int64)
        open_ = np.zeros(0, dtype=np.int64)  # documents with an accumulator
        limited = False
        for j, (i, w) in enumerate(held):
            if not limited and len(open_) >= k:
                limited = rest[j] < np.partition(score[open_], -k)[-k]
            docs = self.docs[self.starts[i] : self.starts[i + 1]]
            gain = self.impact[self.starts[i] : self.starts[i + 1]] * w
            if limited:  # no new accumulators
                has = score[docs] > 0
                score[docs[has]] += gain[has]
            else:
                open_ = np.concatenate([open_, docs[(score[docs] == 0) & (gain > 0)]])
                score[docs] += gain
        if not len(open_):
            return open_, score[:0]
        if len(open_) > k:
            open_ = open_[score[open_] >= np.partition(score[open_], -k)[-k]]  # with all ties
        order = np.lexsort((self.doc_ids[open_], self.no_id[open_], -score[open_]))[:k]
        return open_[order], score[open_[order]]


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    """(item id, terms) of all items, in blocks; an item of more terms is a block of its own."""
    rows, size = [], 0
    for item_id, text in items.toLocalIterator():  # a partition of the items at a time
        terms = Counter(terms_of(text))
        if rows and size + len(terms) > block_words:
            yield rows
            rows, size = [], 0
        rows.append((item_id, terms))
        size += len(terms)
    if rows:
        yield rows


def _matches(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Each document's length and its postings for the vocabulary's terms (numbers from 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def match(batches):
        get = shared.value.get
        for batch in batches:
            lengths, terms, counts, ends = [], [], [], [0]
            for text in batch.column(1):
                words = terms_of(text.as_py())
                found, n = np.unique(np.fromiter(filter(None, map(get, words)), dtype=np.int64), return_counts=True)
                lengths.append(len(words))
                terms.append(found)
                counts.append(n)
                ends.append(ends[-1] + len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x or [[]]), t))
                     for x, t in ((terms, pa.int32()), (counts, pa.int64()))]
            columns = [batch.column(0), pa.array(lengths, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(match, "doc_id long, n long, terms array<int>, tf array<long>")


def _searched(matches: DataFrame, items: list[list[tuple[int, int]]], n_docs: int, n_terms: int, k: int, shard_postings: int) -> DataFrame:
    """The best documents of each shard for each item (its number in the block)."""
    shared = matches.sparkSession.sparkContext.broadcast(items)
    names = ["item", "doc_id", "score"]

    def shard_of(batches) -> Shard:
        ids = pa.concat_arrays([b.column(0) for b in batches])
        lengths = [n for b in batches for n in b.column(1).to_pylist()]
        sizes = np.concatenate([b.column(2).value_lengths().to_numpy() for b in batches])
        terms = np.concatenate([b.column(2).flatten().to_numpy() for b in batches])
        tf = np.concatenate([b.column(3).flatten().to_numpy() for b in batches])
        no_id = ids.is_null().to_numpy(zero_copy_only=False)
        docs = np.repeat(np.arange(len(ids)), sizes)
        return Shard(ids.fill_null(0).to_numpy(), no_id, length_norms(lengths, n_docs, n_terms), docs, terms, tf)

    def results(batches):
        shard = shard_of(batches)
        numbers, places, scores = [], [], []
        for number, item in enumerate(shared.value):
            found, score = shard.best(item, k)
            numbers.append(np.full(len(found), number, dtype=np.int64))
            places.append(found)
            scores.append(score)
        places = np.concatenate(places)
        ids = pa.array(shard.doc_ids[places], pa.int64(), mask=shard.no_id[places])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(numbers)), ids, pa.array(np.concatenate(scores))], names)

    def search(batches):
        waiting, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            size += len(batch.column(2).flatten())
            if size >= shard_postings:
                yield results(waiting)
                waiting, size = [], 0
        if waiting:
            yield results(waiting)

    return matches.mapInArrow(search, "item long, doc_id long, score long")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = 200_000,
    shard_postings: int = 4_000_000,
) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item id, rank, id, score."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    texts = docs.select(q(id_col).cast("long").alias("doc_id"), q(text_col).alias("text"))
    wanted = items.select(q(item_col).alias("item_id"), q(item_text_col).alias("text"))
    kind = wanted.schema["item_id"].dataType
    schema = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    out = spark.createDataFrame([], schema)
    for block in _blocks(wanted, block_words):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}), 1)}
        matches = scratch.save(_matches(texts, vocabulary), "postings")
        n_docs, n_terms = matches.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        counted = matches.select(F.explode("terms").alias("term")).groupBy("term").count()
        df = {r["term"]: r["count"] for r in counted.toLocalIterator()}  # at most a block's terms
        weighted = []
        for _, terms in block:
            rarest = sorted((df[i], i, n) for i, n in ((vocabulary[t], n) for t, n in terms.items()) if i in df)
            weighted.append([(i, n * term_weight(n_docs, d)) for d, i, n in rarest])
        found = _searched(matches, weighted, n_docs, n_terms, k, shard_postings)
        ranked = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item long, item_id {kind.simpleString()}")
        best = scratch.save(found.join(names, "item").select("item_id", "rank", "doc_id", "score"), "best")
        scratch.drop(matches)
        out = out.unionByName(best)
    return out
