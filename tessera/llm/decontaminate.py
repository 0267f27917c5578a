"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Two passes over the documents, neither of which moves a text between tasks:

1. every task counts in how many of its documents each benchmark n-gram occurs;
   the counts are summed over the corpus.  An item's *rare* n-grams are those whose
   document frequency is at most ``common_df`` plus four times the item's median,
   so at least half of them, whatever the size of the corpus and however often the
   item itself was copied into it;
2. rare n-grams found in a document seed passages around them, and a passage with
   at least ``min_seeds`` different seeds of an item is aligned with the item, word
   by word.  The score is the alignment's share of a perfect match.

The benchmark is handled in blocks of at most ``block_words`` words, so what is
sent to the tasks is bounded whatever its size; each block takes two passes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import fresh, q

WORD = re.compile(r"\w+")
MATCHES = "array<struct<item_id:bigint,score:double,n_seeds:int,start_word:int,end_word:int>>"


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased."""
    return WORD.findall(text.lower()) if text else []


def smith_waterman(item: np.ndarray, passage: np.ndarray, match=2, mismatch=-1, gap=1) -> tuple[int, int, int]:
    """Best local alignment of two id sequences: (score, first, end) with the passage's words [first, end).

    One row per item word; gaps within the passage are a running maximum, so a row
    is a few numpy operations.  ``start`` carries where each cell's alignment began.
    """
    n = len(passage)
    ramp = np.arange(n + 1) * gap
    row, start = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    best, first, end = 0, 0, 0
    for word in item:
        step = np.where(passage == word, match, mismatch)
        diagonal, up = row[:-1] + step, row[1:] - gap
        cell, origin = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
        take = np.maximum(diagonal, up)
        better = take > 0
        cell[1:][better] = take[better]
        origin[1:][better] = np.where(diagonal >= up, start[:-1], start[1:])[better]
        # a gap in the passage: the best cell to the left, less the gap's length
        reach = cell + ramp
        lead = np.maximum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == lead, np.arange(n + 1), 0))
        cell, origin = lead - ramp, origin[source]
        row, start = cell, origin
        at = int(row.argmax())
        if row[at] > best:
            best, first, end = int(row[at]), int(start[at]), at
    return best, first, end


@dataclass
class Block:
    """Benchmark items as word ids, and their n-grams; picklable and of bounded size."""

    n: int
    vocabulary: dict[str, int]
    items: dict[int, np.ndarray]
    grams: np.ndarray  # sorted distinct n-grams, as numbers
    owners: dict[int, list[int]]  # n-gram -> items that have it
    short_lengths: list[int] = field(default_factory=list)  # of items with fewer than n words
    rare: dict[int, set[int]] = field(default_factory=dict)  # item -> its rare n-grams

    @classmethod
    def build(cls, rows: list[tuple[int, str]], n: int) -> Block:
        vocabulary: dict[str, int] = {}
        items = {}
        for item_id, text in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
            if ids:
                items[item_id] = np.array(ids, dtype=np.int64)
        block = cls(n, vocabulary, items, np.empty(0, dtype=np.int64), {})
        for item_id, ids in items.items():
            grams = block.grams_of(ids).tolist() if len(ids) >= n else [block.whole(ids)]
            for gram in set(grams):
                block.owners.setdefault(gram, []).append(item_id)
        block.grams = np.array(sorted(block.owners), dtype=np.int64)
        block.short_lengths = sorted({len(x) for x in items.values() if len(x) < n})
        return block

    def grams_of(self, ids: np.ndarray) -> np.ndarray:
        """The n-gram that starts at each place; -1 where one of its words is no benchmark word.

        Numbers in base |vocabulary| + 1, digits from 1: exact, as a block's size keeps
        them below 2^63.
        """
        out = np.zeros(max(0, len(ids) - self.n + 1), dtype=np.int64)
        known = np.ones(len(out), dtype=bool)
        for k in range(self.n):
            part = ids[k : k + len(out)]
            out = out * (len(self.vocabulary) + 1) + part + 1
            known &= part >= 0
        return np.where(known, out, -1)

    def whole(self, ids: np.ndarray) -> int:
        """The one gram of a sequence shorter than n words: its digits, then zeros."""
        number = 0
        for k in range(self.n):
            number = number * (len(self.vocabulary) + 1) + (int(ids[k]) + 1 if k < len(ids) else 0)
        return number

    def short_hits(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Items shorter than n words, at every place of a document: (gram, place)."""
        found = []
        for length in self.short_lengths:
            for place in range(len(ids) - length + 1):
                part = ids[place : place + length]
                if (part >= 0).all() and (gram := self.whole(part)) in self.owners:
                    found.append((gram, place))
        return found

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Benchmark n-grams in a document: (n-gram, place), by place."""
        grams = self.grams_of(ids)
        places = np.flatnonzero(grams >= 0)
        grams = grams[places]
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            known = self.grams[at] == grams
            grams, places = grams[known], places[known]
        else:
            grams, places = grams[:0], places[:0]
        more = self.short_hits(ids)
        if more:
            grams = np.r_[grams, [g for g, _ in more]]
            places = np.r_[places, [p for _, p in more]]
        return grams, places

    def ids_of(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        found = words_of(text)
        return np.fromiter((get(w, -1) for w in found), dtype=np.int64, count=len(found))

    def matches(self, text: str | None, min_seeds: int, min_score: float) -> list[dict]:
        """The best passage of each item that the text holds a copy of."""
        ids = self.ids_of(text)
        grams, places = self.hits(ids)
        seeds: dict[int, list[tuple[int, int]]] = {}
        for gram, place in zip(grams.tolist(), places.tolist(), strict=True):
            for item in self.owners[gram]:
                if gram in self.rare[item]:
                    seeds.setdefault(item, []).append((place, gram))
        found = []
        for item, hits in sorted(seeds.items()):
            words = self.items[item]
            need = min(min_seeds, len(self.rare[item]))
            best = None
            for low, high, n_seeds in passages(sorted(hits), len(words), self.n):
                if n_seeds < need:
                    continue
                low, high = max(0, low - len(words)), min(len(ids), high + len(words))
                score, first, end = smith_waterman(words, ids[low:high])
                share = score / (2 * len(words))
                if share >= min_score and (best is None or share > best["score"]):
                    best = {
                        "item_id": item,
                        "score": share,
                        "n_seeds": n_seeds,
                        "start_word": low + first,
                        "end_word": low + end,
                    }
            if best:
                found.append(best)
        return found


def passages(hits: list[tuple[int, int]], length: int, n: int) -> Iterator[tuple[int, int, int]]:
    """Stretches of seeds for one item: (first place, end, number of different seeds).

    A stretch covers at most twice the item's length; the next begins at its middle,
    so a copy is never cut by both.
    """
    i = 0
    while i < len(hits):
        begin = hits[i][0]
        j = i
        while j < len(hits) and hits[j][0] < begin + 2 * length:
            j += 1
        yield begin, hits[j - 1][0] + n, len({g for _, g in hits[i:j]})
        if j == len(hits):
            return
        while i < len(hits) and hits[i][0] < begin + length:
            i += 1


def _blocks(benchmark: DataFrame, n: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of bounded size.

    ``toLocalIterator`` holds one partition of the (narrow) benchmark at a time; an
    item longer than a block is a block of its own.
    """
    rows, size = [], 0
    for item_id, text in benchmark.toLocalIterator():
        length = len(words_of(text))
        if rows and size + length > block_words:
            yield Block.build(rows, n)
            rows, size = [], 0
        rows.append((item_id, text))
        size += length
    if rows:
        yield Block.build(rows, n)


def _document_frequency(docs: DataFrame, text_col: str, block: Block) -> dict[int, int]:
    """In how many rows of ``docs`` each of the block's n-grams occurs (n-grams in none are left out)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                grams, _ = block.hits(block.ids_of(text.as_py()))
                seen.update(set(grams.tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["gram", "df"]
        )

    counted = docs.select(q(text_col)).mapInArrow(count, "gram long, df long")
    return {r["gram"]: r["df"] for r in counted.groupBy("gram").agg(F.sum("df").alias("df")).collect()}


def _set_rare(block: Block, df: dict[int, int], common_df: int) -> None:
    own: dict[int, set[int]] = {}
    for gram, items in block.owners.items():
        for item in items:
            own.setdefault(item, set()).add(gram)
    for item, grams in own.items():
        counts = sorted(df.get(g, 0) for g in grams)
        limit = common_df + 4 * counts[len(counts) // 2]
        block.rare[item] = {g for g in grams if df.get(g, 0) <= limit}


def _match_column(text, block: Block, min_seeds: int, min_score: float):
    @F.arrow_udf(MATCHES)
    def matches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(
            pa.struct(
                [
                    ("item_id", pa.int64()),
                    ("score", pa.float64()),
                    ("n_seeds", pa.int32()),
                    ("start_word", pa.int32()),
                    ("end_word", pa.int32()),
                ]
            )
        )
        for batch in texts:
            yield pa.array([block.matches(t.as_py(), min_seeds, min_score) for t in batch], kind)

    return matches(text)


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 3,
    common_df: int = 16,
    min_seeds: int = 2,
    min_score: float = 0.5,
    block_words: int = 1_000_000,
) -> tuple[DataFrame, str]:
    """``docs`` plus an array of the benchmark items found in each text, and that column's name.

    Items with a null id or without words match nothing; of rows that repeat an
    item id, the longest text counts.  Null and wordless texts match nothing.
    """
    if (block_words + 1) ** n >= 2**63:
        raise ValueError("block_words ** n must stay below 2 ** 63")
    ship_package(docs.sparkSession)
    items = benchmark.select(q(item_col).cast("bigint").alias("item_id"), q(item_text_col).alias("text")).where(
        "item_id is not null and text is not null"
    )
    last = Window.partitionBy("item_id").orderBy(F.length("text").desc(), "text")
    items = items.withColumn("rank", F.row_number().over(last)).where("rank = 1").select("item_id", "text")
    (column,) = fresh(docs, "benchmark_matches")
    found = F.array().cast(MATCHES)
    for block in _blocks(items, n, block_words):
        _set_rare(block, _document_frequency(docs, text_col, block), common_df)
        found = F.concat(found, _match_column(q(text_col), block, min_seeds, min_score))
    return docs.withColumn(column, found), column


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document and benchmark item that it holds a copy of.

    ``(doc_id, item_id, score, n_seeds, start_word, end_word)``: words of the text from
    ``start_word`` up to ``end_word``.  Rows with a null id are searched as well.
    """
    out, column = with_matches(docs, benchmark, **options)
    return out.select(q(id_col).alias("doc_id"), F.explode(q(column)).alias("m")).select("doc_id", "m.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a copy of a benchmark item, all columns unchanged."""
    out, column = with_matches(docs, benchmark, **options)
    return out.where(F.size(q(column)) == 0).drop(column)
