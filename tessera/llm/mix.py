"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Each source's documents fall into blocks by a keyed hash; a pass over a source
   goes through its blocks in a keyed permutation.  A source whose target is m times
   its size is read in floor(m) whole passes and one part of a pass, which ends
   inside one block: there documents are taken as long as they fit.  The block
   where it ends is found by summing blocks of blocks, so no task sums up a source.
   Documents that don't fit are passed over: those of later blocks that do are taken
   likewise, until what is left is below the least document left out.
2. The quotas (blocks drawn from each source) are split among the output shards:
   a node of the tree that holds shards [lo, hi) divides its quota vector between
   its halves by one multivariate-hypergeometric draw, seeded by (seed, lo, hi).
   Quotas are met exactly and every shard is a random sample of the mix.  A shard's
   task walks from the root to its leaf by itself, so nothing is exchanged and a
   lost task is simply run again.
3. A shard's share of a source is a range of that source's sequence of blocks, so
   shards are disjoint.  Documents are joined to blocks, and shuffled in their shard.
   Documents taken beyond the block where a pass ends go to shards by their hash.

What reaches the driver is one row per source (at most ``max_sources``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .common import fresh, q

PASSES = 3  # a document is taken at most so many times
MOST_BLOCKS = 500_000_000  # of all sources; numpy's draw takes fewer than 10^9
BLOCKS_TOGETHER = 1024
PLACES = "array<struct<_pass:int,_shard:bigint>>"


def word_count(text):
    """Number of runs of characters outside 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def capped_targets(sizes: list[int], weights: list[float], cap: float = PASSES) -> list[float]:
    """Share the sum of all sizes by weight; no target above ``cap`` times its size, the excess shared anew."""
    targets = [0.0] * len(sizes)
    open_, left = list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
        left -= sum(targets[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def keyed_permutation(seed: int, n: int) -> tuple[int, int, int]:
    """(factor, its inverse, offset): position = (block * factor + offset) mod any power of two up to 2^31."""
    rng = np.random.default_rng([seed, n])
    factor = int(rng.integers(1 << 29)) * 2 + 1
    return factor, pow(factor, -1, 1 << 31), int(rng.integers(1 << 31))


@dataclass
class Quota:
    """What a mix draws from each source, by the source's index."""

    seed: int
    sources: list[str | None]
    sizes: list[int]
    targets: list[float]
    blocks: np.ndarray  # blocks in a pass, a power of two
    whole: np.ndarray  # whole passes
    part: np.ndarray  # blocks of the pass that is read in part, the last one in part
    shard_blocks: int

    @property
    def drawn(self) -> np.ndarray:
        return self.whole * self.blocks + self.part

    @property
    def shards(self) -> int:
        return max(1, -(-int(self.drawn.sum()) // self.shard_blocks))


class SplittingTree:
    """Quotas of one shard, by descending from the root; nodes passed last are kept."""

    def __init__(self, seed: int, quotas: np.ndarray, shards: int):
        self.seed, self.shards, self.total = seed, shards, int(quotas.sum())
        self.path = [(0, shards, quotas.astype(np.int64), np.zeros(len(quotas), dtype=np.int64))]

    def slots(self, shard: int) -> int:
        """Blocks in the shards before this one."""
        return shard * self.total // self.shards

    def leaf(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, count): the shard's range in each source's sequence of blocks."""
        while not self.path[-1][0] <= shard < self.path[-1][1]:
            self.path.pop()
        while self.path[-1][1] - self.path[-1][0] > 1:
            lo, hi, quotas, first = self.path[-1]
            mid = (lo + hi) // 2
            rng = np.random.default_rng([self.seed, lo, hi])
            n = self.slots(mid) - self.slots(lo)
            left = rng.multivariate_hypergeometric(quotas, n, method="marginals")
            if shard < mid:
                self.path.append((lo, mid, left, first))
            else:
                self.path.append((mid, hi, quotas - left, first + left))
        _, _, quotas, first = self.path[-1]
        return first, quotas


def block_places(spark: SparkSession, quota: Quota) -> DataFrame:
    """``(_source, _block, _places)``: for each drawn block its (pass, shard) pairs, one for each time it is drawn."""
    keys = [keyed_permutation(quota.seed, n) for n in range(PASSES + 1)]
    inverse = np.array([k[1] for k in keys], dtype=np.int64)
    offset = np.array([k[2] for k in keys], dtype=np.int64)

    def leaves(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = SplittingTree(quota.seed, quota.drawn, quota.shards)
        for part in parts:
            for shard in part["id"]:
                first, count = tree.leaf(int(shard))
                source = np.repeat(np.arange(len(count)), count)
                at = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
                size = quota.blocks[source]
                number = at // size
                block = (((at % size - offset[number]) % size) * (inverse[number] % size)) % size
                yield pd.DataFrame(
                    {"_source": source.astype(np.int32), "_block": block, "_pass": number.astype(np.int32), "_shard": shard}
                )

    drawn = spark.range(quota.shards).mapInPandas(leaves, "_source int, _block long, _pass int, _shard long")
    return drawn.groupBy("_source", "_block").agg(F.sort_array(F.collect_list(F.struct("_pass", "_shard"))).alias("_places"))


def _position(block, size, number: int, seed: int):
    factor, _, offset = keyed_permutation(seed, number)
    return F.pmod(block * F.pmod(F.lit(factor), size) + F.lit(offset), size)


def _in_source(df: DataFrame, quota_rows: DataFrame, source_col: str) -> DataFrame:
    """Rows with their source's ``quota_rows`` (one small row per source) and their block."""
    joined = df.join(quota_rows, q(source_col).eqNullSafe(F.col("_name"))).drop("_name")
    return joined.withColumn("_block", F.pmod(F.col("_hash"), F.col("_blocks")))


@dataclass
class Mix:
    """A drawn mix: the quotas, their blocks' places, and the documents taken from the last block of a pass or beyond."""

    quota: Quota
    quota_rows: DataFrame
    places: DataFrame
    chosen: DataFrame

    def place(self, keyed: DataFrame, source_col: str) -> DataFrame:
        """Rows of ``keyed`` (with ``_hash``) plus ``_source_size``, ``_target`` and ``_places`` (null if never drawn)."""
        rows = _in_source(keyed, self.quota_rows, source_col)
        rows = rows.join(self.places, ["_source", "_block"], "left").join(
            self.chosen, ["_source", "_hash"], "left"
        )
        in_part = F.col("_part") - 1  # place of the block in which the last pass ends
        at = F.lit(-1).cast("bigint")
        for n in range(PASSES):
            at = F.when(F.col("_whole") == n, _position(F.col("_block"), F.col("_blocks"), n, self.quota.seed)).otherwise(at)
        rows = rows.withColumn("_out", (at == in_part) & F.col("_beyond").isNull())
        whole = F.filter("_places", lambda p: (p["_pass"] < F.col("_whole")) | ~F.col("_out"))
        shard = F.pmod(F.xxhash64(F.lit(self.quota.seed), F.lit("beyond"), "_hash"), F.lit(self.quota.shards))
        alone = F.array(F.struct(F.col("_whole").cast("int").alias("_pass"), shard.alias("_shard")))
        places = F.when(F.col("_beyond"), F.concat(F.coalesce(whole, F.array().cast(PLACES)), alone)).otherwise(whole)
        return rows.withColumn("_places", places).drop(
            "_source", "_block", "_blocks", "_whole", "_part", "_rest", "_beyond", "_out"
        )


def keyed_rows(docs: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """``docs`` plus ``_size`` and the keyed hash ``_hash`` that rules where a row goes; equal rows go together."""
    return docs.withColumns(
        {
            "_size": word_count(q(text_col)),
            "_hash": F.xxhash64(F.lit(seed), q(id_col).cast("string"), F.xxhash64(F.lit(seed), q(text_col))),
        }
    )


def draw_mix(
    sized: DataFrame,
    scratch: Scratch,
    source_col: str = "source",
    weights=(1, 2, 3),
    seed: int = 17,
    block_docs: int = 256,
    shard_blocks: int = 16,
    max_sources: int = 1_000_000,
) -> Mix:
    """Quotas and places for documents given as ``(source, _size, _hash)``; ``sized`` is read several times."""
    spark = sized.sparkSession
    ship_package(spark)
    totals = sized.groupBy(q(source_col).alias("name")).agg(F.count("*").alias("n"), F.sum("_size").alias("size"))
    rows = totals.limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"a mix is declared source by source; there are more than {max_sources} sources")
    rows.sort(key=lambda r: (r["name"] is None, r["name"] or ""))  # Python orders text by code point
    sizes = [int(r["size"]) for r in rows]
    targets = capped_targets(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))])
    while sum(-(-r["n"] // block_docs) for r in rows) * 2 * PASSES > MOST_BLOCKS:
        block_docs *= 2
    blocks = np.array([1 << max(0, -(-r["n"] // block_docs) - 1).bit_length() for r in rows], dtype=np.int64)
    whole = np.array([min(PASSES, int(t // s)) if s else 0 for t, s in zip(targets, sizes, strict=True)], dtype=np.int64)
    rest = [int(t - w * s) for t, w, s in zip(targets, whole.tolist(), sizes, strict=True)]
    quota = Quota(seed, [r["name"] for r in rows], sizes, targets, blocks, whole, np.zeros(len(rows), dtype=np.int64), shard_blocks)
    ends, chosen = _part_passes(sized, _quota_rows(spark, quota, rest), source_col, seed, scratch)
    for source, part in ends:
        quota.part[source] = part
    places = scratch.save(block_places(spark, quota), "block-places")
    return Mix(quota, _quota_rows(spark, quota, rest), places, chosen)


def _quota_rows(spark: SparkSession, quota: Quota, rest: list[int]) -> DataFrame:
    rows = [
        (name, i, int(quota.blocks[i]), int(quota.whole[i]), int(quota.part[i]), rest[i], quota.sizes[i], quota.targets[i])
        for i, name in enumerate(quota.sources)
    ]
    kind = "_name string, _source int, _blocks long, _whole long, _part long, _rest long, _source_size long, _target double"
    return spark.createDataFrame(rows, kind)


def _part_passes(
    sized: DataFrame, quota_rows: DataFrame, source_col: str, seed: int, scratch: Scratch
) -> tuple[list[tuple[int, int]], DataFrame]:
    """Where each source's last, partial pass ends, and ``(_source, _hash, _beyond)``: which documents are taken there and beyond."""
    rows = _in_source(sized, quota_rows.where("_rest > 0"), source_col)
    at = F.lit(0).cast("bigint")
    for n in range(PASSES):
        at = F.when(F.col("_whole") == n, _position(F.col("_block"), F.col("_blocks"), n, seed)).otherwise(at)
    placed = rows.select("_source", "_rest", "_hash", "_size", at.alias("_at"))
    ends = _ends(placed, scratch)
    chosen = _last_documents(placed, ends, _fitting, scratch)
    found = [(r["_source"], r["_at"] + 1) for r in ends.select("_source", "_at").collect()]  # one row per source
    return found, _beyond(placed, ends, chosen, scratch)


def _ends(placed: DataFrame, scratch: Scratch) -> DataFrame:
    """``(_source, _at, _left)``: the block in which the words of a source pass ``_rest``, and what is left before it.

    Sums of blocks, then of ``BLOCKS_TOGETHER`` of them: every window is over one
    source's sums of blocks of blocks, or over the blocks of one such sum.
    """
    sums = scratch.save(placed.groupBy("_source", "_rest", "_at").agg(F.sum("_size").alias("_words")), "block-sums")
    wide = F.floor(F.col("_at") / BLOCKS_TOGETHER).cast("bigint")
    coarse = sums.groupBy("_source", "_rest", wide.alias("_wide")).agg(F.sum("_words").alias("_words"))
    before = F.sum("_words").over(Window.partitionBy("_source").orderBy("_wide")) - F.col("_words")
    coarse = coarse.withColumn("_before", before).where("_before <= _rest and _rest < _before + _words")
    inside = sums.withColumn("_wide", wide).join(coarse.select("_source", "_wide", "_before"), ["_source", "_wide"])
    upto = F.col("_before") + F.sum("_words").over(Window.partitionBy("_source").orderBy("_at")) - F.col("_words")
    ends = scratch.save(
        inside.withColumn("_upto", upto)
        .where("_upto <= _rest and _rest < _upto + _words")
        .select("_source", "_at", (F.col("_rest") - F.col("_upto")).alias("_left")),
        "pass-ends",
    )
    scratch.drop(sums)
    return ends


def _last_documents(placed: DataFrame, ends: DataFrame, fitting, scratch: Scratch) -> DataFrame:
    """``(_source, _hash, _size)``: the documents taken from the block where each source ends."""
    last = placed.join(ends, ["_source", "_at"]).groupBy("_source", "_left", "_hash").agg(F.sum("_size").alias("_size"))
    return scratch.save(
        last.groupBy("_source").applyInPandas(fitting, "_source int, _hash long, _size long"), "last-documents"
    )


def _beyond(placed: DataFrame, ends: DataFrame, chosen: DataFrame, scratch: Scratch) -> DataFrame:
    """``chosen`` of the block where each pass ends, and the documents of later blocks that fit in what is left then.

    Each round takes, in the blocks' order, documents that fit until one would not, and
    leaves less than half of what it began with (see ``_largest_fitting``).
    """

    def later(rows: DataFrame, ends: DataFrame, chosen: DataFrame) -> DataFrame:
        used = chosen.groupBy("_source").agg(F.sum("_size").alias("_used"))
        left = (F.col("_left") - F.coalesce("_used", F.lit(0))).alias("_rest")
        open_ = ends.join(used, "_source", "left").select("_source", F.col("_at").alias("_end"), left)
        rows = rows.drop("_rest").join(open_, "_source").where("_at > _end and _size > 0 and _size <= _rest")
        alike = rows.groupBy("_source", "_rest", "_hash", "_at").agg(F.sum("_size").alias("_size"))  # drawn together
        return scratch.save(alike.where("_size <= _rest"), "later-documents")

    taken = [chosen.select("_source", "_hash", F.lit(False).alias("_beyond"))]
    rows = later(placed, ends, chosen)
    while not rows.isEmpty():
        ends = _ends(rows, scratch)
        before = rows.join(ends.select("_source", F.col("_at").alias("_end")), "_source", "left")
        before = before.where("_end is null or _at < _end").select("_source", "_hash", F.lit(True).alias("_beyond"))
        chosen = _last_documents(rows, ends, _largest_fitting, scratch)
        taken += [scratch.save(before, "later-blocks"), chosen.select("_source", "_hash", F.lit(True).alias("_beyond"))]
        done, rows = rows, later(rows, ends, chosen)
        scratch.drop(done, ends)
    scratch.drop(rows)
    whole = taken[0]
    for part in taken[1:]:
        whole = whole.union(part)
    return whole


def _fitting(block: pd.DataFrame) -> pd.DataFrame:
    """Documents of one block, in hash order, each taken if it still fits; what is left is below the least one left out."""
    return _first_fit(block.sort_values("_hash"))


def _largest_fitting(block: pd.DataFrame) -> pd.DataFrame:
    """The same, largest documents first: where not all fit, what is left is below half of what was."""
    fits = block[block["_size"] <= block["_left"]]
    return _first_fit(fits.sort_values(["_size", "_hash"], ascending=[False, True]))


def _first_fit(block: pd.DataFrame) -> pd.DataFrame:
    left, take = int(block["_left"].iloc[0]) if len(block) else 0, []
    for size in block["_size"]:
        take.append(size <= left)
        left -= int(size) if size <= left else 0
    return block.loc[np.array(take, dtype=bool), ["_source", "_hash", "_size"]]


def mix_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **options
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies, shards)`` for every row of ``docs``.

    ``taken``: words the mix takes of the document, repeats counted; ``shards``: where
    its copies go.  A null source is a source of its own, after all others; null and
    empty texts have size 0 (taken is 0 however often they are drawn).  Equal rows are
    drawn together.  Seeded: reruns agree.  Sources without words have target 0.
    """
    scratch = Scratch(docs.sparkSession)
    columns = docs.select(q(id_col).alias("doc_id"), q(text_col).alias("text"), q(source_col).alias("source"))
    sized = scratch.save(
        keyed_rows(columns, "doc_id", "text", seed).select("doc_id", "source", "_size", "_hash"), "sized"
    )
    placed = draw_mix(sized, scratch, "source", seed=seed, **options).place(sized, "source")
    copies = F.coalesce(F.size("_places"), F.lit(0)).cast("bigint")
    return placed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * copies).alias("taken"),
        copies.alias("copies"),
        F.transform(F.coalesce("_places", F.array().cast(PLACES)), lambda p: p["_shard"]).alias("shards"),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **options
) -> DataFrame:
    """The mix itself: the rows drawn, all columns, repeats included, plus ``mix_shard`` and ``mix_position``.

    Positions count from 0 in a random order within each shard.  The two names are
    lengthened if ``docs`` has them.
    """
    scratch = Scratch(docs.sparkSession)
    shard, position = fresh(docs, "mix_shard", "mix_position")
    narrow = docs.select(q(id_col).alias("doc_id"), q(text_col).alias("text"), q(source_col).alias("source"))
    sized = scratch.save(keyed_rows(narrow, "doc_id", "text", seed).select("source", "_size", "_hash"), "sized")
    drawn = draw_mix(sized, scratch, "source", seed=seed, **options)
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no name of the caller's can meet one of ours
    plain = docs.toDF(*own.values())
    placed = drawn.place(keyed_rows(plain, own[id_col], own[text_col], seed), own[source_col])
    copies = placed.select("*", F.explode("_places").alias("_place")).select("*", "_place.*")
    order = F.xxhash64(F.lit(seed), F.col("_shard"), F.col("_pass"), F.col("_hash"))
    local = Window.partitionBy("_shard").orderBy(order, "_hash", "_pass")
    return copies.withColumn("_position", F.row_number().over(local) - 1).select(
        *[F.col(own[c]).alias(c) for c in docs.columns],
        F.col("_shard").alias(shard),
        F.col("_position").cast("bigint").alias(position),
    )
