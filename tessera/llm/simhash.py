"""SimHash near-duplicates: positional byte index, count filter, verification, components.

Two 64-bit fingerprints within ``max_bits`` differing bits differ in at most
``max_bits`` of their eight bytes, so they share at least ``8 - max_bits`` bytes
by value and position.  The inverted index is keyed by several positional bytes
at once: a family of position sets such that any ``8 - max_bits`` shared
positions contain one of them (for 4 bits: 20 triples, 24-bit keys).  Within a
posting list the shared positional bytes of each pair are tallied, pairs below
the guaranteed minimum are dropped and the rest is verified bit by bit.

Posting lists hold distinct fingerprints only, so exact copies cost nothing.  A
list of more than ``list_cap`` fingerprints is not compared pair by pair: its
fingerprints are joined through the points halfway between them (every point
within ``ceil(max_bits / 2)`` bits), which finds the same links in rows linear
in the number of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .common import fresh, q
from .graph import connected_components

SEED = 42
BITS_AT_ONCE = 1 << 16  # shingle hashes unpacked to bits at a time


def fingerprint(raw: bytes | None, width: int = 4) -> int:
    """64-bit SimHash of the text's ``width``-word shingles, as an unsigned integer.

    Words are runs of bytes outside 0x20 and 0x09-0x0D, A-Z lower-cased
    (``bytes.split`` and ``bytes.lower`` do exactly that).  Shorter texts count as
    one shingle; null and wordless texts give 0.
    """
    words = raw.lower().split() if raw else []
    n = len(words) - width + 1
    if not words:
        return 0
    if n < 2:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[:n].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), BITS_AT_ONCE):
        part = np.array(hashes[i : i + BITS_AT_ONCE], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text, width: int = 4):
    """Column: the text's fingerprint as a (signed) bigint; never null."""

    @F.arrow_udf("long")
    def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            values = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, width) for t in batch]
            yield pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    return fingerprints(text.cast("binary"))


def key_positions(shared: int) -> list[tuple[int, ...]]:
    """Sets of byte positions, one of which lies within any ``shared`` of the eight.

    For four shared bytes a Turan system of 20 triples; otherwise all sets of
    ``shared`` positions, at most four (a larger key is not more exact).
    """
    if shared != 4:
        return list(combinations(range(8), min(shared, 4)))
    part = [0, 0, 0, 1, 1, 1, 2, 2]
    wanted = lambda t: (len({part[p] for p in t}) == 1) or any(
        sorted(part[p] for p in t) == sorted((g, g, (g + 1) % 3)) for g in range(3)
    )
    return [t for t in combinations(range(8), 3) if wanted(t)]


def hamming_ball(radius: int) -> np.ndarray:
    """All 64-bit masks of at most ``radius`` bits."""
    masks = [0]
    for k in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(64), k)]
    return np.array(masks, dtype=np.uint64)


def _linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then verification, of pairs of fingerprints."""
    x = np.bitwise_xor(a, b)
    shared = (x.reshape(-1, 1).view(np.uint8) == 0).sum(axis=1)
    found = shared >= 8 - max_bits
    found[found] = np.bitwise_count(x[found]) <= max_bits
    return found


def list_links(fps: np.ndarray, max_bits: int) -> tuple[list, list]:
    """A spanning forest of the links within one posting list: fewer edges than fingerprints."""
    left, right = [], []
    open_ = np.arange(len(fps))
    while len(open_) > 1:
        frontier, open_ = [open_[0]], open_[1:]
        while frontier and len(open_):
            at = frontier.pop()
            near = _linked(np.broadcast_to(fps[at], len(open_)).copy(), fps[open_], max_bits)
            for other in open_[near]:
                left.append(fps[at])
                right.append(fps[other])
                frontier.append(other)
            open_ = open_[~near]
    return left, right


def _list_edges(max_bits: int, small: int = 8):
    """mapInArrow over rows sorted by key: links within each posting list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key0, fp0 = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)

        def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            bounds = np.flatnonzero(np.diff(keys)) + 1
            starts, sizes = np.r_[0, bounds], np.diff(np.r_[0, bounds, len(keys)])
            size_at = np.repeat(sizes, sizes)
            a, b = [], []
            few = np.flatnonzero((size_at > 1) & (size_at <= small))
            k, f = keys[few], fps[few]
            for step in range(1, small):
                if step >= len(f):
                    break
                near = (k[:-step] == k[step:]) & _linked(f[:-step], f[step:], max_bits)
                a.append(f[:-step][near])
                b.append(f[step:][near])
            for s, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
                x, y = list_links(fps[s : s + n], max_bits)
                a.append(np.array(x, dtype=np.uint64))
                b.append(np.array(y, dtype=np.uint64))
            a = np.concatenate(a) if a else np.empty(0, dtype=np.uint64)
            b = np.concatenate(b) if b else np.empty(0, dtype=np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([key0, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fp0, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])  # the last list may go on in the next batch
            key0, fp0 = keys[last:], fps[last:]
            if last:
                yield links(keys[:last], fps[:last])
        if len(key0):
            yield links(key0, fp0)

    return run


def _halfway_points(radius: int):
    ball = hamming_ball(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64):
                points = np.bitwise_xor(ball, fp).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(points), pa.array(np.full(len(points), fp).view(np.int64))], ["point", "fp"]
                )

    return run


def fingerprint_links(fps: DataFrame, scratch: Scratch, max_bits: int = 4, list_cap: int = 4096) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints linked within ``max_bits`` bits.

    ``fps`` has one column ``fp`` of distinct bigints.  Not every linked pair is an
    edge, but any two linked fingerprints are connected by edges between linked ones
    (through a common halfway point beyond ``list_cap``).
    """
    byte = lambda p: F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255))
    keys = []
    for i, positions in enumerate(key_positions(max(8 - max_bits, 1))):
        key = F.lit(i).cast("bigint")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(byte(p))
        keys.append(key)
    index = fps.select(F.explode(F.array(*keys)).alias("key"), "fp")
    crowded = scratch.save(
        index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > list_cap).select("key"), "crowded"
    )
    some_crowded = not crowded.isEmpty()
    lists = index.join(crowded, "key", "left_anti") if some_crowded else index
    edges = (
        lists.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_list_edges(max_bits), "a long, b long")
    )
    if some_crowded:
        points = (
            index.join(crowded, "key", "left_semi")
            .select("fp")
            .distinct()
            .mapInArrow(_halfway_points((max_bits + 1) // 2), "point long, fp long")
        )
        first = points.groupBy("point").agg(F.min("fp").alias("a"))  # at most one ball of fingerprints to a point
        if max_bits % 2:  # an odd distance has no exact middle: the point may lie one bit too far from one end
            second = points.withColumnRenamed("fp", "b")
            pairs = points.withColumnRenamed("fp", "a").join(second, "point").where("a < b")
            near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
            edges = edges.union(pairs.where(near).select("a", "b"))
        else:
            edges = edges.union(points.join(first, "point").where("a <> fp").select("a", F.col("fp").alias("b")))
    return edges


def _rooted(fps: DataFrame, scratch: Scratch, max_bits: int, list_cap: int) -> DataFrame:
    """``(fp, root)`` for each of the distinct fingerprints ``fp``: equal roots, same component."""
    edges = scratch.save(fingerprint_links(fps, scratch, max_bits, list_cap), "links")
    roots = connected_components(edges, scratch)
    scratch.drop(edges)
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    max_bits: int = 4,
    list_cap: int = 4096,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    component_id is the least id reachable over links (itself included).  Null,
    empty and wordless texts share fingerprint zero and are linked like any other;
    a null id never becomes a component_id unless the component has no other
    (then it is null); repeated rows each get a row.  Long texts are read whole.
    Other columns are ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    signed = scratch.save(
        docs.select(q(id_col).alias("doc_id"), fingerprint_column(q(text_col), width).alias("fp")), "simhash"
    )
    classes = scratch.save(signed.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprints")
    rooted = classes.join(_rooted(classes.select("fp"), scratch, max_bits, list_cap), "fp")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = scratch.save(rooted.join(least, "root").select("fp", "component_id"), "components")
    scratch.drop(classes)
    return signed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4, list_cap: int = 4096
) -> DataFrame:
    """One row of each component of near-duplicates, all columns unchanged.

    It is the row of least id (a null id comes last), of equal ids that of least text
    hash; of rows equal in both, any one.  Rows whose texts are not linked all stay, also
    where they repeat an id or have none.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark)
    # a row's name: whether it has an id, the id, and the text's hash
    no_id, id_, hashed = names = fresh(docs, "kept_null", "kept_id", "kept_hash")
    of_text = F.xxhash64(F.coalesce(q(text_col), F.lit("")), q(text_col).isNull())
    blank = F.lit(0).cast(docs.select(q(id_col)).schema[0].dataType)
    key = {no_id: q(id_col).isNull(), id_: F.coalesce(q(id_col), blank), hashed: of_text}
    signed = docs.select(*[c.alias(n) for n, c in key.items()], fingerprint_column(q(text_col), width).alias("fp"))
    # of equal fingerprints, then of a component, only the least name is carried on
    least = F.min(F.struct(*names)).alias("least")
    classes = scratch.save(signed.groupBy("fp").agg(least), "fingerprints")
    rooted = classes.join(_rooted(classes.select("fp"), scratch, max_bits, list_cap), "fp")
    kept = scratch.save(rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.*"), "kept")
    scratch.drop(classes)
    return docs.withColumns(key).join(kept, list(names), "left_semi").dropDuplicates(list(names)).select(
        *[q(c) for c in docs.columns]
    )
