"""Phrase collocations: fixed word sequences that occur together more often than apart.

Counts of n-grams are held by weighted acyclic automata (``automata.CountAutomaton``).  Texts
are first written as streams of word numbers, of a bounded number of words of one language
each, with a dictionary of their own.  Then, for each length from 1 to ``longest`` words:

1. each task counts a stream's n-grams and builds an automaton from every run of sorted
   n-grams (``runs``);
2. prefix ranges of about ``range_grams`` n-grams are chosen from a sample of the runs (the
   sample shapes the ranges only); runs are cut at their ends;
3. the pieces of a range are united, equal n-grams' counts summed, and n-grams below
   ``least`` dropped.

An n-gram of at least ``least`` occurrences has only such parts, so a pass counts no n-gram
of which a part is known to be rarer.  Tasks know this from a bit table of fixed size
(``filter_bits``) that holds the hashes of all frequent n-grams of the pass before; a
collision means needless counting, never a lost n-gram.

A candidate's parts are looked up by composition: distinct parts go to their prefix range
and are followed through its automaton, all of a level at a time.  What remains (scores,
nested phrases, ranks) is DataFrame work.  Scores are exact: products are decimals.

Rows: a null text is empty; a null ``lang`` counts as ``und``; equal rows count each; an
empty table gives no rows; extra columns are not read.  A text is counted whole, in one
task.  Ties in score and count rank by the phrase's UTF-8 bytes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, ship_package
from .automata import CountAutomaton, mixed, summed
from .common import least_of, q

#: Sampled runs that shape the prefix ranges, and the most ranges.
SAMPLED_RUNS, MOST_RANGES = 2048, 100_000
#: Sampled n-grams of a run.
MARKS = 16
#: N-grams whose parts a task looks up together.
FILTERED = 1 << 17

# A-Z becomes a-z, piece ends become line feeds, tabs become blanks.
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)
#: Rows of these tables hold up to megabytes: row groups end at 8 MB, asked after each row (Parquet's own default is every
#: 100 rows), so that neither a writer nor a reader's batch holds a whole file; such values don't repeat.
_WIDE_ROWS = {
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
    "parquet.enable.dictionary": "false",
}
_RUN = "lang string, marks array<array<string>>, n long, total long, automaton binary"
_PIECE = "part int, lang string, automaton binary"
_GRAMS = "lang string, words array<string>, a long"


class _Numbers(dict):
    """Words by the number in which they came; the blank's rest is 0, a piece's end 1."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode())
    return np.array([xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def gram_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of n-grams, from their words' hashes column by column."""
    return reduce(lambda h, c: mixed(h * np.uint64(0x9E3779B97F4A7C15) + c), columns)


def _probes(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of a hash in a table of 2 ** bits bits."""
    return [(mixed(hashes + np.uint64(i)) >> np.uint64(64 - bits)).astype(np.int64) for i in range(3)]


def _holds(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bit table may hold each hash."""
    out = np.ones(len(hashes), dtype=bool)
    for at in _probes(hashes, bits):
        out &= (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
    return out


_STREAM = "lang string, words binary, ids binary"


def _streams(docs: DataFrame, flush_words: int) -> DataFrame:
    """Texts as numbers of words: a dictionary (joined by line feeds) and numbers; 1 ends a piece, words begin at 2."""

    def flushed(parts):
        langs = list(parts)
        words = [b"\n".join(list(parts[lang][0])[2:]) for lang in langs]
        ids = [np.concatenate(parts[lang][1]).tobytes() for lang in langs]
        columns = [pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "words", "ids"])

    def encode(batches):
        parts, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                numbers, found = parts.setdefault(lang, (_Numbers(), []))
                words = (text.as_py() or "").encode().translate(_TO_WORDS).replace(b"\n", b" \n ").split(b" ")
                words.append(b"\n")
                ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
                found.append(ids[ids > 0])
                size += len(words)
                if size >= flush_words:
                    yield flushed(parts)
                    parts, size = {}, 0
        if parts:
            yield flushed(parts)

    return docs.mapInArrow(encode, _STREAM)


def _counted(lang: str, found: list[bytes], stream: np.ndarray, n: int, tables: list[np.ndarray], bits: int):
    """Words in byte order, a stream's distinct sorted n-grams and their counts."""
    hashes = word_hashes(lang, found) if tables else np.zeros(len(found), np.uint64)
    kept = _holds(tables[0], hashes, bits) if tables else np.ones(len(found), dtype=bool)
    places = sorted(np.flatnonzero(kept).tolist(), key=found.__getitem__)
    label = np.full(len(found) + 2, -1, dtype=np.int32)
    label[np.array(places, dtype=np.int64) + 2] = np.arange(len(places))
    hashed = np.concatenate([np.zeros(2, np.uint64), hashes])
    labels = label[stream]
    starts = np.flatnonzero(labels >= 0).astype(np.int32)
    for k in range(1, n):
        starts = starts[starts < len(stream) - k]
        starts = starts[labels[starts + k] >= 0]
    if n > 2:  # both parts of one word less must be frequent
        for shift in (0, 1):
            kept = [np.zeros(0, dtype=starts.dtype)]
            for i in range(0, len(starts), FILTERED):
                some = starts[i : i + FILTERED]
                part = gram_hashes([hashed[stream[some + shift + k]] for k in range(n - 1)])
                kept.append(some[_holds(tables[1], part, bits)])
            starts = np.concatenate(kept)
    rows = np.empty((len(starts), n), dtype=np.int32)
    for k in range(n):
        rows[:, k] = labels[starts + k]
    del labels, starts, hashed, hashes, label
    rows, counts = summed(rows, np.ones(len(rows), np.int64), len(places) + 1)
    return [found[i] for i in places], rows, counts


def _runs(streams: DataFrame, n: int, tables: list, bits: int, run_grams: int) -> DataFrame:
    """Automata of each stream's n-grams, ``run_grams`` sorted n-grams each."""
    shared = streams.sparkSession.sparkContext.broadcast(tables)

    def count(batches):
        for batch in batches:
            for lang, words, ids in zip(*(batch.column(i) for i in range(3))):
                stream = np.frombuffer(ids.as_buffer(), dtype=np.int32)
                found = words.as_py().split(b"\n") if len(words.as_buffer()) else []
                total = int((stream > 1).sum())
                yield from _as_runs(lang.as_py(), total, *_counted(lang.as_py(), found, stream, n, shared.value, bits), run_grams)

    return streams.mapInArrow(count, _RUN)


def _as_runs(lang: str, total: int, words: list[bytes], rows: np.ndarray, counts: np.ndarray, run_grams: int) -> Iterator[pa.RecordBatch]:
    names = ["lang", "marks", "n", "total", "automaton"]
    kinds = [pa.string(), pa.list_(pa.list_(pa.string())), pa.int64(), pa.int64(), pa.binary()]
    for i in range(0, max(len(rows), 1), run_grams):  # a run without n-grams still carries the words' number
        run = CountAutomaton.build(words, rows[i : i + run_grams], counts[i : i + run_grams]).to_bytes()
        size = len(rows[i : i + run_grams])
        step = max(1, -(-size // MARKS))
        marks = [[words[w].decode() for w in row] for row in rows[i : i + size][step // 2 :: step].tolist()]
        values = (lang, marks, size, 0 if i else total, run)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)  # a run at a time


def _tuple(words) -> tuple[bytes, ...]:
    return tuple(w.encode() for w in words)


def _boundaries(runs: DataFrame, range_grams: int) -> list[tuple]:
    """First (language, n-gram) of every prefix range but the first, from a bounded sample of the runs."""
    grams = runs.agg(F.sum("n")).first()[0] or 0
    wanted = min(MOST_RANGES, -(-grams // range_grams))
    if wanted <= 1:
        return []
    sample = least_of(runs.where("n > 0"), F.xxhash64("lang", "marks", "n"), SAMPLED_RUNS).limit(2 * SAMPLED_RUNS)
    marks = [
        (r["lang"], _tuple(m), r["n"] / len(r["marks"])) for r in sample.select("lang", "marks", "n").toLocalIterator() for m in r["marks"]
    ]
    marks.sort()
    upto = np.cumsum([m[2] for m in marks])
    places = np.searchsorted(upto, upto[-1] * np.arange(1, wanted) / wanted)
    return sorted({marks[min(i, len(marks) - 1)][:2] for i in places.tolist()})


def _pieces(runs: DataFrame, boundaries: list[tuple]) -> DataFrame:
    """Runs cut at the ranges' ends, each piece with its range's number."""
    shared = runs.sparkSession.sparkContext.broadcast(boundaries)

    def cut(batches):
        ends = shared.value
        for batch in batches:
            for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                run = CountAutomaton.from_bytes(blob.as_py())
                if not run.words:
                    continue
                rows, _ = run.listed()
                first, last = ((lang, run.grams(rows[i : i + 1])[0]) for i in (0, len(rows) - 1))
                at, upto = bisect_right(ends, first), bisect_right(ends, last)
                if at == upto:
                    pieces = [blob.as_py()]
                else:
                    gram = lambda i, run=run, rows=rows: run.grams(rows[i : i + 1])[0]
                    places = [bisect_left(range(len(rows)), g, key=gram) for _, g in ends[at:upto]]
                    pieces = [a.to_bytes() if a.words else None for a in run.cut(places)]
                kept = [i for i, piece in enumerate(pieces) if piece is not None]
                columns = [
                    pa.array([at + i for i in kept], pa.int32()),
                    pa.array([lang] * len(kept), pa.string()),
                    pa.array([pieces[i] for i in kept], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "lang", "automaton"])  # a run at a time

    return runs.select("lang", "automaton").mapInArrow(cut, _PIECE)


def _united(pieces: DataFrame, least: int) -> DataFrame:
    """One automaton for each range: counts summed over its pieces, rarer n-grams dropped."""

    def unite(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        whole = CountAutomaton.union([CountAutomaton.from_bytes(b) for b in pdf["automaton"]], least)
        return pd.DataFrame({"part": [key[0]], "lang": [key[1]], "automaton": [whole.to_bytes()]})

    return pieces.groupBy("part", "lang").applyInPandas(unite, _PIECE)


def _bit_table(united: DataFrame, bits: int) -> np.ndarray:
    """The bit table of all n-grams of the automata: ORed in Spark, at most 2 ** bits / 64 numbers."""

    def set_bits(batches):
        slots = np.zeros(1 << (bits - 6), dtype=np.uint64)
        for batch in batches:
            for lang, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                a = CountAutomaton.from_bytes(blob.as_py())
                rows, _ = a.listed()
                hashes = word_hashes(lang, a.words)
                for at in _probes(gram_hashes([hashes[c] for c in rows.T]), bits):
                    at = np.unique(at)
                    first = np.flatnonzero(np.diff(at >> 6, prepend=-1))
                    ones = np.uint64(1) << (at & 63).astype(np.uint64)
                    slots[at[first] >> 6] |= np.bitwise_or.reduceat(ones, first) if len(at) else ones
        held = np.flatnonzero(slots)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(slots[held].view(np.int64))], ["slot", "ones"])

    found = united.mapInArrow(set_bits, "slot long, ones long").groupBy("slot").agg(F.expr("bit_or(ones)").alias("ones")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[found["slot"].to_numpy()] = found["ones"].to_numpy().view(np.uint64)
    return table


def _listed(united: DataFrame) -> DataFrame:
    """Every n-gram of the automata, with its count."""

    def list_grams(batches):
        for batch in batches:
            for lang, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                a = CountAutomaton.from_bytes(blob.as_py())
                rows, counts = a.listed()
                words = pa.array([w.decode() for w in a.words], pa.string()).take(pa.array(rows.ravel()))
                ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
                columns = [pa.array([lang] * len(rows), pa.string()), pa.ListArray.from_arrays(ends, words), pa.array(counts.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "a"])

    return united.mapInArrow(list_grams, _GRAMS)


class PhraseCounts:
    """Counts of all n-grams of at least ``least`` occurrences, as automata by prefix range."""

    def __init__(self, docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 4, least: int = 30,
                 filter_bits: int = 26, flush_words: int = 2_000_000, run_grams: int = 1 << 16, range_grams: int = 1 << 17):
        spark = docs.sparkSession
        ship_package(spark)
        self.longest, self.least, self.scratch = longest, least, Scratch(spark)
        texts = docs.select(F.coalesce(q(lang_col), F.lit("und")).alias("lang"), q(text_col).alias("text"))
        self.united: dict[int, DataFrame] = {}
        self.boundaries: dict[int, list[tuple]] = {}
        streams = self.scratch.save(_streams(texts, flush_words), "streams", **_WIDE_ROWS)
        tables: list[np.ndarray] = []
        for n in range(1, longest + 1):
            runs = self.scratch.save(_runs(streams, n, tables, filter_bits, run_grams), f"runs-{n}", **_WIDE_ROWS)
            if n == 1:
                self.totals = self.scratch.save(runs.groupBy("lang").agg(F.sum("total").alias("n")), "words")
            self.boundaries[n] = _boundaries(runs, range_grams)
            self.united[n] = self.scratch.save(_united(_pieces(runs, self.boundaries[n]), least), f"counts-{n}", **_WIDE_ROWS)
            self.scratch.drop(runs)
            if n < longest:
                # the words' table and the newest one
                tables = [*tables[:1], _bit_table(self.united[n], filter_bits)]
        self.scratch.drop(streams)

    def grams(self, n: int) -> DataFrame:
        """lang, words, a: all frequent n-grams of ``n`` words."""
        return _listed(self.united[n])

    def lookup(self, parts: DataFrame) -> DataFrame:
        """Counts of distinct ``parts`` (lang, words), by composition with each range's automaton."""
        out = []
        for n in range(1, self.longest):
            wanted = _routed(parts.where(F.size("words") == n), self.boundaries[n])

            def compose(key: tuple, wanted: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
                if not len(wanted) or not len(held):
                    return wanted.head(0).assign(a=0)[["lang", "words", "a"]].astype({"a": "int64"})
                grams = [_tuple(x) for x in wanted["words"]]
                words = sorted({w for g in grams for w in g})
                number = {w: i for i, w in enumerate(words)}
                rows = np.array([[number[w] for w in g] for g in grams], dtype=np.int64)
                counts = CountAutomaton.from_bytes(held["automaton"].iloc[0]).composed(words, rows)
                return pd.DataFrame({"lang": wanted["lang"], "words": [list(x) for x in wanted["words"]], "a": counts})

            both = wanted.groupBy("part", "lang").cogroup(self.united[n].groupBy("part", "lang"))
            out.append(both.applyInPandas(compose, _GRAMS))
        return reduce(DataFrame.unionByName, out)


def _routed(parts: DataFrame, boundaries: list[tuple]) -> DataFrame:
    """``parts`` with the number of the prefix range each belongs to."""
    shared = parts.sparkSession.sparkContext.broadcast(boundaries)

    @F.arrow_udf("int")
    def part_of(langs: pa.Array, words: pa.Array) -> pa.Array:
        grams = zip(langs.to_pylist(), words.to_pylist())
        return pa.array([bisect_right(shared.value, (lang, _tuple(w))) for lang, w in grams], pa.int32())

    return parts.select(part_of("lang", "words").alias("part"), "lang", "words")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 4, least: int = 30,
                 nested_percent: int = 80, top: int = 2000, **limits) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words by score.

    lang, rank, phrase, its count ``a``, the counts ``l`` and ``r`` of both sides of its
    weakest cut, the language's words ``n`` and the score floor(2,000,000 a / (l + r)).  A
    phrase is left out if a longer candidate that holds it has ``nested_percent`` of its
    count or more.  ``limits``: see :class:`PhraseCounts`.
    """
    counts = PhraseCounts(docs, lang_col, text_col, longest, least, **limits)
    scratch = counts.scratch
    grams = scratch.save(reduce(DataFrame.unionByName, [counts.grams(n) for n in range(2, longest + 1)]), "candidates")

    # one row per cut, then distinct parts; the counts go back by two joins
    sized = grams.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
    cuts = sized.select("*", F.expr("slice(words, 1, k)").alias("front"), F.expr("slice(words, k + 1, size(words) - k)").alias("back"))
    sides = cuts.select("lang", F.explode(F.array("front", "back")).alias("words")).distinct()
    known = scratch.save(counts.lookup(sides), "parts")
    left = known.select("lang", F.col("words").alias("front"), F.col("a").alias("l"))
    right = known.select("lang", F.col("words").alias("back"), F.col("a").alias("r"))
    scored = cuts.join(left, ["lang", "front"]).join(right, ["lang", "back"]).withColumn(
        "score", F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + r)")
    )
    weakest = F.min(F.struct("score", "k", "l", "r"))
    best = scored.groupBy("lang", "words").agg(F.first("a").alias("a"), weakest.alias("cut"))

    longer = grams.where(F.size("words") > 2)
    inner = longer.select(
        "lang", "a",
        F.explode(F.expr(
            "flatten(transform(sequence(2, size(words) - 1), w -> "
            "transform(sequence(1, size(words) - w + 1), i -> slice(words, i, w))))"
        )).alias("words"),
    ).groupBy("lang", "words").agg(F.max("a").alias("longer"))
    holds_most = F.expr(f"CAST(longer AS DECIMAL(20,0)) * 100 >= CAST(a AS DECIMAL(20,0)) * {nested_percent}")
    kept = best.join(inner, ["lang", "words"], "left").where(~F.coalesce(holds_most, F.lit(False)))

    kept = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    out = scratch.save(ranked, "ranked").join(counts.totals, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
