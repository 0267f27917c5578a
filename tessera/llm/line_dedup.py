"""Line dedup over levelled sorted runs of line hashes.

A run is a Parquet table, sorted by hash, with one row per line key:
``(h1, h2, docs, keeper)`` -- how many documents hold the key and the largest id
among them.  A batch of documents becomes one run of level 0; every ``fanout``
runs of a level are merged into one run of the next, so a store of n batches has
at most ``fanout * log(n)`` runs.  Runs are additive as long as all rows of a
document are in one batch.

``LineRuns.add`` ingests a batch and tells which of its keys no earlier batch
held (the anti join of the new run with the stored ones); ``LineRuns.frequent``
gives the keys held by enough documents, and ``drop_lines`` anti-joins documents'
lines with those.

Keys are 128-bit hashes (two independent 64-bit ones): lines are told apart by
content far beyond the number of lines that any corpus holds.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import fresh, lower_ascii, q

BLANKS = " \t\n\x0b\x0c\r"  # 0x20 and 0x09-0x0D
ADDED = ("gone_id", "gone_text", "gone", "all_lines", "kept_lines")  # columns joined on; the last two stay


def line_key(line):
    """The line without blanks at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def text_lines(text):
    """The text's lines; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_hash(text):
    """Tells apart the rows of one id, or of none; a null text is as an empty one, with the same lines."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(doc_id, of_text, pos, h1, h2)`` of every line whose key has ``min_chars`` code points or more.

    ``doc_id`` is the document that is counted, ``(doc_id, of_text)`` the row whose line it is.
    """
    of_text = text_hash(q(text_col)).alias("of_text")
    lines = docs.select(q(id_col).alias("doc_id"), of_text, F.posexplode(text_lines(q(text_col))).alias("pos", "line"))
    keyed = lines.select("doc_id", "of_text", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc_id", "of_text", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2")
    )


class LineRuns:
    """Runs of line hashes in one folder, by level.

    The list of runs is kept by this object and by ``save_index``; a run that a
    merge has replaced stays until the new one is written.
    """

    def __init__(self, scratch: Scratch, fanout: int = 4):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.scratch, self.fanout = scratch, fanout
        self.levels: list[list[DataFrame]] = []

    @staticmethod
    def run_of(lines: DataFrame) -> DataFrame:
        """One batch's run.  A document counts once for a key, however often it holds it."""
        held = lines.select("h1", "h2", "doc_id").distinct()
        return held.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))

    def add(self, lines: DataFrame, with_new_keys: bool = False) -> DataFrame | None:
        """Add a batch of ``hashed_lines``; optionally the keys that no earlier batch held."""
        run = self._write(self.run_of(lines))
        new = run.select("h1", "h2")
        if with_new_keys:
            for level in self.levels:
                for older in level:
                    new = new.join(older.select("h1", "h2"), ["h1", "h2"], "left_anti")
            new = self.scratch.save(new, "new-keys")  # before a merge may replace a run
        self._place(run, 0)
        return new if with_new_keys else None

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def merged(self) -> DataFrame | None:
        return self._merge(self.runs()) if self.runs() else None

    def frequent(self, min_docs: int) -> DataFrame | None:
        """Keys held by ``min_docs`` documents or more, of all batches."""
        merged = self.merged()
        return None if merged is None else merged.where(F.col("docs") >= min_docs)

    def index(self) -> str:
        """The levels' run files as JSON, to reopen the store from."""
        return json.dumps([[run.inputFiles() for run in level] for level in self.levels])

    def _place(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            old = self.levels[level]
            whole = self._write(self._merge(old))
            self.levels[level] = []
            self.scratch.drop(*old)
            self._place(whole, level + 1)

    def _write(self, run: DataFrame) -> DataFrame:
        return self.scratch.save(run.sortWithinPartitions("h1", "h2"), "line-run")

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        if len(runs) == 1:
            return runs[0]
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.union(run)
        return rows.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))


def dropped_positions(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """``(doc_id, of_text, gone)``: a row's positions that frequent keys take, the document not being their keeper."""
    keys = frequent.select("h1", "h2", "keeper")
    hit = lines.join(keys, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return hit.groupBy("doc_id", "of_text").agg(F.collect_set("pos").alias("gone"))


def drop_lines(docs: DataFrame, lines: DataFrame, frequent: DataFrame | None, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the arrays ``kept`` (lines that stay) and ``n_lines``, under names returned by ``fresh``.

    A document whose lines all go keeps an empty array.
    """
    key, of_text, gone, all_, kept = fresh(docs, *ADDED)
    if frequent is None:
        joined = docs.withColumn(gone, F.lit(None).cast("array<int>"))
    else:
        dropped = dropped_positions(lines, frequent).toDF(key, of_text, gone)
        same_row = q(id_col).eqNullSafe(q(key)) & (text_hash(q(text_col)) == q(of_text))
        joined = docs.join(dropped, same_row, "left").drop(key, of_text)
    split = joined.withColumn(all_, text_lines(q(text_col)))
    places = F.array_except(F.sequence(F.lit(0), F.size(q(all_)) - 1), q(gone))
    stay = F.when(q(gone).isNull(), q(all_)).otherwise(F.transform(places, lambda i: F.get(q(all_), i)))
    return split.withColumn(kept, stay).drop(gone)


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """``docs`` plus ``all_lines`` and ``kept_lines`` (lengthened if the names are taken).

    A line whose key (blanks stripped at both ends, A-Z lower-cased) has
    ``min_chars`` code points and is held by ``min_docs`` documents goes from all
    documents but the one of the largest id.  Documents enter the runs in
    ``batches`` batches by a hash of the id, so a repeated id counts as one document;
    null ids together are one document of the lowest rank.  Each row loses lines of its
    own text only, also where rows share an id or have none.  Null and empty texts
    have one empty line, which is never long enough to go.
    """
    scratch = Scratch(docs.sparkSession)
    lines = hashed_lines(docs, id_col, text_col, min_chars)
    batch = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(batches)).cast("int").alias("batch")
    hashed = scratch.save(lines.select("*", batch), "lines", partition_by=("batch",))
    store = LineRuns(scratch, fanout)
    for i in range(batches):
        store.add(hashed.where(F.col("batch") == i).drop("batch"))
    frequent = scratch.save(store.frequent(min_docs), "frequent")
    scratch.drop(*store.runs())
    return drop_lines(docs, hashed.drop("batch"), frequent, id_col, text_col)


def added_columns(docs: DataFrame) -> tuple[str, str]:
    """Names of the two columns that ``line_dedup`` adds to ``docs``."""
    return fresh(docs, *ADDED)[-2:]


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, same columns: texts hold the lines that stay; ``n_chars``, if there, is counted anew.

    Texts that lose nothing, null ones included, stay as they are.
    """
    all_, kept = added_columns(docs)
    out = line_dedup(docs, id_col, text_col, **options)
    changed = F.size(q(kept)) < F.size(q(all_))
    (text,) = fresh(out, "text_left")
    out = out.withColumn(text, F.when(changed, F.array_join(q(kept), "\n")).otherwise(q(text_col)))
    swap = {text_col: q(text)}
    if "n_chars" in docs.columns:
        count = F.char_length(q(text)).cast(docs.schema["n_chars"].dataType)
        swap["n_chars"] = F.when(changed, count).otherwise(q("n_chars"))
    return out.select(*[swap[c].alias(c) if c in swap else q(c) for c in docs.columns])
