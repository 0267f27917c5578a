"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of a text is addressed by its SHA-256.  The ledger holds which
(blob, rule, rule version) triples have been scanned, and the findings of each; a
scan reads the texts of blobs that lack a triple, once each, and runs only the
missing rules on them.  Findings are joined back to every path that has the blob,
so a thousand copies, or a thousand old versions, are scanned once.

Spans come without a user-defined function: splitting a text at a rule's matches
gives the gaps between them, and the running sum of the lengths of gaps and matches
gives where each match begins and ends, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .common import q


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (leftmost, non-overlapping) whose ``group`` has ``least`` characters or more.

    ``hint``, if given, is a pattern without which ``pattern`` never matches, cheap to
    look for.  A rule that changes gets a new version, and only that is scanned anew.
    """

    name: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str | None = None


BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        r"[:=]",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    # as the longest runs of [0-9a-f], without stopping at each short one
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

MORE_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----", 0, 1),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 20),
)

RULES = BASE_RULES + MORE_RULES


def blob_of(text):
    """Content address; a null text is an empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class Ledger:
    """Scanned triples ``(blob, rule, version)`` and findings ``(blob, rule, version, start, end)``.

    Both are lists of Parquet tables in the scratch folder, one of each for a scan.
    """

    SCANNED = "blob binary, rule string, version int"
    FINDINGS = "blob binary, rule string, version int, start bigint, end bigint"

    def __init__(self, spark: SparkSession, scratch: Scratch | None = None):
        self.spark, self.scratch = spark, scratch or Scratch(spark)
        self._scanned: list[DataFrame] = []
        self._findings: list[DataFrame] = []

    def _all(self, tables: list[DataFrame], schema: str) -> DataFrame:
        rows = tables[0] if tables else self.spark.createDataFrame([], schema)
        for table in tables[1:]:
            rows = rows.unionByName(table)
        return rows

    def scanned(self) -> DataFrame:
        return self._all(self._scanned, self.SCANNED)

    def findings(self) -> DataFrame:
        return self._all(self._findings, self.FINDINGS)

    def scan(self, texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan ``texts(text)`` for the triples that are missing; returns those triples.

        Texts that repeat are reduced to one row a blob before any rule runs; the
        reduction combines within each task first, so a blob of very many rows isn't
        gathered in one place.
        """
        blobs = texts.select(blob_of(q("text")).alias("blob"), F.coalesce(q("text"), F.lit("")).alias("text"))
        blobs = blobs.dropDuplicates(["blob"])
        if self._scanned:
            label = F.concat_ws("@", "rule", F.col("version").cast("string"))
            done = self.scanned().groupBy("blob").agg(F.collect_set(label).alias("done"))
            blobs = blobs.join(done, "blob", "left").where(
                F.col("done").isNull() | (F.size(F.array_except(F.array(*[F.lit(_label(r)) for r in rules]), "done")) > 0)
            )
        else:
            blobs = blobs.withColumn("done", F.lit(None).cast("array<string>"))
        todo = [~F.coalesce(F.array_contains("done", _label(r)), F.lit(False)) for r in rules]
        found = blobs.select(
            "blob",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), _pieces(r, t).alias("at"))
                        for r, t in zip(rules, todo, strict=True)
                    ]
                )
            ).alias("r"),
        ).where("r.at is not null")
        pieces = self.scratch.save(found.select("blob", "r.*"), "scan")
        new = self.scratch.save(pieces.select("blob", "rule", "version"), "scanned")
        findings = self.scratch.save(_spans(pieces, rules), "findings")
        self.scratch.drop(pieces)
        self._scanned.append(new)
        self._findings.append(findings)
        return new


def _label(rule: Rule) -> str:
    return f"{rule.name}@{rule.version}"


def _pieces(rule: Rule, todo):
    """Null if the triple isn't to be scanned, else an array of (gap, match, kept) lengths, one for each match."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)
    lengths = F.arrays_zip(
        F.transform(gaps, F.char_length).alias("gap"),
        F.transform(whole, F.char_length).alias("match"),
        F.transform(kept, F.char_length).alias("kept"),
    )
    none = F.array().cast("array<struct<gap:int,match:int,kept:int>>")
    some = F.when(F.regexp_like(text, pattern), lengths).otherwise(none)
    if rule.hint:
        some = F.when(F.regexp_like(text, F.lit(rule.hint)), some).otherwise(none)
    return F.when(todo, some)


def _spans(pieces: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Running sums of a blob's gaps and matches, by rule; matches whose group is too short go.

    A window holds the matches of one rule in one text.
    """
    rows = pieces.select("blob", "rule", "version", F.posexplode("at").alias("pos", "p")).where("p.match is not null")
    upto = Window.partitionBy("blob", "rule", "version").orderBy("pos")
    end = F.sum((F.col("p.gap") + F.col("p.match")).cast("bigint")).over(upto)
    least = F.lit(None).cast("int")
    for r in rules:
        least = F.when((F.col("rule") == r.name) & (F.col("version") == r.version), r.least).otherwise(least)
    spans = rows.select(
        "blob", "rule", "version", (end - F.col("p.match")).alias("start"), end.alias("end"), F.col("p.kept").alias("kept")
    )
    return spans.where(F.col("kept") >= least).drop("kept")


def blob_digests(findings: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """One row for each blob with findings: a count for each base rule, and the sorted spans, base ones and all."""
    current = F.lit(False)
    order = F.lit(len(rules))
    for i, r in enumerate(rules):
        own = (F.col("rule") == r.name) & (F.col("version") == r.version)
        current, order = current | own, F.when(own, i).otherwise(order)
    spans = findings.where(current).withColumn("kind", order)
    text = lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))
    listed = F.sort_array(F.collect_list(F.struct("start", "kind", "end", "rule")))
    rows = spans.groupBy("blob").agg(listed.alias("all"))
    base_only = F.filter("all", lambda s: s["kind"] < len(base))
    number = lambda i: F.size(F.filter("all", lambda s: s["kind"] == i)).cast("bigint")
    return rows.select(
        "blob",
        *[number(i).alias(f"n_{r.name}") for i, r in enumerate(base)],
        F.array_join(F.transform(base_only, text), ",").alias("base_spans"),
        F.array_join(F.transform("all", text), ",").alias("spans"),
    )


def secret_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ledger: Ledger | None = None,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_spans, spans)`` for every row of ``docs``.

    Rows are paths; their texts are the blobs.  With a ledger, only what it lacks is
    scanned, and it keeps what is found.  ``spans`` lists ``kind:start:end`` by start, then kind
    as listed in ``rules``.  A null text is an empty one, without findings; repeated rows and
    null ids get a row each; an empty table gives an empty result.  Other columns are ignored.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.scan(docs.select(q(text_col).alias("text")), rules)
    paths = docs.select(q(id_col).alias("doc_id"), blob_of(q(text_col)).alias("blob"))
    digests = blob_digests(ledger.findings(), rules)
    counts = [F.coalesce(f"n_{r.name}", F.lit(0)).cast("bigint").alias(f"n_{r.name}") for r in BASE_RULES]
    return paths.join(digests, "blob", "left").select(
        "doc_id",
        *counts,
        F.coalesce("base_spans", F.lit("")).alias("base_spans"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
