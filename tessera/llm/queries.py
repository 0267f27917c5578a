"""Registered queries of the training-data operators, over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .bpe import bpe_decode, bpe_encode
from .common import crc_fold, read_table
from .decontaminate import contaminated
from .lexical import ranked_search
from .licences import licence_scan
from .line_dedup import added_columns, line_dedup
from .mix import mix_counts
from .phrases import collocations
from .pii import pii_report
from .quality import fit_quality, quality_score
from .secrets import RULES, secret_scan
from .simhash import near_duplicates
from .toxicity import fit_toxicity, toxicity_score

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


@_register("op1_mix")
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of the sources takes of each document, beside the source's target."""
    return mix_counts(read_table(spark, sf_dir, "documents"))


@_register("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and the least doc_id of its near-duplicates; one row per row, null ids and repeated rows included."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@_register("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data under pseudonyms, and how much of each kind it held; null texts stay null."""
    return pii_report(read_table(spark, sf_dir, "documents"), key="registered-query")


@_register("op4_ann")
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th one; vectors that are null, zero or not finite take no part."""
    return nearest(read_table(spark, sf_dir, "embeddings"), lambda c: c % 20 == 0)


def _secrets_sql() -> str:
    """The same pieces in DuckDB: gaps between a rule's matches, and running sums of their lengths."""
    lit = lambda x: "'" + x.replace("'", "''") + "'"
    pieces = " UNION ALL ".join(
        f"""SELECT doc_id, {lit(r.name)} AS kind, {i} AS ord, {r.least} AS least,
        unnest(range(len(regexp_extract_all(text, {lit(r.pattern)}, 0)))) AS pos,
        unnest(regexp_extract_all(text, {lit(r.pattern)}, 0)) AS whole,
        unnest(regexp_extract_all(text, {lit(r.pattern)}, {r.group})) AS part,
        unnest(list_slice(string_split_regex(text, {lit(r.pattern)}), 1, -2)) AS gap FROM t"""
        for i, r in enumerate(RULES)
    )
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord)"
    counts = ", ".join(f"count(*) FILTER (WHERE ord = {i}) AS n_{r.name}" for i, r in enumerate(RULES[:3]))
    zeros = ", ".join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in RULES[:3])
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
pieces AS ({pieces}),
ends AS (SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, ord ORDER BY pos) AS upto FROM pieces),
spans AS (
  SELECT doc_id, kind, ord, CAST(upto - length(whole) AS BIGINT) AS s, CAST(upto AS BIGINT) AS e
  FROM ends WHERE length(part) >= least),
byd AS (
  SELECT doc_id, {counts}, {listed} FILTER (WHERE ord < 3) AS base, {listed} AS spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN byd ON t.doc_id = byd.doc_id"""


@_register("op5_secrets", _secrets_sql())
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text, by kind and span; a null text is an empty one, equal rows have equal spans."""
    found = secret_scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


_LINES_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.doc_id, l.pos, l.line, (f.k IS NOT NULL AND f.keeper <> l.doc_id) AS gone
  FROM keyed l LEFT JOIN frequent f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@_register("op6_line_dedup", _LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after frequent ones are dropped; a null or empty text is one empty line."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    all_, kept = added_columns(docs)
    n, left = F.size(all_).cast("bigint"), F.size(kept).cast("bigint")
    return line_dedup(docs).select(
        "doc_id",
        n.alias("n_lines"),
        (n - left).alias("n_dropped"),
        F.sha2(F.array_join(kept, "\n"), 256).alias("kept_sha256"),
    )


@_register("op7_licences")
def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in every text, with their spans; a null or empty text has none."""
    found = licence_scan(read_table(spark, sf_dir, "documents"))
    spans = F.transform("found", lambda f: F.concat_ws(":", f["family"], f["start"].cast("string"), f["end"].cast("string")))
    best = F.array_max(F.transform("found", lambda f: F.struct(f["probability"], f["family"])))
    return found.select(
        "doc_id", "families", "n_licences", best["family"].alias("best_family"), best["probability"].alias("best_probability"),
        F.array_join(spans, ",").alias("spans"),
    )


@_register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by a model of labelled rows outside the held-out fold; null and empty texts score as clean ones."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = crc_fold(4, 2)
    model = fit_toxicity(docs, labels, held_out)
    scored = docs.select("doc_id", toxicity_score(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by a model of labelled rows outside the held-out fold; null and empty texts are scored alike."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held_out = crc_fold(3, 1)
    model = fit_quality(docs, labels, held_out)
    scored = docs.select("doc_id", quality_score(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_register("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, with the item and its score; empty tables give no rows."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
i AS (
  SELECT row_number() OVER () AS iid, item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
c AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM d),
m AS (SELECT rid, doc_id, 100 - 75 + ((75 * len(ts) * nn) // ll) AS m FROM d, c),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d)
      WHERE t IN (SELECT t FROM i) GROUP BY rid, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY t, nn),
s AS (
  SELECT iid, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN p USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 10
"""


@_register("op11_lexical_search", _SEARCH_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item's ten best documents of the whole table."""
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _phrases_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    grams = " UNION ALL ".join(
        f"SELECT lang, unnest(list_transform(range(1, len(ws) - {k} + 2), lambda i: ws[i:i + {k} - 1])) AS g FROM p" for k in range(1, 5)
    )
    return f"""
WITH p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
f AS (SELECT lang, g, count(*) AS f FROM ({grams}) GROUP BY lang, g HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM c),
scored AS (
  SELECT cuts.lang, cuts.g, a, k, x.f AS l, y.f AS r, CAST((2000000 * CAST(a AS HUGEINT)) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:k]
  JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k + 1:len(cuts.g)]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, s, max(a) AS longer FROM (
    SELECT lang, a, unnest(list_concat(list_transform(range(1, len(g)), lambda i: g[i:i + 1]),
      CASE WHEN len(g) = 4 THEN [g[1:3], g[2:4]] ELSE [] END)) AS s FROM c WHERE len(g) > 2) GROUP BY lang, s),
kept AS (
  SELECT best.lang, array_to_string(best.g, ' ') AS phrase, a, l, r, score
  FROM best LEFT JOIN inner_ ON inner_.lang = best.lang AND inner_.s = best.g
  WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT))
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n ON n.lang = kept.lang
QUALIFY rank <= 2000
"""


@_register("op12_collocations", _phrases_sql())
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words."""
    return collocations(read_table(spark, sf_dir, "documents"))


@_register("op13_bpe")
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts encoded and decoded by the 49k word vocabulary, as digests."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe_decode(bpe_encode(docs, vocabulary), vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
