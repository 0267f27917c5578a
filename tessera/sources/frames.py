"""Readers, the labelled/unlabelled frame, unions and sinks.

The reference keeps a labelled and an unlabelled table and glues them by row
position.  Here both parts live in ONE frame with an explicit key and a
``split`` column; "splitting back" is a filter, never positional slicing.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Texts that stand for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# What a column's texts have been so far; a column's type follows from the union of its values' marks.
_INT, _DOUBLE, _BOOLEAN, _DATE, _TEXT = 1, 2, 4, 8, 16


def _mark(c: Column, null_tokens: Sequence[str]) -> Column:
    """The mark of one text (0: a missing value)."""
    digits = c.rlike(r"^[ \t]*[+-]?[0-9]+[ \t]*$")
    number = c.rlike(r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$") | c.rlike("^[+-]?(?i:inf|infinity)$")
    return (
        F.when(c.isNull() | c.isin(*null_tokens), 0)
        .when(digits & F.trim(c).try_cast("bigint").isNotNull(), _INT)
        .when(number, _DOUBLE)
        .when(c.isin("True", "TRUE", "true", "False", "FALSE", "false"), _BOOLEAN)
        .when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull(), _DATE)
        .otherwise(_TEXT)
    )


def infer_types(df: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """(column, type, n, n_missing) of text columns, from all rows in one pass.

    Marks are joined by bitwise or, so partial results merge in any order and a late value
    widens the type: whole numbers with fractions are double, whole numbers beyond 64 bits
    too; only booleans boolean, only ISO dates date; any other mix is text.  A column without
    values is double, as an all-missing one is in pandas.
    """
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.bit_or(_mark(F.col(f"`{c}`"), null_tokens)), F.lit(0)).alias("marks"),
            F.count("*").alias("n"),
            F.count_if(_mark(F.col(f"`{c}`"), null_tokens) == 0).alias("n_missing"),
        )
        for c in df.columns
    ]
    marks = F.col("marks")
    kind = (
        F.when(marks == _INT, "bigint")
        .when(marks.isin(0, _DOUBLE, _INT | _DOUBLE), "double")
        .when(marks == _BOOLEAN, "boolean")
        .when(marks == _DATE, "date")
        .otherwise("string")
    )
    found = df.agg(F.array(*per_column).alias("found")).select(F.inline("found"))
    return found.select("column", kind.alias("type"), "n", "n_missing")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """CSV with a header, quoted fields as pandas reads them.

    With a schema there is no pass over the data.  Without one, all columns are read as text
    and typed by :func:`infer_types` over all rows (one pass; the driver receives one row per
    column); ``null_tokens`` are missing values.
    """
    if schema is not None:
        return spark.read.schema(schema).option("header", True).csv(path)
    text = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    kinds = {r["column"]: r["type"] for r in infer_types(text, null_tokens).collect()}
    columns = []
    for c in text.columns:
        value = F.when(~F.col(f"`{c}`").isin(*null_tokens), F.col(f"`{c}`"))
        columns.append((value if kinds[c] == "string" else F.trim(value).cast(kinds[c])).alias(c))
    return text.select(*columns)


def labelled_frame(
    labelled: DataFrame, unlabelled: DataFrame, target: str, split: str = "split",
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """One frame with a provenance column; the target is NULL on unlabelled rows."""
    a = labelled.withColumn(split, F.lit(names[0]))
    b = unlabelled.withColumn(split, F.lit(names[1]))
    return a.unionByName(b, allowMissingColumns=True)


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def split_back(df: DataFrame, value: str, split: str = "split") -> DataFrame:
    return df.where(F.col(split) == F.lit(value))


def output_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for job outputs."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "outputs", f"{name}-{uuid.uuid4().hex}")


MANIFEST = "_manifest.json"


class _Store:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway, conf = spark.sparkContext._jvm, spark.sparkContext._gateway, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def read(self, path: str) -> str | None:
        if not self.fs.exists(self.path(path)):
            return None
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, content: str) -> None:
        """The file has the old content or the new one at any time: written aside, then renamed over."""
        aside = f"{path}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(aside), False)
        stream.write(content.encode())
        stream.close()
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        self.context.rename(self.path(aside), self.path(path), options)

    def files(self, path: str) -> dict[str, int]:
        """Data files below a folder and their lengths."""
        found, listing, root = {}, self.fs.listFiles(self.path(path), True), self.fs.makeQualified(self.path(path)).toString()
        while listing.hasNext():
            status = listing.next()
            name = status.getPath().toString()[len(root) + 1 :]
            if not name.rpartition("/")[2].startswith(("_", ".")):
                found[name] = status.getLen()
        return found

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def folders(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(path)) if s.isDirectory()]


def commit_output(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), options: dict | None = None) -> str:
    """Write ``df`` as the new contents of the output ``path``; returns the folder of this version.

    The rows are staged in a folder of their own; when all tasks have committed, a manifest
    that lists its files takes the place of the old one in a single rename.  Until then, and
    if the write fails at any point, readers (:func:`committed_path`) see the old version.  A
    repeated write is a new version.  The version before the current one stays, for readers
    that have begun; older ones and remains of failed writes go.
    """
    spark = df.sparkSession
    store = _Store(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    df.write.mode("error").options(**(options or {})).partitionBy(*partition_by).format(fmt).save(f"{path}/{version}")
    old = store.read(f"{path}/{MANIFEST}")
    before = json.loads(old)["version"] if old else None
    manifest = {"version": version, "previous": before, "format": fmt, "files": store.files(f"{path}/{version}")}
    store.replace(f"{path}/{MANIFEST}", json.dumps(manifest, sort_keys=True))
    for name in store.folders(path):
        if name.startswith("v-") and name not in (version, before):
            store.delete(f"{path}/{name}")
    return f"{path}/{version}"


def committed_path(spark: SparkSession, path: str) -> str:
    """The folder of the current version; an error if there is none, or if it lacks a file of its manifest."""
    store = _Store(spark, path)
    content = store.read(f"{path}/{MANIFEST}")
    if content is None:
        raise FileNotFoundError(f"nothing has been committed to {path}")
    manifest = json.loads(content)
    folder = f"{path}/{manifest['version']}"
    if store.files(folder) != manifest["files"]:
        raise OSError(f"{folder} does not hold the files of its manifest")
    return folder


def write_predictions(df: DataFrame, path: str, key: str, label: str) -> str:
    """``to_csv(index=False)`` of ``(key, label)``: a header per part file; see :func:`commit_output`."""
    return commit_output(df.select(key, label), path, "csv", options={"header": True})


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> str:
    """One output folder per parameter value (``by=threshold``); see :func:`commit_output`."""
    return commit_output(df, path, fmt, [by])


def table_profile(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
