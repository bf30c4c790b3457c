"""Helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import run_dir

# Whitespace between words: blank and tab to carriage return.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it again: later jobs neither repeat the work
    nor see other values when an executor is lost."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_text(df: DataFrame, function: Callable, schema: str, text: str = "text") -> DataFrame:
    """``df`` with the columns of ``schema``, a pandas function of the text alone.

    The other columns stay in the JVM. Columns of the new names are replaced. The function counts as not
    deterministic, so that no filter or later column runs it twice.
    """
    made = F.pandas_udf(function, schema).asNondeterministic()
    new = [f.name for f in made.returnType.fields]
    kept = [c for c in df.columns if c not in new]
    return df.withColumn("_made", made(F.col(text))).select(*kept, "_made.*")


KEY = ["_key1", "_key2"]


def row_key(df: DataFrame) -> list[Column]:
    """128 bits of hash over all columns, nulls told apart: equal rows have equal keys."""
    columns = [F.col(f"`{f.name}`").cast("string") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
               for f in df.schema]
    seen = [*columns, *[c.isNull() for c in columns]]
    return [F.xxhash64(F.lit(i), *seen).alias(name) for i, name in enumerate(KEY)]


def different_rows(df: DataFrame) -> DataFrame:
    """The different rows of ``df`` as the struct ``_doc`` with their key; repeats fall together before the shuffle."""
    return df.select(*row_key(df), F.struct("*").alias("_doc")).groupBy(*KEY).agg(F.first("_doc").alias("_doc"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_hot(keyed: DataFrame, keys: list[str], item: str, limit: int) -> DataFrame:
    """Deals the rows of each key into groups of bounded size in which every two rows of the key meet.

    A key of up to ``limit`` rows is one group; keys of a single row go. A larger key is cut by a
    hash of ``item`` into chunks of about ``limit`` rows, and each pair of chunks is one group. Adds
    ``chunk`` (of the row), ``low`` and ``high`` (the group's two chunks).
    """
    sizes = (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
             .select(*keys, F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("_chunks")))
    rows = keyed.join(sizes, keys).withColumn(
        "chunk", F.pmod(F.xxhash64(F.lit(7), item), F.col("_chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    return (rows.withColumn("_other", other)
            .withColumn("low", F.least("chunk", "_other"))
            .withColumn("high", F.greatest("chunk", "_other"))
            .drop("_chunks", "_other"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))
