"""Source index and sentence identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINES_PER_SOURCE = 10_000_000


def source_index(df: DataFrame, metadata: str = "metadata", mode: str = "dense") -> DataFrame:
    """(source_id, metadata) of the distinct sources. Ids follow from the content, so a retry gives the same ones:
    ``dense`` numbers the sorted sources from 0 (one task orders the dimension), ``hash`` needs no order and serves
    streams and dimensions of any size."""
    own = df.select(F.col(metadata).alias("metadata")).distinct()
    if mode == "hash":
        return own.select(F.xxhash64("metadata").alias("source_id"), "metadata")
    return own.select((F.row_number().over(Window.orderBy("metadata")) - 1).cast("long").alias("source_id"), "metadata")


def with_source_id(df: DataFrame, index: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Joins the index; Spark broadcasts it where its measured size is under the session's threshold."""
    named = index.select("source_id", F.col("metadata").alias("_m"))
    return df.join(named, df[metadata].eqNullSafe(named["_m"])).drop("_m")


def sentence_id(source_id: Column, line_idx: Column) -> Column:
    return source_id * F.lit(LINES_PER_SOURCE) + line_idx


def lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per non-blank line, ``line_idx`` counting all lines of its text."""
    rest = [c for c in df.columns if c not in (text, "line_idx")]
    rows = df.select(*rest, F.posexplode(F.split(F.col(text), "\n")).alias("line_idx", text))
    return rows.withColumn("line_idx", F.col("line_idx").cast("long")).where(F.length(text) > 0)
