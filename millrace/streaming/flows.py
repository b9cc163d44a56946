"""The row-local operators over streams, and language identification by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.clean import clean
from millrace.operators.langid import identify
from millrace.operators.segment import segment
from millrace.operators.sources import lines
from millrace.operators.tokenize import TokenResources, tokenize_udf


def read_documents(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    """A stream of Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def sentences(stream: DataFrame, metadata: str = "source") -> DataFrame:
    """Clean, tokenised sentences; stateless. Source ids are hashes of the metadata, as a stream has no dense order."""
    rows = segment(lines(stream.withColumn("source_id", F.xxhash64(metadata))))
    return clean(rows).withColumn("tokens", tokenize_udf(stream.sparkSession, TokenResources())(F.col("text")))


def counts_by_window(stream: DataFrame, time_col: str, late: str = "10 minutes", width: str = "1 hour", by: str = "event_type") -> DataFrame:
    """Rows per time window and key; rows later than the watermark are dropped."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, width), by).agg(F.count("*").alias("n")).select("window.start", "window.end", by, "n")


def identify_batches(stream: DataFrame, profile: DataFrame, keys: list[str], sink: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """A writer that runs the batch plan of language identification on each micro-batch and hands on its result."""
    return stream.writeStream.foreachBatch(lambda batch, number: sink(identify(batch, profile, keys), number))
