"""Readers and writers of the text formats: tagged sources, framed records, word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import utf16_length

START, END = "<source>", "</source>"


def read_tagged(spark: SparkSession, path: str, index: bool = True) -> DataFrame:
    """(metadata, line_idx, text) of files in which ``<source>header</source>`` goes before each source's lines.

    A chunk without the end tag is dropped; blank lines are skipped but counted in line_idx."""
    chunks = spark.read.option("lineSep", START).text(path).where(F.instr("value", END) > 0)
    cut = F.instr("value", END)
    rows = chunks.select(F.concat(F.lit(START), F.col("value").substr(F.lit(1), cut + len(END) - 1)).alias("metadata"), F.split(F.col("value").substr(cut + len(END), F.length("value")), "\n").alias("lines"))
    rows = rows.select("metadata", F.posexplode("lines").alias("line_idx", "text")).select("metadata", F.col("line_idx").cast("long").alias("line_idx"), F.regexp_replace("text", "\r$", "").alias("text"))
    rows = rows.where(F.length("text") > 0)
    return rows if index else rows.drop("line_idx")


def dropped_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row: chunks of tagged files and how many of them have no end tag, so that their body is dropped."""
    chunks = spark.read.option("lineSep", START).text(path).where(F.length(F.trim("value")) > 0)
    return chunks.agg(F.count("*").alias("chunks"), F.count_if(F.instr("value", END) == 0).alias("dropped"))


def read_plain(spark: SparkSession, path: str) -> DataFrame:
    """(metadata, text) of files without headers; metadata is empty."""
    return spark.read.text(path).select(F.lit("").alias("metadata"), F.col("value").alias("text")).where(F.length("text") > 0)


def header_field(metadata: Column, name: str) -> Column:
    """One of the inner fields of a header, null if it isn't there."""
    got = F.regexp_extract(metadata, f"(?s)<{name}>(.*?)</{name}>", 1)
    return F.when(got != "", got)


def with_header_fields(df: DataFrame) -> DataFrame:
    """Adds ``source``: a struct of the header's known fields."""
    names = ("location", "date", "user", "original_encoding", "language")
    return df.withColumn("source", F.struct(*[header_field(F.col("metadata"), n).alias(n) for n in names]))


def framed(text: Column, source_id: Column) -> Column:
    """``(length,text,id)``: the length in UTF-16 units makes any text safe."""
    return F.concat(F.lit("("), utf16_length(text).cast("string"), F.lit(","), text, F.lit(","), source_id.cast("string"), F.lit(")"))


def unframed(value: Column) -> Column:
    """Struct (n_chars, text, source_id) of a framed record; null where it isn't one.

    The id follows the last comma, the text is what lies between; its length is checked."""
    n = F.regexp_extract(value, r"(?s)^\((\d+),", 1)
    text = F.regexp_extract(value, r"(?s)^\(\d+,(.*),(-?\d+)\)$", 1)
    key = F.regexp_extract(value, r"(?s)^\(\d+,.*,(-?\d+)\)$", 1)
    good = (key != "") & (utf16_length(text) == F.try_to_number(n, F.lit("9999999999")).cast("int"))
    return F.when(good, F.struct(n.cast("int").alias("n_chars"), text.alias("text"), key.cast("long").alias("source_id")))


def read_framed(spark: SparkSession, path: str) -> DataFrame:
    """(n_chars, text, source_id) of framed text files; other lines are dropped."""
    rows = spark.read.text(path).select(unframed(F.col("value")).alias("r")).where("r IS NOT NULL")
    return rows.select("r.*")


def write_framed(df: DataFrame, path: str, text: str = "text", source_id: str = "source_id") -> None:
    df.select(framed(F.col(text), F.col(source_id))).write.mode("overwrite").text(path)


def write_source_index(index: DataFrame, path: str, files: int = 5) -> None:
    """``(metadata,id)`` lines in a few files: the index is a dimension."""
    index.coalesce(files).select(F.concat(F.lit("("), "metadata", F.lit(","), F.col("source_id").cast("string"), F.lit(")"))).write.mode("overwrite").text(path)


def write_languages(df: DataFrame, path: str) -> None:
    """One folder per language."""
    df.write.mode("overwrite").partitionBy("lang").parquet(path)


def read_word_lists(spark: SparkSession, path: str, languages: list[str] | None = None) -> DataFrame:
    """(lang, word, freq, total) of ``<lang>.words`` files (or folders of one file): total frequency first, then frequency, tab, word."""
    rows = spark.read.text(f"{path.rstrip('/')}/*.words", wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.words(?:/[^/]*)?$", 1).alias("lang"), F.split("value", "\r?\n").alias("rows"))
    if languages:
        rows = rows.where(F.col("lang").isin(languages))
    total = F.expr("try_cast(trim(rows[0]) AS long)")
    rows = rows.select("lang", total.alias("total"), F.explode(F.slice("rows", 2, 1 << 30)).alias("row")).where(F.col("row").rlike(r"^\d+\t[^\t]+$"))
    rows = rows.select("lang", F.split("row", "\t")[1].alias("word"), F.split("row", "\t")[0].cast("long").alias("freq"), "total")
    return rows.groupBy("lang", "word").agg(F.sum("freq").alias("freq"), F.first("total").alias("total"))
