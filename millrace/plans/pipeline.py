"""End-to-end text pipelines: segment first (A) and clean first (B)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import utf16_length
from millrace.operators.clean import clean
from millrace.operators.pos import tagger
from millrace.operators.segment import SegmentResources, segment
from millrace.operators.sources import lines, sentence_id, source_index, with_source_id
from millrace.sources.resources import RULES, Rule


def sentences(df: DataFrame, metadata: str, res: SegmentResources | None = None) -> DataFrame:
    """(source_id, sent_id, seg, text) of tagged texts: lines, source ids, then sentences; no shuffle but the index."""
    rows = lines(df.select(F.col(metadata).alias("metadata"), "text"))
    rows = with_source_id(rows, source_index(df, metadata))
    rows = rows.select("source_id", sentence_id(F.col("source_id"), F.col("line_idx")).alias("sent_id"), "text")
    return segment(rows, res)


def finish(rows: DataFrame) -> DataFrame:
    """Tokens, tags and lengths of clean sentences."""
    done = rows.withColumn("__done", tagger(rows.sparkSession)(F.col("text")))
    return done.select(*rows.columns, "__done.tokens", "__done.tagged", utf16_length(F.col("text")).alias("n_chars"))


def segment_first(df: DataFrame, metadata: str = "source", rules: Mapping[int, Rule] = RULES) -> DataFrame:
    """Pipeline A: segment, clean, tokenise, tag."""
    return finish(clean(sentences(df, metadata), rules))


def clean_first(df: DataFrame, metadata: str = "source", rules: Mapping[int, Rule] = RULES) -> DataFrame:
    """Pipeline B: clean the lines, then segment, tokenise, tag."""
    rows = clean(lines(df.select(F.col(metadata).alias("metadata"), "text")), rules)
    rows = with_source_id(rows, source_index(df, metadata))
    return finish(segment(rows.select("source_id", sentence_id(F.col("source_id"), F.col("line_idx")).alias("sent_id"), "text")))
