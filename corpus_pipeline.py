"""The corpus pipeline: toxicity, near-dedup, substring dedup, benchmark decontamination, SentencePiece.

Columns beside doc_id, text and n_chars pass through whatever their names; an empty table gives an empty one. Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, minhash, spm, substrings, toxicity
from millrace.llm.common import forget, materialise, table


def _held(docs: DataFrame) -> DataFrame:
    """Rows as one struct under a name of this run, with the id and the text's hash: no column can clash, whatever its name."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    row = docs.toDF(*names)
    at = {c: F.col(n) for c, n in zip(reversed(docs.columns), reversed(names), strict=True)}
    key = F.struct(at["doc_id"].cast("long").alias("i"), F.xxhash64(at["text"].cast("string")).alias("t"))
    return row.select(F.struct(*names).alias("row"), key.alias("key"))


def _keys(found: DataFrame, *more) -> DataFrame:
    return found.select(F.struct(F.col("doc_id").alias("i"), F.col("th").alias("t")).alias("found"), *more)


def _same() -> Column:
    return F.col("key.i").eqNullSafe(F.col("found.i")) & (F.col("key.t") == F.col("found.t"))


def _columns(docs: DataFrame, rows: DataFrame, new: dict[str, Column] | None = None) -> DataFrame:
    """The given columns again, some of them with new values."""
    new = new or {}
    return rows.select(*[new.get(c, F.col(f"row.c{k}")).alias(c) for k, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject, with all their columns. Null and empty texts are scored like others, so
    they stay; repeated rows share their text's fate; a text of any length is scored whole."""
    return toxicity.clean(docs, toxicity.chain_for(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by five-word shingles (similarity 0.8 or more) the document with the smallest id (a null
    id only where there is no other); of repeated rows one, and of rows of one id and text that differ elsewhere one as well.
    Candidates are SimHash components (fingerprints within 4 bits, by pivot distance tables), and bands of minima for pairs beyond."""
    kept = minhash.representatives(docs)
    rows = _held(docs).join(_keys(kept), _same()).dropDuplicates(["key"])
    return _columns(docs, rows)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows; all rows stay, untouched texts as they are (null included), and
    ``n_chars`` follows the text."""
    kept = substrings.removals(docs).where("n_removed > 0").dropDuplicates(["doc_id", "th"])
    rows = _held(docs).join(_keys(kept, F.col("kept").alias("text")), _same(), "left")
    old = {c: F.col(f"row.c{k}") for k, c in enumerate(docs.columns)}
    new = {"text": F.coalesce("text", old["text"])}
    if "n_chars" in old:
        new["n_chars"] = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(old["n_chars"])
    return _columns(docs, rows, new)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs, with all their columns; null and wordless texts stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document; null text has null ids, repeated rows stay."""
    return spm.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece", to_tokens),
]
#: Classifier, components and tokenizer are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, path = materialise(docs, f"pipeline-{k}")
            if before:
                forget(spark, before)
            before = path
    return docs
