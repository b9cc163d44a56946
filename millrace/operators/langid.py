"""Language identification: word probabilities looked up for a sentence's words, summed by language."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from millrace.functions.text import lengths, words_arrow
from millrace.session import BATCH, SPREAD_BYTES, UNKNOWN_BYTES, ship, size_of

#: Subtracted from the least probability to make the penalty of an unknown word.
BELOW = 0.000001
#: Estimated bytes of rows that make a block; pairs of block and word that a task holds to tell them apart; rows, and sums of
#: rows and languages, that are worked on at once.
BLOCK_BYTES, MOST_PAIRS, SLICE_ROWS, SLICE_SUMS = 8 << 20, 2_000_000, 20_000, 1 << 22


def build_profile(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, word, freq, prob) from labelled texts; prob is the share of the language's words."""
    ship(df.sparkSession)
    rows = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = rows.mapInArrow(counter("lang"), f"lang {rows.schema['lang'].dataType.simpleString()}, word string, n long")
    counts = counts.groupBy("lang", "word").agg(F.sum("n").alias("freq"))
    total = counts.groupBy("lang").agg(F.sum("freq").alias("total"))
    return counts.join(F.broadcast(total), "lang").select("lang", "word", "freq", (F.col("freq") / F.col("total")).alias("prob"))  # one row per language


def profile_of(word_lists: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """The profile of word lists that state their totals (see read_word_lists)."""
    rows = word_lists.where(F.col("lang").isin(languages)) if languages else word_lists
    return rows.select("lang", "word", "freq", (F.col("freq") / F.col("total")).alias("prob")).where("prob > 0")


def least_probability(profile: DataFrame) -> DataFrame:
    """One row: min_prob, the value that stands for a word that a language doesn't know."""
    return profile.agg((F.min("prob") - BELOW).alias("min_prob"))


def _blocks(df: DataFrame) -> int:
    """How many blocks the rows of ``df`` make, from Spark's estimate of their bytes; some a core where they are few."""
    spark, size = df.sparkSession, size_of(df)
    if size >= UNKNOWN_BYTES:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, size // BLOCK_BYTES, min(3 * spark.sparkContext.defaultParallelism, 4 * size // SPREAD_BYTES))


def _counts(batches: list[pa.RecordBatch], by: str, text: str) -> pa.Table:
    """(by, word, n) of the words of some rows."""
    cut = words_arrow(pa.concat_arrays([x[text] for x in batches]))
    word, own = cut.flatten().dictionary_encode(), pa.concat_arrays([x[by] for x in batches]).dictionary_encode(null_encoding="encode")
    wide = max(1, len(word.dictionary))
    pair = np.repeat(own.indices.to_numpy().astype(np.int64), lengths(cut)) * wide + word.indices.to_numpy()
    if len(own.dictionary) * wide <= SLICE_SUMS:
        times = np.bincount(pair)
        found = np.flatnonzero(times)
        times = times[found]
    else:
        found, times = np.unique(pair, return_counts=True)
    return pa.table({by: own.dictionary.take(pa.array(found // wide)), "word": word.dictionary.take(pa.array(found % wide)), "n": pa.array(times, pa.int64())})


def counter(by: str, text: str = "text") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow: (by, word, n) of rows with these columns. Pairs are summed up in a buffer of a bounded number, so
    some come more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, held, n = [], 0, [], 0

        def out(more: bool) -> Iterator[pa.RecordBatch]:
            nonlocal rows, size, held, n
            if rows:
                held, rows, size = [*held, _counts(rows, by, text)], [], 0
                n += held[-1].num_rows
            if held and (not more or n > MOST_PAIRS):
                held = [pa.concat_tables(held).group_by([by, "word"], use_threads=False).aggregate([("n", "sum")]).rename_columns([by, "word", "n"])]
                n = held[0].num_rows
                if not more or n > MOST_PAIRS // 2:
                    yield from held[0].to_batches(8 * BATCH["spark.sql.execution.arrow.maxRecordsPerBatch"])
                    held, n = [], 0

        for batch in batches:
            rows.append(batch)
            size += batch.nbytes
            if size > BATCH["spark.sql.execution.arrow.maxBytesPerBatch"]:
                yield from out(True)
        yield from out(False)

    return run


def _summed(rows: pa.Table, known: pa.Table, keys: list[str]) -> pa.Table:
    """(keys, lang, n_words, total, found) of a block's rows, from the profile's rows (word, lang, prob) for the block's words."""
    known = known.group_by(["word", "lang"], use_threads=False).aggregate([("prob", "min")]).combine_chunks()
    vocabulary, langs = pc.unique(known["word"]), pc.unique(known["lang"])
    word = pc.index_in(known["word"], vocabulary).to_numpy()
    order = np.argsort(word, kind="stable")
    lang, prob = pc.index_in(known["lang"], langs).to_numpy()[order], known["prob_min"].to_numpy()[order]
    entries = np.bincount(word, minlength=len(vocabulary))  # a word's entries lie side by side
    first, wide, out = np.cumsum(entries) - entries, max(1, len(langs)), []
    rows = rows.combine_chunks()
    step = max(1, min(SLICE_ROWS, SLICE_SUMS // wide))
    for at in range(0, rows.num_rows if len(vocabulary) else 0, step):
        own = rows.slice(at, step)
        cut = words_arrow(pa.concat_arrays(own["__text"].chunks))
        n = lengths(cut)
        code = pc.index_in(cut.flatten(), vocabulary).fill_null(-1).to_numpy()
        row, code = np.repeat(np.arange(len(n)), n)[code >= 0], code[code >= 0]
        times = entries[code]
        entry = np.repeat(first[code] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        cell = np.repeat(row, times) * wide + lang[entry]
        total, found = np.bincount(cell, prob[entry], len(n) * wide), np.bincount(cell, minlength=len(n) * wide)
        hit = np.flatnonzero(found)
        of = pa.array(hit // wide)
        columns = {k: own[k].take(of) for k in keys} | {"__lang": langs.take(pa.array(hit % wide)), "__n": pa.array(n[hit // wide], pa.int32()), "__total": pa.array(total[hit]), "__found": pa.array(found[hit], pa.int64())}
        out.append(pa.table(columns))
    return pa.concat_tables(out) if out else None


def _sums(df: DataFrame, profile: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, lang, n_words, total, found), a row for each language that knows a word of a row of ``df``.

    Rows are dealt into blocks by their keys. Only the distinct words of a block meet the profile, and come back to the block with
    their probabilities, where words are looked up row by row in an Arrow function. So a word is moved once a block and language
    instead of once an occurrence, no common word makes a large group, and memory follows the block."""
    ship(df.sparkSession)
    n = _blocks(df)
    block = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias("__block")
    rows = df.select(*keys, F.col(text).alias("__text"), block).repartition(n, "__block")
    # all columns, so that this and the look-up below read the same exchange
    own = rows.mapInArrow(counter("__block", "__text"), "__block int, word string, n long")
    known = own.select("__block", "word").join(profile.select("word", "lang", "prob"), "word").select("__block", "word", "lang", F.col("prob").cast("double").alias("prob"))
    schema = StructType([*rows.select(*keys).schema.fields, StructField("__lang", profile.schema["lang"].dataType), *(StructField(c, t) for c, t in (("__n", IntegerType()), ("__total", DoubleType()), ("__found", LongType())))])
    empty = to_arrow_schema(schema).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = _summed(left, right, keys)
        return empty if out is None else out

    found = rows.groupBy("__block").cogroup(known.groupBy("__block")).applyInArrow(run, schema)
    return found.withColumnsRenamed({"__lang": "lang", "__n": "n_words", "__total": "total", "__found": "found"})


def scores(df: DataFrame, profile: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, lang, prob): the mean probability of a sentence's words in each language that knows any of them.

    The sums come block by block (see _sums) and are then dealt out by the keys, so what groups by these needs no further exchange.
    ``profile`` is read twice: give a written table."""
    known = _sums(df, profile, keys, text).repartition(*keys).groupBy(*keys, "lang", "n_words").agg(F.sum("total").alias("total"), F.sum("found").alias("found"))
    missing = F.greatest(F.col("n_words") - F.col("found"), F.lit(0))
    known = known.join(F.broadcast(least_probability(profile)), F.lit(True))  # a single row
    return known.select(*keys, "lang", _mean(F.col("total") + F.col("min_prob") * missing, F.col("n_words")).alias("prob"))


def _mean(total: Column, n: Column) -> Column:
    return F.round(total / n, 8)


def identify(df: DataFrame, profile: DataFrame, keys: list[str], text: str = "text", keep_unknown: bool = False) -> DataFrame:
    """(keys, lang, prob) of the best language; of equal ones the first by name. Sentences without a known word have
    no row, or nulls with ``keep_unknown``."""
    best = scores(df, profile, keys, text).groupBy(*keys).agg(F.min(F.struct((-F.col("prob")).alias("p"), F.col("lang").alias("l"))).alias("b"))
    best = best.select(*keys, F.col("b.l").alias("lang"), (-F.col("b.p")).alias("prob"))
    return df.select(*keys).join(best, keys, "left") if keep_unknown else best


def unknown(df: DataFrame, profile: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Rows of ``df`` in which no language knows a word."""
    return df.join(scores(df, profile, keys, text).select(*keys).distinct(), keys, "left_anti")


def ranked(df: DataFrame, profile: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """All scores with their rank in the sentence."""
    order = Window.partitionBy(*keys).orderBy(F.col("prob").desc(), "lang")
    return scores(df, profile, keys, text).withColumn("rank", F.row_number().over(order))
