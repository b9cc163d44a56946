"""Sentence cleaning: rules compiled to columns, first hits, reports, entity replacement."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import replace
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import quoted, utf16_length, utf16_length_sql
from millrace.session import ship
from millrace.sources.resources import ENTITIES, RULES, Rule, rejected_characters, rejected_java


#: Rows or bytes of text that rules look at in one go.
GATHER_ROWS, GATHER_BYTES = 1 << 16, 16 << 20


def failed(rule: Rule, text: Column) -> Column:
    """Whether the rule rejects the text: all of its criteria fail."""
    parts = []
    if rule.pattern:
        parts.append(text.rlike(rule.pattern))
    if rule.min_length:
        parts.append(utf16_length(text) < rule.min_length)
    if rule.max_length:
        parts.append(utf16_length(text) > rule.max_length)
    if rule.chars and (rule.ratio or rule.count):
        left = utf16_length(F.translate(text, rule.chars, ""))
        if rule.ratio:  # single precision, as the limit is
            parts.append((utf16_length(text) / (left + 1)).cast("float") > F.lit(rule.ratio).cast("float"))
        else:
            parts.append(utf16_length(text) - left >= rule.count)
    if rule.hex_pattern:
        parts.append(text.rlike(rejected_java(rule.hex_pattern)))
    return reduce(and_, parts)


def failed_sql(rule: Rule, text: str) -> str:
    """The same for DuckDB (whose regular expressions have no look-around)."""
    parts, size = [], utf16_length_sql
    if rule.pattern:
        parts.append(f"regexp_matches({text}, {quoted(rule.pattern)})")
    if rule.min_length:
        parts.append(f"{size(text)} < {rule.min_length}")
    if rule.max_length:
        parts.append(f"{size(text)} > {rule.max_length}")
    if rule.chars and (rule.ratio or rule.count):
        left = size(f"translate({text}, {quoted(rule.chars)}, '')")
        if rule.ratio:
            parts.append(f"CAST(CAST({size(text)} AS DOUBLE) / ({left} + 1) AS FLOAT) > CAST({rule.ratio} AS FLOAT)")
        else:
            parts.append(f"{size(text)} - {left} >= {rule.count}")
    if rule.hex_pattern:
        parts.append(f"regexp_matches({text}, {quoted(rejected_characters(rule.hex_pattern))})")
    return "(" + " AND ".join(parts) + ")"


def _units(texts: pa.Array) -> np.ndarray:
    """Lengths in UTF-16 units: code points, and one more for each above U+FFFF (whose UTF-8 begins with F0 or more)."""
    n = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data, ends = np.frombuffer(texts.buffers()[2] or b"", np.uint8), np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    wide = np.flatnonzero(data[ends[0] : ends[-1]] >= 0xF0) + ends[0]
    return n + np.bincount(np.searchsorted(ends, wide, "right") - 1, minlength=len(n)) if len(wide) else n


def _gathered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Larger arrays of the same rows: patterns are compiled anew for each array, some in milliseconds."""
    held, rows, size = [], 0, 0
    for texts in batches:
        held.append(texts)
        rows, size = rows + len(texts), size + texts.nbytes
        if rows >= GATHER_ROWS or size >= GATHER_BYTES:
            yield pa.concat_arrays(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.concat_arrays(held)


def in_arrow(rule: Rule) -> bool:
    """Whether the rule's pattern is one for RE2, which DuckDB and Arrow have: none with look-around or names of Java's own."""
    try:
        pc.match_substring_regex(pa.array([""]), rule.pattern)
    except pa.ArrowInvalid:
        return False
    return True


def _ready(rules: Mapping[int, Rule]) -> dict[int, Rule]:
    """The rules with their hexadecimal patterns as classes, which take seconds to make: for workers, by the driver."""
    return {n: replace(r, pattern=rejected_characters(r.hex_pattern), hex_pattern="") if r.hex_pattern and not r.pattern else r for n, r in rules.items()}


def failed_arrow(rule: Rule, texts: pa.Array, units: np.ndarray) -> np.ndarray:
    """``failed`` for Arrow texts without nulls, of which units are the lengths. Patterns are tried where the other criteria fail."""
    out = np.ones(len(texts), bool)
    if rule.min_length:
        out &= units < rule.min_length
    if rule.max_length:
        out &= units > rule.max_length
    if rule.chars and (rule.ratio or rule.count):
        gone = sum(pc.count_substring(texts, c).to_numpy(zero_copy_only=False).astype(np.int64) * (1 + (c > "\uffff")) for c in sorted(set(rule.chars)))
        out &= (units / (units - gone + 1)).astype(np.float32) > np.float32(rule.ratio) if rule.ratio else gone >= rule.count
    for pattern in filter(None, (rule.pattern, rule.hex_pattern and rejected_characters(rule.hex_pattern))):
        if 4 * out.sum() > len(out):
            out &= pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
        elif out.any():
            out[out] = pc.match_substring_regex(texts.filter(pa.array(out)), pattern).to_numpy(zero_copy_only=False)
    return out


def first_rule_udf(spark: SparkSession, rules: Mapping[int, Rule] = RULES, any_rule: bool = False):
    """``first_rule`` as an Arrow function, where all rules are for RE2. any_rule: some rule that rejects, cheap ones being tried first."""
    ship(spark)
    order = sorted(_ready(rules).items(), key=lambda x: (any_rule and bool(x[1].pattern or x[1].hex_pattern), x[0]))

    @F.arrow_udf("int")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return map(first, _gathered(batches))

    def first(texts: pa.Array) -> pa.Array:
        found, left = np.zeros(len(texts), np.int32), np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
        rows = texts.take(pa.array(left))
        units = _units(rows)
        for n, rule in order:
            bad = failed_arrow(rule, rows, units)
            if bad.any():
                found[left[bad]] = n
                rows, units, left = rows.filter(pa.array(~bad)), units[~bad], left[~bad]
        return pa.array(found, mask=found == 0)

    return run


def _first(df: DataFrame, text: str, rules: Mapping[int, Rule], any_rule: bool = False) -> Column:
    """The rule that rejects a row's text, in Arrow where all rules can do so."""
    if 0 not in rules and all(map(in_arrow, rules.values())):
        return first_rule_udf(df.sparkSession, rules, any_rule)(F.col(text))
    return first_rule(F.col(text), rules)


def first_rule(text: Column, rules: Mapping[int, Rule] = RULES) -> Column:
    """The lowest number of the rules that reject the text, null where it is valid. One lazy expression: later rules are
    evaluated only where earlier ones pass."""
    return F.coalesce(*[F.when(failed(r, text), F.lit(n)) for n, r in sorted(rules.items())])


def first_rule_sql(text: str, rules: Mapping[int, Rule] = RULES) -> str:
    return "CASE " + " ".join(f"WHEN {failed_sql(r, text)} THEN {n}" for n, r in sorted(rules.items())) + " END"


def valid(text: Column, rules: Mapping[int, Rule] = RULES) -> Column:
    """Whether no rule rejects; lengths are tried before patterns, as order doesn't matter here."""
    cheap = sorted(rules.items(), key=lambda x: (bool(x[1].pattern or x[1].hex_pattern), x[0]))
    return F.coalesce(*[F.when(failed(r, text), F.lit(False)) for _, r in cheap], F.lit(True))


def clean(df: DataFrame, rules: Mapping[int, Rule] = RULES, text: str = "text") -> DataFrame:
    """Non-empty rows that no rule rejects."""
    return df.where(F.length(text) > 0).where(_first(df, text, rules, any_rule=True).isNull())


def rejects(df: DataFrame, rules: Mapping[int, Rule] = RULES, text: str = "text") -> DataFrame:
    """Rejected rows with rule_id and ``report``: the line and the rule that fired first."""
    names = F.create_map(*[x for n, r in sorted(rules.items()) for x in (F.lit(n), F.lit(r.description))])
    rows = df.where(F.length(text) > 0).withColumn("rule_id", _first(df, text, rules)).where("rule_id IS NOT NULL")
    return rows.withColumn("report", F.concat(F.col(text), F.lit("\tRule: "), F.col("rule_id").cast("string"), F.lit(" "), names[F.col("rule_id")]))


def clean_column(df: DataFrame, column: int, rules: Mapping[int, Rule] = RULES, text: str = "text") -> DataFrame:
    """Tab-separated rows of which the numbered field (from 0) is valid; rows without that field go."""
    part = F.get(F.split(F.col(text), "\t"), F.lit(column))
    return df.where(part.isNotNull() & (F.length(part) > 0)).where(valid(part, rules))


def rule_hits(df: DataFrame, rules: Mapping[int, Rule] = RULES, text: str = "text") -> DataFrame:
    """(rule_id, hits): rows that each rule rejects, tested alone, over one scan."""
    if all(map(in_arrow, rules.values())):
        ship(df.sparkSession)
        own = _ready(rules)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hits = dict.fromkeys(sorted(rules), 0)
            for texts in _gathered(batch[0] for batch in batches):
                texts = texts.drop_null()
                units = _units(texts)
                for n in hits:
                    hits[n] += int(failed_arrow(own[n], texts, units).sum())
            yield pa.RecordBatch.from_pydict({"rule_id": pa.array(list(hits), pa.int32()), "hits": pa.array(list(hits.values()), pa.int64())})

        none = df.sparkSession.createDataFrame([(n, 0) for n in sorted(rules)], "rule_id int, hits long")  # a table without rows may have no task
        return df.select(F.col(text)).mapInArrow(run, "rule_id int, hits long").unionByName(none).groupBy("rule_id").agg(F.sum("hits").alias("hits"))
    sums = df.agg(*[F.coalesce(F.sum(failed(r, F.col(text)).cast("long")), F.lit(0)).alias(str(n)) for n, r in sorted(rules.items())])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule_id"), F.col(str(n)).alias("hits")) for n in sorted(rules)])))


def rule_report(df: DataFrame, rules: Mapping[int, Rule] = RULES, text: str = "text") -> DataFrame:
    """(rule_id, hits) by first hit; null counts the valid rows."""
    return df.select(_first(df, text, rules).alias("rule_id")).groupBy("rule_id").agg(F.count("*").alias("hits"))


def replace_entities(text: Column, entities: Mapping[str, str] = ENTITIES) -> Column:
    """Literal replacements, in the mapping's order."""
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), entities.items(), text)


def replace_entities_sql(text: str, entities: Mapping[str, str] = ENTITIES) -> str:
    return reduce(lambda c, kv: f"replace({c}, {quoted(kv[0])}, {quoted(kv[1])})", entities.items(), text)
