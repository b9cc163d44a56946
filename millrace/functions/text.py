"""Column helpers for text: UTF-16 lengths, word splitting, literals shared with DuckDB."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Java calls white space (no-break spaces are none), inside a character class that Java, RE2 and Python read alike.
WHITE = r"\t-\r\x1C- \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}"
WHITE_PYTHON = "\t-\r\x1c- \u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000"


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 code units, the unit of framed records and of length rules."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def words(text: Column) -> Column:
    """Split at single spaces: empty strings inside stay, those at the end go; only spaces give no words."""
    cut = F.regexp_replace(text, " +$", "")
    return F.when((cut == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(cut, " "))


def words_arrow(texts: pa.Array) -> pa.ListArray:
    """The same for Arrow; null where the text is."""
    cut = pc.ascii_rtrim(texts, " ")
    out = pc.split_pattern(cut, " ")
    blank = pc.and_(pc.equal(cut, ""), pc.not_equal(texts, ""))
    if not pc.any(blank).as_py():
        return out
    return pc.if_else(blank, pa.scalar([], out.type), out)


def lengths(lists: pa.ListArray) -> np.ndarray:
    """How many values each list has; none where it is null."""
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)


def mapped(lists: pa.ListArray, codes: np.ndarray, values: pa.Array) -> pa.Array:
    """The lists' entries by their values, joined by single spaces; empty values go, null lists stay null. codes: a place in values for
    each entry."""
    n = lengths(lists)
    if pc.any(pc.equal(values, "")).as_py():
        kept = pc.not_equal(values, "").to_numpy(zero_copy_only=False)[codes]
        n, codes = np.bincount(np.repeat(np.arange(len(n)), n)[kept], minlength=len(n)), codes[kept]
    offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    out = pc.binary_join(pa.ListArray.from_arrays(offsets, values.take(pa.array(codes))), " ")
    return pc.if_else(lists.is_valid(), out, pa.scalar(None, pa.string())) if lists.null_count else out


def words_sql(text: str) -> str:
    """The same for DuckDB."""
    cut = f"regexp_replace({text}, ' +$', '')"
    return f"CASE WHEN {cut} = '' AND {text} <> '' THEN CAST([] AS VARCHAR[]) ELSE string_split({cut}, ' ') END"


def utf16_length_sql(text: str) -> str:
    return f"(length({text}) + length(regexp_replace({text}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def quoted(value: str) -> str:
    """A DuckDB string literal."""
    return "'" + value.replace("'", "''") + "'"


def escaped(value: str) -> str:
    """Literal text inside a regular expression that Java and RE2 read alike."""
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):X}}}" for c in value)


def alternatives(values: Iterable[str]) -> str:
    """One group that matches any of the values, earlier ones first."""
    return "(?:" + "|".join(escaped(v) for v in values) + ")"


def char_class(codes: Iterable[int]) -> str:
    """A character class of code points, runs as ranges."""
    parts, run = [], []
    for code in [*sorted(set(codes)), None]:
        if run and code != run[-1] + 1:
            parts.append(f"\\x{{{run[0]:X}}}" + (f"-\\x{{{run[-1]:X}}}" if len(run) > 1 else ""))
            run = []
        run.append(code)
    return "[" + "".join(parts) + "]"
