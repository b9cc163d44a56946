"""Sentence segmentation.

``segments`` is a column of array functions: a boundary counts at the end of a space-separated token. ``segment_exact``
walks characters in an Arrow function and can reproduce the historic corner cases (``compat``).

A boundary is rejected when the token before it is an abbreviation, when a pre-rule says so, when the next token is on
the post-list or a post-rule says so, and when the next token is the last one or follows a double space.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import alternatives, char_class, quoted
from millrace.session import ship
from millrace.sources.resources import ABBREVIATIONS, BOUNDARIES, POST_LIST, Signed, compiled

#: Two noncharacters, which text for interchange never has.
CUT = "\ufdd0\ufdd1"


@dataclass(frozen=True)
class SegmentResources:
    """Boundaries in order, words before which and after which a boundary doesn't count, signed rules.

    Pre-rules match the token before a boundary, post-rules the one after it; of each the first full match decides:
    pre ``-`` and post ``+`` mean no boundary."""

    boundaries: list[str] = field(default_factory=lambda: list(BOUNDARIES))
    pre_list: list[str] = field(default_factory=lambda: with_capitals(ABBREVIATIONS))
    post_list: list[str] = field(default_factory=lambda: list(POST_LIST))
    pre_rules: list[Signed] = field(default_factory=list)
    post_rules: list[Signed] = field(default_factory=list)
    #: Whether a boundary before a text's last token counts (by default it doesn't, so a last sentence of one word is merged).
    split_last: bool = False


def with_capitals(words: list[str]) -> list[str]:
    """Each entry and its form with a capital first letter."""
    return list(dict.fromkeys(x for w in words for x in (w, w[:1].upper() + w[1:])))


def _decided(token: Column, rules: list[Signed], stop: bool) -> Column:
    """Whether the first rule that matches the whole token says no boundary."""
    out = F.lit(False)
    for rule in reversed(rules):
        out = F.when(token.rlike(f"^(?:{rule.pattern})$"), F.lit(rule.positive == stop)).otherwise(out)
    return out


def _cut_pattern(res: SegmentResources) -> str:
    """A Java pattern for the spaces at which a text is cut, for lists without signed rules. What is rare is looked at first: the character
    before the space, then the boundary, the token before it, and the tokens after it."""
    marks = char_class({ord(b[-1]) for b in res.boundaries})
    boundaries = alternatives(sorted(res.boundaries, key=len))
    before = f"(?<!(?:^| ){alternatives(sorted(set(res.pre_list)))} )" if res.pre_list else ""
    # an entry of the post-list may end in a boundary; the first place at which one reaches the token's end is where it is cut off
    after = f"(?!{alternatives(sorted(set(res.post_list)))}{boundaries}?{'(?: |$)' if res.split_last else ' '})" if res.post_list else ""
    return f" (?<={marks} )(?<={boundaries} ){before}(?=[^ ]+{'' if res.split_last else ' '}){after}"


def segments(text: Column, res: SegmentResources | None = None) -> Column:
    """Array of the text's sentences."""
    res = res or SegmentResources()
    if res.boundaries and not res.pre_rules and not res.post_rules and not set("".join(res.boundaries)) & set("".join(res.post_list)):
        return F.filter(F.split(text, _cut_pattern(res)), lambda s: s != "")
    end = alternatives(res.boundaries) + "$"
    tokens = F.split(text, " ")
    # what follows each token, null after the last ones: lambdas see tokens only through their arguments
    none, last = F.lit(None).cast("string"), 1 if res.split_last else 2
    after = F.concat(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - last, F.lit(0))), F.array_repeat(none, F.least(F.size(tokens), F.lit(last))))
    pre, post = [F.array(*map(F.lit, x)) if x else F.array().cast("array<string>") for x in (res.pre_list, res.post_list)]

    def piece(token: Column, following: Column) -> Column:
        bare = F.regexp_replace(following, end, "")
        accept = following.isNotNull() & (following != "") & token.rlike(end) & ~F.array_contains(pre, token) & ~F.array_contains(post, bare)
        if res.pre_rules:
            accept = accept & ~_decided(token, res.pre_rules, False)
        if res.post_rules:
            accept = accept & ~_decided(bare, res.post_rules, True)
        return F.when(accept, F.concat(token, F.lit(CUT))).otherwise(token)

    return F.filter(F.split(F.array_join(F.zip_with(tokens, after, piece), " "), CUT + " "), lambda s: s != "")


def segment(df: DataFrame, res: SegmentResources | None = None, text: str = "text") -> DataFrame:
    """One row per sentence, ``seg`` numbering a row's sentences from 0."""
    rest = [c for c in df.columns if c != text]
    rows = df.select(*rest, F.posexplode(segments(F.col(text), res)).alias("seg", text))
    return rows.withColumn("seg", F.col("seg").cast("long"))


def segment_text(text: str, res: SegmentResources, compat: bool = False) -> list[str]:
    """Sentences of one text, character by character. compat: boundaries inside tokens count and swallow the character
    after them, pre-rules have no effect, and one last character after a boundary is lost."""
    find = re.compile("|".join(map(re.escape, res.boundaries)) or "(?!)").search
    reach = max(map(len, res.pre_list), default=0)
    pre, post = frozenset(res.pre_list), frozenset(res.post_list)
    out, base, at = [], 0, 0  # the sentence starts at base
    while (m := find(text, at)) is not None:
        at = m.end()
        inside = not compat and at < len(text) and text[at] != " "
        if inside or _no_boundary(text, base, m.start(), at, res, pre, post, reach, compat):
            continue
        out.append(text[base:at])
        base = at = at + 1
        if base >= len(text):
            return out
    return out + [text[base:]] if base < len(text) else out


@lru_cache(maxsize=1024)
def compiled_once(pattern: str):
    return compiled(pattern)


def _no_boundary(text: str, base: int, start: int, end: int, res: SegmentResources, pre: frozenset, post: frozenset, reach: int, compat: bool) -> bool:
    low = max(base, start - reach) if compat else base
    token = text[max(low, text.rfind(" ", low, start) + 1) : end].strip()
    if token in pre:
        return True
    if not compat:
        for rule in res.pre_rules:
            if compiled_once(rule.pattern).fullmatch(token):
                if not rule.positive:
                    return True
                break
    stop = text.find(" ", end + 1)
    if stop < 0 and res.split_last:
        stop = len(text)
    if stop < 0 or stop == end + 1 or end >= len(text):
        return True
    after = text[end + 1 : stop]
    for b in res.boundaries:
        if after.endswith(b):
            after = after[: -len(b)]
            break
    if after in post:
        return True
    for rule in res.post_rules:
        if compiled_once(rule.pattern).fullmatch(after):
            return rule.positive
    return False


def segments_udf(spark: SparkSession, res: SegmentResources | None = None, compat: bool = False):
    """``segment_text`` as a column function."""
    res = res or SegmentResources()
    ship(spark)

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else segment_text(t, res, compat) for t in texts.to_pylist()], pa.list_(pa.string()))

    return run


def segment_exact(df: DataFrame, res: SegmentResources | None = None, text: str = "text", compat: bool = False) -> DataFrame:
    """Like ``segment``, by ``segment_text``."""
    run = segments_udf(df.sparkSession, res, compat)
    rest = [c for c in df.columns if c != text]
    rows = df.select(*rest, F.posexplode(run(F.col(text))).alias("seg", text))
    return rows.withColumn("seg", F.col("seg").cast("long"))


def segments_exact_sql(lines: str, keys: str, res: SegmentResources | None = None, compat: bool = False) -> str:
    """DuckDB query for ``segment_exact`` (lists and rules without look-around): a recursive walk from boundary to boundary."""
    res = res or SegmentResources()
    find = quoted(alternatives(res.boundaries))
    tail = quoted(alternatives(res.boundaries) + "$")
    isin = lambda x, members: f"{x} IN ({', '.join(map(quoted, members))})" if members else "false"

    def ruled(token: str, rules: list[Signed], stop: bool) -> str:
        cases = " ".join(f"WHEN regexp_full_match({token}, {quoted(r.pattern)}) THEN {r.positive == stop}" for r in rules)
        return f"CASE {cases} ELSE false END" if rules else "false"

    reach = max(map(len, res.pre_list), default=0)
    before = f"right(substr(text, base, start - base), {reach})" if compat else "substr(text, base, start - base)"
    return f"""
WITH RECURSIVE walk AS (
  SELECT {keys}, text, 1 AS base, 1 AS spot, CAST(0 AS BIGINT) AS seg, CAST(NULL AS VARCHAR) AS sentence FROM {lines}
  UNION ALL
  SELECT {keys}, text,
         CASE WHEN m = '' THEN NULL WHEN no THEN base WHEN fin >= length(text) THEN NULL ELSE fin + 1 END,
         CASE WHEN no THEN fin ELSE fin + 1 END, seg + CASE WHEN sentence IS NULL THEN 0 ELSE 1 END,
         CASE WHEN m = '' THEN substr(text, base) WHEN no THEN NULL ELSE substr(text, base, fin - base) END
  FROM (SELECT *, {'false' if compat else "(fin <= length(text) AND substr(text, fin, 1) <> ' ')"} OR {isin('token', res.pre_list)}
             OR {'false' if compat else ruled('token', res.pre_rules, False)} OR fin > length(text) OR stop < 2
             OR {isin('bare', res.post_list)} OR {ruled('bare', res.post_rules, True)} AS no
        FROM (SELECT *, regexp_replace(regexp_extract({before}, '[^ ]*$') || m, '^\\s+|\\s+$', '', 'g') AS token,
                     regexp_replace(substr(text, fin + 1, greatest(stop - 1, 0)), {tail}, '') AS bare
              FROM (SELECT *, start + length(m) AS fin, instr(substr(text, start + length(m) + 1), ' ') AS stop
                    FROM (SELECT *, spot + instr(substr(text, spot), m) - 1 AS start
                          FROM (SELECT *, regexp_extract(substr(text, spot), {find}) AS m FROM walk WHERE base IS NOT NULL))))))
SELECT {keys}, seg, sentence AS text FROM walk WHERE sentence <> ''"""


def segments_sql(lines: str, keys: str, res: SegmentResources | None = None) -> str:
    """DuckDB query for ``segment`` over a relation with the given keys and text (lists only, no rules)."""
    res = res or SegmentResources()
    end = quoted(alternatives(res.boundaries) + "$")
    pre, post = (", ".join(map(quoted, x)) for x in (res.pre_list, res.post_list))
    return f"""
SELECT {keys}, seg, text FROM (
  SELECT {keys}, CAST(seg AS BIGINT) AS seg, string_agg(x, ' ' ORDER BY i) AS text FROM (
    SELECT *, coalesce(sum(CASE WHEN acc THEN 1 ELSE 0 END) OVER (
        PARTITION BY {keys} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
    FROM (
      SELECT *, regexp_matches(x, {end}) AND x NOT IN ({pre}) AND i + 1 < n AND nxt <> ''
          AND regexp_replace(nxt, {end}, '') NOT IN ({post}) AS acc
      FROM (SELECT *, lead(x) OVER (PARTITION BY {keys} ORDER BY i) AS nxt FROM (
        SELECT {keys}, unnest(string_split(text, ' ')) AS x, generate_subscripts(string_split(text, ' '), 1) AS i,
               len(string_split(text, ' ')) AS n FROM {lines}))))
  GROUP BY ALL)
WHERE text <> ''"""
