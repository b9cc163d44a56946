"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z) and cut into words; an item's windows of ``window`` consecutive words are the patterns
(an item of fewer words is one pattern of its own length). Patterns of one length share a block shift table over
pairs of words: the scan looks at the last pair of the current window, skips as many words as no pattern can
start in, and only at shift 0 goes to the bucket of that suffix, where whole patterns are compared directly.

The patterns travel with the tasks: their words are counted by Spark first, and beyond ``MAX_PATTERN_WORDS`` the items are
dealt into groups of bounded size. One group at a time is on the driver and broadcast; each further group is one more pass over the
documents, written in between, and hits are merged by document.

Rows: null or wordless texts have no words; such items have no windows; empty tables give no rows or no hits. An item without
an id goes by the empty name; items of one id count as one. Repeated documents stay; texts of any length are searched whole;
other columns are left out by ``hits`` and kept by ``clean``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import filter_rows, forget, id_text, map_arrow, materialise, table

WINDOW = 10
#: Bound on what is sent to each task at once: about 60 MB of tables.
MAX_PATTERN_WORDS = 2_000_000
_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(_CLASS)
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower()) if text else []


class WuManber:
    """Patterns of one length over word numbers."""

    def __init__(self, length: int, patterns: dict[tuple, list[int]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = self._key(pattern, end)
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets.setdefault(self._key(pattern, length), []).append((pattern, items))

    def _key(self, words, end: int):
        return words[end - 1] if self.block == 1 else (words[end - 2] << 32) | words[end - 1]

    def scan(self, words: list[int]):
        """(start, items) of each occurrence."""
        end, n, length, far = self.length, len(words), self.length, self.far
        shift, buckets, two = self.shift.get, self.buckets, self.block == 2
        while end <= n:
            last = words[end - 1]
            if last < 0:  # in no pattern
                end += length
                continue
            key = (words[end - 2] << 32) | last if two else last
            step = shift(key, far)
            if step:
                end += step
                continue
            seen = tuple(words[end - length : end])
            for pattern, items in buckets.get(key, ()):
                if pattern == seen:
                    yield end - length, items
            end += 1


class Matcher:
    """All items' windows: word numbers and one search per pattern length."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.number: dict[str, int] = {}
        self.names = [str(i) for i, _ in items]
        by: dict[int, dict[tuple, list[int]]] = {}
        for k, (_, text) in enumerate(items):
            words = [self.number.setdefault(w, len(self.number)) for w in words_of(text)]
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                owners = by.setdefault(size, {}).setdefault(tuple(words[at : at + size]), [])
                if not owners or owners[-1] != k:
                    owners.append(k)
        self.searches = [WuManber(size, patterns) for size, patterns in sorted(by.items())]

    def find(self, words: list[str]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit word ranges, merged and in order; and the items found."""
        get = self.number.get
        numbers = [get(w, -1) for w in words]
        spans, found = [], set()
        for search in self.searches:
            for at, items in search.scan(numbers):
                spans.append((at, at + search.length))
                found.update(items)
        return _merged(spans), found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges joined, in order."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _groups(items: DataFrame, window: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items in groups whose windows hold a bounded number of words (a single item may be larger), one group at a time. The number
    of groups follows from a count of all windows' words; items are dealt out by hash."""
    sized = items.withColumn("words", F.regexp_count(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(_CLASS)))
    total = sized.agg(F.sum("words")).first()[0] or 0
    n = max(1, -(-total * window * (1 if total * window <= MAX_PATTERN_WORDS else 2) // MAX_PATTERN_WORDS))
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [tuple(r) for r in own.collect()]


SPANS = "doc_id long, n_words long, spans array<struct<a:long,b:long>>, items array<string>"


def _items(items: DataFrame, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    return items.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, hit word ranges [a, b) and the ids of the items found (as strings).

    Each further group of items adds its hits to a written copy of the rows that carries what earlier groups found."""
    spark = docs.sparkSession
    base = id_text(docs).withColumn("spans", F.lit(None).cast("array<struct<a:long,b:long>>")).withColumn("items", F.lit(None).cast("array<string>"))
    before = sent = None
    for group in _groups(_items(items), window):
        if sent is not None:  # a further group: what was found so far is written, and the group before it let go
            base, path = materialise(base, "hits")
            sent.unpersist()
            if before:
                forget(spark, before)
            before = path
        sent = spark.sparkContext.broadcast(group)

        def run(batch: pa.RecordBatch, sent=sent) -> dict:
            matcher = _matcher(sent.value, window)
            n, spans, names = [], [], []
            for text, found, known in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
                words = words_of(text)
                where, which = matcher.find(words)
                where = _merged([*where, *((s["a"], s["b"]) for s in found or ())])
                n.append(len(words))
                spans.append([{"a": a, "b": b} for a, b in where])
                names.append(sorted({matcher.names[x] for x in which} | set(known or ())))
            return {"doc_id": batch.column("doc_id"), "n_words": n, "spans": spans, "items": names, "text": batch.column("text")}

        base = map_arrow(base, run, SPANS + ", text string")
    return base.select("doc_id", "n_words", "spans", "items")


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the items occurs, with all their columns."""
    before = sent = None
    for group in _groups(_items(items), window):
        if sent is not None:
            docs, path = materialise(docs, "clean")
            sent.unpersist()
            if before:
                forget(docs.sparkSession, before)
            before = path
        sent = docs.sparkSession.sparkContext.broadcast(group)

        def keep(sent=sent):
            matcher = _matcher(sent.value, window)
            return lambda text: not matcher.find(words_of(text))[0]

        docs = filter_rows(docs, keep, text_col)
    return docs


_MATCHERS: dict[int, tuple[object, Matcher]] = {}


def _matcher(group: list, window: int) -> Matcher:
    """Built once per worker process and broadcast value."""
    if (id(group), window) not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[id(group), window] = (group, Matcher(group, window))
    return _MATCHERS[id(group), window][1]


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words",
        F.expr("aggregate(spans, 0L, (s, x) -> s + x.b - x.a)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
keys AS (
  SELECT DISTINCT item_id, n, array_to_string(w[a:a + n - 1], ' ') AS key
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS a FROM items WHERE len(w) > 0)),
spots AS (
  SELECT doc_id, n, a, array_to_string(w[a:a + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM words, (SELECT DISTINCT n FROM keys) WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, spots.n, a FROM spots JOIN keys USING (n, key)),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS i FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
