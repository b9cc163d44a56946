"""Substring deduplication by level-wise doubling of word windows.

A word is removed where a window of ``window`` consecutive words covers it whose word sequence starts anywhere else.
Lengths go up by doubling from ``SHORTEST`` or so: 9, 18, 35 words for a window of 35 (the last step overlaps).

Of the shortest windows inside each full window only the one of the least hash is looked at (its anchor): equal full windows
have equal anchors, so no repeat is missed, and of fourteen positions thirteen need no row. Consecutive full windows with one
anchor are a run. Anchors that occur once are done with; of those that repeat, and of those alone, the block is extended to
twice its length (to the right as far as the full window reaches, else to the left, which is the same choice in equal
windows), and again only blocks that repeat survive. At the full length equal runs (same block and same window hashes)
repeat in all their windows; in the others, at the edges of shared passages, every full window is hashed and counted.
Only the distinct runs are compared there, weighted by their number, so a group of copies counts once. No candidates are
left after that: a window of the full length decides, so the doubling ends there.

A row is written once, with the block hashes of all lengths; a level reads the hashes of those rows only that survived the
one before. Blocks, runs and windows have 64-bit polynomial hashes with bases of their own over one 64-bit hash of each word;
windows are compared by their block's and their own, equal runs by their block's and the hash of all their windows.

Texts go through one shuffle by row key; of rows without edge runs that is the end, the rest go through a second.
Counts are aggregated before they are shuffled. Keys that repeat are written before they are joined with their
occurrences: then both sides of the join are plain shuffles, of which Spark splits the hot partitions (there is one row
for a key on the other side). Lists are gathered only per row (bounded by its text).

Rows: null text counts as empty (no words). Repeated rows and repeated ids count as separate documents and stay; what repeated
rows (one id, also null, and one text) find is gathered once for all of them. Ids are cast to long; other columns are left out.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import forget, map_arrow, materialise, table

WINDOW, SHORTEST = 35, 9
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_UPPER, _LOWER = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Words(dict):
    """64-bit hash of each word, computed once; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = _Words()


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of anything but space and U+0009 to U+000D."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _doubled(one: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of all windows of ``length`` from hashes of windows of 1, 2, 4, ... words."""
    out, done, now, size = None, 0, one, 1
    n = len(one) - length + 1
    while True:
        if length & size:
            part = now[done : done + n]
            out = part if out is None else out * _power(base, size) + part
            done += size
        if 2 * size > length:
            return out
        now = now[:-size] * _power(base, size) + now[size:]
        size *= 2


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` consecutive values, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def lengths(window: int, shortest: int = SHORTEST) -> list[int]:
    """Rising block lengths below the window, each at most doubled by the next."""
    out = [(window + 1) // 2]
    while out[0] > shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


def windows_of(words: list[bytes], window: int, shortest: int = SHORTEST) -> tuple[list[np.ndarray], np.ndarray]:
    """Per full window: its block's hash at each length, and its own hash."""
    one = np.fromiter(map(_HASHES.__getitem__, words), "u8", len(words))
    steps = lengths(window, shortest)
    size, n = steps[0], len(words) - window + 1
    block = _mix(_doubled(one, size, _B1))
    # the upper half of the hash chooses the anchor, of equal ones the leftmost: its place is the lower half
    place = _least((block & _UPPER) | np.arange(len(block), dtype="u8"), window - size + 1) & _LOWER
    place = place.astype("i8")
    out, start = [block[place]], np.arange(n)
    for longer in steps[1:]:
        right = place + longer <= start + window
        place = np.where(right, place, place + size - longer)
        size = longer
        out.append(_mix(_doubled(one, size, _B1))[place])
    return out, _mix(_doubled(one, window, _B2))


def _begins(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], x[1:] != x[:-1]])


def runs_of(blocks: list[np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Runs of windows with the same blocks at all lengths: start, length, hash of all their windows. And for each length the weight of
    a run: 1 where the block's own run begins, 2 if a window repeats in that, else 0."""
    start = np.flatnonzero(np.logical_or.reduce([_begins(x) for x in blocks]))
    size = np.diff(np.concatenate([start, [len(hashes)]]))
    at = (np.arange(len(hashes)) - np.repeat(start, size)).astype("u8")
    value = np.add.reduceat(_mix(hashes + at * _B1), start) + size.astype("u8")
    order = np.sort(hashes)
    again = (order[1:] == order[:-1]).any()
    weights = []
    for x in blocks:
        begin = _begins(x)
        weight = begin.astype("i4")
        if again:
            own = np.flatnonzero(begin)
            for a, b in zip(own.tolist(), [*own[1:].tolist(), len(hashes)], strict=True):
                if b - a > 1 and len(np.unique(hashes[a:b])) < b - a:
                    weight[a] = 2
        weights.append(weight[start])
    return start, size, value, weights


def _runs(rows: DataFrame, window: int, shortest: int) -> DataFrame:
    levels = len(lengths(window, shortest))
    schema = ", ".join(f"b{k} long, w{k} int" for k in range(levels)) + ", run long, doc_id long, th long, a int, n int"

    def run(batch: pa.RecordBatch) -> dict | None:
        keep: list[tuple] = []
        for k, text in enumerate(batch.column(2).to_pylist()):
            words = words_of(text)
            if len(words) >= window:
                blocks, hashes = windows_of(words, window, shortest)
                start, size, value, weights = runs_of(blocks, hashes)
                keep.append((value, np.full(len(start), k), start, size, *(x[start] for x in blocks), *weights))
        if not keep:
            return None
        value, which, start, size, *rest = (np.concatenate(x) for x in zip(*keep, strict=True))
        which = pa.array(which)
        out = {"run": value.view("i8"), "doc_id": batch.column(0).take(which), "th": batch.column(1).take(which), "a": start.astype("i4"), "n": size.astype("i4")}
        return out | {f"b{k}": rest[k].view("i8") for k in range(levels)} | {f"w{k}": rest[levels + k] for k in range(levels)}

    return map_arrow(rows, run, schema)


def _covered(n_words: int, window: int, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Words covered by the windows that start in [start, start + size)."""
    edge = np.zeros(n_words + 1, "i8")
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + sizes + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


FOUND = "kind int, doc_id long, th long, text string, n_words long, n_removed long, kept string, starts array<int>, sizes array<int>, anchor long, hash long, at int, weight long"


def _row(**values) -> dict:
    names = [x.split()[0] for x in FOUND.split(", ")]
    n = len(next(iter(values.values())))
    return {k: values[k] if k in values else [None] * n for k in names}


def removals(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, th, n_words, n_removed, kept): kept words joined by one space (or their SHA-256 in hex, with ``digest``);
    th is a 64-bit hash of the text, which tells rows of one id apart. One row per row of ``docs``."""
    if window < 2:
        raise ValueError("a window has two words at least")
    spark = docs.sparkSession

    def given(kept: bytes) -> str:
        return hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "surrogatepass")

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("th"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # block lengths below the window: rows whose block occurs again
    live, live_path = materialise(_runs(rows, window, shortest), "runs")
    levels = len(lengths(window, shortest))
    for k in range(levels):
        block = f"b{k}"
        again, again_path = materialise(live.groupBy(block).agg(F.sum(f"w{k}").alias("c")).where("c > 1").select(F.col(block).alias("x")), "again")
        more = [c for j in range(k + 1, levels) for c in (f"b{j}", f"w{j}")] or [F.col(block).alias("anchor")]
        alive, alive_path = materialise(live.join(again, live[block] == again["x"]).select(*more, "run", "doc_id", "th", "a", "n"), "live")
        forget(spark, live_path, again_path)
        live, live_path = alive, alive_path
    # the full length: equal runs, and one run for each distinct one
    kinds, kinds_path = materialise(live.groupBy("anchor", "run").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "a", "n")).alias("one")), "kinds")
    mixed, mixed_path = materialise(kinds.groupBy("anchor").agg(F.min("c").alias("least")).where("least = 1").select(F.col("anchor").alias("x")), "mixed")
    edge = kinds.join(mixed, kinds["anchor"] == mixed["x"]).select("one.doc_id", "one.th", "anchor", "one.a", "one.n", F.col("c").alias("weight"))
    whole = kinds.where("c > 1").select(F.col("anchor").alias("x"), F.col("run").alias("y"))
    whole = live.join(whole, (live["anchor"] == whole["x"]) & (live["run"] == whole["y"])).select("doc_id", "th", F.lit(None).cast("long").alias("anchor"), "a", "n", F.lit(0).cast("long").alias("weight"))
    lists = whole.unionByName(edge).groupBy("doc_id", "th").agg(F.collect_set(F.struct("anchor", "a", "n", "weight")).alias("found"))
    lists = lists.select(F.col("doc_id").alias("i"), F.col("th").alias("t"), "found")
    joined = rows.join(lists, rows["doc_id"].eqNullSafe(lists["i"]) & (rows["th"] == lists["t"]), "left").select("doc_id", "th", "text", "found.anchor", "found.a", "found.n", "found.weight")

    def extend(batch: pa.RecordBatch):
        return [x for at in range(0, batch.num_rows, 256) for x in extend_part(batch.slice(at, 256))]

    def extend_part(batch: pa.RecordBatch) -> list[dict]:
        done: dict[str, list] = {k: [] for k in ("kind", "doc_id", "th", "text", "n_words", "n_removed", "kept", "starts", "sizes")}
        some: dict[str, list] = {k: [] for k in ("doc_id", "th", "anchor", "hash", "at", "weight")}
        for doc_id, th, text, anchors, a, n, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = words_of(text)
            own = [k for k, w in enumerate(weights or ()) if w]  # runs of which windows are to be counted
            full = np.array([(a[k], n[k]) for k, w in enumerate(weights or ()) if not w], "i8").reshape(-1, 2)
            if own:
                hashes = _mix(_doubled(np.fromiter(map(_HASHES.__getitem__, words), "u8", len(words)), window, _B2))
                for k in own:
                    size = n[k]
                    some["doc_id"] += [doc_id] * size
                    some["th"] += [th] * size
                    some["anchor"] += [anchors[k]] * size
                    some["hash"].append(hashes[a[k] : a[k] + size].view("i8"))
                    some["at"].append(np.arange(a[k], a[k] + size))
                    some["weight"] += [weights[k]] * size
            later = any(weights[k] == 1 for k in own)
            hit = _covered(len(words), window, full[:, 0], full[:, 1])
            kept = b"" if later else b" ".join(compress(words, (~hit).tolist())) if len(full) else b" ".join(words)
            for column, value in zip(done.values(), (2 if later else 1, doc_id, th, text if later else None, len(words), int(hit.sum()), None if later else given(kept), full[:, 0] if later else None, full[:, 1] if later else None), strict=True):
                column.append(value)
        out = [_row(**done)]
        if some["doc_id"]:
            some["hash"], some["at"] = np.concatenate(some["hash"]), np.concatenate(some["at"])
            out.append(_row(kind=[3] * len(some["doc_id"]), **some))
        return out

    found, found_path = materialise(map_arrow(joined, extend, FOUND), "found")
    forget(spark, live_path, kinds_path, mixed_path)
    # full windows of the edge runs that occur again
    spots = found.where("kind = 3").select("doc_id", "th", "anchor", "hash", "at", "weight")
    repeat, _ = materialise(spots.groupBy("anchor", "hash").agg(F.sum("weight").alias("c")).where("c > 1").select(F.col("anchor").alias("x"), F.col("hash").alias("y")), "repeat")
    spots = spots.where("weight = 1").join(repeat, (F.col("anchor") == F.col("x")) & (F.col("hash") == F.col("y")))
    lists = spots.groupBy("doc_id", "th").agg(F.collect_set("at").alias("more")).select(F.col("doc_id").alias("i"), F.col("th").alias("t"), "more")
    rest = found.where("kind = 2").select("doc_id", "th", "text", "starts", "sizes")
    rest = rest.join(lists, rest["doc_id"].eqNullSafe(lists["i"]) & (rest["th"] == lists["t"]), "left").select("doc_id", "th", "text", "starts", "sizes", "more")

    def finish(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept")}
        for text, starts, sizes, more in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
            words = words_of(text)
            more = more or []
            hit = _covered(len(words), window, np.array((starts or []) + more, "i8"), np.array((sizes or []) + [1] * len(more), "i8"))
            kept = given(b" ".join(compress(words, (~hit).tolist())))
            for column, value in zip(out.values(), (len(words), int(hit.sum()), kept), strict=True):
                column.append(value)
        return {"doc_id": batch.column(0), "th": batch.column(1)} | out

    last = map_arrow(rest, finish, "doc_id long, th long, n_words long, n_removed long, kept string")
    return found.where("kind = 1").select("doc_id", "th", "n_words", "n_removed", "kept").unionByName(last)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = removals(table(spark, sf_dir, "documents"), digest=True)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 34, 0) + 1)) AS a FROM w),
h AS (SELECT doc_id, a, md5(array_to_string(words[a:a + 34], ' ')) AS key FROM s),
again AS (SELECT key FROM h GROUP BY key HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, unnest(range(a, a + 35)) AS i FROM h SEMI JOIN again USING (key)),
one AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM one ANTI JOIN hit USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
