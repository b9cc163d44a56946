"""The near-duplicate operator's form for texts (``simhash`` has the one for fingerprints): links between documents whose five-word shingles have a Jaccard similarity of 0.8 or more.

Shingles are those of ``simhash`` with five words (a shorter text is one shingle), kept as distinct 32-bit hashes. Texts
with equal sets are one node.

SimHash comes first, with all its steps: a fingerprint of each node's set (each shingle once), buckets of block pairs, pivot
distance tables, fingerprints within 4 bits, components (``simhash.links``, ``simhash.components``). Each component is a bucket,
in which every link at 0.8 is found: of the pairs within 4 bits none is lost.

Most pairs at 0.8 are farther apart than 4 bits; bands add these. 125 minima under fixed permutations of the hashes make 25 bands of five: a pair at 0.8
has an equal band with probability 1 - (1 - 0.8^5)^25 = 0.99995, a nearer one with more. Every candidate pair is
verified by its true similarity, unless the two are linked already.

A larger limit on fingerprints would not do instead: texts at 0.8 differ in about ten of 64 bits, at which pivot distance tables
discard next to nothing and block buckets hold most of the table.

Rows: null and wordless texts are one node, linked to nothing else. Rows with a null id come after all others of their group;
of repeated rows one is kept. Other columns are left out.

Components and bands are searched alike, those with the same nodes once. In a band of more than ``TILE`` nodes each is compared with one of them first, the
band's centre; ``simhash.components`` joins what is found in all bands. Then only nodes outside the band's largest group so far
are compared with the others, in tiles of slices: pairs within a group are linked already, so nothing is lost and a large group
of near copies costs in proportion to its size. Tiles return spanning forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.common import begin, forget, id_text, map_arrow, materialise
from millrace.llm.simhash import SEED, components
from millrace.session import ship

SHINGLE, BANDS, ROWS, TILE = 5, 25, 5, 1024
#: Similarity 0.8 in whole numbers: 9 x common >= 4 x (both sizes).
COMMON, SIZES = 9, 4
_RANDOM = np.array([xxhash.xxh64_intdigest(str(i), seed=SEED) for i in range(2 * BANDS * ROWS)], "u8").astype("u4").reshape(2, -1, 1)
_TIMES, _PLUS = _RANDOM[0] | np.uint32(1), _RANDOM[1]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "u4")
    n, hash32 = max(1, len(words) - SHINGLE + 1), xxhash.xxh32_intdigest
    return np.unique(np.fromiter((hash32(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(n)), "u4", n))


def bands(own: np.ndarray) -> np.ndarray:
    """A key of each band."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, "u4")
    for at in range(0, len(own), 4096):
        np.minimum(least, (own[None, at : at + 4096] * _TIMES + _PLUS).min(axis=1), out=least)
    key = np.arange(BANDS, dtype="u8")
    for column in least.reshape(BANDS, ROWS).T.astype("u8"):
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view("i8")


def fingerprint(own: np.ndarray) -> int:
    """SimHash of a set: a bit is set where over half of the hashes, mixed to 64 bits, have it; zero for the empty set."""
    counts = np.zeros(64, "i8")
    for at in range(0, len(own), 1 << 16):
        key = (own[at : at + (1 << 16)].astype("u8") + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            key = (key ^ (key >> np.uint64(shift))) * np.uint64(times)
        key ^= key >> np.uint64(31)
        counts += np.unpackbits(key.astype(">u8").view("u1").reshape(-1, 8), axis=1).sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(2 * counts > len(own)).tobytes(), "big")


def nodes_of(docs: DataFrame) -> DataFrame:
    """(node, one, fp, bands, own): each distinct set of shingles, its row with the smallest id (null ids last), its fingerprint
    (as a signed long), band keys and hashes."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], "u8").view("i8")
        fp = np.array([fingerprint(s) for s in sets], "u8").view("i8")
        return {"doc_id": batch.column(0), "th": batch.column(2), "node": node, "fp": fp, "bands": [bands(s) for s in sets], "own": [s.tobytes() for s in sets]}

    rows = map_arrow(id_text(docs).withColumn("th", F.xxhash64("text")), run, "doc_id long, th long, node long, fp long, bands array<long>, own binary")
    one = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "th")).alias("one")
    return rows.groupBy("node").agg(one, F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands"), F.any_value("own").alias("own"))


def linked(sets: list[np.ndarray], part: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among ``sets`` beyond those of equal ``group``; where ``part`` has two sides, of those between them."""
    size = np.array([len(s) for s in sets])
    starts, flat = np.concatenate([[0], np.cumsum(size)[:-1]]), np.unique(np.concatenate(sets), return_inverse=True)[1]
    label, sides = np.unique(group, return_inverse=True)[1], bool(part.any())
    flag = np.zeros(int(flat.max(initial=0)) + 1, "i4")
    for a in range(len(sets) - 1):
        open_ = label[a + 1 :] != label[a]
        if sides:
            open_ &= part[a + 1 :] != part[a]
        if not open_.any():
            continue
        own = flat[starts[a] : starts[a] + size[a]]
        flag[own] = 1
        common = np.add.reduceat(flag[flat[starts[a + 1] :]], starts[a + 1 :] - starts[a + 1])
        flag[own] = 0
        for b in (np.flatnonzero(open_ & (COMMON * common >= SIZES * (size[a] + size[a + 1 :]))) + a + 1).tolist():
            if label[a] != label[b]:
                label[label == label[b]] = label[a]
                yield a, b


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin()
    held: list[pa.RecordBatch] = []
    left: list[int] = []
    right: list[int] = []

    def solve() -> None:
        rows = pa.Table.from_batches(held)
        if len(rows) > 1:
            node = rows.column(5).to_numpy()
            for a, b in linked([np.frombuffer(x, "u4") for x in rows.column(6).to_pylist()], rows.column(3).to_numpy(), rows.column(4).to_numpy()):
                left.append(node[a])
                right.append(node[b])

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    for batch in batches:
        tile = np.stack([batch.column(k).to_numpy() for k in range(3)])
        cuts = [0, *(np.flatnonzero((tile[:, 1:] != tile[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                if held and [held[0].column(k)[0].as_py() for k in range(3)] != tile[:, a].tolist():
                    solve()
                    held.clear()
                held.append(batch.slice(a, b - a))
        if left:
            yield out()
            left.clear()
            right.clear()
    if held:
        solve()
    if left:
        yield out()


def _compared(tiles: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): forests of the links in tiles (bucket, low, high, part, group, k), whose rows get their sets of hashes."""
    keys = ["bucket", "low", "high"]
    full = tiles.join(nodes.select("node", "own"), F.col("k") == F.col("node")).select(*keys, "part", "group", "node", "own")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return full.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(_search, "a long, b long")


def near_fingerprints(nodes: DataFrame) -> DataFrame:
    """(node, bucket): nodes with words whose fingerprints are equal or linked by steps of 4 bits or fewer share a bucket."""
    own = nodes.where(F.length("own") > 0).select(F.col("node").alias("own_node"), "fp")
    groups = components(simhash.links(own.select("fp").distinct()))
    rows = own.join(groups, F.col("fp") == F.col("node"), "left")
    return rows.select(F.col("own_node").alias("node"), F.xxhash64(F.lit(BANDS), F.coalesce("root", "fp")).alias("bucket"))


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): spanning forests of the links among ``nodes`` (a written table)."""
    spark = nodes.sparkSession
    ship(spark)
    zero = F.lit(0).cast("long")
    # a text without words is alone in its node: nothing else is similar to it
    rows = nodes.where(F.length("own") > 0).select("node", F.explode("bands").alias("bucket")).unionByName(near_fingerprints(nodes))
    size = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")).where("n > 1")
    once = size.groupBy("n", "x", "y").agg(F.min("bucket").alias("hot")).select("hot", "n")
    rows, rows_path = materialise(rows.join(once, F.col("bucket") == F.col("hot")).select("node", "bucket", "n", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / TILE).cast("long")).alias("slice")), "bands")
    large = rows.where(F.col("n") > TILE)
    if large.isEmpty():
        found = _compared(rows.select("bucket", zero.alias("low"), zero.alias("high"), zero.alias("part"), F.col("node").alias("group"), F.col("node").alias("k")), nodes)
        return materialise(found, "links")[0]
    # large buckets: each node with its bucket's centre, which is copied to all slices
    centre = large.groupBy("bucket", "n").agg(F.min_by("node", F.xxhash64("bucket", "node")).alias("k"))
    centre = centre.select("bucket", F.explode(F.sequence(zero, F.ceil(F.col("n") / TILE).cast("long") - 1)).alias("low"), zero.alias("high"), F.lit(1).cast("long").alias("part"), F.col("k").alias("group"), "k")
    stars, stars_path = materialise(_compared(centre.unionByName(large.select("bucket", F.col("slice").alias("low"), zero.alias("high"), F.lit(2).cast("long").alias("part"), F.col("node").alias("group"), F.col("node").alias("k"))), nodes), "stars")
    joined = components(stars).select(F.col("node").alias("z"), "root")
    rows = rows.join(joined, F.col("node") == F.col("z"), "left").select("node", "bucket", "n", "slice", F.coalesce("root", "node").alias("group"))
    # what is not in its bucket's largest group so far is compared with all of the bucket but its own group
    count = rows.where(F.col("n") > TILE).groupBy("bucket", "group").agg(F.count("*").alias("m")).groupBy("bucket").agg(F.max_by("group", F.struct("m", "group")).alias("main"), (F.sum("m") - F.max("m")).alias("light"))
    count = count.where("light > 0").select(F.col("bucket").alias("z"), "main", F.ceil(F.col("light") / TILE).cast("long").alias("deals"), "light")
    some = rows.join(count, F.col("bucket") == F.col("z"))
    low = F.explode(F.sequence(zero, F.ceil(F.col("n") / TILE).cast("long") - 1))
    every = some.select("bucket", F.col("slice").alias("low"), F.explode(F.sequence(zero, F.col("deals") - 1)).alias("high"), F.lit(1).cast("long").alias("part"), "group", F.col("node").alias("k"))
    light = some.where("group <> main").select("bucket", low.alias("low"), F.pmod(F.xxhash64("node", F.lit(7)), F.col("deals")).alias("high"), F.lit(2).cast("long").alias("part"), "group", F.col("node").alias("k"))
    small = rows.where(F.col("n") <= TILE).select("bucket", zero.alias("low"), zero.alias("high"), zero.alias("part"), "group", F.col("node").alias("k"))
    rest, _ = materialise(_compared(small.unionByName(every).unionByName(light), nodes), "links")
    whole, _ = materialise(rest.unionByName(spark.read.schema(stars.schema).parquet(stars_path)), "links")
    forget(spark, rows_path, stars_path)
    return whole


def representatives(docs: DataFrame) -> DataFrame:
    """(doc_id, th) of one row of each group of linked texts: the one with the smallest id."""
    nodes, path = materialise(nodes_of(docs), "shingles")
    stars = components(links(nodes))
    member = nodes.select(F.col("node").alias("own_node"), "one").join(stars, F.col("own_node") == F.col("node"), "left")
    kept, _ = materialise(member.groupBy(F.coalesce("root", "own_node").alias("group")).agg(F.min("one").alias("one")).select("one.doc_id", "one.th"), "kept")
    forget(docs.sparkSession, path)
    return kept
