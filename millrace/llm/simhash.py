"""SimHash near-duplicates: fingerprints, pivot distance tables, components.

Fingerprint: XXH64 (seed 42) of each 4-word shingle of the text in lower case (A-Z); a bit is set where over half the
hashes have it. Equal fingerprints are one node, so copies never multiply. Fingerprints within ``MAX_DISTANCE`` bits
share at least two of six bit blocks, so each node goes to the 15 buckets of its block pairs: no pair is lost.
Inside a bucket the distances to ``PIVOTS`` reference fingerprints are precomputed; as a distance table coordinate
differs by at most the distance of a pair, pairs whose largest coordinate difference exceeds the limit are discarded
unseen, and survivors are verified by their exact Hamming distance. Nodes of a bucket are sorted by the first pivot's
coordinate, which bounds the sweep.

A bucket of more than ``HOT`` tiles' nodes is parted once more by block pairs of the fingerprints turned by five bits (again no
pair within 4 bits is lost). What still has more than ``TILE`` nodes is dealt into slices by hash; each pair of slices is a tile of
its own, so no task gets a whole hot bucket. Tiles return a spanning forest of their links, never all pairs. Components grow by
alternating large-star and small-star steps on written tables.

Rows: null and wordless texts have fingerprint zero, linked like any other. A row with a null id is kept, its
component is the smallest id of the others reachable (null if none). Repeated rows stay repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import begin, forget, id_text, map_arrow, materialise, table
from millrace.session import ship

SHINGLE, SEED, MAX_DISTANCE = 4, 42, 4
#: Six blocks of bits, of which any two make a bucket key.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
PIVOTS, TILE, HOT, KEYS = 16, 2048, 16, 4


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    line = b" ".join(words)
    last = ends[min(size, len(words)) - 1 :]
    hash64, counts = xxhash.xxh64_intdigest, np.zeros(64, "i8")
    for at in range(0, n, 1 << 16):  # long texts in blocks
        spans = zip(starts[at : min(n, at + (1 << 16))].tolist(), last[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([hash64(line[a:b], SEED) for a, b in spans], ">u8")
        counts += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1).sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp): th a 64-bit hash of the text, fp as a signed long with the fingerprint's bits."""

    def run(batch: pa.RecordBatch) -> dict:
        fp = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], "u8")
        return {"doc_id": batch.column(0), "th": batch.column(2), "fp": fp.view("i8")}

    return map_arrow(id_text(docs).withColumn("th", F.xxhash64("text")), run, "doc_id long, th long, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: a fixed pseudo-random sequence."""
    return np.array([xxhash.xxh64_intdigest(str(i), seed=SEED) for i in range(n)], "u8")


def distance_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint (rows) to each pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype("i1")


def linked(fps: np.ndarray, side: np.ndarray | None = None, limit: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as indices, of the links among ``fps``; with ``side``, of those between the two sides
    (links inside a side are found by another tile)."""
    n = len(fps)
    coords = distance_table(fps)
    order = np.argsort(coords[:, 0], kind="stable")
    x, c = fps[order], coords[order]
    s = None if side is None else side[order]
    label = np.arange(n)
    left, right = [], []
    for gap in range(1, n):
        near = c[gap:, 0] - c[:-gap, 0] <= limit
        if not near.any():
            break
        if s is not None:
            near &= s[gap:] != s[:-gap]
        i = np.flatnonzero(near)
        i = i[label[i] != label[i + gap]]
        if len(i):
            i = i[np.abs(c[i] - c[i + gap]).max(axis=1) <= limit]
            i = i[np.bitwise_count(x[i] ^ x[i + gap]) <= limit]
        for a in i.tolist():
            la, lb = label[a], label[a + gap]
            if la != lb:
                label[label == lb] = la
                left.append(order[a])
                right.append(order[a + gap])
    return np.array(left, "i8"), np.array(right, "i8")


def _small_groups(tile: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside many small groups at once; rows are sorted by group."""
    coords = distance_table(fps)
    left, right = [], []
    for gap in range(1, len(fps)):
        i = np.flatnonzero(tile[gap:] == tile[:-gap])
        if not len(i):
            break
        i = i[np.abs(coords[i] - coords[i + gap]).max(axis=1) <= limit]
        i = i[np.bitwise_count(fps[i] ^ fps[i + gap]) <= limit]
        left.append(i)
        right.append(i + gap)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, "i8"), np.zeros(0, "i8"))


def _search(limit: int):
    small = 32

    def solve(tile: np.ndarray, part: np.ndarray, fps: np.ndarray):
        """part: 0 in tiles of one slice; 1 and 2 for the slices of a pair of slices."""
        starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(tile)]]))
        few = np.repeat(sizes <= small, sizes) & (part == 0)
        a, b = _small_groups(tile[few], fps[few], limit)
        own = fps[few]
        yield own[a], own[b]
        for at, size in zip(starts.tolist(), sizes.tolist(), strict=True):
            if size > 1 and not few[at]:
                x, p = fps[at : at + size], part[at : at + size]
                a, b = linked(x, p if p.any() else None, limit)
                yield x[a], x[b]

    def run(batches):
        begin()
        held: list[np.ndarray] = []
        for batch in batches:
            now = np.stack([np.asarray(batch.column(k)).astype("i8") for k in range(KEYS + 2)])
            if not now.shape[1]:
                continue
            held.append(now)
            if (held[0][:KEYS, 0] == now[:KEYS, -1]).all():  # one group so far; its size is bounded by two slices
                continue
            rows = np.concatenate(held, axis=1)
            cut = int(np.flatnonzero((rows[:KEYS] != rows[:KEYS, -1:]).any(axis=0))[-1]) + 1
            held = [rows[:, cut:]]
            yield from emit(rows[:, :cut])
        if held:
            yield from emit(np.concatenate(held, axis=1))

    def emit(rows: np.ndarray):
        tile = np.concatenate([[0], np.cumsum((rows[:KEYS, 1:] != rows[:KEYS, :-1]).any(axis=0))])
        for a, b in solve(tile, rows[KEYS], np.ascontiguousarray(rows[KEYS + 1]).view("u8")):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], names=["a", "b"])

    return run


def _keys(turn: int = 0) -> list:
    """The bucket number of each pair of blocks: its bits above the pair's number. ``turn``: of the fingerprint turned by as many bits."""
    own = F.shiftrightunsigned("fp", turn).bitwiseOR(F.shiftleft("fp", 64 - turn)) if turn else F.col("fp")
    out = []
    for i in range(len(BLOCKS)):
        for j in range(i + 1, len(BLOCKS)):
            (a, n), (b, m) = BLOCKS[i], BLOCKS[j]
            bits = F.shiftrightunsigned(own, a).bitwiseAND(F.lit((1 << n) - 1))
            more = F.shiftrightunsigned(own, b).bitwiseAND(F.lit((1 << m) - 1))
            out.append(bits.bitwiseOR(F.shiftleft(more, n)).bitwiseOR(F.lit(len(out) << 22).cast("long")).cast("long"))
    return out


def links(nodes: DataFrame, limit: int = MAX_DISTANCE) -> DataFrame:
    """(a, b): spanning forests, per tile, of the links among distinct fingerprints ``nodes.fp``."""
    if limit > MAX_DISTANCE:
        raise ValueError("six blocks find distances up to 4")
    ship(nodes.sparkSession)
    rows = nodes.select("fp", F.explode(F.array(*_keys())).alias("bucket"))
    size = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1).select(F.col("bucket").alias("x"), F.col("n").alias("size"))
    rows = rows.join(size, F.col("bucket") == F.col("x")).select("fp", "bucket", "size")
    # a bucket of more than HOT tiles is parted once more, by the block pairs of the fingerprints turned by five bits
    hot = rows.where(F.col("size") > HOT * TILE).select("fp", "bucket", F.explode(F.array(*_keys(5))).alias("sub"))
    again = hot.groupBy("bucket", "sub").agg(F.count("*").alias("size")).where(F.col("size") > 1).select(F.col("bucket").alias("x"), F.col("sub").alias("y"), "size")
    hot = hot.join(again, (F.col("bucket") == F.col("x")) & (F.col("sub") == F.col("y"))).select("fp", "bucket", "sub", "size")
    rows = rows.where(F.col("size") <= HOT * TILE).select("fp", "bucket", F.lit(-1).cast("long").alias("sub"), "size").unionByName(hot)
    # slice i meets slice j in tile (i, j); a tile (i, i) has the pairs inside the slice
    slices = F.ceil(F.col("size") / TILE).cast("long")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("fp"), slices)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select("bucket", "sub", low.alias("low"), high.alias("high"), F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2).cast("long").alias("part"), "fp")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["bucket", "sub", "low", "high"]
    return dealt.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(_search(limit), "a long, b long")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) of every node that has an edge; root is the component's smallest node (as signed long)."""
    spark = edges.sparkSession
    now, path = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(most):
        # large star: each node's larger neighbours go to its smallest neighbour
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("m", "u").alias("m"))
        large = now.select(F.col("v").alias("c"), F.col("u").alias("far")).unionByName(now.select(F.col("u").alias("c"), F.col("u").alias("far")))
        step = large.join(low, "c").select(F.col("far").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # small star: each node's smaller neighbours go to the smallest of them
        least = step.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k"))
        small = step.join(least.select(F.col("u").alias("c"), "m"), F.col("u") == F.col("c"))
        new = small.select("v", "m").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        new, new_path = materialise(new, "edges")
        # done when stars do not change: no centre is itself below another, and nothing differs from before
        a = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        b = new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        forget(spark, path)
        now, path = new, new_path
        if tuple(a) == tuple(b):
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _labelled(docs: DataFrame, size: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of the rows; and for each fingerprint its component's root and smallest id."""
    fps, _ = materialise(fingerprints(docs, size), "fingerprints")
    nodes, nodes_path = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    stars = components(links(nodes.select("fp"), limit))
    member = nodes.join(stars, nodes["fp"] == stars["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    member, member_path = materialise(member, "members")
    least = member.groupBy("root").agg(F.min("low").alias("component_id"))
    label = member.select(F.col("fp").alias("node"), F.col("root").alias("group")).join(least, F.col("group") == F.col("root")).select("node", "group", "component_id")
    label, _ = materialise(label, "labels")
    forget(docs.sparkSession, nodes_path, member_path)
    return fps, label


def near_duplicates(docs: DataFrame, size: int = SHINGLE, limit: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, th, fp, component_id) of each row of ``docs``."""
    fps, label = _labelled(docs, size, limit)
    return fps.join(label, fps["fp"] == label["node"], "left").select("doc_id", "th", "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
