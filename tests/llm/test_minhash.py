import random

import corpus_pipeline as CP


def similarity(a, b):
    a, b = ({tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(a & b) / len(a | b)


def test_near_copies_by_brute_force(spark):
    """Copies with some words changed: kept are the first of each group linked at 0.8, whatever their fingerprints."""
    rng, rows = random.Random(1024), []
    for _ in range(20):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 300))]
        rows.append(" ".join(base))
        for _ in range(5):
            new = list(base)
            for _ in range(rng.randrange(1, max(2, len(base) // 30))):
                new[rng.randrange(len(new))] = f"x{rng.randrange(5000)}"
            rows.append(" ".join(new))
    order = rng.sample(range(len(rows)), len(rows))
    group = {}
    for d in range(len(rows)):
        todo = [d]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = d
                todo += [y for y in range(len(rows)) if y not in group and similarity(rows[x], rows[y]) >= 0.8]
    docs = spark.createDataFrame([(d, rows[d]) for d in order], "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in CP.drop_near_copies(spark, docs, "").collect()}
    assert got == set(group.values()) and len(got) < len(rows) // 2


def test_large_bands_lose_no_link(spark, monkeypatch):
    """With tiny tiles every band is large: centres first, then what they leave over."""
    from millrace.llm import minhash

    monkeypatch.setattr(minhash, "TILE", 3)
    test_near_copies_by_brute_force(spark)


def simhash_of(text):
    """The stage's fingerprint bit by bit."""
    import xxhash

    words, top = text.lower().encode().split(), 1 << 64
    counts, shingles = [0] * 64, {xxhash.xxh32_intdigest(b" ".join(words[i : i + 5]), 42) for i in range(max(1, len(words) - 4))}
    for h in shingles:
        x = (h + 42) * 0x9E3779B97F4A7C15 % top
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % top
        x = (x ^ x >> 27) * 0x94D049BB133111EB % top
        x ^= x >> 31
        for k in range(64):
            counts[k] += x >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(shingles))


def test_simhash_links_without_any_band(spark):
    """Near copies within 4 bits are linked by their fingerprints alone: no band is left here. None at 0.8 or more is lost, and
    what lies within 4 bits below 0.8 stays apart."""
    from millrace.llm import minhash
    from millrace.llm.common import materialise

    rng, rows = random.Random(7), []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(300, 900))]
        rows.append(" ".join(base))
        for _ in range(4):
            new = list(base)
            for _ in range(rng.choice([1, 1, 2, 40])):
                new[rng.randrange(len(new))] = f"x{rng.randrange(5000)}"
            rows.append(" ".join(new))
    rows += ["", "a b", "c d"]
    nodes, _ = materialise(minhash.nodes_of(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")), "n")
    fps = {d: simhash_of(t) for d, t in enumerate(rows) if t}
    ids = {r.node: r.one.doc_id for r in nodes.collect()}
    assert {r.one.doc_id: r.fp % (1 << 64) for r in nodes.collect() if r.own} == {d: fps[d] for d in ids.values() if d in fps}

    from pyspark.sql import functions as F

    alone, _ = materialise(nodes.withColumn("bands", F.array("node")), "alone")
    group = {d: d for d in range(len(rows))}
    for a, b in minhash.links(alone).collect():
        x, y = group[ids[a]], group[ids[b]]
        group = {d: x if g == y else g for d, g in group.items()}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    near = [(a, b) for a, b in pairs if similarity(rows[a], rows[b]) >= 0.8]
    assert len(near) > 12 and all(group[a] == group[b] for a, b in near)
    assert all(similarity(rows[a], rows[b]) >= 0.8 for a, b in ((ids[a], ids[b]) for a, b in minhash.links(alone).collect()))
