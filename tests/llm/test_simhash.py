import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import simhash as S


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 4:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(values))]


@given(st.text(alphabet="aBÄ \t\n é", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_by_definition(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_long_and_null_texts():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert S.fingerprint(text) == plain_fingerprint(text)
    assert S.fingerprint(None) == S.fingerprint("") == S.fingerprint(" \n") == 0


def family(seed, groups=25):
    rng = np.random.default_rng(seed)
    out = []
    for start in rng.integers(0, 1 << 63, groups, dtype="u8").tolist():
        x = start
        for _ in range(int(rng.integers(1, 20))):
            y = x
            for bit in rng.integers(0, 64, int(rng.integers(0, 6))).tolist():
                y ^= 1 << bit
            out.append(y)
            x = y if rng.random() < 0.5 else x
    return sorted(set(out))


@pytest.mark.parametrize("tile", [2048, 12])
def test_links_and_components_are_complete(spark, monkeypatch, tile):
    monkeypatch.setattr(S, "TILE", tile)
    values = family(tile)
    signed = np.array(values, "u8").view("i8").tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    stars = {r.node: r.root for r in S.components(S.links(df)).collect()}
    got = [stars.get(v, v) for v in signed]
    want = plain_components(values)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_pivots_never_discard_a_link():
    values = np.array(family(5), "u8")
    coords = S.distance_table(values).astype(int)
    for i in range(len(values)):
        near = np.bitwise_count(values[i] ^ values) <= 4
        assert (np.abs(coords[near] - coords[i]).max(axis=1) <= 4).all()


def test_query_by_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away into the deep dark wood where nobody lives at all "
    rows = [(9, base * 3), (4, base * 3), (7, base * 3 + "x"), (1, "a b c"), (2, "A b C"), (3, None), (5, ""), (6, "  "), (8, "other words are here now"), (8, "other words are here now"), (None, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("th", F.lit(1))
    got = S.near_duplicates(df).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps)
    least = {r: min(d for (d, _), x in zip(rows, roots, strict=True) if x == r and d is not None) for r in set(roots)}
    want = Counter((d, least[r]) for (d, _), r in zip(rows, roots, strict=True))
    assert Counter((r.doc_id, r.component_id) for r in got) == want
    assert S.near_duplicates(df.where("false")).count() == 0
