import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm.substrings import lengths, removals


def plain(rows, window):
    tokens = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[a : a + window]) for w in tokens for a in range(len(w) - window + 1))
    out = []
    for (doc, _), words in zip(rows, tokens, strict=True):
        hit = [False] * len(words)
        for a in range(len(words) - window + 1):
            if seen[tuple(words[a : a + window])] > 1:
                hit[a : a + window] = [True] * window
        out.append((doc, len(words), sum(hit), " ".join(w.decode() for w, h in zip(words, hit, strict=True) if not h)))
    return Counter(out)


def ours(spark, rows, window, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.lit("clash")).withColumn("b0", F.lit("clash")).withColumn("x.y", F.lit(1)).withColumn("run", F.lit(0)).repartition(3)
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in removals(df, window, **more).collect())


@pytest.mark.parametrize(("window", "shortest"), [(2, 9), (5, 9), (7, 2), (35, 9), (35, 3)])
def test_against_brute_force(spark, window, shortest):
    random.seed(window)
    rows = [(i, " ".join(random.choice("ab cd e fg".split()) for _ in range(random.randrange(60)))) for i in range(60)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(100, "x " * 90), (101, None), (102, ""), (103, "a b " * 40), (104, rows[5][1]), (104, rows[5][1]), (104, "other"), (None, rows[8][1]), (None, None)]
    rows += [(200 + i, f"u{i} v{i} {passage} w{i}") for i in range(20)] + [(300, f"q {passage[:150]} r"), (301, passage + " " + passage)]
    assert ours(spark, rows, window, shortest=shortest) == plain(rows, window)


def test_empty_table(spark):
    assert removals(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lengths_double():
    assert lengths(35) == [9, 18] and lengths(50) == [7, 13, 25] and lengths(2) == [1] and lengths(35, 3) == [3, 5, 9, 18]
    for window in range(2, 200):
        steps = [*lengths(window), window]
        assert all(a < b <= 2 * a for a, b in zip(steps, steps[1:], strict=False))


def test_repeated_rows_and_null_ids(spark):
    """Many rows of one id (or none) and one text, beside a text that shares a part of it."""
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(7, text)] * 40 + [(None, text)] * 40 + [(8, "a b " + " ".join(f"w{i}" for i in range(30, 90)) + " c"), (9, None), (None, None), (None, "")]
    assert ours(spark, rows, 35) == plain(rows, 35)


def test_a_very_long_text(spark):
    rng = random.Random(3)
    long = [f"v{rng.randrange(4000)}" for _ in range(60_000)]
    long[50_000:50_100] = long[10_000:10_100]
    rows = [(1, " ".join(long)), (2, "x " * 50_000), (3, " ".join(long[30_000:30_036]))]
    assert ours(spark, rows, 35) == plain(rows, 35)
