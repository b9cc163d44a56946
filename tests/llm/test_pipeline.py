import hashlib
import math
import os
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as CP
from millrace.llm import toxicity
from millrace.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def features(text):
    """Words and their beginnings as the chain's documentation says, with their values."""
    out = {}
    for word in set(re.findall(r"\w+", (text or "").lower())):
        out[(xxhash.xxh64_intdigest(word) >> 1) & ~1] = 1.0
        for k in (4, 5, 6):
            if len(word) >= k:
                out[(xxhash.xxh64_intdigest(word[:k] + "*") >> 1) | 1] = 0.5
    return out


def chain_says(chain, text):
    earlier, score = [], 0.0
    own = features(text)
    for model in chain.models:
        score = sum(w * own[f] for f, w in sorted(model.weights.items()) if f in own) + model.bias + sum(a * b for a, b in zip(model.chained, earlier, strict=True))
        earlier.append(1 / (1 + math.exp(-score)))
    return earlier, score > chain.threshold


def shingled(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_chain_by_brute_force(spark):
    docs = table(spark, SF, "documents")
    chain = toxicity.chain_for(docs, table(spark, SF, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in toxicity.score(docs, chain).collect():
        earlier, rejected = chain_says(chain, texts[r.doc_id])
        assert r.rejected == rejected and [r.p_low_quality, r.p_toxic] == pytest.approx(earlier, abs=2e-6)


def test_threshold_by_brute_force():
    """The threshold of the best F1 of all cuts between scores, rows weighted by the classes' shares."""
    import random

    import numpy as np

    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(2, 30)
        y = [1, 0] + [rng.randrange(2) for _ in range(n - 2)]
        s = [round(rng.gauss(yy, 1.0), 1) for yy in y]
        shares = (rng.choice([1.0, 5.0, 0.3]), rng.choice([1.0, 2.0]))

        def f1(cut, s=s, y=y, shares=shares):
            tp = sum(shares[1] for a, b in zip(s, y, strict=True) if a >= cut and b)
            fp = sum(shares[0] for a, b in zip(s, y, strict=True) if a >= cut and not b)
            return 2 * tp / (tp + fp + sum(y) * shares[1])

        got = toxicity._threshold(np.array(s), np.array(y), shares)
        accepted = min((x for x in s if x > got or x == min(s) == got), default=max(s))
        assert f1(accepted) == pytest.approx(max(f1(x) for x in set(s)))


def test_stages_by_brute_force(spark):
    """All stages told with plain Python over plain sets and lists; of the library only the fitted chain is used."""
    docs = table(spark, SF, "documents")
    chain = toxicity.chain_for(docs, table(spark, SF, "labels"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    rows = {d: t for d, t in rows.items() if not chain_says(chain, t)[1]}
    # near copies: the smallest id of each group linked by five-word shingles at 0.8
    sets, group = {d: shingled(t) for d, t in rows.items()}, {}
    for d in sorted(rows):
        todo = [d] if d not in group else []
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = d
                todo += [y for y in rows if y not in group and (sets[x] == sets[y] or len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]))]
    rows = {d: t for d, t in rows.items() if group[d] == d}
    # repeated passages
    seen, tokens = {}, {d: re.findall(rb"[^\x20\x09-\x0D]+", t.encode()) for d, t in rows.items()}
    for w in tokens.values():
        for a in range(len(w) - 34):
            seen[tuple(w[a : a + 35])] = seen.get(tuple(w[a : a + 35]), 0) + 1
    for d, w in tokens.items():
        hit = {k for a in range(len(w) - 34) if seen[tuple(w[a : a + 35])] > 1 for k in range(a, a + 35)}
        if hit:
            rows[d] = b" ".join(x for k, x in enumerate(w) if k not in hit).decode()
    # benchmark windows
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    patterns = {}
    for (t,) in table(spark, SF, "benchmark").select("text").collect():
        w = words(t)
        size = min(10, len(w))
        for a in range(len(w) - size + 1 if size else 0):
            patterns.setdefault(size, set()).add(tuple(w[a : a + size]))
    clean = lambda w: not any(tuple(w[a : a + n]) in own for n, own in patterns.items() for a in range(len(w) - n + 1))
    rows = {d: t for d, t in rows.items() if clean(words(t))}
    got = {r.doc_id: r for r in CP.run(spark, SF).collect()}
    assert set(got) == set(rows)
    assert all(got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for d, t in rows.items())


NAMES = ["_k", "_t", "_kk", "_tt", "_kept", "kept", "x.y", "row", "key", "found", "c0", "c1", "th", "fp", "node", "one", "b0", "run", "spans", "items", "id"]


def odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = ["a b c d e f", "a b c d e f", None, "", "quite another text it is", f"one {passage} two", f"three {passage} four five six", "long " * 30_000, " \n\t "]
    ids = [1, 1, None, 3, None, 5, 6, 7, 8]
    rows = [(i, t, "en", None if k % 2 else "s", None if t is None else len(t), *[f"{n}-{k}" for n in NAMES]) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame(rows, schema), rows


@pytest.mark.parametrize("stage", range(len(CP.STAGES) - 1))
def test_stages_keep_odd_rows_and_columns(spark, stage):
    docs, rows = odd_rows(spark)
    name, run = CP.STAGES[stage]
    out = run(spark, docs, SF)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = [tuple(r) for r in out.collect()]
    assert {r[5:] for r in got} <= {r[5:] for r in rows} and all(r[5 + NAMES.index("x.y")].startswith("x.y-") for r in got)
    assert run(spark, docs.where("false"), SF).count() == 0
    kept = {int(r[5].split("-")[1]): r for r in got}
    if name == "simhash near-dedup":  # one of the repeated row, of the wordless rows and of the two with the passage
        assert len(got) == 5 and {3, 4, 5, 7} < set(kept)
    elif name == "substring dedup":
        assert len(got) == len(rows) and kept[5][1] == "one two" and kept[5][4] == len("one two") and kept[6][1] == "three four five six"
        assert kept[7][1] == "" and all(kept[k][1] == rows[k][1] for k in (0, 1, 2, 3, 4, 8))
    else:
        assert len(got) == len(rows) and all(kept[k] == rows[k] for k in kept)


def test_last_stage_takes_odd_rows(spark):
    docs, rows = odd_rows(spark)
    got = CP.to_tokens(spark, docs, SF).collect()
    assert len(got) == len(rows) and all(r.roundtrip and r.parity for r in got if r.ids is not None)
