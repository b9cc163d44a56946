import hashlib
import io
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, toxicity, urls, warc
from millrace.llm.catalog import ORACLES, QUERIES
from millrace.session import shared_dir

SF = "/root/testdata/sf0.001"

# --- toxicity ---


def labelled(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["scum", "moron", f"vequ{rng.randrange(99)}"])
        low = i % 3 == 0
        if low:
            words.append("click")
        rows.append((i, " ".join(words), int(not low), int(bad)))
    return rows


def test_chain_on_held_out_texts(spark):
    rows = labelled()
    train = spark.createDataFrame(rows[:400], "doc_id long, text string, quality int, toxic int")
    chain = toxicity.chain_for(train.select("doc_id", "text"), train.select("doc_id", "quality", "toxic"))
    test = spark.createDataFrame([(i, t) for i, t, *_ in rows[400:]] + [(9998, None), (9999, "")], "doc_id long, text string").withColumn("rejected", F.lit("clash"))
    got = {r.doc_id: r for r in toxicity.score(test, chain).collect()}
    assert sum(got[i].rejected == bool(b) for i, _, _, b in rows[400:]) >= 190
    assert not got[9998].rejected and not got[9999].rejected
    kept = toxicity.clean(test, chain)
    assert kept.columns == test.columns and kept.count() == sum(not r.rejected for r in got.values())


def test_later_models_use_earlier_probabilities():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 2, 800)
    rows = [np.array([2 if a else 4], "i8") for a in first]
    chain = toxicity.fit_chain(rows, np.column_stack([first, first]), ("a", "b"))
    assert len(chain.models[1].chained) == 1 and chain.models[1].chained[0] > 0


@pytest.mark.parametrize("rows", [[], [(1, 1, 0)], [(1, None, None), (None, 1, 1)]])
def test_without_both_classes_nothing_is_rejected(spark, rows):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    chain = toxicity.chain_for(docs, labels)
    assert not any(r.rejected for r in toxicity.score(docs, chain).collect())


# --- warc ---

HTML = "<html>" + "é" * 200


def test_archives_round_trip(spark):
    rng = random.Random(4)
    rows = [(i, f"http://x/{i}", "".join(rng.choice("abc<>é") for _ in range(rng.randrange(3000)))) for i in range(60)]
    rows += [(100, "u", HTML), (70, "u\r\nWARC-Type: x", HTML), (80, None, HTML), (90, "u", None), (91, "u", ""), (92, "u", "small"), (93, "u", "small"), (70, "again", HTML), (None, "n", HTML)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    manifest = warc.write(pages, f"{shared_dir(spark)}/warc-test")
    for step in (333, 1 << 20):
        got = warc.read(manifest, step=step, keep_payload=True).collect()
        assert len(got) == len(rows) and all(r.intact for r in got)
        want = []
        for page, _, html in rows:
            raw = (html or "").encode()
            revisit = html == HTML and page not in (70, None)
            want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 70 if revisit else None))
        assert sorted(map(repr, want)) == sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
        assert all(bytes(r.payload) == b"" or hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest for r in got)
    for row in manifest.collect():  # plain gzip readers read the files too
        raw, out = open(row.path.removeprefix("file://"), "rb").read(), b""
        while raw:
            z = zlib.decompressobj(31)
            out += z.decompress(raw)
            raw = z.unused_data
        assert out.count(b"WARC/1.1\r\n") == row.n_records
    assert warc.read(warc.write(pages.where("false"), f"{shared_dir(spark)}/warc-none")).count() == 0


def test_false_magic_is_skipped():
    inner = warc.member(warc.record(7, "u", b"x" * 50, "d", "response", None))
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    fake = warc.MAGIC + b"\x00" * 20
    first = warc.member(warc.record(1, "u", b"a", "d", "response", None))
    noise = stored.compress(b"not a record " + fake) + stored.flush()
    data = noise + first + fake + inner
    got = [f["warc-record-id"] for f, _ in warc.Range(io.BytesIO(data), len(data), 0, len(data)).records()]
    assert got == ["<urn:page:1>", "<urn:page:7>"]
    for cut in range(1, len(data)):
        both = [list(warc.Range(io.BytesIO(data), len(data), a, b).records()) for a, b in ((0, cut), (cut, len(data)))]
        assert sum(map(len, both)) == 2


# --- urls ---


def test_rules_and_parts(spark):
    rows = [
        (1, "https://WWW.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (2, "http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        (3, "http://example.com/de/", "example.com", "/de/", "com/", "allow"),
        (4, "http://x.net/fr/1#a/b", "x.net", "/fr/1", "net/fr/", "block"),
        (5, "http://x.net/frx", "x.net", "/frx", None, None),
        (6, None, "", "", None, None),
        (7, "nothing", "", "", None, None),
        (8, "http://examplecom/en/", "examplecom", "/en/", None, None),
        (9, "http://com", "com", "", None, None),
        (10, "a://b://c/d", "b:", "//c/d", None, None),
        (11, "http://b.com?x=/y", "b.com", "", None, None),
        (11, "http://b.com?x=/y", "b.com", "", None, None),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").withColumn("line", F.lit("clash"))
    got = urls.judge(df).collect()
    assert sorted(map(repr, ((r.page_id, r.host, r.path, r.rule) for r in got))) == sorted(repr((r[0], *r[2:5])) for r in rows)
    said = {r.page_id: r.verdict for r in got}
    assert all(said[r[0]] == r[5] for r in rows if r[5]) and set(said.values()) == {"allow", "block"}
    assert urls.judge(df.where("false")).count() == 0


def test_model_by_brute_force(spark):
    rows = [(i, f"http://good{i % 7}.com/p/{i}") for i in range(40)] + [(100 + i, f"http://spam{i % 5}.net/es/{i}") for i in range(40)] + [(200, "http://good3.org/p/4"), (201, "http://spam2.org/es/9"), (202, "://")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    size, c = len(urls.ALPHABET) + 2, urls.CONCENTRATION
    fold = lambda s: "".join(x if x in urls.ALPHABET else urls.OTHER for x in s.lower())
    lines = {}
    for r in got.values():
        lines.setdefault((r.host + r.path, r.verdict if r.rule else None), 0)
        lines[r.host + r.path, r.verdict if r.rule else None] += 1
    held = {r.l for r in spark.createDataFrame([(k[0],) for k in lines], "l string").where(F.pmod(F.xxhash64("l"), F.lit(urls.HELD_OUT)) == 0).collect()}
    counts = {"allow": {}, "block": {}}
    for (line, said), n in lines.items():
        if said and line not in held:
            s = urls.START * urls.ORDER + fold(line)
            for at in range(urls.ORDER, len(s)):
                for k in range(urls.ORDER + 1):
                    for key in (("g", s[at - k : at + 1]), ("c", k, s[at - k : at])):
                        counts[said][key] = counts[said].get(key, 0) + n

    def log_p(said, s, at):
        p = 1 / size
        for k in range(urls.ORDER + 1):
            p = (counts[said].get(("g", s[at - k : at + 1]), 0) + c * p) / (counts[said].get(("c", k, s[at - k : at]), 0) + c)
        return np.log(p)

    for page in (200, 201):
        s = urls.START * urls.ORDER + fold(got[page].host + got[page].path)
        places = range(urls.ORDER, len(s))
        want = sum(log_p("allow", s, i) - log_p("block", s, i) for i in places) / len(places)
        assert got[page].score == pytest.approx(want, abs=2e-6)
    assert got[200].verdict == "allow" and got[201].verdict == "block"


# --- chat ---


def test_preference_pairs(spark):
    turn = lambda role, text: {"role": role, "text": text}
    a, b, c = turn("user", "hi"), turn("assistant", "yes"), turn("assistant", "no 😀")
    pairs = spark.createDataFrame(
        [(1, [a, b], [a, c]), (2, [a, b], [a, b]), (3, [b], []), (4, None, [a]), (5, [a, b, a, c], [a, b])],
        "conv_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>",
    )
    got = {r.conv_id: r for r in chat.format_pairs(pairs).collect()}
    assert got[1].n_prefix == 1 and got[1].prompt == "<|im_start|>user\nhi<|im_end|>\n"
    assert [got[1].rejected_text[m.a : m.b] for m in got[1].rejected_mask] == ["no 😀<|im_end|>\n"]
    assert got[2].n_prefix == 2 and got[2].chosen_text == got[2].rejected_text == "" and got[2].chosen_mask == []
    assert got[3].n_prefix == 0 and got[3].rejected_text == "" and got[4].chosen_text == "" and got[4].rejected_mask == []
    assert got[5].n_prefix == 2 and got[5].chosen_text.count("<|im_start|>") == 2 and len(got[5].chosen_mask) == 1


def test_derived_pairs(spark):
    rows = [(1, 0, "user", "q", 0), (1, 1, "assistant", "a1", 0), (1, 2, "user", "more", 0), (2, 1, "assistant", "a2", 0), (2, 0, None, None, 0), (3, 0, "user", "alone", 0), (None, 0, "user", "x", 0), (1, 1, "assistant", "a1", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    got = {r.conv_id: r for r in chat.format_pairs(chat.derived_pairs(df)).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1].n_prefix == 2 and "a1" in got[1].chosen_text and "a2" in got[1].rejected_text
    assert got[2].rejected_text == "" and "a2" in got[2].chosen_text and got[3].prompt.endswith("alone<|im_end|>\n")
    assert chat.derived_pairs(df.where("false")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
def test_op6_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    got = QUERIES["op6_preferences"](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES['op6_preferences']})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*cols).collect())
