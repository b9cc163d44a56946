import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import decontaminate as D
from millrace.llm import html as H
from millrace.llm import media as M
from millrace.llm import minhash, simhash
from millrace.llm import spm as P
from millrace.llm.common import forget, map_arrow, materialise

# --- decontamination ---


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_hits(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if size else 0):
            for b in range(len(own) - size + 1):
                if own[b : b + size] == w[a : a + size]:
                    hit.update(range(b, b + size))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_hits_by_brute_force(spark):
    random.seed(1)
    text = lambda n: " ".join(random.choice("a b c É d1 F".split()) for _ in range(n))
    items = [(i, text(random.randrange(9))) for i in range(12)] + [(50, None), (51, "..."), (52, "a b c"), (53, "a b c")]
    docs = [(i, text(random.randrange(40)) + random.choice([".", ", É", ""])) for i in range(40)] + [(90, None), (91, ""), (None, "a-b C"), (92, "a b c"), (92, "a b c")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(0))
    bench = spark.createDataFrame(items, "item_id int, text string")
    for window in (3, 10):
        rows = D.digest(D.hits(df, bench, window)).collect()
        want = [(d, *plain_hits(t, items, window)) for d, t in docs]
        want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in want]
        assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    kept = D.clean(df, bench, 10)
    assert kept.columns == df.columns and kept.count() == sum(not plain_hits(t, items, 10)[1] for _, t in docs)


def test_many_items_go_in_groups(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_PATTERN_WORDS", 40)
    items = [(i, f"w{i} x{i} y{i} z{i}") for i in range(9)]
    docs = spark.createDataFrame([(1, "w3 x3 y3 z3 and w8 x8 y8 z8 q"), (2, "none")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in D.digest(D.hits(docs, spark.createDataFrame(items, "item_id int, text string"))).collect()}
    assert got == {1: (8, 2), 2: (0, 0)}


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id int, text string")
    assert D.hits(docs, bench).count() == 0
    assert D.digest(D.hits(spark.createDataFrame([(1, "a")], "doc_id long, text string"), bench)).first().contaminated is False


# --- html ---

PROSE = "The old house stood on the hill near the town and it was a quiet place for all of the years that we had been there. "


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain text", ""),
        ("<article><h1>T &amp; U</h1><p>a\n  b<br>c</article>", "T & U\na b c"),
        (f"<nav><a href=x>Menu</a></nav><main><p>{PROSE}</p><aside>{PROSE}</aside></main><footer>{PROSE}</footer>", PROSE.strip()),
        (f"<article><p>x</p><script>var t='</p>';</script><style>p{{}}</style><!-- <p>no</p> --><div class='ad'>Buy</div><form><p>f</p></form><section id=comments>{PROSE}</section><p>y</p></article>", "x\ny"),
        (f"<div id=wrap><h1>Head</h1><p>{PROSE * 2}</p><p>Short one.</p><p>{PROSE * 2}</p></div><div class=cookie-notice>{PROSE * 2}</div><ul><li><a>one</a><li><a>two</a></ul>", f"Head\n{(PROSE * 2).strip()}\nShort one.\n{(PROSE * 2).strip()}"),
        ("<article><p>never closed <b>bold", "never closed bold"),
        ("<article><p>&#x41;&eacute;&nbsp;&lt;b&gt;</p></article>", "Aé <b>"),
    ],
)
def test_main_text(html, want):
    assert H.extract(html) == want


@given(st.text(alphabet="<>/apdiv\"'= !-&;", max_size=80))
@settings(max_examples=200, deadline=None)
def test_any_markup_is_read(text):
    assert isinstance(H.extract(text), str)


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>a😀</article>"), (2, None, None), (None, "v", ""), (1, "u", "<article><p>a😀</article>")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted((str(r.page_id), r.n_chars) for r in H.main_text(df).collect()) == [("1", 2), ("1", 2), ("2", 0), ("None", 0)]
    assert H.main_text(df.where("false")).count() == 0


# --- media ---


@given(st.text(max_size=300))
@settings(max_examples=50, deadline=None)
def test_wav_round_trip(text):
    payload, n = M.payload_of(text)
    assert n == len(text.encode()) and len(payload) % 64 == 0 and len(payload) >= 64 and payload[n:].strip(b"\0") == b""
    assert M.from_wav(M.to_wav(payload)) == (payload, M.RATE)


def test_peaks_find_tones():
    import numpy as np

    t = np.arange(M.FRAME * 4)
    wave = (128 + 50 * np.sin(2 * np.pi * 100 * t / M.FRAME) + 30 * np.sin(2 * np.pi * 300 * t / M.FRAME)).astype("u1").tobytes()
    peaks = M.peaks_of(wave)
    assert (peaks[:, 0] == 100).all() and (peaks[:, 1] == 300).all()
    times, marks = M.landmarks(wave)
    assert (times[:-1] <= times[1:]).all() and (100 << 20 | 300 << 8 | 1) in marks.tolist()


def test_blocks_do_not_change_peaks(monkeypatch):
    raw = random.Random(2).randbytes(M.FRAME * 7 + 64)
    whole = M.landmarks(raw)
    monkeypatch.setattr(M, "BLOCK", 2)
    assert all((a == b).all() for a, b in zip(whole, M.landmarks(raw), strict=True))


def test_media_rows(spark):
    df = spark.createDataFrame([(1, "same text " * 300), (2, "same text " * 300), (3, None), (None, "")], "doc_id long, text string").withColumn("media", F.lit("clash"))
    rows = {r.doc_id: r for r in M.media_column(df, keep_media=True).collect()}
    assert rows[1].feature == rows[2].feature and rows[1].media_sha256 == rows[2].media_sha256 and len(rows[1].media) == rows[1].media_bytes
    assert rows[3].payload_bytes == 64 and rows[3].payload_sha256 == hashlib.sha256(bytes(64)).hexdigest() == rows[None].payload_sha256


# --- sentencepiece ---


@pytest.fixture(scope="module")
def codec():
    return P.Codec(P.read_model())


TEXTS = ["Hello world", "  a  b   c", "", "x\ny\r\n", "\x00é", "日本語 テスト", " ", "        q", "naïve — “quoted” 😀 text", "a" * 300, "<s> </s> <0x0A> <unk>"]


def test_parity_with_the_library(codec):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abcXYZ  .,'\n0189éß▁") for _ in range(rng.randrange(200))) for _ in range(300)]
    got = codec.encode(texts)
    want = codec.library.encode(texts)
    import numpy as np

    assert [np.frombuffer(a, "<i4").tolist() for a, _ in got] == want
    assert all(same for _, same in got)
    assert [codec.decode(a).decode() for (a, _), t in zip(got, texts, strict=True)] == [t.replace("▁", " ") for t in texts]


@given(st.text(max_size=80))
@settings(max_examples=150, deadline=None)
def test_round_trip(text):
    own = P.codec(P.read_model())
    ((ids, same),) = own.encode([text])
    assert same and own.decode(ids).decode() == text.replace("▁", " ")


def test_whole_texts_are_the_other_way(codec):
    other = P.Codec(P.read_model())
    other.split, other.tokenizer = False, P.build(other.model)
    assert [a for a, _ in other.encode(TEXTS[:1] + TEXTS[3:])] == [a for a, _ in codec.encode(TEXTS[:1] + TEXTS[3:])]


def test_unigram_model_is_rebuilt():
    import struct

    def field(n, raw):
        size, head = len(raw), bytes([n << 3 | 2])
        out = b""
        while True:
            out += bytes([size & 127 | (128 if size > 127 else 0)])
            size >>= 7
            if not size:
                return head + out + raw

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([0x18, kind]))

    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *[(f"<0x{i:02X}>", 0, 6) for i in range(256)], ("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1), ("ab", -2.2, 1), ("▁ab", -2.7, 1)]
    raw = b"".join(piece(*p) for p in pieces) + field(2, bytes([0x18, 1]) + b"\x98\x02\x01") + field(3, field(1, b"identity") + b"\x18\x01\x20\x00\x28\x01")
    own = P.Codec(raw)
    assert own.model.kind == "unigram" and own.model.byte_fallback and own.split
    import numpy as np

    for text in ("ab a b", "abab", "  b é", "q"):
        ((ids, _),) = own.encode([text])
        assert np.frombuffer(ids, "<i4").tolist() == own.library.encode(text) and own.decode(ids).decode() == text


def test_encode_rows(spark):
    df = spark.createDataFrame([(1, "Hello  world"), (2, None), (None, ""), (1, "Hello  world")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    rows = P.encode(df)
    got = {r.doc_id: r for r in rows.collect()}
    assert got[2].ids is None and got[2].n_tokens == 0 and got[None].ids == [] and got[1].roundtrip and got[1].parity
    assert {r.doc_id: r.text for r in P.decode(rows).collect()} == {1: "Hello  world", 2: None, None: ""}
    table, path = materialise(rows, "t")
    assert table.count() == 4
    forget(spark, path)
    assert P.encode(df.where("false")).count() == 0


def test_every_whole_text_is_compared():
    """A library that differs on whole texts only is noticed in each of them, not in a sample."""
    own = P.Codec(P.read_model())
    true = own.library

    class Other:
        def encode(self, texts, **more):
            ids = true.encode(texts, **more)
            return ids + [0] if isinstance(texts, str) and " " in texts else ids

        def decode(self, ids):
            return true.decode(ids) + "?"

    own.library = Other()
    texts = [f"word {i}" for i in range(200)]
    got = own.encode([*texts, "word"])
    assert [ok for _, ok in got] == [False] * 200 + [True]
    assert not any(own.decoders_agree(ids, own.decode(ids)) for ids, _ in got)


class Counted:
    """A tokenizer that notes how many texts and words it is given."""

    def __init__(self, inner):
        self.inner, self.texts, self.words = inner, 0, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        self.words += sum(len(t.split(" ")) for t in texts)
        return self.inner.encode_batch_fast(texts, **more)


def counted(own):
    out = [Counted(getattr(own, name)) for name in ("tokenizer", "joined") if hasattr(own, name)]
    for name, one in zip(("tokenizer", "joined"), out, strict=False):
        setattr(own, name, one)
    return out


def test_chunks_are_encoded_together():
    own = P.Codec(P.read_model())
    count = counted(own)
    odd = ["", " ", "a  b", "  a   ", "x▁y ▁", "é\n\tz 日本語", "😀 \x00", "<s> <0x0A>", "q" * 5000 + " r"]
    texts = [" ".join(f"w{i}x{k}," for k in range(50)) for i in range(60)] + odd
    got = own.encode(texts)
    assert all(same for _, same in got)
    assert sum(c.words for c in count) >= 3000 and sum(c.texts for c in count) < 30


def test_a_full_cache_keeps_what_comes_again(monkeypatch):
    monkeypatch.setattr(P, "CACHE", 50)
    own = P.Codec(P.read_model())
    count = counted(own)
    many = " ".join(f"word{i}" for i in range(60))
    first = own.encode([many])
    own.encode(["other"])
    words = sum(c.words for c in count)
    assert own.encode([many]) == first and sum(c.words for c in count) == words == 61
    for i in range(300):  # bounded all the same
        assert own.encode([f"new{i} word7 {'z' * 100}{i}"])[0][1]
        assert len(own.cache) + len(own.before) <= 2 * 50 + 65 and not any(len(x) > P.CACHE_CHARS for x in [*own.cache, *own.before])


def test_bytes_that_spell_a_marker_decode_alike(codec):
    import numpy as np

    own = [codec.model.ids[p] for p in ("▁", "a", "<0xE2>", "<0x96>", "<0x81>", "▁", "b")]
    ids = np.array(own, "<i4").tobytes()
    assert codec.decode(ids).decode() == "a▁ b" and codec.decoders_agree(ids, codec.decode(ids))


def test_every_row_is_verified(spark):
    df = spark.createDataFrame([(i, f"text {i}  of many" if i % 9 else None) for i in range(300)], "doc_id long, text string")
    assert all(r.verified and r.parity for r in P.encode(df).collect())


# --- html: structure is a feature, the passes decide


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f"<article><p>{PROSE}<video-player src=x></video-player><p>{PROSE}<svg-icon/><p>End of it.</article>", "\n".join([PROSE.strip()] * 2 + ["End of it."])),
        (f"<article><p>{PROSE}<button>Press<p>{PROSE}</article>", "\n".join([PROSE.strip()] * 2)),
        (f"<article><p>{PROSE}</p><p class=advert>{PROSE}</p><p hidden>{PROSE}</p><p style='display: none'>{PROSE}</p><ul><li class=share>{PROSE}</ul><p>Stay<span class=cookie-notice> gone</span>.</article>", f"{PROSE.strip()}\nStay."),
        (f"<body><form id=aspnet><nav><a href=x>Menu</a></nav><h1>Head</h1><p>{PROSE}</p></form></body>", f"Head\n{PROSE.strip()}"),
        (f"<div class='post reviews'><h1>Head</h1><p>{PROSE * 2}</p></div>", f"Head\n{(PROSE * 2).strip()}"),
        (f"<div class='post reviews'><p>{PROSE * 2}</p></div>", (PROSE * 2).strip()),
        (f"<article><h1>Head</h1><p>{PROSE * 3}</p></article><article class=teaser><h2><a href=x>More</a></h2><p>{PROSE}</p></article>", f"Head\n{(PROSE * 3).strip()}"),
        (f"<article><h1><a href=x>Linked head</a></h1><p>{PROSE}</p><p><a href=1>one two</a> <a href=2>three four five</a></p><p>Short.</p></article>", f"Linked head\n{PROSE.strip()}\nShort."),
        (f"<article class=card><p>Teaser.</p></article><div><h1>Head</h1><p>{PROSE * 2}</p><p>{PROSE * 2}</p></div>", f"Head\n{(PROSE * 2).strip()}\n{(PROSE * 2).strip()}"),
        (f"<main><header><h1>Title</h1></header><p>{PROSE}</p></main><p>&copy; us, and all of the rest is ours</p>", f"Title\n{PROSE.strip()}"),
        ("<article><p>a < b and 2 > 1 <p>x</article>", "a < b and 2 > 1\nx"),
        (f"<article><p>{PROSE}<noscript><div>no</div></noscript><select><option>one</select></p><script>x", PROSE.strip()),
    ],
)
def test_structure_is_a_feature(html, want):
    assert H.extract(html) == want


def plain_decision(blocks, labels, edge):
    """The second pass told block by block: look left and right for the nearest decided block; middling ones first."""
    if edge == H.BAD and H.GOOD not in labels:
        labels = [H.GOOD if x == H.NEAR else x for x in labels]
    for kind in (H.NEAR, H.SHORT):
        kept = plain_step(blocks, labels, edge)
        labels = [(H.GOOD if k else H.BAD) if x == kind else x for k, x in zip(kept, labels, strict=True)]
    return [x == H.GOOD for x in labels]


def plain_step(blocks, labels, edge):
    out = []
    for i, (b, own) in enumerate(zip(blocks, labels, strict=True)):
        if own == H.GOOD or own == H.BAD:
            out.append(own == H.GOOD)
            continue
        left = next(((labels[j], i - j) for j in range(i - 1, -1, -1) if labels[j] in (H.GOOD, H.BAD)), (edge, i + 1))
        right = next(((labels[j], j - i) for j in range(i + 1, len(labels)) if labels[j] in (H.GOOD, H.BAD)), (edge, len(labels) - i))
        if b.heading:
            out.append((left if i == len(labels) - 1 else right)[0] == H.GOOD)
        elif left[0] == right[0]:
            out.append(left[0] == H.GOOD)
        elif left[1] != right[1]:
            out.append(min(left, right, key=lambda x: x[1])[0] == H.GOOD)
        else:
            words = b.text.lower().split()
            share = sum(w.strip(".,;:!?()\"'") in H.STOP_WORDS for w in words) / len(words)
            out.append(share >= H.HIGH_STOP or own == H.SHORT and b.text.endswith((".", "!", "?", "…")) and b.links == 0)
    return out


def plain_label(b, inside):
    words = b.text.lower().split()
    share = sum(w.strip(".,;:!?()\"'") in H.STOP_WORDS for w in words) / len(words)
    n = len(b.text)
    if b.heading:
        return H.SHORT
    if b.links > 0.4 * n or (n < 140 and not inside and "©" in b.text):
        return H.BAD
    if n < 60:
        return H.BAD if b.links and not inside else H.SHORT
    if share >= 0.2:
        return H.GOOD if n >= 140 or inside else H.NEAR
    return H.NEAR if inside or share >= 0.08 else H.BAD


def test_passes_by_brute_force():
    rng = random.Random(11)
    vocabulary = "the and of to in it stone river valley window garden quiet morning © walked".split()
    for _ in range(3000):
        blocks = []
        for _ in range(rng.randrange(1, 14)):
            text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 12, 40]))) + rng.choice(["", ".", "?"])
            blocks.append(H.Block(text, rng.choice([0, 0, 0, len(text) // 5, len(text)]), 0, rng.random() < 0.1, ()))
        for inside in (False, True):
            labels = [H.first_pass(b, inside) for b in blocks]
            assert labels == [plain_label(b, inside) for b in blocks]
            edge = H.GOOD if inside else H.BAD
            assert H.second_pass(blocks, labels, edge) == plain_decision(blocks, labels, edge)


def test_every_page_of_the_table_by_its_article():
    """The pages' articles are known: what the tags hold, block by block, told by another parser."""
    import html.parser
    import os

    duckdb = pytest.importorskip("duckdb")
    path = "/root/testdata/sf0.01/pages.parquet"
    if not os.path.isfile(path):
        pytest.skip("needs the generated tables")

    class Article(html.parser.HTMLParser):
        def __init__(self):
            super().__init__()
            self.on, self.out, self.skip = False, [""], 0

        def handle_starttag(self, tag, attrs):
            self.on = self.on or tag == "article"
            self.skip += tag in ("script", "style")
            if tag in ("p", "h1", "h2", "li", "ul"):
                self.out.append("")
            if tag == "br":
                self.out[-1] += " "

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style")
            if tag == "article":
                self.on = False
            if tag in ("p", "h1", "h2", "li", "ul", "article"):
                self.out.append("")

        def handle_data(self, data):
            if self.on and not self.skip:
                self.out[-1] += data

    for (page,) in duckdb.sql(f"SELECT html FROM '{path}'").fetchall():
        other = Article()
        other.feed(page)
        assert H.extract(page) == "\n".join(x for b in other.out if (x := " ".join(b.split())))


def test_scan_is_linear():
    import time

    for piece in ("<a ", "<p><b>", "<a href='", "<button>", "<div><a>", "<noscript>", "<!--", "<li><div>", '<a "\'>'):
        began = time.time()
        H.extract(piece * (1_000_000 // len(piece)))
        assert time.time() - began < 20, piece


def test_workers_drop_what_other_operators_keep(spark):
    docs = spark.createDataFrame([(i, f"word {i} in a text") for i in range(64)], "doc_id long, text string").repartition(16)

    def held(batch):
        return {"n": [len(P._CODECS)] * batch.num_rows}

    assert P.encode(docs).count() == P.encode(docs).where("parity").count() == 64
    with_owner = {r.n for r in map_arrow(docs, held, "n long", P.OWNER).collect()}
    assert 1 in with_owner  # the operator's own next tasks still have it
    assert {r.n for r in map_arrow(docs, held, "n long").collect()} == {0}
    assert P.encode(docs).where("parity").count() == 64


@pytest.mark.parametrize("search", [minhash._search, simhash._search(4)])
def test_searches_begin_without_codecs(search):
    P.codec(P.read_model()).encode(["a text"])
    assert P._CODECS
    assert list(search(iter([]))) == []
    assert not P._CODECS
