import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions.text import words, words_arrow
from millrace.operators import langid as L


@pytest.fixture
def profile(spark):
    return spark.createDataFrame([("de", "der", 6, 0.6), ("de", "so", 4, 0.4), ("en", "the", 5, 0.5), ("en", "so", 4, 0.4), ("en", "x", 1, 0.1)], "lang string, word string, freq int, prob double")


def test_scores_penalise_unknown_words(spark, profile):
    rows = spark.createDataFrame([(1, "der zzz"), (2, "the so"), (3, "so"), (4, "qqq"), (5, "der  the ")], "id int, text string")
    got = {(r.id, r.lang): r.prob for r in L.scores(rows, profile, ["id"]).collect()}
    assert got[1, "de"] == pytest.approx((0.6 + 0.1 - 1e-6) / 2, abs=1e-8)
    assert got[2, "en"] == pytest.approx(0.45, abs=1e-8)
    assert not any(k[0] == 4 for k in got)
    best = {r.id: r.lang for r in L.identify(rows, profile, ["id"]).collect()}
    assert best == {1: "de", 2: "en", 3: "de", 5: "de"}  # a tie goes to the first name
    kept = {r.id: r.lang for r in L.identify(rows, profile, ["id"], keep_unknown=True).collect()}
    assert kept[4] is None and len(kept) == 5
    assert [r.id for r in L.unknown(rows, profile, ["id"]).collect()] == [4]
    assert {r["rank"] for r in L.ranked(rows, profile, ["id"]).collect()} == {1, 2}


def test_profile(spark):
    rows = spark.createDataFrame([("a", "x y x"), ("b", "y")], "lang string, text string")
    got = {(r.lang, r.word): r.prob for r in L.build_profile(rows).collect()}
    assert got == {("a", "x"): pytest.approx(2 / 3), ("a", "y"): pytest.approx(1 / 3), ("b", "y"): 1.0}
    assert L.least_probability(L.build_profile(rows)).first()[0] == pytest.approx(1 / 3 - 1e-6)
    empty = rows.where("false")
    assert L.identify(empty.selectExpr("1 AS id", "text"), L.build_profile(rows), ["id"]).count() == 0


def test_words_in_arrow_are_those_of_the_column(spark):
    texts = ["a b", " a  b ", "", " ", "   ", None, "a b ", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    assert words_arrow(pa.array(texts)).to_pylist() == [r[0] for r in rows.select(words(F.col("text"))).collect()]
    assert words_arrow(pa.array(["a b", "c"])).to_pylist() == [["a", "b"], ["c"]]


def test_no_row_is_moved_for_each_occurrence_of_a_word(spark, monkeypatch):
    """What meets the profile are the distinct words of a block, however often they occur; buffers and slices that run over change nothing."""
    lines = [(k, "der so " * 50 + "der") for k in range(200)] + [(k + 200, "the x so qqq") for k in range(50)]
    rows = spark.createDataFrame(lines, "id int, text string").repartition(3)
    profile = spark.createDataFrame([("de", "der", 0.6), ("de", "so", 0.4), ("en", "the", 0.5), ("en", "so", 0.4), ("en", "x", 0.1)], "lang string, word string, prob double")
    batches = rows.selectExpr("id % 2 AS b", "text").toArrow().to_batches(7)
    assert sum(b.num_rows for b in L.counter("b")(iter(batches))) <= 2 * 5
    want = {(r.id, r.lang): r.prob for r in L.scores(rows, profile, ["id"]).collect()}
    assert len(want) == 500 and want[0, "de"] == pytest.approx((51 * 0.6 + 50 * 0.4) / 101, abs=1e-8) and want[249, "en"] == pytest.approx((1.0 + 0.1 - 1e-6) / 4, abs=1e-8)
    for name in ("MOST_PAIRS", "SLICE_ROWS", "SLICE_SUMS"):
        monkeypatch.setattr(L, name, 3)
    cut = [x for b in L.counter("b")(iter(batches)) for x in b.to_pylist()]
    assert sum(x["n"] for x in cut if x["word"] == "der") == 200 * 51
    one = rows.where("id IN (0, 249)").toArrow().rename_columns(["id", "__text"])
    known = pa.table({k: [r[k] for r in profile.collect()] * 2 for k in ("word", "lang", "prob")})
    got = L._summed(one, known, ["id"]).to_pylist()
    assert {(x["id"], x["__lang"], x["__n"], x["__found"]) for x in got} == {(0, "de", 101, 101), (0, "en", 101, 50), (249, "en", 4, 3), (249, "de", 4, 1)}
