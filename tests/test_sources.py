from pyspark.sql import functions as F

from millrace.functions.text import utf16_length, words
from millrace.operators.sources import lines, source_index, with_source_id
from millrace.sources import text as T


def test_framing_round_trip(spark, tmp_path):
    rows = [(1, "plain"), (2, "a, b), (c,9)"), (3, ""), (4, "astral 😀 one"), (-5, "5,x,6)")]
    df = spark.createDataFrame(rows, "source_id long, text string")
    T.write_framed(df, str(tmp_path / "f"))
    back = T.read_framed(spark, str(tmp_path / "f")).collect()
    assert sorted((r.source_id, r.text) for r in back) == sorted(rows)
    assert {r.source_id: r.n_chars for r in back}[4] == 13
    bad = spark.createDataFrame([("(3,ab,1)",), ("x",)], "v string")
    assert bad.where(T.unframed(F.col("v")).isNotNull()).count() == 0


def test_tagged_sources(spark, tmp_path):
    (tmp_path / "in.txt").write_text("<source><location>a</location></source>first\n\nthird\n<source>lost body\n<source><location>b</location></source>\nx\n<source>h</source>")
    rows = T.read_tagged(spark, str(tmp_path / "in.txt"))
    assert sorted((r.line_idx, r.text) for r in rows.collect()) == [(0, "first"), (1, "x"), (2, "third")]
    assert {r.source.location for r in T.with_header_fields(rows).collect()} == {"a", "b"}
    plain = T.read_plain(spark, str(tmp_path / "in.txt"))
    assert {r.metadata for r in plain.collect()} == {""}


def test_source_index_is_dense_and_stable(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "metadata string")
    index = {r.metadata: r.source_id for r in source_index(df).collect()}
    assert index == {None: 0, "a": 1, "b": 2}
    assert with_source_id(df, source_index(df)).count() == 4
    assert source_index(df, mode="hash").count() == 3
    assert source_index(df.where("false")).count() == 0


def test_words_and_lines(spark):
    df = spark.createDataFrame([("a b",), ("a  b  ",), ("  ",), ("",), (" a",)], "text string")
    assert [r[0] for r in df.select(words(F.col("text"))).collect()] == [["a", "b"], ["a", "", "b"], [], [""], ["", "a"]]
    df = spark.createDataFrame([(1, "x\n\ny")], "id int, text string")
    assert [(r.line_idx, r.text) for r in lines(df).collect()] == [(0, "x"), (2, "y")]
    assert spark.createDataFrame([("😀a",)], "t string").select(utf16_length(F.col("t"))).first()[0] == 3


def test_word_lists(spark, tmp_path):
    (tmp_path / "deu.words").write_text("100\n10\tder\nbad\n5\tdie\n")
    (tmp_path / "eng.words").write_text("50\n10\tthe\n")
    rows = T.read_word_lists(spark, str(tmp_path))
    assert {(r.lang, r.word, r.freq, r.total) for r in rows.collect()} == {("deu", "der", 10, 100), ("deu", "die", 5, 100), ("eng", "the", 10, 50)}
    assert T.read_word_lists(spark, str(tmp_path), ["eng"]).count() == 1
