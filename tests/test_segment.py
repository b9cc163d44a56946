import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace.operators.segment import SegmentResources, _cut_pattern, segment, segment_exact, segment_text, segments
from millrace.sources.resources import Signed

RES = SegmentResources()
CASES = [
    ("One here. Two there. Three now.", ["One here.", "Two there.", "Three now."]),
    ("Dr. Smith came in. He sat down.", ["Dr. Smith came in.", "He sat down."]),
    ("Am 3. Oktober ist frei. Wir feiern da.", ["Am 3. Oktober ist frei.", "Wir feiern da."]),
    ('He said "no." Then he left us.', ['He said "no."', "Then he left us."]),
    ("Double.  Space stays here.", ["Double.  Space stays here."]),
    ("Pi is 3.5 or so. That is fine.", ["Pi is 3.5 or so.", "That is fine."]),
    ("No boundary at all", ["No boundary at all"]),
    ("It ends with one. Word.", ["It ends with one. Word."]),
    ("", []),
    ("Why? Because it is! Yes it is.", ["Why?", "Because it is!", "Yes it is."]),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_exact(text, want):
    assert segment_text(text, RES) == want


def test_native_agrees_with_exact(spark):
    rows = spark.createDataFrame([(t,) for t, _ in CASES], "text string")
    assert [r[0] for r in rows.select(segments(F.col("text"))).collect()] == [w for _, w in CASES]


def test_rules_decide(spark):
    res = SegmentResources(pre_rules=[Signed(r"\d+\.", False)], post_rules=[Signed("[a-z].*", True)])
    text = "He was 7. Then it was over. and so on it went. Now it ends here."
    want = ["He was 7. Then it was over. and so on it went.", "Now it ends here."]
    assert segment_text(text, res) == want
    rows = spark.createDataFrame([(text,)], "text string")
    assert rows.select(segments(F.col("text"), res)).first()[0] == want


def test_compat_keeps_old_quirks():
    assert segment_text("Pi is 3.14 or so. That is it now.", RES, compat=True) == ["Pi is 3.", "4 or so.", "That is it now."]
    assert segment_text("A b. C d e", RES, compat=True) == ["A b.", "C d e"]


def test_rows_keep_other_columns(spark):
    rows = spark.createDataFrame([(1, CASES[0][0]), (2, None)], "id int, text string")
    for run in (segment, segment_exact):
        assert [(r.id, r.seg) for r in run(rows).orderBy("id", "seg").collect()] == [(1, 0), (1, 1), (1, 2)]


def test_one_long_line(spark):
    """Time grows with the line, not with its square."""
    line = " ".join(f"word{k} next." if k % 7 == 0 else f"Word{k}" for k in range(100_000))
    rows = spark.createDataFrame([(1, line)], "id int, text string")
    n = line.count("next. ") - (1 if line.rsplit(" ", 2)[1] == "next." else 0)
    for run in (segment, segment_exact):
        assert run(rows).count() == n + 1


def test_split_last():
    own = SegmentResources(split_last=True)
    assert segment_text("It ends with one. Word.", own) == ["It ends with one.", "Word."]


def test_split_last_native(spark):
    rows = spark.createDataFrame([("It ends with one. Word.",), ("One.",), ("",), (None,)], "text string")
    assert [r[0] for r in rows.select(segments(F.col("text"), SegmentResources(split_last=True))).collect()] == [["It ends with one.", "Word."], ["One."], [], None]


def test_java_patterns_decide(spark):
    res = SegmentResources(pre_rules=[Signed(r"[\p{IsL}]\.", False)])
    text = "He met A. Miller there. Then he left us."
    assert segment_text(text, res) == ["He met A. Miller there.", "Then he left us."]
    assert spark.createDataFrame([(text,)], "text string").select(segments(F.col("text"), res)).first()[0] == ["He met A. Miller there.", "Then he left us."]


def test_the_pattern_for_lists_cuts_as_token_by_token(spark):
    """Random lines by the one pattern, and by the form for rules (with a rule that never matches). What the pattern looks at first is one
    character, not every boundary at every place."""
    rng = random.Random(4)
    parts = ["Dr.", "dr.", "Mai", "Mai.", 'mai."', "März!", "z.B.", "a", "b.", 'c."', "d!”", "", "e…", "Mai..", "p.", "xp.", "É?", "(Dr.", "f.)", "3."]
    rows = spark.createDataFrame([(k, " ".join(rng.choice(parts) for _ in range(rng.randrange(12)))) for k in range(3000)], "k int, text string")
    for own in (SegmentResources(), SegmentResources(split_last=True), SegmentResources(pre_list=[]), SegmentResources(post_list=[]), SegmentResources(post_list=["Mai."])):
        slow = replace(own, pre_rules=[Signed("never", False)])
        both = rows.select("k", segments(F.col("text"), own).alias("a"), segments(F.col("text"), slow).alias("b"))
        assert both.where("a <> b").take(3) == [] and both.where("size(a) > 1").count() > 100
    assert _cut_pattern(SegmentResources()).startswith(" (?<=[")
