import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators import clean as C
from millrace.sources.resources import CZECH, LONGER, RULES, WEB, merged_rules, rejected_characters, rejected_java

GOOD = "This is a decent sentence of some words."
HITS = {
    1: "lower case at the start of it.", 2: "?Why does it start in this way.", 3: "No mark at the end of this one", 5: "It is w o r d s that are spaced out.",
    6: "Two  spaces are in this sentence.", 7: "A,b,c,d,e,f,g,h,i,j,k it goes on and on.", 8: "A.b.c.d.e.f.g.h.i goes on and on.", 9: "Word " * 51 + "end.",
    10: "A b c d e f g h i j k l.", 11: "This has [brackets] in its middle.", 12: "A/b/c/d/e/f/g/h/i is a long path here.", 13: "See THIS IS A VERY LOUD TEXT AND LONG here.",
    14: "Call 0123456789012 for more of this.", 15: "Paid 123456 at once.", 16: "It went on and on . . .", 17: "It went on and on... and on.", 18: "What is it now?? I don't know.",
    19: "All Words In This One Are Capital Letters Here now.", 20: "There is a space , before that mark.", 21: "It was made by John F.", 22: "Too short.",
    23: "Very long " * 30 + "end.", 24: "There is a\ttab in the sentence.", 25: "There is a ™ sign in this one.", 26: "#Tags at the start of a line.", 27: "Write to me@example.org for more.",
    28: "It lies at 51° 20' 22\" or so on.", 29: "Here @@Quelle@@ is left in the text.", 30: "A soft\u00adhyphen is in this sentence.", 31: "An entity &amp;rest is left in here.",
}


@pytest.fixture(scope="module")
def hits(spark):
    rows = spark.createDataFrame([*HITS.items(), (0, GOOD)], "n int, text string")
    return {r.n: r.asDict() for r in rows.select("n", *[C.failed(r, F.col("text")).alias(f"r{k}") for k, r in RULES.items()]).collect()}


@pytest.mark.parametrize("rule", sorted(RULES))
def test_each_rule_has_a_hit_and_a_miss(hits, rule):
    assert hits[rule][f"r{rule}"] and not hits[0][f"r{rule}"]


def test_first_rule_is_the_lowest(spark):
    rows = spark.createDataFrame([("no end",), (GOOD,)], "text string")
    assert [r[0] for r in rows.select(C.first_rule(F.col("text"))).collect()] == [1, None]
    assert [r.text for r in C.clean(rows).collect()] == [GOOD]
    assert C.rejects(rows).first().report.startswith("no end\tRule: 1 ")


def test_ratio_is_single_precision(spark):
    # fourteen characters of which five are spaces: 14 / (9 + 1) is at the limit, not beyond it
    rows = spark.createDataFrame([("aaa b c d e fg",), ("aa b c d e f g",)], "text string")
    assert [r[0] for r in rows.select(C.failed(RULES[10], F.col("text"))).collect()] == [False, True]


def test_overrides_and_extra_rules(spark):
    rows = spark.createDataFrame([("x" * 300,), ("x" * 401,), ("a href",), ("žluťoučký kůň",)], "text string")
    col = F.col("text")
    assert [r[0] for r in rows.select(C.failed(merged_rules(RULES, LONGER)[23], col)).collect()] == [False, True, False, False]
    assert [r[0] for r in rows.select(C.failed(WEB[3000], col)).collect()] == [False, False, True, False]
    assert [r[0] for r in rows.select(C.failed(CZECH[1000], col)).collect()] == [True, True, True, False]


def test_tab_column_and_entities(spark):
    rows = spark.createDataFrame([(f"1\t{GOOD}",), ("2\tbad",), ("3",)], "text string")
    assert [r.text for r in C.clean_column(rows, 1).collect()] == [f"1\t{GOOD}"]
    one = spark.createDataFrame([("caf&eacute; &amp;uuml; &lt;",)], "text string")
    assert one.select(C.replace_entities(F.col("text"))).first()[0] == "café ü &lt;"


def test_hits_and_report(spark):
    rows = spark.createDataFrame([(t,) for t in HITS.values()], "text string")
    found = {r.rule_id: r.hits for r in C.rule_hits(rows).collect()}
    assert set(found) == set(RULES) and all(found.values())
    assert sum(r.hits for r in C.rule_report(rows).collect()) == len(HITS)
    empty = rows.where("false")
    assert all(r.hits == 0 for r in C.rule_hits(empty).collect()) and C.clean(empty).count() == 0


def test_the_class_for_java_is_the_same(spark):
    """All characters below U+10000 by both forms of the rule's class, and by the rule; only one of the forms tries each range on ASCII."""
    own = RULES[25].hex_pattern
    assert rejected_java(own).count("&&") == 1 and rejected_java("c2ad").count("&&") == 1
    rows = spark.range(1, 0x10000).where("id < 55296 OR id >= 57344").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    for p in (own, "c2ad", "(5e)|(7f)"):
        assert rows.where(F.col("c").rlike(rejected_characters(p)) != F.col("c").rlike(rejected_java(p))).count() == 0
    assert rows.where(C.failed(RULES[25], F.col("c"))).count() == rows.where(F.col("c").rlike(rejected_characters(own))).count() > 50


def test_arrow_rules_are_those_of_the_sql():
    """Each rule over its own hits and random lines, against DuckDB; lengths are in UTF-16 units, also of slices."""
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(2)
    chars = "ab AB.,;:!?-/()[]<>~*\"'^|_…•™😀é×1 2­\r @#§°\t"
    texts = [*HITS.values(), GOOD, ""] + ["".join(rng.choice(chars) for _ in range(rng.randrange(120))) for _ in range(2000)] + ["".join(rng.choice("ab c😀,") for _ in range(rng.randrange(300))) for _ in range(300)]
    rows = pa.array(texts)
    units = C._units(rows)
    assert units.tolist() == [len(x.encode("utf-16-le")) // 2 for x in texts] and C._units(rows.slice(17, 100)).tolist() == units[17:117].tolist()
    con = duckdb.connect()
    con.register("r", pa.table({"k": list(range(len(texts))), "text": rows}))
    for n, rule in (RULES | {23: LONGER[23], 3000: WEB[3000]}).items():
        assert C.in_arrow(rule)
        assert C.failed_arrow(rule, rows, units).tolist() == [x[0] for x in con.sql(f"SELECT {C.failed_sql(rule, 'text')} FROM r ORDER BY k").fetchall()], n
    assert not C.in_arrow(CZECH[1000])


def test_frames_and_columns_agree(spark):
    """The frame's functions in Arrow, and the columns; rules with look-around stay columns."""
    rows = spark.createDataFrame([(t,) for t in [*HITS.values(), GOOD, None, ""]], "text string")
    for rules in (RULES, merged_rules(RULES, CZECH)):
        by_column = rows.where("length(text) > 0").select("text", C.first_rule(F.col("text"), rules).alias("r")).collect()
        assert {r.text: r.rule_id for r in C.rejects(rows, rules).collect()} == {r.text: r.r for r in by_column if r.r}
        assert [r.text for r in C.clean(rows, rules).collect()] == [r.text for r in by_column if not r.r]
        own = rows.select(*[F.coalesce(F.sum(C.failed(r, F.col("text")).cast("long")), F.lit(0)).alias(str(n)) for n, r in rules.items()]).first().asDict()
        assert {str(r.rule_id): r.hits for r in C.rule_hits(rows, rules).collect()} == own
    plan = C.rule_hits(rows)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "RLIKE" not in plan
