import json
import os
import time

from pyspark.sql import functions as F

from millrace import cli
from millrace.functions.register import register
from millrace.operators.pos import pairs, tag_with, tagged
from millrace.plans.pipeline import clean_first, segment_first
from millrace.streaming import flows

TEXT = "The old house stood on a hill near the town. It was a quiet place for all of the years.\nshort"


def test_baseline_tags(spark):
    df = spark.createDataFrame([("the dog runs quickly to Berlin in 1990 .",), ("",)], "t string")
    assert [r[0] for r in df.select(tagged(F.col("t"))).collect()] == ["the_DT dog_NN runs_NNS quickly_RB to_IN Berlin_NNP in_IN 1990_CD ._.", ""]
    assert df.select(pairs(F.col("t"))).first()[0][0].tag == "DT"


def test_own_tagger(spark):
    df = spark.createDataFrame([("a bb",), (None,)], "text string")
    assert [r.tagged for r in tag_with(df, lambda: lambda ws: [str(len(w)) for w in ws]).collect()] == ["a_1 bb_2", None]


def test_a_tagger_is_loaded_once_a_task(spark, tmp_path):
    def load():
        (tmp_path / f"{os.getpid()}-{time.time_ns()}").touch()
        return lambda ws: ["X"] * len(ws)

    df = spark.range(0, 9000, 1, 1).selectExpr("CAST(id AS STRING) AS text")
    assert tag_with(df, load).where("tagged LIKE '%_X'").count() == 9000 and len(list(tmp_path.iterdir())) == 1


def test_pipelines(spark):
    df = spark.createDataFrame([("s", TEXT)], "source string, text string")
    a = segment_first(df).orderBy("seg").collect()
    assert [r.seg for r in a] == [0, 1] and a[0].tokens.endswith("town .") and a[0].tagged.startswith("The_NNP")
    assert clean_first(df).count() == 2
    assert segment_first(df.where("false")).count() == 0


def test_streams(spark, tmp_path):
    spark.createDataFrame([("s", TEXT)], "source string, text string").write.parquet(str(tmp_path / "in"))
    stream = flows.read_documents(spark, str(tmp_path / "in"), "source string, text string")
    run = flows.sentences(stream).writeStream.format("memory").queryName("sents").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    assert run.awaitTermination(60) and spark.table("sents").count() == 2
    profile = spark.createDataFrame([("en", "the", 0.5)], "lang string, word string, prob double")
    got = []
    writer = flows.identify_batches(stream, profile, ["source"], lambda df, n: got.extend(df.collect())).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2"))
    run = writer.start()
    assert run.awaitTermination(60) and got[0].lang == "en"


def test_windowed_counts(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP'2024-01-01 00:10:00' AS ts, 'a' AS event_type").write.parquet(str(tmp_path / "ev"))
    stream = flows.read_documents(spark, str(tmp_path / "ev"), "ts timestamp, event_type string")
    run = flows.counts_by_window(stream, "ts").writeStream.outputMode("complete").format("memory").queryName("wins").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c3")).start()
    assert run.awaitTermination(60) and spark.table("wins").first().n == 1


def test_sql_names(spark):
    register(spark)
    assert spark.sql("SELECT tokenize('a, b.')").first()[0] == "a , b ."
    assert [r[0] for r in spark.sql("SELECT first_rule(t) FROM VALUES ('no end'), ('This is a decent sentence of some words.') v(t)").collect()] == [1, None]
    assert spark.sql("SELECT replace_entities('caf&eacute;')").first()[0] == "café"
    assert [r.sentence for r in spark.sql("SELECT * FROM segment('One here. Two it is.')").collect()] == ["One here.", "Two it is."]


def test_command_line(spark, tmp_path):
    src = tmp_path / "raw.txt"
    src.write_text(f"<source><location>x</location></source>\n{TEXT}\n")
    at = lambda n: str(tmp_path / n)
    read = lambda n: [r.value for r in spark.read.text(at(n)).collect()]
    cli.main(["segment", "-i", str(src), "-o", at("seg"), "--log", at("log")], spark)
    assert len(read("seg")) == 3 and "elapsed_s" in json.loads((tmp_path / "log").read_text())
    cli.main(["clean", "-i", at("seg"), "-o", at("cl"), "--framed", "--log", at("log")], spark)
    assert len(read("cl")) == 2
    cli.main(["clean", "-i", at("seg"), "-o", at("rej"), "--framed", "-e", "--log", at("log")], spark)
    assert "Rule: 1" in read("rej")[0]
    cli.main(["tokenize", "-i", at("cl"), "-o", at("tok"), "--log", at("log")], spark)
    assert any("town ." in r for r in read("tok"))
    cli.main(["pos", "-i", at("tok"), "-o", at("pos"), "--log", at("log")], spark)
    assert any("town_NN" in r for r in read("pos"))
    (tmp_path / "words").mkdir()
    (tmp_path / "words" / "eng.words").write_text("10\n5\tthe\n")
    cli.main(["langid", "-i", at("cl"), "-o", at("lang"), "--word-lists", at("words"), "--log", at("log")], spark)
    assert {r.lang for r in spark.read.parquet(at("lang")).collect()} == {"eng"}


def test_a_stream_of_one_row_group_is_dealt_out(spark, tmp_path):
    from millrace.session import SPREAD_BYTES, spread
    from millrace.streaming import flows

    docs = spark.range(4000).selectExpr("id AS doc_id", "'a' AS source", "repeat(sha2(cast(id AS string), 512), 16) AS text")
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    stream = spread(flows.read_documents(spark, str(tmp_path / "doc[s]"), table.schema), table)
    parts = []
    run = stream.writeStream.foreachBatch(lambda df, n: parts.append((df.rdd.getNumPartitions(), df.count()))).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    size = sum(f.stat().st_size for f in (tmp_path / "docs").glob("*.parquet"))
    assert parts == [(min(spark.sparkContext.defaultParallelism, size // SPREAD_BYTES), 4000)] and parts[0][0] > 1 or size < 2 * SPREAD_BYTES
