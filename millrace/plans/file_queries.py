"""Registered queries over files: tables written in the engine's text formats and read back, resources read from files,
streams, SQL names. Files go to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.register import register
from millrace.functions.text import utf16_length_sql
from millrace.operators import clean as cleaning
from millrace.operators import langid
from millrace.operators.pos import tagger
from millrace.operators.segment import SegmentResources, segment, segments_exact_sql, with_capitals
from millrace.operators.sources import lines, source_index
from millrace.operators.tokenize import TokenResources, tokenize_exact, tokens_sql
from millrace.plans import queries as core
from millrace.session import materialise, new_path, spread
from millrace.sources import resources as res
from millrace.sources import text as files
from millrace.streaming import flows

Spark, Frame = SparkSession, DataFrame


def put(spark: Spark, name: str, text: str) -> str:
    """Writes a small resource file to the shared folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{new_path(spark, 'resource')}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return path.toString()


def get(spark: Spark, path: str) -> str:
    """A resource file, read by Spark's reader from wherever it lies."""
    return spark.read.text(path, wholetext=True).first()[0]


def _stored(spark: Spark, name: str, text: str) -> str:
    return get(spark, put(spark, name, text))


# --- text sources and sinks


def _tagged_file(spark: Spark, sf: str, end: str = f"'{files.END}'") -> str:
    docs = core._table(spark, sf, "documents")
    head = F.concat(F.lit(f"{files.START}<location>"), "source", F.lit("</location><date>2000-01-01</date><user>"), F.col("doc_id").cast("string"), F.lit("</user><original_encoding>UTF-8</original_encoding><language>"), "lang", F.lit("</language>"), F.expr(end))
    path = new_path(spark, "tagged")
    docs.select(F.concat(head, "text")).write.text(path)
    return path


def q_tagged_files(spark: Spark, sf: str) -> Frame:
    """Documents as source-tagged text, read back line by line, with the headers' fields."""
    rows = files.with_header_fields(files.read_tagged(spark, _tagged_file(spark, sf)))
    return rows.select(F.col("source.user").cast("long").alias("doc_id"), "source.location", "source.language", "line_idx", "text")


def q_tagged_dropped(spark: Spark, sf: str) -> Frame:
    """Every second document lacks the header's end tag; such chunks are dropped, and counted."""
    return files.dropped_bodies(spark, _tagged_file(spark, sf, f"CASE WHEN doc_id % 2 = 0 THEN '{files.END}' ELSE '' END"))


def q_plain_files(spark: Spark, sf: str) -> Frame:
    path = new_path(spark, "plain")
    core._lines(spark, sf).select("text").write.text(path)
    return files.read_plain(spark, path).select("metadata", "text")


def q_framed_files(spark: Spark, sf: str) -> Frame:
    path = new_path(spark, "framed")
    files.write_framed(core._lines(spark, sf), path, source_id="doc_id")
    return files.read_framed(spark, path).select(F.col("n_chars").cast("long").alias("n_chars"), "text", "source_id")


def q_source_index_files(spark: Spark, sf: str) -> Frame:
    path = new_path(spark, "sources")
    files.write_source_index(source_index(core._table(spark, sf, "documents"), "source"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def q_language_files(spark: Spark, sf: str) -> Frame:
    path = new_path(spark, "languages")
    files.write_languages(core.q_lang_identify(spark, sf), path)
    return spark.read.parquet(path).select("doc_id", "line_idx", "lang", "prob")


def q_pos_files(spark: Spark, sf: str) -> Frame:
    path = new_path(spark, "tags")
    rows = core._lines(spark, sf).select("doc_id", tagger(spark)(F.col("text")).alias("t")).select("doc_id", F.col("t.tagged").alias("text"))
    files.write_framed(rows, path, source_id="doc_id")
    return files.read_framed(spark, path).select(F.col("text").alias("tagged"), F.col("source_id").alias("doc_id"))


def q_word_list_files(spark: Spark, sf: str) -> Frame:
    """The words of the documents' lines as one word list a language, read back as a profile."""
    profile, path = materialise(langid.build_profile(core._lines(spark, sf, "lang")), "profile")[0], new_path(spark, "words")
    for lang in sorted(r[0] for r in profile.select("lang").distinct().collect()):  # languages are few
        own = profile.where(F.col("lang") == lang)
        rows = own.select(F.concat(F.col("freq").cast("string"), F.lit("\t"), "word").alias("line"), F.lit(1).alias("k"))
        rows = rows.unionByName(own.agg(F.sum("freq").cast("string").alias("line")).withColumn("k", F.lit(0)))
        rows.where("line NOT LIKE '%\t'").coalesce(1).sortWithinPartitions("k").select("line").write.text(f"{path}/{lang}.words")
    return langid.profile_of(files.read_word_lists(spark, path)).select("lang", "word", "freq", F.round("prob", 10).alias("prob"))


# --- resource files

_EXTRA = res.merged_rules(res.RULES, res.LONGER, res.CZECH, res.WEB)


def q_rule_files(spark: Spark, sf: str) -> Frame:
    """Lines by first rule, with the general rules and those of a language and a text type from rule files."""
    parts = [res.parse_rules(_stored(spark, f"{n}.rules", res.rules_text(r))) for n, r in (("general", res.RULES), ("texttype_web", res.WEB), ("lang_ces", res.CZECH), ("lang_ara", res.LONGER))]
    found = cleaning.rule_report(core._lines(spark, sf), res.merged_rules(*parts))
    return found.select(F.coalesce("rule_id", F.lit(0)).alias("rule_id"), "hits")


def q_rule_hits_pages(spark: Spark, sf: str) -> Frame:
    """Hits of the extra rules over the lines of the pages."""
    rows = lines(core._table(spark, sf, "pages").select(F.col("html").alias("text")))
    return cleaning.rule_hits(rows, res.merged_rules(res.CZECH, res.WEB))


def q_entity_file(spark: Spark, sf: str) -> Frame:
    entities = res.parse_entities(_stored(spark, "entities.list", "".join(f"{k}\t{v}\n" for k, v in res.ENTITIES.items())))
    new = cleaning.replace_entities(F.col("html"), entities)
    return core._table(spark, sf, "pages").select("page_id", F.length(new).cast("long").alias("n_chars"), F.md5(new.cast("binary")).alias("md5"))


_ACTIONS = """id\tcharacter\twordstart\twordmid\twordend\tsentenceEnd
1\t(\twhitespace\twhitespace\twhitespace\twhitespace
2\t,\twhitespace\tnothing\twhitespace\twhitespace
3\t.\tnothing\tnothing\tnothing\twhitespace
4\t-\tdelete\tnothing\tdelete\twhitespace
5\te\tother\tdelete\tother\tother
6\t:\twhitespace\tdelete\tdelete\tdelete
"""
_CUSTOM = TokenResources(actions=res.parse_actions(_ACTIONS), abbreviations=frozenset({"art.", "Nr.", "etc."}), fixed=frozenset({"the", "were"}))


def q_action_file_tokens(spark: Spark, sf: str) -> Frame:
    """Tokens by a table with deletions, abbreviations and fixed tokens, all from files."""
    own = TokenResources(
        actions=res.parse_actions(_stored(spark, "actions.txt", _ACTIONS)), abbreviations=res.parse_abbreviations(_stored(spark, "abbrev.txt", "art\nNr \netc\n")),
        fixed=res.parse_fixed_tokens(_stored(spark, "fixed.txt", "the\n%N%\nwere\n")),
    )
    return tokenize_exact(core._lines(spark, sf), own).select("doc_id", "line_idx", F.col("text").alias("tokens"))


_LISTS = {"boundaries": '."\n!\n.\n?\n:\n', "pre": "Dr.\nz.B.\nno.\n", "post": "Januar\nMarch\nmayo\nund\n", "pre_rules": "# letters\n- [\\p{IsL}]\\.\n- [0-9]+\\.\n+ (\n", "post_rules": '"+ [a-z].*"\n- .*\n'}


def _lists(read) -> SegmentResources:
    return SegmentResources(res.parse_boundaries(read("boundaries")), with_capitals(res.parse_list(read("pre"))), res.parse_list(read("post")), res.parse_signed(read("pre_rules")), res.parse_signed(read("post_rules")))


def q_segment_files(spark: Spark, sf: str) -> Frame:
    """Sentences by boundaries, lists and signed rules from files."""
    return segment(core._lines(spark, sf), _lists(lambda name: _stored(spark, name, _LISTS[name])))


# --- streams, SQL names


def _streamed(stream: Frame, path: str, schema: str | None = None) -> Frame:
    spark = stream.sparkSession
    run = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", path + "-state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _glob(sf: str, name: str) -> str:
    """A pattern for one file: streams take folders and patterns only."""
    return f"{sf.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"


def q_stream_windows(spark: Spark, sf: str) -> Frame:
    """Events by hour and type, counted by a stream with a watermark; the last state is what counts."""
    schema = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").schema
    path = new_path(spark, "windows")
    counts = flows.counts_by_window(flows.read_documents(spark, _glob(sf, "events"), schema).withColumn("ts", F.col("ts").cast("timestamp")), "ts")
    run = counts.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(path)).option("checkpointLocation", path + "-state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(counts.schema).parquet(path).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


def q_stream_sentences(spark: Spark, sf: str) -> Frame:
    """Clean, tokenised sentences of the documents as a stream."""
    docs = spark.read.parquet(f"{sf.rstrip('/')}/documents.parquet")
    found = flows.sentences(spread(flows.read_documents(spark, _glob(sf, "documents"), docs.schema).select("doc_id", "source", "text"), docs))
    return _streamed(found.select("doc_id", "line_idx", "seg", "tokens"), new_path(spark, "stream"))


def q_sql_functions(spark: Spark, sf: str) -> Frame:
    """first_rule, tokenize and segment by their SQL names."""
    register(spark)
    core._lines(spark, sf).createOrReplaceTempView("millrace_lines")
    return spark.sql("""SELECT doc_id, line_idx, rule_id, CAST(s.seg AS BIGINT) AS seg, tokenize(s.sentence) AS tokens
                        FROM (SELECT *, coalesce(first_rule(text), 0) AS rule_id FROM millrace_lines), LATERAL segment(text) s""")


QUERIES = {k[2:]: v for k, v in list(globals().items()) if k.startswith("q_")}

LINES, _SENTENCES = core.LINES, core.SENTENCES
_EXTRA_FIRST = f"coalesce({cleaning.first_rule_sql('text', {n: r for n, r in _EXTRA.items() if n < 1000})}, CASE WHEN NOT regexp_matches(text, '[éěšč]') THEN 1000 WHEN {cleaning.failed_sql(res.WEB[3000], 'text')} THEN 3000 ELSE 0 END)"
_PAGES = "(SELECT x AS text FROM (SELECT unnest(string_split(html, chr(10))) AS x FROM pages) WHERE length(x) > 0)"
_PLAIN = {k: v.replace("\\p{IsL}", "\\p{L}") for k, v in _LISTS.items()}
_CLEAN = f"(SELECT * FROM {_SENTENCES} WHERE ({core._FIRST}) IS NULL)"

ORACLES: dict[str, str] = {
    "tagged_files": f"SELECT doc_id, source AS location, lang AS language, line_idx, text FROM {LINES}",
    "tagged_dropped": "SELECT count(*) AS chunks, count(*) FILTER (doc_id % 2 = 1) AS dropped FROM documents",
    "plain_files": f"SELECT '' AS metadata, text FROM {LINES}",
    "framed_files": f"SELECT {utf16_length_sql('text')} AS n_chars, text, doc_id AS source_id FROM {LINES}",
    "source_index_files": f"SELECT '(' || metadata || ',' || source_id || ')' AS line FROM {core.INDEX}",
    "language_files": core.ORACLES["lang_identify"],
    "pos_files": f"SELECT doc_id, {core._TAGGED} AS tagged FROM ({core._TOKENS})",
    "word_list_files": f"SELECT lang, word, freq, round(prob, 10) AS prob FROM {core._PROFILE.replace('FROM documents', 'FROM ' + LINES)} WHERE word <> ''",
    "rule_files": f"SELECT {_EXTRA_FIRST} AS rule_id, count(*) AS hits FROM {LINES} GROUP BY 1",
    "rule_hits_pages": f"SELECT 1000 AS rule_id, count(*) FILTER (NOT regexp_matches(text, '[éěšč]')) AS hits FROM {_PAGES} UNION ALL SELECT 3000, count(*) FILTER ({cleaning.failed_sql(res.WEB[3000], 'text')}) FROM {_PAGES}",
    "entity_file": core.ORACLES["clean_replace_entities"],
    "action_file_tokens": tokens_sql(LINES, "doc_id, line_idx", _CUSTOM),
    "segment_files": segments_exact_sql(LINES, "doc_id, line_idx", _lists(_PLAIN.__getitem__)),
    "stream_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_sentences": f"WITH r AS MATERIALIZED {_CLEAN} {tokens_sql('r', 'doc_id, line_idx, seg').lstrip().replace('WITH RECURSIVE', 'SELECT * FROM (WITH RECURSIVE', 1)})",
    "sql_functions": f"WITH e AS MATERIALIZED ({segments_exact_sql(LINES, 'doc_id, line_idx')}), t AS ({tokens_sql('e', 'doc_id, line_idx, seg')}) SELECT doc_id, line_idx, coalesce({core._FIRST}, 0) AS rule_id, seg, tokens FROM t JOIN {LINES} l USING (doc_id, line_idx)",
}
