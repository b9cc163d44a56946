"""Command line: segment, clean, langid, tokenize, pos."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import utf16_length
from millrace.operators.clean import clean, clean_column, rejects, replace_entities
from millrace.operators.langid import identify, profile_of
from millrace.operators.pos import tagged
from millrace.operators.segment import SegmentResources, segment_exact, with_capitals
from millrace.operators.sources import sentence_id, source_index, with_source_id
from millrace.operators.tokenize import TokenResources, tokenize_exact
from millrace.plans.metrics import timed
from millrace.sources import resources as res
from millrace.sources.text import read_framed, read_plain, read_tagged, read_word_lists, write_framed, write_languages, write_source_index


def _file(path: str | None) -> str | None:
    return Path(path).read_text(encoding="utf-8") if path else None


def _tagged(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Rows with source_id and text from tagged or plain input; the index is written beside the output."""
    rows = read_tagged(spark, args.input) if args.metadata else read_plain(spark, args.input).withColumn("line_idx", F.lit(0).cast("long"))
    index = source_index(rows)
    write_source_index(index, args.output.rstrip("/") + "_sources")
    return with_source_id(rows, index)


def _input(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return read_framed(spark, args.input).select("source_id", "text") if args.framed else _tagged(spark, args)


def run_segment(spark: SparkSession, args: argparse.Namespace) -> None:
    given = {k: f for k, f in (("boundaries", args.boundaries), ("pre_list", args.abbreviations), ("post_list", args.post_list), ("pre_rules", args.pre_rules), ("post_rules", args.post_rules)) if f}
    parse = {"boundaries": res.parse_boundaries, "pre_list": lambda x: with_capitals(res.parse_list(x)), "post_list": res.parse_list, "pre_rules": res.parse_signed, "post_rules": res.parse_signed}
    rows = _input(spark, args)
    if "line_idx" in rows.columns:
        rows = rows.withColumn("source_id", sentence_id(F.col("source_id"), F.col("line_idx")))
    write_framed(segment_exact(rows.select("source_id", "text"), SegmentResources(**{k: parse[k](_file(f)) for k, f in given.items()}), compat=args.compat), args.output)


def run_clean(spark: SparkSession, args: argparse.Namespace) -> None:
    rules = res.RULES
    if args.rules:
        folder = Path(args.rules).parent
        more = [folder / f"texttype_{args.text_type}.rules", folder / f"lang_{args.language}.rules"]
        rules = res.merged_rules(res.parse_rules(_file(args.rules)), *[res.parse_rules(p.read_text(encoding="utf-8")) for p in more if p.exists()])
    else:
        rules = res.merged_rules(rules, res.WEB if args.text_type == "web" else {}, res.BY_LANGUAGE.get(args.language, {}))
    rows = _input(spark, args)
    if args.replace is not None:
        rows = rows.withColumn("text", replace_entities(F.col("text"), res.parse_entities(_file(args.replace)) if args.replace else res.ENTITIES))
    if args.column is not None:
        rows = clean_column(rows, args.column, rules)
    elif args.exchange:
        rows = rejects(rows, rules).withColumn("text", F.col("report"))
    else:
        rows = clean(rows, rules)
    write_framed(rows, args.output)


def run_langid(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = _input(spark, args).withColumn("row", F.monotonically_increasing_id())
    profile = profile_of(read_word_lists(spark, args.word_lists, args.languages))
    write_languages(identify(rows, profile, ["row", "source_id", "text"], keep_unknown=args.keep_unknown).drop("row"), args.output)


def run_tokenize(spark: SparkSession, args: argparse.Namespace) -> None:
    given = {}
    if args.actions:
        given["actions"] = res.parse_actions(_file(args.actions))
    if args.abbreviations:
        given["abbreviations"] = res.parse_abbreviations(_file(args.abbreviations))
    if args.fixed:
        given["fixed"] = res.parse_fixed_tokens(_file(args.fixed))
    write_framed(tokenize_exact(_input(spark, args), TokenResources(**given)), args.output)


def run_pos(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = _input(spark, args).select("source_id", tagged(F.col("text")).alias("text"))
    if args.parquet:
        rows.withColumn("n_chars", utf16_length(F.col("text"))).write.mode("overwrite").parquet(args.output)
    else:
        write_framed(rows, args.output)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, run) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("-i", "--input", required=True)
        p.add_argument("-o", "--output", required=True)
        p.add_argument("-x", "--run-id", default=name)
        p.add_argument("--log", help="file for the run's times")
        p.add_argument("--framed", action=argparse.BooleanOptionalAction, default=name in ("tokenize", "pos", "langid"), help="input has (length,text,id) records")
        p.add_argument("-m", "--metadata", action=argparse.BooleanOptionalAction, default=True, help="input has source headers")
        return p

    p = command("segment", run_segment)
    for flag in ("--boundaries", "--abbreviations", "--post-list", "--pre-rules", "--post-rules"):
        p.add_argument(flag)
    p.add_argument("--compat", action="store_true")
    p = command("clean", run_clean)
    p.add_argument("--rules")
    p.add_argument("-l", "--language", default="")
    p.add_argument("-t", "--text-type", default="")
    p.add_argument("-r", "--replace", nargs="?", const="", help="replace entities, by a file or the default list")
    p.add_argument("-c", "--column", type=int, help="check this tab-separated field (from 0)")
    p.add_argument("-e", "--exchange", action="store_true", help="write what is rejected, with the rule")
    p = command("langid", run_langid)
    p.add_argument("--word-lists", required=True)
    p.add_argument("--languages", nargs="*")
    p.add_argument("--keep-unknown", action="store_true")
    p = command("tokenize", run_tokenize)
    for flag in ("--actions", "--abbreviations", "--fixed"):
        p.add_argument(flag)
    command("pos", run_pos).add_argument("--parquet", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    with timed(args.run_id, args.log):
        args.run(spark or SparkSession.builder.appName(f"millrace-{args.command}").getOrCreate(), args)


if __name__ == "__main__":
    main()
