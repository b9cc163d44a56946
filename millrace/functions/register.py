"""SQL names for the operators' functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import SparkSession

from millrace.operators.clean import first_rule_udf
from millrace.operators.segment import segments_udf
from millrace.operators.tokenize import TokenResources, tokenize_udf
from millrace.session import ship
from millrace.sources.resources import ENTITIES


def _quoted(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession) -> None:
    """Registers tokenize(text), first_rule(text), replace_entities(text) and the table function segment(text) -> (seg,
    sentence), with the default resources. replace_entities is an SQL function, which the optimiser inlines."""
    ship(spark)
    spark.udf.register("tokenize", tokenize_udf(spark, TokenResources()))
    spark.udf.register("millrace_segments", segments_udf(spark))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION segment(text STRING) RETURNS TABLE(seg INT, sentence STRING) RETURN SELECT pos, col FROM posexplode(millrace_segments(text))")
    spark.udf.register("first_rule", first_rule_udf(spark))
    new = reduce(lambda c, kv: f"replace({c}, {_quoted(kv[0])}, {_quoted(kv[1])})", ENTITIES.items(), "text")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION replace_entities(text STRING) RETURNS STRING RETURN {new}")
