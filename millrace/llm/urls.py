"""URL filter: rules, else a character language-model ratio; DataFrame functions only.

Two smoothed variable-order Markov models over the characters of host and path, one of accepted and one of rejected
URLs, are fitted on all URLs that a rule decides. The probability of a character interpolates orders 0 to ``ORDER``:
p_k = (count_k + c * p_(k-1)) / (total_k + c), so that long contexts count as far as they were seen. A URL's score is
the log-likelihood difference per character. The threshold is calibrated on held-out decided URLs (a share by hash that
is not fitted): the score that splits them with the least balanced error.

Characters are folded to an alphabet of ``len(ALPHABET) + 2`` symbols, hence there are at most that many to the power
``ORDER + 1`` grams: the score table has a proven bound (about 70,000 rows at order 2) and is broadcast to the
URLs. Counts are pre-aggregated by gram, scores by URL, so no common host or gram gathers rows in one task.

Rows: a null url, or one without ``://``, has an empty host and path; such a line has the score 0. If the held-out share lacks a class,
all decided URLs calibrate; without both classes at all the method allows all. Repeated rows stay; equal URLs have equal scores, and
one exactly at the threshold is allowed. URLs of any length are scored whole; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialise, table

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-"
OTHER, START = "~", "^"
ORDER, CONCENTRATION, HELD_OUT = 2, 4.0, 5


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def grams_of(line: Column, order: int = ORDER) -> Column:
    """Each character with the ``order`` characters before it, over the folded alphabet."""
    folded = F.regexp_replace(F.lower(line), f"[^{ALPHABET.replace('-', '')}-]", OTHER)
    padded = F.concat(F.lit(START * order), folded)
    places = F.sequence(F.lit(1), F.length(folded))
    return F.when(F.length(folded) > 0, F.transform(places, lambda i: padded.substr(i, F.lit(order + 1))))


def score_table(counts: DataFrame, order: int = ORDER, concentration: float = CONCENTRATION) -> DataFrame:
    """(gram, delta): log p_accepted - log p_rejected of each gram's last character. ``counts`` (gram, good, bad)
    holds every gram to be scored; it is bounded by the alphabet, so are all groups here."""
    size = len(ALPHABET) + 2
    now = counts.select("gram", "good", "bad")
    total = now.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    p = {c: F.lit(1.0 / size) for c in ("good", "bad")}
    for k in range(order + 1):
        gram, context = F.col("gram").substr(order + 1 - k, k + 1), F.col("gram").substr(order + 1 - k, k)
        now = now.withColumn("_g", gram).withColumn("_c", context)
        tails = now.groupBy("_g").agg(*[F.sum(c).alias(f"n_{c}") for c in p])
        now = now.join(tails, "_g")
        if k:
            heads = now.groupBy("_c").agg(*[F.sum(c).alias(f"t_{c}") for c in p])
            now = now.join(heads, "_c")
        for c in p:
            seen = F.col(f"t_{c}") if k else F.lit(total[c])
            now = now.withColumn(f"p_{c}", (F.col(f"n_{c}") + concentration * p[c]) / (seen + concentration))
        now = now.drop("_g", "_c", *[f"n_{c}" for c in p], *[f"t_{c}" for c in p])
        p = {c: F.col(f"p_{c}") for c in p}
    return now.select("gram", (F.log(p["good"]) - F.log(p["bad"])).alias("delta"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of each row; score is null where a rule decides."""
    url = F.col(f"`{url_col}`").cast("string")
    host, path = host_of(url), path_of(url)
    base = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), F.concat("host", "path").alias("line"))
    held = F.pmod(F.xxhash64("line"), F.lit(HELD_OUT)) == 0
    # one row per distinct line, with its number
    lines = base.groupBy("line", "said").agg(F.count("*").alias("n")).withColumn("held", held)
    lines, _ = materialise(lines, "lines")
    grams = lines.select("said", "held", "n", F.explode(grams_of(F.col("line"))).alias("gram"))
    fit = ~F.col("held") & F.col("said").isNotNull()
    counts = grams.groupBy("gram").agg(*[F.sum(F.when(fit & (F.col("said") == v), F.col("n")).otherwise(0)).alias(c) for c, v in (("good", "allow"), ("bad", "block"))])
    counts, _ = materialise(counts, "grams")
    deltas, _ = materialise(score_table(counts), "deltas")
    def scored_lines(asked: DataFrame, tag: str) -> DataFrame:
        letters = asked.select("line", "said", "n", F.explode_outer(grams_of(F.col("line"))).alias("gram"))
        scored = letters.join(F.broadcast(deltas), "gram", "left").groupBy("line", "said").agg(F.max("n").alias("n"), F.round(F.coalesce(F.avg("delta"), F.lit(0.0)), 6).alias("score"))
        return materialise(scored, tag)[0]

    # score the lines that no rule decides, and those held out for calibration
    scored = scored_lines(lines.where(F.col("said").isNull() | F.col("held")), "scores")
    cut = threshold(scored.where("said IS NOT NULL")).first()  # one row
    if cut is None:  # a class has no line held out: all decided lines calibrate
        cut = threshold(scored_lines(lines.where("said IS NOT NULL"), "decided")).first()
    own = F.when(F.col("score") >= (cut["threshold"] if cut else float("-inf")), "allow").otherwise("block")
    free = scored.where("said IS NULL").select(F.col("line").alias("asked"), "score", own.alias("own"))
    out = base.join(free, (F.col("line") == F.col("asked")) & F.col("said").isNull(), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", "own").alias("verdict"), "score")


def threshold(decided: DataFrame, step: float = 0.01) -> DataFrame:
    """One row at most: of the grid's cells (bounded in number) the one from which accepting held-out lines has the least
    balanced error; the threshold lies half-way to the next cell below that has lines."""
    place = F.least(F.greatest(F.floor(F.col("score") / step), F.lit(-1000)), F.lit(1000))
    bins = decided.groupBy(place.alias("bin")).agg(*[F.sum(F.when(F.col("said") == v, F.col("n")).otherwise(0)).alias(c) for c, v in (("good", "allow"), ("bad", "block"))])
    up = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # 2,001 rows at most
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.lag("bin").over(Window.orderBy("bin"))
    bins = bins.select("bin", ((F.col("bin") + F.coalesce(before, F.col("bin"))) / 2).alias("middle"), F.coalesce(F.sum("good").over(up), F.lit(0)).alias("lost"), F.sum("bad").over(every).alias("bads"), F.coalesce(F.sum("bad").over(up), F.lit(0)).alias("caught"), F.sum("good").over(every).alias("goods"))
    bins = bins.where("goods > 0 AND bads > 0").select("bin", "middle", (F.col("lost") / F.col("goods") + 1 - F.col("caught") / F.col("bads")).alias("error"))
    best = bins.agg(F.min(F.struct("error", "bin", "middle")).alias("best")).select("best.middle").where("middle IS NOT NULL")
    return best.select((F.col("middle") * step).alias("threshold"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
