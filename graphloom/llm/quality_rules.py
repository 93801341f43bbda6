"""Quality rules with thresholds taken from mergeable quantile sketches per language and source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm._util import cut
from graphloom.llm.text_stats import with_stats

#: Relative width of a sketch bucket.
GAMMA = 1.02
#: Bucket of zero; positive values have larger ones.
ZERO = -1_000_000
#: A group's sketch counts as if so many texts were dealt like those of its language, and a language's like those of all texts.
PRIOR = 200
#: A fence lies so many spreads outside the middle half. A spread is the interquartile range of the group or of its
#: language, or what chance alone makes of a count in a text of that length, whichever is largest.
REACH = 6.0
#: Rule -> (numerator, denominator). Repetition is left to the base rules.
RULES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "chars_per_word": ("word_chars", "n_words"),
}
#: Up to so many rows of thresholds (some 200 bytes each) are broadcast; more are joined by key.
BROADCAST_ROWS = 50_000


def _value(rule: str) -> Column:
    top, bottom = RULES[rule]
    return F.when(F.col(f"stats.{bottom}") > 0, F.col(f"stats.{top}") / F.col(f"stats.{bottom}")).otherwise(F.lit(0.0))


def base_failed() -> Column:
    s = F.col
    return (s("stats.n_words") < 50) | (100 * s("stats.n_repeat_words") > 50 * s("stats.n_words"))


def sketch(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Bucket counts (keys, rule, bucket, n): a relative-error quantile sketch.

    Buckets have logarithmic bounds, so sketches merge by adding counts, in any order and with
    the same result; a group has at most some thousand buckets whatever its size.
    """
    each = F.array(*[F.struct(F.lit(r).alias("rule"), _value(r).alias("x")) for r in RULES])
    rows = texts.select(*keys, F.explode(each).alias("e"))
    bucket = F.when(F.col("e.x") > 0, F.ceil(F.log(F.col("e.x")) / math.log(GAMMA)).cast("int")).otherwise(ZERO)
    return rows.groupBy(*keys, F.col("e.rule").alias("rule"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def blended(counts: DataFrame, keys: list[str], parent: DataFrame, above: list[str]) -> DataFrame:
    """(keys, rule, bucket, w): each group's counts and PRIOR texts dealt like its parent's (above, rule, bucket, w)."""
    own = counts.groupBy(*keys, "rule", "bucket").agg(F.sum("n").cast("double").alias("w"))
    whole = parent.groupBy(*above, "rule").agg(F.sum("w").alias("total")).select(*[F.col(k).alias(f"t_{k}") for k in above], F.col("rule").alias("t_rule"), "total")
    dealt = parent.select(*[F.col(k).alias(f"p_{k}") for k in above], F.col("rule").alias("p_rule"), "bucket", F.col("w").alias("p_w"))
    here, there, totals = F.col("rule") == F.col("p_rule"), F.col("rule") == F.col("t_rule"), own.select(*keys, "rule").distinct()
    for k in above:
        here, there = here & F.col(k).eqNullSafe(F.col(f"p_{k}")), there & F.col(k).eqNullSafe(F.col(f"t_{k}"))
    prior = totals.join(whole, there).join(dealt, here).select(*keys, "rule", "bucket", (F.lit(float(PRIOR)) * F.col("p_w") / F.col("total")).alias("w"))
    return own.unionByName(prior).groupBy(*keys, "rule", "bucket").agg(F.sum("w").alias("w"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rule, q1, q3) of sketches (keys, rule, bucket, w), w being counts or weights."""
    by = W.partitionBy(*keys, "rule")
    upto = sketches.withColumn("upto", F.sum("w").over(by.orderBy("bucket"))).withColumn("total", F.sum("w").over(by) * (1 - 1e-9))
    at = F.when(F.col("bucket") == ZERO, 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bucket")))
    return upto.groupBy(*keys, "rule").agg(F.min(F.when(F.col("upto") * 4 >= F.col("total"), at)).alias("q1"), F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, at)).alias("q3"))


def thresholds(texts: DataFrame) -> DataFrame:
    """One row per (lang, source): for each rule a struct (q1, q3, spread).

    texts: lang, source, stats of texts that pass the base rules. Counts cover all of them. Sketches are blended by
    weight, alike at every size: a group of a few texts is judged nearly as its language, one of many by itself.
    """
    counts = cut(sketch(texts, ["lang", "source"]))
    every = counts.groupBy("rule", "bucket").agg(F.sum("n").cast("double").alias("w"))
    lang = cut(blended(counts, ["lang"], every, []))
    own = quartiles(blended(counts, ["lang", "source"], lang, ["lang"]), ["lang", "source"])
    wide = quartiles(lang, ["lang"]).select(F.col("lang").alias("l"), F.col("rule").alias("r"), (F.col("q3") - F.col("q1")).alias("wide"))
    joined = own.join(wide, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("r")))
    limit = F.struct("q1", "q3", F.greatest(F.col("q3") - F.col("q1"), "wide").alias("spread"))
    return cut(joined.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == r, limit)).alias(r) for r in RULES]))


def within_fences(rule: str, limit: str) -> Column:
    """Whether the text's value is inside the fences around q1 and q3 of the struct `limit`; true without one."""
    n = F.greatest(F.col(f"stats.{RULES[rule][1]}"), F.lit(1))
    chance = F.sqrt(F.greatest(F.col(f"{limit}.q3") * n, F.lit(1.0))) / n
    room = REACH * F.greatest(F.col(f"{limit}.spread"), chance)
    return F.coalesce(_value(rule).between(F.col(f"{limit}.q1") - room, F.col(f"{limit}.q3") + room), F.lit(True))


def judge(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """stats (lang, source, stats, ...) with base_failed and kept added."""
    limits = limits.select(F.col("lang").alias("__l"), F.col("source").alias("__s"), *[F.col(r).alias(f"__{r}") for r in RULES])
    if limits.count() <= BROADCAST_ROWS:
        limits = F.broadcast(limits)
    joined = stats.join(limits, F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s")), "left")
    good = F.lit(True)
    for r in RULES:
        good = good & within_fences(r, f"__{r}")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & good).drop(
        "__l", "__s", *[f"__{r}" for r in RULES])


def score(docs: DataFrame) -> DataFrame:
    """doc_id, stats, base_failed and kept for every row of docs (doc_id, text, lang, source).

    Null and empty texts have no words and fail. Null languages and sources form groups of their
    own. Repeated rows are judged alike. No limits (an empty table, or all texts failed): the base
    rules decide alone.
    """
    stats = cut(with_stats(docs, "text", ["doc_id", "lang", "source"]))
    return judge(stats, thresholds(stats.filter(~base_failed())))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; the text is read twice, never shuffled."""
    limits = thresholds(with_stats(docs, "text", ["lang", "source"]).filter(~base_failed()))
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns of any name pass through
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)], "lang", "source", "text")
    good = judge(with_stats(given, "text", [*names, "lang", "source"]), limits).filter("kept")
    return good.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def query(spark, sf_dir: str) -> DataFrame:
    out = score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      "base_failed", "kept")
