"""URL allow and block rules by a sort-merge range join, in DataFrame expressions only.

A rule (host, path) is an interval: its reversed host, and the paths from its own to the last one
that begins with it. A url probes the reversed suffixes of its host. Within a reversed host, rule
bounds and url paths are sorted together and swept; every bound carries the stack of nested rules
that are active after it, and a url reads the stack of the bound before it. The stacks of the few
bounds come from a join on path prefixes before the sweep, so that any slice of a host starts with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm._util import beside, cut, shuffle_width

#: The contract's rules (fixed values): action, host, path.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"),
         ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Up to so many bounds of rules, and judged urls (some 300 bytes each, under 64 MB), are broadcast; more are joined by key.
BROADCAST_RULES, BROADCAST_URLS = 50_000, 200_000
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def bounds(rules: DataFrame) -> DataFrame:
    """(hkey, at, stack): interval bounds of the rules, with the rules active after each, shortest path first.

    at is the path in hex, so that bytes sort as text; the upper bound adds a character above all hex
    digits. Intervals of one host are nested or disjoint. A rule's stack is found by an equi-join of its
    path's prefixes with the rules, so its length is bounded by that of the path.
    """
    own = rules.groupBy("host", "path").agg(F.max("action").alias("action"))  # block wins over allow
    own = own.select(_reversed(F.col("host")).alias("hkey"), "host", "path", "action")
    outer = own.select("hkey", F.col("path").alias("opath"), F.struct(F.length("path").alias("n"), "host", "path", "action").alias("rule"))
    prefixes = own.select("hkey", "path", F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", 1, n))).alias("opath"))
    stacks = prefixes.join(outer, ["hkey", "opath"]).groupBy("hkey", "path").agg(F.array_sort(F.collect_list("rule")).alias("stack"))
    start = stacks.select("hkey", F.hex(F.encode("path", "UTF-8")).alias("at"), "stack")
    end = stacks.select("hkey", F.concat(F.hex(F.encode("path", "UTF-8")), F.lit("G")).alias("at"), F.slice("stack", 1, F.size("stack") - 1).alias("stack"))
    return start.unionByName(end)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict added.

    rules: action, host, path. A rule fits its host and all subdomains if the path starts with the
    rule's; the rule with most characters in host and path wins, then the one with the longer host.
    Null urls and urls without :// have empty parts, and no rule. Every distinct url is judged
    once, so repeated rows cost one probe and keep their number; a host's urls are cut into slices
    of a mean partition's size, each swept on its own beside the host's bounds. Null urls, and those that
    no rule fits, aren't shuffled back.
    """
    spark = pages.sparkSession
    labels = F.split("host", r"\.", -1)
    depth = rules.agg(F.max(F.size(labels))).first()[0] or 0  # more labels than any rule has match none
    urls = pages.select(F.col(url_col).alias("u")).filter("u is not null").distinct()
    parts = urls.select("u", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path")).filter("host <> ''")
    levels = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(depth, 1)))), lambda n: F.array_join(F.slice(F.reverse(labels), F.lit(1), n), "."))
    edges = cut(bounds(rules))
    few = (lambda df: F.broadcast(df)) if edges.count() <= BROADCAST_RULES else (lambda df: df)
    probes = parts.select("u", F.hex(F.encode("path", "UTF-8")).alias("at"), F.explode(levels).alias("hkey")).join(few(edges.select("hkey").distinct()), "hkey", "left_semi")
    counts = cut(probes.groupBy("hkey").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    mean = max(1, -(-total // (2 * shuffle_width(spark))))
    slices = counts.select("hkey", F.ceil(F.col("n") / mean).cast("int").alias("slices"))
    dealt = probes.join(few(slices), "hkey").select("hkey", F.pmod(F.xxhash64("u"), F.col("slices")).cast("int").alias("slice"), "at", F.lit(1).alias("kind"), "u",
                                               F.lit(None).cast(edges.schema["stack"].dataType).alias("stack"))
    copies = edges.join(few(slices), "hkey").select("hkey", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "at", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("u"), "stack")
    active = F.last("stack", ignorenulls=True).over(W.partitionBy("hkey", "slice").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow))
    swept = dealt.unionByName(copies).withColumn("active", active).filter("kind = 1").select("u", F.try_element_at("active", F.lit(-1)).alias("top")).filter("top is not null")
    best = F.max(F.struct((F.length("top.host") + F.length("top.path")).alias("n"), F.length("top.host").alias("h"), F.concat("top.host", "top.path").alias("rule"), F.col("top.action").alias("verdict")))
    judged = cut(swept.groupBy("u").agg(best.alias("best")).select(F.col("u").alias("__u"), "best.rule", "best.verdict"))
    cols = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    out = beside(pages.withColumn("__url", F.col(f"`{url_col}`")).select(*cols, "__url"), "__url", judged, "__u", judged.count() <= BROADCAST_URLS)
    return out.select(*cols, host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


_CASES = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{a}:{h}{p}}}"
                  for a, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))


def _sql() -> str:
    rule = verdict = _CASES
    for a, h, p in RULES:
        rule = rule.replace(f"{{{a}:{h}{p}}}", f"'{h}{p}'")
        verdict = verdict.replace(f"{{{a}:{h}{p}}}", f"'{a}'")
    return rf"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path FROM pages)
SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule, CASE {verdict} ELSE 'allow' END AS verdict FROM parts"""


SQL = _sql()
