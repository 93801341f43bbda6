"""Length reductions over variants, gates, histograms, bands and the sorted length index."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators.order import numbered


def parse_reduction(text: str) -> int | None:
    """Percentile of 'p1' to 'p99'; None for 'max' and 'p100'."""
    if text in ("max", "p100"):
        return None
    found = re.fullmatch(r"p0?(\d{1,2})", text)
    if not found or not 1 <= int(found[1]) <= 99:
        raise ValueError(f"no such reduction: {text}")
    return int(found[1])


def percentile_lower(values: Column, q: int) -> Column:
    """Element floor((n - 1) * (q / 100)), in doubles, of an array in ascending order; 0 of an empty one."""
    at = F.floor((F.size(values) - 1) * (F.lit(float(q)) / F.lit(100.0))).cast("int")
    return F.coalesce(F.get(F.array_sort(values), at), F.lit(0))


def reduce_lengths(nodes: DataFrame, keys: list[str], reduction: str, length: str = "length") -> DataFrame:
    """One length per section. A section's variants are few, so gathering them is bounded by their number."""
    q = parse_reduction(reduction)
    if q is None:
        return nodes.groupBy(*keys).agg(F.coalesce(F.max(length), F.lit(0)).alias("length"))
    return nodes.groupBy(*keys).agg(F.collect_list(length).alias("__all")).select(*keys, percentile_lower(F.col("__all"), q).alias("length"))


def reduce_grouped(nodes: DataFrame, keys: list[str], group: str, reduction: str, length: str = "length") -> DataFrame:
    """As reduce_lengths, over one value per distinct body: its maximum, or for percentiles its mean; truncated."""
    q = parse_reduction(reduction)
    one = F.max(length).cast("double") if q is None else F.avg(length)
    per_body = nodes.groupBy(*keys, group).agg(one.alias("__length"))
    return reduce_lengths(per_body, keys, reduction, "__length").withColumn("length", F.col("length").cast("long"))


def gate(nodes: DataFrame, keys: list[str], body: str, least_variants: int, least_bodies: int) -> DataFrame:
    """n_variants and n_bodies of the sections that have enough of both."""
    return nodes.groupBy(*keys).agg(F.count("*").alias("n_variants"), F.countDistinct(body).alias("n_bodies")).filter(
        (F.col("n_variants") >= least_variants) & (F.col("n_bodies") >= least_bodies))


def histogram(lengths: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sections per length from the least to the greatest one, gaps as zero. Length 0 is no section."""
    keys = keys or []
    counts = lengths.filter("length > 0").groupBy(*keys, "length").agg(F.count("*").alias("n"))
    spans = counts.groupBy(*keys).agg(F.min("length").alias("a"), F.max("length").alias("b")).filter("a is not null")
    every = spans.select(*keys, F.explode(F.sequence("a", "b")).alias("length"))
    return every.join(counts, [*keys, "length"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def in_band(lengths: DataFrame, low: int, high: int) -> DataFrame:
    """Sections with a length in the band; length 0 is never eligible."""
    return lengths.filter(F.col("length").between(max(low, 1), high))


def count_in_band(lengths: DataFrame, low: int, high: int, keys: list[str] | None = None) -> DataFrame:
    return in_band(lengths, low, high).groupBy(*(keys or [])).agg(F.count("*").alias("n"))


def length_index(lengths: DataFrame, keys: list[str], section: str = "section_id") -> DataFrame:
    """Position of every eligible section in the stable order by (length, section), within each index."""
    return numbered(lengths.filter("length > 0"), keys, ["length", section], "position").withColumn("position", F.col("position").cast("int"))


def write_length_index(lengths: DataFrame, path: str, section: str = "section_id") -> None:
    """Index as a table by (mode, depth), sorted by length within files, so that a band reads few row groups."""
    lengths.filter("length > 0").repartitionByRange("mode", "depth", "length").sortWithinPartitions("length", section).write.mode(
        "overwrite").partitionBy("mode", "depth").parquet(path)


def auto_size(nodes: DataFrame, keys: list[str], length: str = "length") -> DataFrame:
    """Most variants of a section, and the greatest length and 64 more."""
    per = nodes.groupBy(*keys).agg(F.count("*").alias("n"), F.max(length).alias("m"))
    return per.agg(F.max("n").alias("num_variants"), (F.max("m") + 64).alias("context_len"))


def statistics(nodes: DataFrame, keys: list[str], low: int, high: int, length: str = "length") -> DataFrame:
    return nodes.groupBy(*keys).agg(F.count("*").alias("n_total"), F.count_if(F.col(length).between(low, high)).alias("n_in_range"))


def sorted_specs(specs: DataFrame) -> DataFrame:
    return specs.orderBy("mode", "depth")
