"""Filtering, ordering, grouping and search of variants for inspection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.operators.order import numbered


def axis_filter(variants: DataFrame, disabled: dict[str, list[str]]) -> DataFrame:
    """Variants none of whose axis values is disabled; a missing value is '?'."""
    kept = [~F.coalesce(F.col(axis).cast("string"), F.lit("?")).isin(values) for axis, values in disabled.items() if values]
    return variants.filter(reduce(lambda a, b: a & b, kept, F.lit(True)))


def functions_passing(functions: DataFrame, variants: DataFrame, disabled: dict[str, list[str]], key: str) -> DataFrame:
    return functions.join(axis_filter(variants, disabled).select(key).distinct(), key, "left_semi")


def name_search(rows: DataFrame, needle: str, name: str) -> DataFrame:
    return rows.filter(F.contains(F.lower(F.col(name)), F.lit(needle.lower())))


def next_match(rows: DataFrame, needle: str, name: str, order: str, cursor: int) -> DataFrame:
    """The first match behind the cursor, or else the first of all."""
    return name_search(rows, needle, name).orderBy((F.col(order) <= cursor).cast("int"), order).limit(1)


def previous_match(rows: DataFrame, needle: str, name: str, order: str, cursor: int) -> DataFrame:
    return name_search(rows, needle, name).orderBy((F.col(order) >= cursor).cast("int"), F.desc(order)).limit(1)


def natural_key(text: Column) -> Column:
    """Runs of digits compare as numbers: each is padded to twenty places."""
    padded = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1)), lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 20, "0")).otherwise(p))
    return F.array_join(padded, "")


def natural_sort(rows: DataFrame, columns: list[str], within: list[str] | None = None, place: str = "place") -> DataFrame:
    """rows with their place in natural order; missing values come last. The columns have to tell rows apart."""
    keys = [natural_key(F.col(c).cast("string")).asc_nulls_last() for c in columns]
    return numbered(rows, within or [], keys, place).withColumn(place, F.col(place).cast("int"))


def group_leaves(variants: DataFrame, grouping: list[str], rest: list[str], leaf: str) -> DataFrame:
    """(grouping, place, leaf): every leaf of every group as a row, numbered in the order of the remaining axes."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c) for c in grouping]
    order = F.struct(*[natural_key(F.coalesce(F.col(c).cast("string"), F.lit("￿"))).alias(f"k{i}") for i, c in enumerate(rest)], F.col(leaf).alias("leaf"))
    rows = variants.select(*keys, order.alias("o"))
    return rows.select(*grouping, (F.row_number().over(W.partitionBy(*grouping).orderBy("o")) - 1).alias("place"), F.col("o.leaf").alias("leaf"))


def group_tree(variants: DataFrame, grouping: list[str], rest: list[str], leaf: str, most: int = 100_000) -> DataFrame:
    """One row per group: its values, size and leaves in the order of the remaining axes.

    A group's leaves are listed for people to read; of larger groups the first `most` are, and the size counts all.
    group_leaves has all of them as rows.
    """
    listed = F.collect_list(F.when(F.col("place") < most, F.struct("place", "leaf")))
    return group_leaves(variants, grouping, rest, leaf).groupBy(*grouping).agg(F.count("*").alias("n"), F.transform(F.array_sort(listed), lambda x: x["leaf"]).alias("leaves"))


def metadata_keys(rows: DataFrame, extra: str = "extra") -> DataFrame:
    return rows.select(F.explode(F.map_keys(extra)).alias("key")).distinct()


def axis_values(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Distinct (axis, value), missing ones as '?'."""
    each = F.array(*[F.struct(F.lit(a).alias("axis"), F.coalesce(F.col(a).cast("string"), F.lit("?")).alias("value")) for a in axes])
    return rows.select(F.explode(each).alias("e")).select("e.axis", "e.value").distinct()


def valid_jumps(jumps: DataFrame, blocks: DataFrame) -> DataFrame:
    """Jumps whose target is a block of the section."""
    return jumps.join(blocks.select("section_id", F.col("block").alias("target")), ["section_id", "target"], "left_semi")


def cap_list(rows: DataFrame, only: list[str] | None, most: int | None, name: str = "program") -> DataFrame:
    """Allowed names, then the first `most` of them in order."""
    kept = rows if only is None else rows.filter(F.col(name).isin(only))
    return kept.select(name).distinct().orderBy(name).limit(most if most is not None else (1 << 31) - 1)
