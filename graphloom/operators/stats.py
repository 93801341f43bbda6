"""Corpus statistics: sizes of artifacts beside those of the units they come from, along any axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.order import numbered


def share_by(units: DataFrame, artifacts: DataFrame, axes: list[str], unit: str, of: str, whole: str, part: str) -> DataFrame:
    """(axes, files, mean_share): mean of part / whole over the artifacts, by axes of their units.

    units: unit, whole and the axes; artifacts: of (their unit) and part, of the kind asked for. Units whose size is
    null or not positive have no share and are left out, as are artifacts without a unit.
    """
    sized = units.filter(F.col(whole) > 0).select(F.col(unit).alias("__unit"), F.col(whole).alias("__whole"), *axes)
    shares = artifacts.select(F.col(of).alias("__of"), F.col(part).cast("double").alias("__part")).join(sized, F.col("__of") == F.col("__unit"))
    return shares.groupBy(*axes).agg(F.count("*").alias("files"), F.avg(F.col("__part") / F.col("__whole")).alias("mean_share"))


def sums_by_kind(files: DataFrame, key: str, kind: str, size: str, apart: list[str]) -> DataFrame:
    """(key, a column for each kind set apart, rest, total): sizes summed in one pass; a kind without files has 0."""
    of = [F.sum(F.when(F.col(kind) == k, F.col(size)).otherwise(0)).alias(k) for k in apart]
    rest = F.sum(F.when(F.coalesce(F.col(kind).isin(apart), F.lit(False)), 0).otherwise(F.col(size))).alias("rest")
    return files.groupBy(key).agg(*of, rest, F.sum(size).alias("total"))


def against(units: DataFrame, built: DataFrame, key: str, whole: str) -> DataFrame:
    """Sizes of the units of each key beside what was built of them (columns of sums_by_kind); keys of one side stay.

    units, known and whole_total: how many units there are, of how many the size is known, and their sum. growth: total
    over whole_total, null where nothing is known.
    """
    sources = units.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("units"), F.count(whole).alias("known"), F.sum(whole).alias("whole_total"))
    both = sources.join(built, F.col("__key") == F.col(key), "full_outer").withColumn(key, F.coalesce(F.col("__key"), F.col(key))).drop("__key")
    return both.withColumn("growth", F.when(F.col("whole_total") > 0, F.col("total") / F.col("whole_total")))


def mean_by(rows: DataFrame, axes: list[str], value: str) -> DataFrame:
    """(axes, known, mean) of the rows whose value is known."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*axes).agg(F.count("*").alias("known"), F.avg(value).alias("mean"))


def pair_sizes(artifacts: DataFrame, sources: DataFrame) -> DataFrame:
    """artifact, source and ratio: the source is the one named by the parent folder, or else by the path without its suffix.

    artifacts: path, parent, stem, size_bytes; sources: path, size_bytes. Unpaired rows of either side stay, as orphans.
    """
    src = sources.select(F.col("path").alias("source"), F.col("size_bytes").alias("source_bytes"))
    by_parent = src.select(F.col("source").alias("p_source"), F.col("source_bytes").alias("p_bytes"))
    paired = artifacts.join(by_parent, F.col("parent") == F.col("p_source"), "left").join(src, F.col("stem") == F.col("source"), "left")
    paired = paired.select("path", "size_bytes", F.coalesce("p_source", "source").alias("source"), F.coalesce("p_bytes", "source_bytes").alias("source_bytes"))
    left = src.join(paired.select("source").distinct(), "source", "left_anti").select(F.lit(None).cast("string").alias("path"), F.lit(None).cast("long").alias("size_bytes"), "source", "source_bytes")
    rows = paired.unionByName(left).withColumn("ratio", F.when(F.col("source_bytes") > 0, F.col("size_bytes") / F.col("source_bytes")))
    return rows.withColumn("status", F.when(F.col("source").isNull(), "no_source").when(F.col("path").isNull(), "no_artifact").otherwise("paired"))


def covered_raw(raw: DataFrame, built: DataFrame, key: str = "program") -> DataFrame:
    """Bytes and files of the raw inputs whose program has been built."""
    return raw.join(built.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("n_files"), F.sum("size_bytes").alias("raw_total"))


def size_summary(rows: DataFrame, keys: list[str], value: str = "ratio") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.avg(value).alias("mean"), F.max(value).alias("most"))


def qualified_names(rows: DataFrame, folder: str = "folder", name: str = "name") -> DataFrame:
    """The bare name where it is unique, else folder/name; duplicates of that are marked."""
    bare = rows.groupBy(name).agg(F.countDistinct(folder).alias("__n"))
    pairs = rows.groupBy(folder, name).agg(F.count("*").alias("__m"))
    joined = pairs.join(bare, name)
    label: Column = F.when(F.col("__n") == 1, F.col(name)).otherwise(F.concat_ws("/", folder, name))
    return joined.select(folder, name, label.alias("label"), (F.col("__m") > 1).alias("is_collision"))


def first_root(files: DataFrame) -> DataFrame:
    """One file of each base name, that of the first root. files: base, root_ord, path, size_bytes."""
    return files.groupBy("base").agg(F.min(F.struct("root_ord", "path", "size_bytes")).alias("f")).select("base", "f.root_ord", "f.path", "f.size_bytes")


def deal_by_size(files: DataFrame, n: int) -> DataFrame:
    """Files by falling size, dealt in turn into n lists."""
    dealt = numbered(files, [], [F.desc("size_bytes"), "path"], "place").withColumn("place", F.col("place").cast("int"))
    return dealt.withColumn("list_id", F.col("place") % n)


def rollup(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(v).alias(v) for v in values])
