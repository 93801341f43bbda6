"""Catalogs stored by bucket: nodes meet their geometry and bodies without a shuffle, and all tables change together.

Tables lie under <path>/<key>/, key being a hash of their rows, so that the same rows are stored once. <path>/pointer
gets a row for each publication, after all its tables are whole; a reader takes the newest. Tables are never changed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

#: What buckets are of, where a table doesn't say otherwise.
KEYS = ["section_id", "variant_idx"]
POINTER = "version long, key string, name string, bucketed string, buckets int"


def content_key(tables: dict[str, DataFrame]) -> str:
    """Hash of the tables' names, schemas and rows, whatever their order; repeated rows count."""
    parts = []
    for name in sorted(tables):
        rows = tables[name]
        both = [F.xxhash64(F.lit(k), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))) for k in (0, 1)]
        row = rows.agg(F.count("*"), *[F.coalesce(F.bit_xor(h), F.lit(0)) for h in both], *[F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)) for h in both]).first()
        parts.append([name, rows.schema.simpleString(), *map(str, row)])
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:32]


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _files(spark, path)
    return files.exists(place)


def _name(key: str, name: str) -> str:
    return f"graphloom_{key}_{name}"


def _store(rows: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> None:
    spark = rows.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    dealt = rows.repartition(buckets, *keys)  # a task for each bucket, so a file for each
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)


def publish(tables: dict[str, DataFrame], path: str, buckets: int, keys: dict[str, list[str]] | None = None) -> str:
    """Stores the tables under one key, points to it, and returns it. A table that is whole there already isn't written again.

    keys: by table what its buckets are of, KEYS unless given. A publication that fails leaves the pointer as it was.
    """
    spark = next(iter(tables.values())).sparkSession
    key, by = content_key(tables), {name: (keys or {}).get(name, KEYS) for name in tables}
    for name, rows in tables.items():
        if not exists(spark, f"{path}/{key}/{name}/_SUCCESS"):
            _store(rows, _name(key, name), f"{path}/{key}/{name}", by[name], buckets)
    version = (_pointer(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    rows = [(version, key, name, ",".join(by[name]), buckets) for name in tables]
    spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("append").parquet(f"{path}/pointer")
    return key


def _pointer(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(POINTER).parquet(f"{path}/pointer")
    except AnalysisException:
        return spark.createDataFrame([], POINTER)


def current(spark: SparkSession, path: str, key: str | None = None) -> dict[str, DataFrame]:
    """The tables of the newest publication, or of a given key: all of one publication, whatever is published meanwhile.

    A reader in another session declares the buckets anew. Nothing published: an error.
    """
    rows = _pointer(spark, path)
    rows = rows if key is None else rows.filter(F.col("key") == key)
    newest = rows.groupBy("version").agg(F.collect_list(F.struct("key", "name", "bucketed", "buckets")).alias("t")).orderBy(F.desc("version")).first()
    if newest is None:
        raise ValueError(f"nothing is published at {path}")
    found = {}
    for t in newest["t"]:
        name, place = _name(t["key"], t["name"]), f"{path}/{t['key']}/{t['name']}"
        if not spark.catalog.tableExists(name):
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(place).schema)
            by = ", ".join(f"`{k}`" for k in t["bucketed"].split(","))
            spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {t['buckets']} BUCKETS LOCATION '{place}'")
        found[t["name"]] = spark.table(name)
    return found


def checked(rows: DataFrame, path: str, key: str) -> DataFrame:
    """The stored table at the path if it was made from these inputs (key), else rows, which are stored there with the key.

    An interrupted write has no key, and is made anew.
    """
    spark = rows.sparkSession
    if exists(spark, f"{path}/_SUCCESS") and exists(spark, f"{path}.key/{key}/_SUCCESS"):
        return spark.read.parquet(path)
    place, files = _files(spark, f"{path}.key")
    files.delete(place, True)
    rows.write.mode("overwrite").parquet(path)
    spark.createDataFrame([(key,)], StructType([StructField("key", StringType())])).coalesce(1).write.mode("overwrite").parquet(f"{path}.key/{key}")
    return spark.read.parquet(path)


def with_stored(nodes: DataFrame, table: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """nodes and what the table has of them; nodes that are stored by the same buckets aren't shuffled, nor is the table."""
    return nodes.join(table.hint("merge"), keys or KEYS, "left")


def read_band(spark: SparkSession, path: str, mode: str, depth: int, low: int, high: int) -> DataFrame:
    """Sections of an index (lengths.write_length_index) with a length in the band: only its folder, and row groups that reach into the band, are read."""
    return spark.read.parquet(path).filter((F.col("mode") == mode) & (F.col("depth") == depth)).filter(F.col("length").between(max(low, 1), high))
