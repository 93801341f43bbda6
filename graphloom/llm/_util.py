"""Shared parts of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Longs in the bitmap of a sieve: 16 MB as rows.
SIEVE_WORDS = 1 << 20
#: Up to so many edges, a row for each node (at most twice as many, 24 bytes each, 24 MB) is broadcast.
BROADCAST_EDGES = 500_000
#: Numbers in a block of summed(), blocks that are added at a time, and rounds of that: 2 million tasks.
BLOCK, FAN, ROUNDS = 8192, 128, 3


#: What this Python worker keeps for its next tasks: one operator's model at a time.
_kept: dict[tuple, Any] = {}


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the reliable checkpoint folder and cut its lineage.

    The folder is the one the cluster names in spark.checkpoint.dir, or that the session has set; a temporary
    one only on a single machine where neither is.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not (sc.master.startswith("local") and "cluster" not in sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="graphloom-"))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the files of shuffles, broadcasts and checkpoints that nothing refers to any more.

    Spark does so when the driver's JVM collects garbage, which may be long after the disks are full. What Python
    referred to is only free after a moment, so a second collection follows.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def hand_back() -> None:
    """Gives memory that this process has freed back to the system; the C library would keep most of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def let_go() -> None:
    """Drops what earlier tasks of another operator kept: Spark's Python workers outlive stages, and an executor has to hold it beside all that follows."""
    if _kept:
        _kept.clear()
        hand_back()


def keep(key: tuple, make: Callable[[], Any]) -> Any:
    """make(), kept by this worker for its next tasks until another operator's task comes."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partition count: the one number that grows with the cluster."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def let(value: Column, use) -> Column:
    """use(value) with the value computed once: lambdas would compute what they mention anew for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Identifies a document by id and text: rows alike in both are one document."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit("\x00"), F.coalesce(F.col(text_col), F.lit("")))))


def sieve(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """rows with a column __maybe: false only if `column` isn't among the keys (a DataFrame of one column of that type).

    Each key sets a bit of a bitmap of SIEVE_WORDS longs, which is broadcast: its size is the same for any number
    of keys. Null is never among the keys.
    """
    def hashed(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(SIEVE_WORDS * 64))

    bit = F.expr("shiftleft(1L, cast(__h % 64 as int))")
    words = keys.select(hashed(keys.columns[0]).alias("__h")).groupBy(F.expr("shiftright(__h, 6)").alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    met = rows.withColumn("__h", F.when(F.col(column).isNotNull(), hashed(column))).join(F.broadcast(words), F.expr("shiftright(__h, 6)") == F.col("__word"), "left")
    return met.withColumn("__maybe", F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))).drop("__h", "__word", "__bits")


def beside(rows: DataFrame, column: str, table: DataFrame, key: str, few: bool) -> DataFrame:
    """Left join of rows with a table by column = key. few: the table is within its caller's bound, and is broadcast.

    Else only the rows that the table may know are shuffled; the others pass by.
    """
    if few:
        return rows.join(F.broadcast(table), F.col(column) == F.col(key), "left")
    marked = sieve(rows, column, table.select(key))
    known = marked.filter("__maybe").join(table, F.col(column) == F.col(key), "left")
    return known.unionByName(marked.filter("not __maybe"), allowMissingColumns=True).drop("__maybe")


def part_rows(part: int, flat: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One task's numbers as rows for summed(): block int, part bigint, numbers array<double>."""
    for at in range(0, len(flat), BLOCK):
        values = pa.array([flat[at : at + BLOCK]], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK], pa.int32()), pa.array([part], pa.int64()), values], names=["block", "part", "numbers"])


PARTS = "block int, part bigint, numbers array<double>"


def summed(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' numbers (rows of part_rows), added in order of part, so that it's the same in every run.

    At most FAN blocks meet in a group; the driver receives one sum, as long as one task's numbers. Empty without parts.
    """
    def add(key: tuple, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["part"].to_numpy(), kind="stable")
        values = rows["numbers"].combine_chunks().flatten().to_numpy().reshape(len(order), -1)
        total = values[order[0]].copy()
        for i in order[1:]:
            total += values[i]
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "numbers": pa.array([total], pa.list_(pa.float64()))})

    for _ in range(ROUNDS):
        parts = parts.groupBy("block", F.expr(f"part div {FAN}").alias("group")).applyInArrow(add, PARTS)
    blocks = {r["block"]: r["numbers"] for r in parts.select("block", "numbers").collect()}
    return np.concatenate([np.array(blocks[b]) for b in sorted(blocks)]) if blocks else np.zeros(0)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return tuple(row)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph by alternating large-star and small-star.

    edges: columns u, v of one comparable type; repeats and loops are allowed.
    Returns (node, root): root is the smallest node of its component. Nodes without
    an edge to another node don't appear. Least neighbours are aggregated with map-side partials. They meet the
    edges by broadcast while edges are few; beyond that they are checkpointed first, so that the join reads two plain
    shuffles and Spark splits the edges of a hub among tasks. Rounds are checkpointed, and the driver sees a count
    and a checksum only.
    """
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        few = before[0] <= BROADCAST_EDGES

        def kept(df: DataFrame) -> DataFrame:
            """While edges are few, in as many partitions as they need, whatever the width of a shuffle."""
            return df.coalesce(1 + before[0] // 50_000) if few else df

        def ready(df: DataFrame) -> DataFrame:
            return F.broadcast(kept(df)) if few else cut(df)

        e = kept(e)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ready(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = kept(large.unionByName(low.filter("m < u").select("u", F.col("m").alias("v"))).distinct())
        low2 = ready(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low2, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e2 = cut(kept(small.unionByName(low2.select("u", F.col("m").alias("v"))).distinct()))
        after = _state(e2)
        e, done, before = e2, after == before, after
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())
