"""Catalogs as tables: sections with their variants and calls, bodies, geometry, and lookups in them.

A catalog is a folder with one Parquet table per kind, partitioned by program and sorted by section within files, so
that a lookup reads few row groups and a scan only the columns it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.sources.function_csv import MOST_BLOCK_RUNS, MOST_INSN_RUNS

#: Table -> its columns beside program.
TABLES = {
    "sections": ["arm", "section_id", "func_name", "n_variants"],
    "variants": ["section_id", "variant_idx", "vkey", "body_id"],
    "calls": ["section_id", "variant_idx", "called_idx", "callee_section", "callee_variant"],
    "geometry": ["section_id", "variant_idx", "body_len", "id_count", "value_count"],
    "bodies": ["body_id", "tokens", "block_rl", "insn_rl"],
}


def assemble_records(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (with the numbers of their runs and tokens), and rejects (binary, func_name, reason) whose runs are too many or don't add up.

    Block runs count instructions' tokens as instruction runs do, so both sum to the number of tokens.
    """
    def total(c: str) -> Column:
        return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)

    uneven = (total("insn_rl") != F.size("tokens")) | (total("block_rl") != F.size("tokens"))
    reason = (F.when(F.col("tokens").isNull() | F.col("insn_rl").isNull() | F.col("block_rl").isNull(), "missing").when(F.size("insn_rl") >= MOST_INSN_RUNS, "insn_runs")
              .when(F.size("block_rl") >= MOST_BLOCK_RUNS, "block_runs").when(uneven, "uneven"))
    marked = parsed.withColumn("reason", reason)
    sizes = {"n_insns": F.size("insn_rl"), "n_blocks": F.size("block_rl"), "n_tokens": F.size("tokens")}
    return marked.filter("reason is null").drop("reason").withColumns(sizes), marked.filter("reason is not null").select("binary", "func_name", "reason")


def token_spans(records: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, n_tokens): where a body's tokens lie in a record of two sizes, its runs and its tokens, in numbers."""
    return records.select(*keys, (F.lit(2) + F.col("n_insns") + F.col("n_blocks")).alias("start"), "n_tokens")


def write(tables: dict[str, DataFrame], path: str) -> None:
    """Each table, published whole or not at all by the committer; a name or column that the layout lacks is an error."""
    for name, rows in tables.items():
        columns = ["program", *TABLES[name]]
        order = [c for c in ("section_id", "variant_idx", "called_idx", "body_id") if c in TABLES[name]]
        rows.select(*columns).repartitionByRange("program", order[0]).sortWithinPartitions("program", *order).write.mode("overwrite").partitionBy("program").parquet(f"{path}/{name}")


def scan(spark: SparkSession, path: str, table: str, programs: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """A table's columns (all, if none are named) of the programs; nothing else is read."""
    rows = spark.read.parquet(f"{path}/{table}")
    rows = rows if programs is None else rows.filter(F.col("program").isin(programs))
    return rows.select("program", *(columns or TABLES[table]))


def discover(sections: DataFrame, only: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Distinct programs in order: those of only, of these the first most."""
    found = sections.select("program").distinct()
    found = found if only is None else found.filter(F.col("program").isin(only))
    found = found.orderBy("program")
    return found if most is None else found.limit(most)


def collection(catalogs: DataFrame, indexes: DataFrame, specs: list[tuple[str, int]], on_missing: str = "raise") -> DataFrame:
    """(program, mode, depth, has_index): every catalog under every spec; one without index is an error, is skipped or stays marked.

    on_missing: raise, skip or keep. catalogs: program. indexes: program, mode, depth.
    """
    if on_missing not in ("raise", "skip", "keep"):
        raise ValueError(f"no such policy: {on_missing}")
    wanted = catalogs.select("program").distinct().select("program", F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(k).alias("depth")) for m, k in specs])).alias("s")).select("program", "s.*")
    known = indexes.select("program", "mode", "depth").distinct().withColumn("has_index", F.lit(True))
    rows = wanted.join(known, ["program", "mode", "depth"], "left")
    if on_missing == "skip":
        return rows.filter("has_index")
    missing = F.lit(False) if on_missing == "keep" else F.raise_error(F.concat(F.lit("no index of "), "program")).cast("boolean")
    return rows.withColumn("has_index", F.coalesce("has_index", missing))


def function_by_name(sections: DataFrame, variants: DataFrame, program: str, func_name: str) -> DataFrame:
    """Variants of one function; none if the program or the name is unknown."""
    one = sections.filter((F.col("program") == program) & (F.col("func_name") == func_name))
    return one.join(variants, ["program", "section_id"])


def function_by_index(sections: DataFrame, variants: DataFrame, program: str, section_id: int) -> DataFrame:
    return sections.filter((F.col("program") == program) & (F.col("section_id") == section_id)).join(variants, ["program", "section_id"])


def report_rows(rows: DataFrame, order: list[str], most: int = 10) -> DataFrame:
    """The first rows of a report; only as many of each task are gathered."""
    return rows.orderBy(*order).limit(most)


def files_with(rows: DataFrame, package: str, file: str, count: Column) -> DataFrame:
    """(package, n_files, n_found): per package the files in which something is found, and how often."""
    found = rows.groupBy(package, file).agg(F.sum(count).alias("n")).filter("n > 0")
    return found.groupBy(package).agg(F.count("*").alias("n_files"), F.sum("n").alias("n_found"))
