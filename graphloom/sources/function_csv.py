"""Function files: versioned CSV with three packed arrays, a metadata cell and a closing vocabulary row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import codecs, metadata
from graphloom.operators.order import numbered

PRELUDE, VOCAB_MARK = "version=", "vocabulary"
HEADER = ["function_name", "occurrence", "tokens_base64", "block_runlength_base64", "instruction_runlength_base64", "metadata"]
#: Vocabulary rows are wider than function rows.
MORE = [f"more{i}" for i in range(12)]
SCHEMA = ", ".join(f"{c} string" for c in HEADER + MORE)
#: Records beyond these sizes are rejected; fixed values of the body format.
MOST_INSN_RUNS, MOST_BLOCK_RUNS = 1 << 24, 1 << 16


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the files below path as text cells, with binary (file name without suffix)."""
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", "*_output.csv").option("multiLine", True).option("escape", '"').csv(path)
    return rows.withColumn("binary", F.regexp_extract(F.input_file_name(), r"([^/]+)_output\.csv$", 1))


def _is_vocab() -> Column:
    """A function may be called like the mark, but then an occurrence follows."""
    return (F.col("function_name") == VOCAB_MARK) & ~F.coalesce(F.col("occurrence").rlike("^[0-9]"), F.lit(False))


def _is_prelude() -> Column:
    return F.startswith("function_name", F.lit(PRELUDE)) & F.col("occurrence").isNull()


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(binary, format_version): that of the prelude, else 1."""
    number = F.when(_is_prelude(), F.regexp_extract("function_name", r"(\d+)$", 1).cast("int")).otherwise(1)
    return read_rows(spark, path).groupBy("binary").agg(F.max(number).alias("format_version"))


def function_rows(rows: DataFrame) -> DataFrame:
    """Without preludes, headers and vocabulary rows."""
    return rows.filter(~(_is_prelude() | _is_vocab() | (F.col("function_name") == HEADER[0])))


def definitions(rows: DataFrame) -> DataFrame:
    """(binary, cell, types): the last vocabulary row of each file, earlier ones being checkpoints; types as an array."""
    own = rows.withColumn("__n", F.monotonically_increasing_id()).filter(_is_vocab())  # a file is read in order, by one task
    last = own.groupBy("binary").agg(F.max_by(F.struct("occurrence", "block_runlength_base64"), "__n").alias("d"))
    return last.select("binary", F.coalesce("d.occurrence", F.lit("")).alias("cell"), codecs.text_to_array("d.block_runlength_base64").alias("types"))


def parse(rows: DataFrame) -> DataFrame:
    """binary, func_name, occurrence, tokens, block_rl, insn_rl, called: arrays decoded and callees read."""
    meta = metadata.parse(F.col("metadata"))
    return function_rows(rows).select(
        "binary", F.col("function_name").alias("func_name"), F.coalesce(F.col("occurrence").cast("int"), F.lit(0)).alias("occurrence"),
        codecs.text_to_array("tokens_base64").alias("tokens"), codecs.text_to_array("block_runlength_base64").alias("block_rl"),
        codecs.text_to_array("instruction_runlength_base64").alias("insn_rl"), metadata.callees(meta).alias("called"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows within the size limits, and the others with reason and time."""
    reason = F.when(F.size("insn_rl") >= MOST_INSN_RUNS, "insn_runs").when(F.size("block_rl") >= MOST_BLOCK_RUNS, "block_runs")
    marked = parsed.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null").select("reason", "func_name", F.current_timestamp().alias("at"))


def write(functions: DataFrame, path: str) -> None:
    """Function rows as CSV cells, one folder per binary; the committer publishes all or nothing."""
    cells = functions.select("binary", F.col("func_name").alias("function_name"), F.col("occurrence").cast("string").alias("occurrence"), codecs.array_to_text("tokens").alias("tokens_base64"),
                             codecs.array_to_text("block_rl").alias("block_runlength_base64"), codecs.array_to_text("insn_rl").alias("instruction_runlength_base64"), "metadata")
    cells.write.mode("overwrite").partitionBy("binary").option("escape", '"').option("header", True).csv(path)


#: Function rows between two vocabulary rows; a fixed value of the format.
CHECKPOINT_ROWS = 16_384


def file_lines(functions: DataFrame, vocabulary: DataFrame, every: int = CHECKPOINT_ROWS) -> DataFrame:
    """(binary, line, text): the lines of whole function files: prelude, header, functions in order, vocabulary rows in between and at the end.

    functions: binary, ord, func_name, occurrence, tokens, block_rl, insn_rl, metadata. vocabulary: binary, local_id, token,
    type_id (from 0), first_ord: the order of the first function that uses it. Behind each `every` functions stands what they and those before
    them use; the last row has all. Functions are numbered by ranges; a vocabulary row has at most 65,535 tokens.
    """
    numbers = numbered(functions, ["binary"], ["ord"], "n")
    cells = numbers.select("binary", (F.col("n") + 2 + F.floor(F.col("n") / every)).alias("line"), F.col("func_name").alias("c0"), F.col("occurrence").cast("string").alias("c1"),
                           codecs.array_to_text("tokens").alias("c2"), codecs.array_to_text("block_rl").alias("c3"), codecs.array_to_text("insn_rl").alias("c4"), F.col("metadata").alias("c5"))
    sizes = functions.select("binary").union(vocabulary.select("binary")).distinct().join(functions.groupBy("binary").agg(F.count("*").alias("n")), "binary", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    heads = sizes.select("binary", F.inline(F.array(F.struct(F.lit(0).cast("long").alias("line"), F.lit(f"{PRELUDE}2").alias("text")), F.struct(F.lit(1).cast("long").alias("line"), F.lit(",".join(HEADER)).alias("text")))))
    marks = sizes.select("binary", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("n") / every) + 1)).alias("k"))
    marks = marks.withColumn("last", F.col("k") > F.floor(F.col("n") / every)).select("binary", "k", "last", F.when(F.col("last"), F.col("n") + 1 + F.col("k")).otherwise(F.col("k") * (every + 1) + 1).alias("line"))
    first = vocabulary.join(numbers.select("binary", F.col("ord").alias("first_ord"), "n"), ["binary", "first_ord"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    held = marks.join(first, "binary", "left").filter(F.col("last") | (F.col("n") < F.col("k") * every) | F.col("local_id").isNull())
    sets = held.groupBy("binary", "line").agg(F.array_sort(F.collect_list(F.when(F.col("local_id").isNotNull(), F.struct("local_id", "token", "type_id")))).alias("t"))
    types = F.transform("t", lambda x: x["type_id"])
    starts = F.filter(F.sequence(F.lit(0), F.size("t")), lambda i: (i == 0) | (i == F.size("t")) | (F.get(types, i) != F.get(types, F.greatest(i - 1, F.lit(0)))))
    starts = F.when(F.size("t") > 0, starts).otherwise(F.array().cast("array<int>"))
    sets = sets.withColumn("s", starts).withColumn("runs", F.transform(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))), lambda e, i: e - F.get("s", i)))
    sets = sets.withColumn("kinds", F.transform("runs", lambda _, i: F.get(types, F.get("s", i)).cast("long")))
    rows = sets.select("binary", "line", F.lit(VOCAB_MARK).alias("c0"), F.array_join(F.transform("t", lambda x: x["token"]), ",").alias("c1"), F.lit("").alias("c2"), codecs.array_to_text("kinds").alias("c3"), codecs.array_to_text("runs").alias("c4"), F.lit("").alias("c5"))
    quoted = [F.when(F.coalesce(F.col(f"c{i}"), F.lit("")).rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(f"c{i}", F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(f"c{i}", F.lit(""))) for i in range(6)]
    return cells.unionByName(rows).select("binary", "line", F.concat_ws(",", *quoted).alias("text")).unionByName(heads)


def write_files(functions: DataFrame, vocabulary: DataFrame, path: str, every: int = CHECKPOINT_ROWS) -> None:
    """The lines of file_lines in a folder for each binary, binary=<name>: parts by range of lines, in the order of their names, so that a large file has many tasks."""
    lines = file_lines(functions, vocabulary, every)
    lines.repartitionByRange("binary", "line").sortWithinPartitions("binary", "line").select("binary", "text").write.mode("overwrite").partitionBy("binary").text(path)
