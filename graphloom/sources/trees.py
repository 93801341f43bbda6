"""Scans of folder trees: inputs, sidecars and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import axes

#: File suffix -> kind of a per-binary output; fixed values of the layout.
KINDS = {"_output.csv": "output_csv", "_strings.bin": "strings_bin", "_function_ranges.txt": "function_ranges", "_meta.json": "meta_json", "_consts.txt": "consts_txt", "_output.mapping.b64c": "output_mapping"}


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, base, folder, size_bytes) of every file; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("base"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.col("length").alias("size_bytes"))


def elf_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.filter(axes.is_elf(F.col("content"), F.col("path"))).select("path", F.col("length").alias("size_bytes"))


def outputs(files: DataFrame) -> DataFrame:
    """(fullname, kind, package, size_bytes) of recognised outputs beside an output file of their binary."""
    suffix = "|".join(s.replace(".", r"\.") for s in sorted(KINDS, key=len, reverse=True))
    named = files.withColumn("suffix", F.regexp_extract("base", f"({suffix})$", 1)).filter("suffix <> ''")
    kind = F.lit(None).cast("string")
    for s, k in KINDS.items():
        kind = F.when(F.col("suffix") == s, k).otherwise(kind)
    rows = named.select(F.expr("substring(base, 1, length(base) - length(suffix))").alias("fullname"), "folder", kind.alias("kind"), "size_bytes")
    anchors = rows.filter("kind = 'output_csv'").select("fullname", "folder")
    return rows.join(anchors, ["fullname", "folder"], "left_semi")


def variant_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Variant axes from JSON sidecars named ...__hhhhhhhh.json; further keys go to the map extra."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("wholetext", True).text(path)
    data = lines.select(F.from_json("value", "map<string,string>").alias("m"), F.regexp_extract(F.input_file_name(), r"__([0-9a-f]{8})\.json$", 1).alias("id"))
    axis = {"arch": "arch", "compiler": "compiler_family", "compiler_version": "compiler_version", "opt": "optimization", "pkg": "pkg"}
    own = list(axis.values())
    return data.filter("id <> ''").select(*[F.col("m")[v].alias(k) for k, v in axis.items()], F.conv("id", 16, 10).cast("long").alias("variant_id"),
                                          F.map_filter("m", lambda k, v: ~k.isin(own)).alias("extra"))


def strings_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """(binary, line, escaped): lines of the strings files, 1-based within each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_strings.bin").load(path)
    text = F.decode("content", "ISO-8859-1")  # one character per byte
    lines = F.split(F.regexp_replace(text, "\n$", ""), "\n", -1)
    return files.select(F.regexp_extract("path", r"([^/]+)_strings\.bin$", 1).alias("binary"), F.posexplode(lines).alias("n", "t")).select("binary", (F.col("n") + 1).alias("line"), F.encode("t", "ISO-8859-1").alias("escaped"))


def function_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(binary, row, min_addr, max_addr) of lines with two hex addresses; lines with # are headings."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_function_ranges.txt").option("wholetext", True).text(path)
    rows = lines.select(F.regexp_extract(F.input_file_name(), r"([^/]+)_function_ranges\.txt$", 1).alias("binary"), F.posexplode(F.filter(F.split("value", "\n"), lambda x: (x != "") & ~F.startswith(x, F.lit("#")))).alias("row", "t"))
    return rows.select("binary", "row", *[F.conv(F.regexp_replace(F.trim(F.split("t", ",")[i]), "^0x", ""), 16, 10).cast("long").alias(n) for i, n in enumerate(("min_addr", "max_addr"))])


def instruction_sets(spark: SparkSession, path: str) -> DataFrame:
    """(category, mnemonic) of a JSON object of lists."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("category", "m")).select("category", F.explode("m").alias("mnemonic"))


def content_hash(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))
