"""Readers, writers and streams on small trees."""

import json

from pyspark.sql import functions as F

from graphloom.functions import codecs
from graphloom.operators import vocab
from graphloom.sources import function_csv, trees
from graphloom.streaming import incremental


def csv_file(folder, name, version):
    folder.mkdir(parents=True, exist_ok=True)
    arr = codecs.encode_array
    meta = json.dumps({"local_funcs": [{"name": "g"}]}).replace('"', '""')
    lines = ["version=2"] * (version == 2) + [",".join(function_csv.HEADER), f'f,0,{arr([300, 1])},{arr([2])},{arr([2])},"{meta}"', f'vocabulary,"add",norm,{arr([1])},p,{arr([1])},a,b,c,d,format_version,2', f'vocabulary,0,{arr([301])},{arr([1])},{arr([1])},""', f'vocabulary,"add,sub",norm,{arr([1, 2])},p,{arr([1, 1])},a,b,c,d,format_version,2']
    (folder / f"{name}_output.csv").write_text("\n".join(lines) + "\n")


def test_function_files(spark, tmp_path):
    csv_file(tmp_path / "pkg", "x64-gcc-9-O2_a", 2)
    csv_file(tmp_path / "pkg", "x64-gcc-9-O2_b", 1)
    rows = function_csv.read_rows(spark, str(tmp_path))
    assert {r["binary"]: r["format_version"] for r in function_csv.versions(spark, str(tmp_path)).collect()} == {"x64-gcc-9-O2_a": 2, "x64-gcc-9-O2_b": 1}
    good, bad = function_csv.split_rejects(function_csv.parse(rows))
    got = good.orderBy("binary").collect()
    assert sorted((r["func_name"], r["tokens"], len(r["called"])) for r in got) == [("f", [300, 1], 1)] * 2 + [("vocabulary", [301], 0)] * 2 and bad.count() == 0
    defs = vocab.valid_definitions(function_csv.definitions(rows))
    assert {(r["cell"], r["is_valid"]) for r in defs.collect()} == {("add,sub", True)}
    function_csv.write(good.withColumn("metadata", F.lit("{}")), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 4


def test_trees(spark, tmp_path):
    csv_file(tmp_path / "pkg", "a", 2)
    (tmp_path / "pkg" / "a_strings.bin").write_bytes(b"x\\ny\nz\n")
    (tmp_path / "pkg" / "orphan_strings.bin").write_bytes(b"s\n")
    (tmp_path / "pkg" / "a_function_ranges.txt").write_text("# format=1\n0x10,0x20\n30,40\n")
    (tmp_path / "pkg" / "prog__0000002a.json").write_text(json.dumps({"arch": "x64", "compiler_family": "gcc", "compiler_version": "9", "optimization": "O2", "pkg": "p", "flag": "z"}))
    (tmp_path / "pkg" / "prog").write_bytes(b"\x7fELF...")
    assert {(r["fullname"], r["kind"]) for r in trees.outputs(trees.listing(spark, str(tmp_path))).collect()} == {("a", "output_csv"), ("a", "strings_bin"), ("a", "function_ranges")}
    assert [bytes(r["escaped"]) for r in trees.strings_sidecar(spark, str(tmp_path)).filter("binary = 'a'").orderBy("line").collect()] == [b"x\\ny", b"z"]
    assert [(r["min_addr"], r["max_addr"]) for r in trees.function_ranges(spark, str(tmp_path)).orderBy("row").collect()] == [(16, 32), (48, 64)]
    side = trees.variant_sidecars(spark, str(tmp_path)).first()
    assert (side["variant_id"], side["opt"], side["extra"]) == (42, "O2", {"flag": "z"})
    assert trees.elf_files(spark, str(tmp_path)).count() == 1
    assert trees.content_hash(spark, str(tmp_path)).count() == 6


def test_index_as_it_arrives(spark, tmp_path):
    source = str(tmp_path / "in")
    for name in ("p", "q"):
        spark.createDataFrame([(name, 1, 5), (name, 2, 0)], "program string, section_id int, length int").write.mode("append").parquet(source)
        incremental.index_as_it_arrives(spark, source, "program string, section_id int, length int", lambda b: b.filter("length > 0"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["program"], r["section_id"]) for r in got.collect()} == {("p", 1), ("q", 1)} and got.count() == 2


def test_ready_pool(spark):
    pool = incremental.ReadyPool({"a": lambda n: spark.range(n * 3, n * 3 + 3)}, lambda rows: [r["id"] for r in rows])
    assert [pool.get("a", 2) for _ in range(3)] == [[0, 1], [2, 3], [4, 5]]


def test_stored_nodes_meet_geometry_without_a_shuffle(spark, tmp_path):
    from graphloom.sources import stored

    path = str(tmp_path / "catalog")
    nodes = spark.range(400).selectExpr("id % 40 AS section_id", "CAST(id DIV 40 AS INT) AS variant_idx", "id AS root")
    geometry = spark.range(400).selectExpr("id % 40 AS section_id", "CAST(id DIV 40 AS INT) AS variant_idx", "id * 2 AS body_len")
    bodies = geometry.selectExpr("section_id", "variant_idx", "array(section_id) AS tokens")
    key = stored.publish({"nodes": nodes, "geometry": geometry, "bodies": bodies}, path, 4)
    tables = stored.current(spark, path)
    both = stored.with_stored(stored.with_stored(tables["nodes"], tables["geometry"]), tables["bodies"])
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert both.filter("body_len = root * 2 and tokens[0] = section_id").count() == 400
    assert stored.publish({"nodes": nodes, "geometry": geometry.repartition(3), "bodies": bodies}, path, 4) == key
    other = stored.publish({"nodes": nodes, "geometry": geometry.withColumn("body_len", geometry.body_len + 1), "bodies": bodies}, path, 4)
    assert other != key and stored.current(spark, path)["geometry"].filter("body_len % 2 = 1").count() == 400
    for t in ("nodes", "geometry", "bodies"):  # as a session that didn't write them
        spark.sql(f"DROP TABLE graphloom_{key}_{t}")
    old = stored.current(spark, path, key)
    assert old["geometry"].filter("body_len % 2 = 1").count() == 0
    assert "Exchange" not in stored.with_stored(old["nodes"], old["geometry"])._jdf.queryExecution().executedPlan().toString()


def test_a_failed_publication_leaves_the_pointer(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from graphloom.sources import stored

    path, rows = str(tmp_path / "catalog"), spark.range(9).selectExpr("id AS section_id", "0 AS variant_idx")
    with pytest.raises(ValueError, match="nothing is published"):
        stored.current(spark, path)
    key = stored.publish({"nodes": rows}, path, 2)
    with pytest.raises(Exception, match="no row"):
        stored.publish({"nodes": rows.limit(3), "bad": rows.withColumn("x", F.when(F.col("section_id") < 8, 1).otherwise(F.raise_error(F.lit("no row")).cast("int")))}, path, 2)
    assert stored.current(spark, path).keys() == {"nodes"} and stored.current(spark, path)["nodes"].count() == 9
    assert stored.current(spark, path, key)["nodes"].count() == 9


def test_results_are_reused_by_the_key_of_their_inputs(spark, tmp_path):
    from graphloom.sources import stored

    path = str(tmp_path / "made")
    assert stored.checked(spark.range(3), path, "a").count() == 3
    assert stored.checked(spark.range(5), path, "a").count() == 3
    assert stored.checked(spark.range(5), path, "b").count() == 5
    assert stored.checked(spark.range(7), path, "a").count() == 7


def test_a_band_is_read_from_its_row_groups(spark, tmp_path):
    from graphloom.operators import lengths
    from graphloom.sources import stored

    rows = spark.range(200_000).selectExpr("'max' AS mode", "CAST(id % 2 AS INT) AS depth", "id AS section_id", "(id * 7919) % 1000 AS length")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lengths.write_length_index(rows, str(tmp_path / "index"))
        band = stored.read_band(spark, str(tmp_path / "index"), "max", 1, 100, 120)
        assert band.count() == rows.filter("depth = 1 and length between 100 and 120").count()
        plan = band._jdf.queryExecution().executedPlan()
        plan.execute().count()
        leaf = plan.collectLeaves().head()
        read = leaf.metrics().apply("numOutputRows").value()
        assert 0 < read < 100_000 / 2 and "PartitionFilters: [isnotnull(mode" in plan.toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_files_with_vocabulary_rows_in_between(spark, tmp_path):
    import csv
    from pathlib import Path

    from graphloom.functions import codecs
    from graphloom.sources import function_csv

    functions = [("b", 10 * i, f'f"{i},', i % 2, [272 + i], [1], [1], f'{{"k": "v{i}"}}') for i in range(5)] + [("a", 1, "only", None, [272], [1], [1], None)]
    vocabulary = [("b", 272 + i, f"t{i}", i // 2, 10 * i) for i in range(5)] + [("a", 272, "x", 0, 1), ("c", 272, "y", 3, 0)]
    f = spark.createDataFrame(functions, "binary string, ord long, func_name string, occurrence int, tokens array<int>, block_rl array<int>, insn_rl array<int>, metadata string").repartition(3)
    v = spark.createDataFrame(vocabulary, "binary string, local_id int, token string, type_id int, first_ord long")
    function_csv.write_files(f, v, str(tmp_path / "out"), 2)

    def read(name):
        parts = sorted(Path(tmp_path / "out" / f"binary={name}").glob("part-*"))
        return list(csv.reader("".join(p.read_text() for p in parts).splitlines()))

    code = lambda x: codecs.encode_array(x)
    vocab = lambda ts, kinds, runs: ["vocabulary", ",".join(ts), "", code(kinds), code(runs), ""]
    row = lambda i: [f'f"{i},', str(i % 2), code([272 + i]), code([1]), code([1]), f'{{"k": "v{i}"}}']
    assert read("b") == [["version=2"], function_csv.HEADER, row(0), row(1), vocab(["t0", "t1"], [0], [2]), row(2), row(3), vocab(["t0", "t1", "t2", "t3"], [0, 1], [2, 2]), row(4), vocab([f"t{i}" for i in range(5)], [0, 1, 2], [2, 2, 1])]
    assert read("a") == [["version=2"], function_csv.HEADER, ["only", "", code([272]), code([1]), code([1]), ""], vocab(["x"], [0], [1])]
    assert read("c") == [["version=2"], function_csv.HEADER, vocab(["y"], [3], [1])]
