"""Small functions on literal values, and progress of stages."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from graphloom.functions import axes, metadata, numbers
from graphloom.operators import arms, decode, inspect, lengths, vocab
from graphloom.sources import trees
from graphloom.streaming import incremental, progress


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_metadata_cells(spark):
    row = spark.createDataFrame([("[(1, 2, 'f', 'local_function', 0), (1, 2, 'g', 'plt', 0), (1, 2, 'f', 'local_function', 9)]",), ("[1, (",), (None,)], "cell string")
    assert [r[0] for r in row.select(metadata.legacy_callees("cell")).collect()] == [["f"], [], []]
    assert one(spark, metadata.strip_before_pipe(F.lit("ab 1 |cd 22|x"))) == "ab|cd|x"
    assert tuple(one(spark, metadata.split_first_instruction(F.lit("push 00 | pop")))) == ("push", "00 | pop")
    assert tuple(one(spark, metadata.split_first_instruction(F.lit("push")))) == ("push", "")
    entry = F.struct(F.lit("f").alias("name"), F.lit(None).cast("string").alias("library"), F.lit(0).alias("occurrence"), F.lit("0x1").alias("addr"))
    other = F.struct(F.lit("g").alias("name"), F.lit(None).cast("string").alias("library"), F.lit(4).alias("occurrence"), F.lit("0x2").alias("addr"))
    got = one(spark, metadata.backfill_occurrence(F.struct(F.array(entry, other).alias("local_funcs")), F.create_map(F.lit("0x1"), F.lit(7))))
    assert [(e["name"], e["occurrence"]) for e in got["local_funcs"]] == [("f", 7), ("g", 4)]


def test_numbers_as_text(spark):
    assert [one(spark, numbers.render_integer(F.lit(v))) for v in (255, -16, 0)] == ["v:FF (255)", "v:-10 (-16)", "v:0 (0)"]
    assert [one(spark, numbers.render_float(F.lit(v))) for v in (0.1, -2.5)] == ["f64:0.1", "f64:-2.5"]


def test_lists_and_folders(spark, tmp_path):
    assert [one(spark, axes.outside_folders(F.lit(p), ["debug/", "tmp/"])) for p in ("a/b", "a/debug/b", "tmp/x")] == [True, False, False] and one(spark, axes.outside_folders(F.lit("tmp/x"), []))
    rows = spark.createDataFrame([("c",), ("a",), ("b",), ("a",)], "program string")
    assert [r[0] for r in inspect.cap_list(rows, ["a", "c"], None).collect()] == ["a", "c"] and [r[0] for r in inspect.cap_list(rows, None, 2).collect()] == ["a", "b"]
    specs = spark.createDataFrame([("p50", 1), ("max", 2), ("max", 0)], "mode string, depth int")
    assert [tuple(r) for r in lengths.sorted_specs(specs).collect()] == [("max", 0), ("max", 2), ("p50", 1)]
    (tmp_path / "sets.json").write_text('{"load": ["ldr", "ldp"], "none": []}')
    assert sorted(map(tuple, trees.instruction_sets(spark, str(tmp_path / "sets.json")).collect())) == [("load", "ldp"), ("load", "ldr")]
    jumps, blocks = spark.createDataFrame([(1, 0), (1, 5), (2, 0)], "section_id int, target int"), spark.createDataFrame([(1, 0), (1, 1)], "section_id int, block int")
    assert [tuple(r) for r in inspect.valid_jumps(jumps, blocks).select("section_id", "target").collect()] == [(1, 0)]


def test_bodies_and_axes(spark):
    rows = spark.createDataFrame([([1, 2], [3]), ([1], [2, 3]), ([1, 2], [3]), (None, [3])], "a array<int>, b array<int>")
    keys = [r[0] for r in rows.select(arms.body_key("a", "b")).collect()]
    assert keys[0] == keys[2] and len(set(keys)) == 3
    ids = F.array(*[F.lit(x) for x in (9, 1, 7, 16, 8, 15, 2)])
    assert tuple(one(spark, decode.surviving_counts(ids, F.lit(5)))) == (2, 2) and one(spark, decode.variant_prefix(F.array(F.lit(300), F.lit(301)))) == [44, 45]
    names = spark.createDataFrame([("x-gcc",), ("?",)], "name string")
    good, bad = vocab.readable_axes(names, F.struct(F.when(F.col("name") != "?", "gcc").alias("comp")))
    assert [r["axes"]["comp"] for r in good.collect()] == ["gcc"] and [tuple(r) for r in bad.collect()] == [("?", "axes are not readable")]


def test_windows_close_behind_the_watermark(spark, tmp_path):
    at = datetime.datetime(2026, 1, 1, 0, 5)
    spark.createDataFrame([(at, "a"), (at, "a"), (at + datetime.timedelta(hours=1), "b"), (at + datetime.timedelta(hours=3), "z")], "t timestamp, k string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, k string").parquet(str(tmp_path / "in"))
    query = incremental.windowed_counts(stream, "t", "k").writeStream.format("memory").queryName("windows_of_test").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted((r["k"], r["n"]) for r in spark.table("windows_of_test").collect()) == [("a", 2), ("b", 1)]


def test_progress_of_stages(spark, tmp_path):
    lines, now = [], [0.0]
    log = progress.StageLog(lines.append, 1.0, lambda: now[0])
    log.start("scan")
    assert log.say("scan", 1, 9) and not log.say("scan", 2, 9)
    now[0] = 2.0
    assert log.say("scan", 6, 9) and log.say("scan", 9, 9, last=True) and lines == ["scan: 1 of 9", "scan: 6 of 9, 3 a second", "scan: 9 of 9, 4 a second"]
    a, seen_a = progress.observed(spark.range(10), "read", least=F.min("id"))
    b, seen_b = progress.observed(a.filter("id > 6"), "kept")
    b.write.format("noop").mode("overwrite").save()
    assert progress.figures([("read", seen_a), ("kept", seen_b)], log) == {"read": {"rows": 10, "least": 0}, "kept": {"rows": 3}} and lines[-2:] == ["read: 10", "kept: 3"]
    spark.range(5).write.parquet(str(tmp_path / "in"))
    listener = progress.StreamProgress(log)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).observe("arrived", F.count(F.lit(1)).alias("rows"))
        stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(60)
        for _ in range(50):
            if listener.rows.get("arrived") == 5 and "arrived: 5" in lines:
                break
            time.sleep(0.1)
        assert listener.rows == {"arrived": 5} and "arrived: 5" in lines
    finally:
        spark.streams.removeListener(listener)


def test_validation_batches_are_those_of_one_stream(spark):
    import random

    from graphloom.operators import sampling

    class Picky(sampling.Xoshiro):
        """Draws again now and then, as the plain generator would once in an age."""

        def below(self, n):
            while True:
                high, low = divmod(self.next() * n, 1 << 64)
                if low % 5:
                    return high
                self.again += 1

    rnd = random.Random(6)
    counts = [rnd.choice([0, 1, 2, 3, 5, 9]) for _ in range(60)]
    rows = spark.createDataFrame([(100 + i, n) for i, n in enumerate(counts)], "section_id long, n_variants int").repartition(7)
    for kind in (sampling.Xoshiro, Picky):
        rng, want, number = kind(42), [], 0
        for i, n in enumerate(counts):
            order = list(range(n))
            for j in range(n - 1, 0, -1):
                k = rng.below(j + 1)
                order[j], order[k] = order[k], order[j]
            for b in range(0, n - n % 2, 2):
                want.append((100 + i, number, order[b : b + 2]))
                number += 1
        assert sorted(tuple(r) for r in sampling.validation_batches(rows, 2, 42, kind).collect()) == want
    far = sampling.Xoshiro(3)
    for _ in range(1000):
        far.next()
    assert sampling.Jumps(sampling.Xoshiro).ahead(3, 1000).s == far.s


def test_floats_of_all_widths(spark):
    import random
    import struct
    from fractions import Fraction

    rnd = random.Random(12)
    assert [numbers.full_digits(k) for k in ("f16", "bf16", "f32", "f64", "f80", "f128")] == [5, 4, 9, 17, 21, 36]
    for kind, (e_bits, m_bits, stored) in numbers.FORMATS.items():
        bits = [rnd.getrandbits(1 + e_bits + m_bits) for _ in range(300)] + [rnd.getrandbits(m_bits - 1 if stored else m_bits) for _ in range(50)] + [0, 1 << e_bits + m_bits]
        for b in bits:
            e, m = b >> m_bits & (1 << e_bits) - 1, b & (1 << m_bits) - 1
            if stored:  # of the extended kind, only patterns whose stored leading one is right are numbers
                b = b & ~(1 << m_bits - 1) | (e > 0) << m_bits - 1
            if e < (1 << e_bits) - 1:
                assert numbers.to_bits(numbers.from_float(b, kind), kind) == b
                text = numbers.float_text(numbers.from_float(b, kind), kind, numbers.full_digits(kind)).split(":")[1]
                if text != "0":
                    head, power = text.split(" E")
                    assert abs(Fraction(head) * Fraction(10) ** int(power) / numbers.value_of(numbers.from_float(b, kind)) - 1) <= Fraction(1, 2 ** (m_bits + 1)) or e == 0, m
    for x in (0.1, -1.5, 1e300, 5e-324, 123456.0):
        parts = numbers.from_float(struct.unpack(">Q", struct.pack(">d", x))[0], "f64")
        head, power = numbers.float_text(parts, "f64", 17)[4:].split(" E")
        assert float(f"{head}e{power}") == x and numbers.value_of(parts) == Fraction(x)
    one = [(1 << 63, (1 << 30) - 63)]
    assert numbers.float_text(numbers.from_float(0x3FFF << 112, "f128"), "f128", 4).startswith("f128:0.1") and numbers.value_of(one) == 1
    assert [numbers.float_text(numbers.from_float(b, "f16"), "f16", 4) for b in (0x7C00, 0xFC00, 0x7E01, 0x8000, 0xC000, 0x3555)] == ["f16:Inf", "f16:-Inf", "f16:NaN", "f16:0", "f16:-0.2 E1", "f16:0.3333 E0"]
    df = spark.createDataFrame([(bytearray(struct.pack(">d", x)),) for x in (0.1, float("inf"), -2.0)], "raw binary").select(numbers.float_chunks("f64")("raw").alias("c"))
    got = df.select(numbers.render_chunks("f64", "short")("c"), numbers.render_chunks("f64", "full")("c"), numbers.render_chunks("f64", "hex")("c"), numbers.exact_value("c").alias("v")).collect()
    assert [tuple(r)[:3] for r in got] == [("f64:0.1000 E0", "f64:0.10000000000000001 E0", "f64:0x3fb999999999999a"), ("f64:Inf", "f64:Inf", "f64:0x7ff0000000000000"), ("f64:-0.2 E1", "f64:-0.2 E1", "f64:0xc000000000000000")]
    assert tuple(got[0]["v"]) == ("3602879701896397", "36028797018963968") and tuple(got[1]["v"]) == (None, None) and tuple(got[2]["v"]) == ("-2", "1")


def test_tokens_of_long_rows_are_remapped_in_order(spark, monkeypatch):
    monkeypatch.setattr(vocab, "PIECE", 7)
    n = 60_000
    local = spark.range(n).select(F.lit("a").alias("binary"), F.col("id").alias("local_id"), (F.col("id") * 3).cast("int").alias("unified_id"))
    rows = spark.createDataFrame([(1, "a", [5, None, 2, n, 2]), (2, "a", []), (3, "a", None), (4, "b", [1]), (5, "a", list(range(n - 1, -1, -1)))], "k int, binary string, tokens array<bigint>")
    got = {r["k"]: r["tokens"] for r in vocab.remap_tokens(rows, local, ["k"]).collect()}
    assert got.pop(5) == [3 * x for x in range(n - 1, -1, -1)]
    assert got == {1: [15, -1, 6, -1, 6], 2: [], 3: None}
    plan = vocab.remap_tokens(rows, local, ["k"])._jdf.queryExecution().toString()
    assert "map_from_entries" not in plan  # looking ids up in one map a file took time by the square of its ids
    with pytest.raises(Exception, match="mapped twice"):
        vocab.remap_tokens(rows, local.unionByName(local), ["k"]).collect()
