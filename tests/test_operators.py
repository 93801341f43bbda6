"""Cases that are easy to get wrong, on small tables; and imperative restatements of the iterative operators."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.functions import axes, codecs, metadata, numbers
from graphloom.operators import arms, catalog, decode, graph, inspect, lengths, sampling, validate, vocab


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_classification_and_rerouting(spark):
    rows = [("p", "a", "twice", 1, "x"), ("p", "a", "twice", 2, "y"), ("p", "b", "twice", 3, "x"), ("p", "a", "both", 4, "x"), ("p", "b", "both", 5, "y"),
            ("p", "a", "same", 6, "x"), ("p", "b", "same", 7, "x"), ("p", "a", "one", 8, "x"), ("p", "a", ".Lx", 9, "x")]
    f = spark.createDataFrame(rows, "program string, vkey string, func_name string, ord long, body string")
    got = arms.reroute_identical(arms.classify(arms.drop_local_labels(f)))
    assert dict(values(got.select("func_name", "arm").distinct(), "func_name", "arm")) == {"twice": "unmatched", "both": "matched", "same": "unmatched", "one": "unmatched"}


def test_semantic_dedup_compares_with_the_first_body(spark):
    f = spark.createDataFrame([("n", i, b) for i, b in enumerate("ABBA")], "name string, ord int, body string")
    assert values(arms.semantic_dedup(f, ["name"]), "ord", "slot") == [(0, 0), (1, 1), (2, 2)]


def test_canonical_names(spark):
    long = "x" * 300
    f = spark.createDataFrame([("f", "a, b c", None), ("f", None, "sym@@V"), ("f", "", None), ("f", long, None)], "n string, c string, k string")
    got = [r[0] for r in f.select(arms.canonical_name(F.col("n"), F.col("c"), F.col("k"))).collect()]
    assert got[:3] == ["f@a_b_c", "sym_V:thunk", "f"]
    assert len(got[3]) == 2 + 192 + 8


@pytest.mark.parametrize("n", [1, 2, 7, 101])
def test_percentiles(spark, n):
    nodes = spark.createDataFrame([(1, i) for i in range(n)], "section_id int, length int")
    for q in (1, 29, 50, 75, 99):
        got = lengths.reduce_lengths(nodes, ["section_id"], f"p{q:02d}").first()["length"]
        assert got == int(np.percentile(np.arange(n), q, method="lower"))


def test_reduction_names():
    assert [lengths.parse_reduction(x) for x in ("max", "p100", "p01", "p75")] == [None, None, 1, 75]
    for bad in ("p0", "p101", "mean"):
        with pytest.raises(ValueError):
            lengths.parse_reduction(bad)


def test_histogram_has_gaps_and_no_zero_length(spark):
    f = spark.createDataFrame([(0,), (2,), (5,), (5,)], "length int")
    assert values(lengths.histogram(f), "length", "n") == [(2, 1), (3, 0), (4, 0), (5, 2)]
    assert lengths.histogram(f.filter("length < 0")).count() == 0


def test_index_is_read_by_band(spark, tmp_path):
    f = spark.createDataFrame([("max", 0, i, i % 7) for i in range(50)], "mode string, depth int, section_id int, length int")
    lengths.write_length_index(f, str(tmp_path / "index"))
    assert lengths.count_in_band(spark.read.parquet(str(tmp_path / "index")), 0, 3).first()["n"] == sum(1 <= i % 7 <= 3 for i in range(50))


def test_call_resolution(spark):
    variants = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "b"), (3, 0, "a"), (3, 1, "b")], "section_id int, variant_idx int, vkey string")
    calls = spark.createDataFrame([(1, 0, "a", 0, 2, False), (1, 1, "b", 0, 2, False), (1, 0, "a", 1, 3, True), (1, 0, "a", 2, None, False)],
                                  "section_id int, variant_idx int, vkey string, called_idx int, callee_section int, callee_duplicated boolean")
    e = catalog.call_entries(calls, variants)
    assert values(e, "variant_idx", "called_idx", "j") == [(0, 0, 0xFFFE), (0, 1, 0xFFFE), (1, 0, 0)]
    assert values(catalog.resolve_variants(e), "variant_idx", "called_idx", "callee_variant") == [(0, 0, 0), (1, 0, 0)]


def walk(roots, edges, depth):
    """Restates the inclusion rule node by node."""
    out = []
    for root, lanes in roots.items():
        seen = {lane: {root} for lane in lanes}
        level = {lane: [(root, lane)] for lane in lanes}
        for d in range(1, depth + 1):
            new = {}
            for lane in lanes:
                children = [c for node in level[lane] for c in edges.get(node, [])]
                new[lane] = list({s: (s, v) for s, v in reversed(children)}.values()) if children else []
                order = list(dict.fromkeys(s for s, _ in children))
                new[lane] = sorted(new[lane], key=lambda x: order.index(x[0]))
            after = {lane: seen[lane] | {s for s, _ in new[lane]} for lane in lanes}
            for lane in lanes:
                level[lane] = [(s, v) for s, v in new[lane] if s not in seen[lane] and not all(s in after[x] for x in lanes)]
                out += [(root, lane, d, i, s, v) for i, (s, v) in enumerate(level[lane])]
            seen = after
    return sorted(out)


def test_inclusion_equals_restatement(spark):
    rnd = random.Random(5)
    n = {s: rnd.randint(1, 4) for s in range(25)}
    rows = [(s, v, slot, t, rnd.randrange(n[t])) for s in n for v in range(n[s]) for slot, t in enumerate(rnd.sample(range(25), rnd.randint(0, 4)))]
    edges = {}
    for s, v, _, t, w in rows:
        edges.setdefault((s, v), []).append((t, w))
    e = spark.createDataFrame(rows, "section_id int, variant_idx int, called_idx int, callee_section int, callee_variant int")
    r = spark.createDataFrame([(s, v, v) for s in n for v in range(n[s])], "root int, lane int, variant_idx int")
    got = graph.included(r, e, 3).filter("depth > 0")
    assert values(got, "root", "lane", "depth", "ord", "section_id", "variant_idx") == walk({s: range(k) for s, k in n.items()}, edges, 3)


def test_recursion_and_single_variant(spark):
    e = spark.createDataFrame([(1, 0, 0, 1, 0), (1, 0, 1, 2, 0), (1, 1, 0, 3, 0), (9, 0, 0, 2, 0)], "section_id int, variant_idx int, called_idx int, callee_section int, callee_variant int")
    r = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (9, 0, 0)], "root int, lane int, variant_idx int")
    assert values(graph.included(r, e, 2).filter("depth > 0"), "root", "lane", "section_id") == [(1, 0, 2), (1, 1, 3)]


def test_backfill_still_tries_smaller_items(spark):
    f = spark.createDataFrame([([(50,), (20,), (40,), (10,)],)], "pool array<struct<length:bigint>>")
    assert f.select(graph.backfill(F.col("pool"), F.lit(75)).alias("r")).first()["r"] == (5, [50, 20])


def test_cutoff_at_an_exact_boundary(spark):
    f = spark.createDataFrame([(1, i, n) for i, n in enumerate([30, 34, 5, 5])], "k int, i int, length int")
    assert values(decode.cutoff(f, ["k"], ["i"], F.lit(64)), "i", "surviving", "is_cut") == [(0, 30, False), (1, 34, False), (2, 0, True), (3, 0, False)]


def test_units_and_expansion(spark):
    long_int = [257, *range(9)]
    f128, nan128 = [263, 0x3F, 0xFF, *[0] * 14], [263, 0x7F, 0xFF, *[1] * 14]
    f = spark.createDataFrame([([300, *long_int, 256, 264, 1, 2, *f128, *nan128],), ([],), ([5, 6],)], "tokens array<int>").withColumn("u", decode.units(F.col("tokens")))
    got = [r[0] for r in f.select(decode.expand_tokens(F.col("u"), F.lit(9))).collect()]
    assert got == [[9, 44, 1, 1, 8, 7, 7, 7], [9], [9]]
    assert f.select(F.transform("u", lambda u: u["negative"])).first()[0] == [False, True, False, False, False]
    assert [tuple(r) for r in decode.geometry(f.select("tokens")).select("body_len", "id_count", "value_count").collect()] == [(7, 1, 5), (0, 0, 0), (0, 0, 0)]


def test_assembly_pads_and_cuts(spark):
    f = spark.createDataFrame([(1, 0, [9, 1, 2]), (1, 1, [9, 3]), (2, 0, [9])], "r int, i int, tokens array<int>").withColumn("p", F.array(F.lit(100)))
    assert values(decode.assemble(f, ["r"], ["i"], 5, "p"), "r", "tokens") == [(1, [100, 9, 1, 2, 9]), (2, [100, 9, 0, 0, 0])]


def test_run_rebasing(spark):
    f = spark.createDataFrame([([1, 2, 3, 1], [3, 4])], "i array<int>, b array<int>")
    assert f.select(decode.rebase_runs(F.col("i"), F.col("b"))).first()[0] == [2, 2]


def test_padding_with_too_few_donors(spark):
    f = spark.createDataFrame([(1, 5), (2, 1), (3, 0)], "section_id int, n_variants int")
    got = decode.pad_redistribute(f, 3, sampling.draw_key(1, "section_id", "variant_idx"))
    assert got.count() == 9 and got.filter("variant_idx is null").count() == 3
    assert decode.pad_ragged(f, 3).count() == 4
    assert decode.pad_resample(f, 3, 1).filter("variant_idx is null").count() == 3


def test_sampling(spark):
    f = spark.createDataFrame([("p", i, i % 10) for i in range(100)], "program string, section_id int, length int")
    assert sampling.sample_sections(f, 50, 60, 5, 1, ["program"]).count() == 0
    assert sampling.sample_sections(f, 1, 3, 1000, 1, ["program"]).count() == 30
    one, two = ([r["section_id"] for r in sampling.sample_sections(f, 1, 9, 20, s, ["program"]).collect()] for s in (1, 2))
    assert len(set(one)) == 20 and one != two
    assert sampling.near_length(f, 5, 10, 1).filter("length <> 5").count() == 0


def test_random_stream_is_uniform_and_portable():
    rng = sampling.Xoshiro(42)
    counts = Counter(rng.below(6) for _ in range(6000))
    assert max(counts.values()) - min(counts.values()) < 200
    chunks = list(sampling.shuffled_chunks([5, 0, 4], 2, 1))
    assert [at for at, _ in chunks] == [0, 0, 2, 2] and all(len(c) == 2 for _, c in chunks)
    assert list(sampling.shuffled_chunks([5, 0, 4], 2, 1)) == chunks


def test_vocabulary_cells(spark):
    f = spark.createDataFrame([("a", ""), ("b", None), ("c", "x,y")], "binary string, cell string")
    assert [r[0] for r in f.select(vocab.vocab_count(F.col("cell"))).collect()] == [0, None, 2]
    assert values(vocab.load(f), "binary", "local_id", "token") == [("c", 257, "x"), ("c", 258, "y")]
    m = vocab.mapping(vocab.load(f), spark.createDataFrame([("x", 272)], "token string, unified_id int"))
    assert values(m, "unified_id") == [(-1,), (272,)]
    assert values(vocab.complete_files(m), "binary", "is_complete") == [("c", False)]


@given(st.lists(st.integers(0, (1 << 33) - 1), max_size=300))
def test_array_codec(xs):
    assert codecs.decode_array(codecs.encode_array(np.array(xs, dtype=np.uint64))).tolist() == xs


@given(st.binary())
def test_string_escapes(raw):
    escaped = codecs.escape_bytes(raw)
    assert b"\n" not in escaped and codecs.unescape_bytes(escaped) == raw


def test_bad_escapes():
    for bad in (b"\\", b"a\\q", b"\\\\\\"):
        with pytest.raises(ValueError):
            codecs.unescape_bytes(bad)


@given(st.floats(allow_nan=False, allow_infinity=False))
def test_float_chunks_are_exact(x):
    bits = int(np.float64(x).view(np.uint64))
    assert numbers.value_of(numbers.from_float(bits, "f64")) == Fraction(x)


@given(st.integers(0, 1 << 200), st.booleans())
def test_integer_chunks_are_exact(n, negative):
    parts = numbers.integer_chunks(n.to_bytes(26, "big"), negative)
    assert len(parts) == 4 and numbers.value_of(parts) == (-n if negative else n)
    assert all(s == 0 or s >> 63 for s, _ in parts)


def test_special_floats():
    top = (1 << 31) - 1
    assert numbers.from_float(0x7FF0 << 48, "f64") == [(0, top)]
    assert numbers.from_float(0xFFF8 << 48, "f64") == [(1, top | 1 << 31)]
    assert numbers.from_float(1 << 63, "f64")[0][0] == 0
    assert len(numbers.from_float(0x3FFF << 112 | 1, "f128")) == 2
    assert numbers.value_of(numbers.from_float(0x3FFF << 64 | 1 << 63, "f80")) == 1
    assert numbers.value_of(numbers.from_float(0x3C01, "f16")) == Fraction(1025, 1024)


def test_axes(spark):
    names = ["x64-clang-3.5-O0_minigzipsh", "armv7l-hf-clang-10.0.1-Oz_hello__15f3f338", "x86_64-gcc-9-rc-O2_a_b", "vax-gcc-1-O0_p", "x64-gcc_p"]
    got = [tuple(r["a"]) for r in spark.createDataFrame([(n,) for n in names], "n string").select(axes.parse_axes(F.col("n")).alias("a")).collect()]
    assert got[0] == ("minigzipsh", "x64", "x86", 64, "clang", "3.5", "O0")
    assert got[1] == ("hello__15f3f338", "armv7l-hf", "arm", 32, "clang", "10.0.1", "Oz")
    assert got[2] == ("a_b", "x86_64", "x86", 64, "gcc", "9-rc", "O2")
    assert got[3] == ("p", *[None] * 6) and got[4] == ("p", *[None] * 6)


def test_unknown_arch_is_an_error(spark):
    with pytest.raises(Exception, match="unknown arch"):
        spark.createDataFrame([("vax",)], "a string").select(axes.platform_of(F.col("a"))).collect()


def test_metadata(spark):
    cell = '{"local_funcs":[{"name":"f","occurrence":1},{"name":"g","occurrence":0},{"name":"f","occurrence":2}],"ext_funcs":[{"name":"f","library":"libc"}]}'
    f = spark.createDataFrame([(cell,), ("{}",), (None,)], "c string").withColumn("m", metadata.parse(F.col("c")))
    got = f.select(F.transform(metadata.callees(F.col("m")), lambda c: F.concat_ws(":", "x" if False else c["name"], c["type"].cast("string"), c["library"])).alias("n"), metadata.occurrences(F.col("m")).alias("o")).collect()
    assert got[0]["n"] == ["f:0", "g:0", "f:2:libc"] and got[0]["o"] == {"g": 0}
    assert got[1]["n"] == [] and got[1]["o"] == {}


def test_instruction_text(spark):
    f = spark.createDataFrame([("mov  rax, [rbx+0x401000]",)], "t string")
    assert f.select(metadata.instruction_tokens(F.col("t"), F.array(F.lit(0x401000).cast("long")), F.array().cast("array<bigint>"))).first()[0] == ["mov", "rax", "[", "rbx", "+", "SYMBOL", "]"]


def test_natural_sort_puts_missing_last(spark):
    f = spark.createDataFrame([("v10",), ("v9",), (None,), ("v009",)], "v string")
    assert [r["v"] for r in inspect.natural_sort(f, ["v"]).orderBy("place").collect()][2:] == ["v10", None]


def test_search_wraps(spark):
    f = spark.createDataFrame([(i, n) for i, n in enumerate(["Abc", "x", "abC", "y"])], "i int, n string")
    assert inspect.next_match(f, "ABC", "n", "i", 2).first()["i"] == 0
    assert inspect.previous_match(f, "abc", "n", "i", 0).first()["i"] == 2


def test_missing_index_is_an_error(spark):
    m, i = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a",)], "k string")
    assert values(validate.require_members(m, i, "k", skip=True), "k") == [("a",)]
    with pytest.raises(Exception, match="no index for b"):
        validate.require_members(m, i, "k", skip=False).collect()


@pytest.mark.parametrize("bound", [0, 100])
def test_levels_of_a_walk_are_not_written(spark, monkeypatch, bound):
    rows = [(s, v, slot, (s * (slot + 2) + v) % 9, v) for s in range(9) for v in range(2) for slot in range(2)]
    edges = {}
    for s, v, _, t, w in rows:
        edges.setdefault((s, v), []).append((t, w))
    e = spark.createDataFrame(rows, "section_id int, variant_idx int, called_idx int, callee_section int, callee_variant int")
    r = spark.createDataFrame([(s, v, v) for s in range(9) for v in range(2)], "root int, lane int, variant_idx int")
    written, write = [], graph.materialized
    monkeypatch.setattr(graph, "materialized", lambda df: written.append(df.columns) or write(df))
    monkeypatch.setattr(graph, "BROADCAST_CALLS", bound, raising=False)
    got = graph.included(r, e, 4).filter("depth > 0")
    assert values(got, "root", "lane", "depth", "ord", "section_id", "variant_idx") == walk({s: range(2) for s in range(9)}, edges, 4)
    assert not [c for c in written if "root" in c]
