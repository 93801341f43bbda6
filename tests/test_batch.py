"""Catalog tables, gates and number slots of batches on small rows."""

import pytest
from pyspark.sql import functions as F

from graphloom.operators import batch, vocab
from graphloom.sources import catalog_tables as T


def test_tables_are_written_and_scanned(spark, tmp_path):
    sections = spark.createDataFrame([("b", "matched", 2, "g", 1), ("a", "matched", 1, "f", 2), ("a", "unmatched", 0, "e", 1)], "program string, arm string, section_id long, func_name string, n_variants int")
    variants = spark.createDataFrame([("a", 1, 0, "x", 5), ("a", 1, 1, "y", 6), ("b", 2, 0, "x", 5)], "program string, section_id long, variant_idx int, vkey string, body_id long")
    T.write({"sections": sections, "variants": variants}, str(tmp_path))
    assert sorted(map(tuple, T.scan(spark, str(tmp_path), "sections", ["a"], ["section_id"]).collect())) == [("a", 0), ("a", 1)]
    s, v = T.scan(spark, str(tmp_path), "sections"), T.scan(spark, str(tmp_path), "variants")
    assert sorted(r.body_id for r in T.function_by_name(s, v, "a", "f").collect()) == [5, 6]
    assert T.function_by_name(s, v, "b", "f").count() == 0
    assert [r.vkey for r in T.function_by_index(s, v, "b", 2).collect()] == ["x"]
    plan = T.scan(spark, str(tmp_path), "variants", ["a"], ["body_id"]).filter("body_id > 5")._jdf.queryExecution().toString()
    assert "vkey" not in plan.split("Physical Plan")[1]


def test_missing_index(spark):
    catalogs, indexes = spark.createDataFrame([("a",), ("b",)], "program string"), spark.createDataFrame([("a", "max", 0)], "program string, mode string, depth int")
    assert [r.program for r in T.collection(catalogs, indexes, [("max", 0)], "skip").collect()] == ["a"]
    with pytest.raises(Exception, match="no index of b"):
        T.collection(catalogs, indexes, [("max", 0)]).collect()


def test_records_and_rejects(spark):
    rows = spark.createDataFrame([("b", "f", [272, 1, 273], [3], [2, 1]), ("b", "g", [272], [2], [1]), ("b", "h", None, [1], [1])], "binary string, func_name string, tokens array<int>, block_rl array<int>, insn_rl array<int>")
    good, bad = T.assemble_records(rows)
    assert [(r.func_name, r.start, r.n_tokens) for r in T.token_spans(good, ["func_name"]).collect()] == [("f", 5, 3)]
    assert {(r.func_name, r.reason) for r in bad.collect()} == {("g", "uneven"), ("h", "missing")}


def test_gate_and_unknown_tokens(spark):
    header = spark.createDataFrame([(2, "abc")], "version int, fingerprint string")
    assert vocab.gate_version(header, 2, "abc").count() == 1 and vocab.gate_version(header, 2, "abc").first().version == 2
    with pytest.raises(Exception, match="another version"):
        vocab.gate_version(header, 2, "abd").count()
    unified = spark.createDataFrame([("a", 272)], "token string, unified_id int")
    with pytest.raises(Exception, match="unknown token b"):
        vocab.encode_records(spark.createDataFrame([(1, ["a", "b"])], "k int, tokens array<string>"), unified, ["k"]).collect()


def test_numbers_of_floats_and_wide_integers(spark):
    one = [0x3F, 0xF0, 0, 0, 0, 0, 0, 0]
    rows = spark.createDataFrame([(0, 0, 0, 5, 0, one, False), (0, 0, 1, 1, 0, [1, 0, 0, 0, 0, 0, 0, 0, 3], True), (0, 0, 2, 1, 1, [1, 0, 0, 0, 0, 0, 0, 0, 3], True)],
                                 "root long, lane int, at long, token int, chunk int, payload array<int>, negative boolean")
    got = {r["at"]: (int(r.sig), r.word) for r in batch.number_slots(rows).collect()}
    bias, minus = 1 << 30, 1 << 31
    assert got == {0: (1 << 63, bias - 63), 1: (3 << 62, minus + bias - 62), 2: (1 << 63, minus + bias + 64 - 63)}


def test_padding_lanes_and_prefix(spark):
    rows = spark.createDataFrame([(1, 0, 0, [500, 501]), (1, 1, None, [500])], "root long, lane int, variant_idx int, prefix array<int>")
    edges = spark.createDataFrame([], "section_id long, variant_idx int, called_idx int, callee_section long, callee_variant int")
    targets = spark.createDataFrame([], "section_id long, variant_idx int, category int, place int, fid long")
    bodies = spark.createDataFrame([(1, 0, 4, [272, 264, 3, 273, 274])], "section_id long, variant_idx int, body_len int, tokens array<int>")
    got = {r.lane: r for r in batch.batch_decode(None, None, edges, targets, bodies, 5, 1, 2, rows=rows).collect()}
    assert got[0].tokens == [500, 501, 9, 16, 8] and got[0].identities == [0, 3] and got[0].n_tokens == 5
    assert got[1].tokens == [0] * 5 and got[1].identities == [] and got[1].fids == []


def test_offsets_with_ties_of_padding(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else i) for i in range(40)], "row long, n int")
    want, at = [], 0
    for i in range(40):
        want.append((i, at))
        at += 0 if i % 3 == 0 else i
    assert sorted((r.row, r.offset) for r in batch.row_offsets(rows, ["row"], "n").select("row", F.col("offset")).collect()) == want


EDGE = "section_id long, variant_idx int, called_idx int, callee_section long, callee_variant int, type int, matched boolean"
TARGET = "section_id long, variant_idx int, category int, place int, fid long"
BODY = "section_id long, variant_idx int, body_len int, tokens array<int>"


def test_linked_callees_have_the_linked_token_and_identity(spark):
    """A root that calls 2 through the linkage table; 3 is unmatched, and 4 behind it."""
    rows = spark.createDataFrame([(1, 0, 0), (1, 1, 1)], "root long, lane int, variant_idx int")
    edges = spark.createDataFrame([(1, 0, 0, 2, 0, 10, True), (1, 0, 1, 3, 0, 9, False), (3, 0, 0, 4, 0, 9, True), (1, 0, 2, 5, 0, 11, True)], EDGE)
    targets = spark.createDataFrame([(1, 0, 10, 0, 2), (1, 0, 9, 0, 3), (1, 0, 11, 0, 5)], TARGET)
    bodies = spark.createDataFrame([(1, 0, 3, [266, 0, 267, 0, 272]), (1, 1, 1, [275]), (2, 0, 1, [273]), (4, 0, 2, [265, 0, 274])], BODY)
    got = {r.lane: r for r in batch.batch_decode(None, None, edges, targets, bodies, 12, 1, 2, rows=rows).collect()}
    assert got[0].tokens[:6] == [9, 10, 11, 16, 10, 17] and got[0].n_tokens == 6
    assert got[0].identities == [0, 0, 0, 0]  # root, linked 0 in the body, external 0, the linked callee itself
    assert [tuple(f) for f in got[0].fids] == [(9, 0, 1), (9, 1, 3), (10, 0, 2), (11, 0, 5)]
    through = {r.lane: r for r in batch.batch_decode(None, None, edges, targets, bodies, 12, 1, 2, rows=rows, unmatched_hops=3).collect()}
    assert through[0].tokens[:9] == [9, 10, 11, 16, 10, 17, 9, 9, 18] and through[0].identities == [0, 0, 0, 0, 2, 3]
    assert through[1].tokens[:2] == [9, 19] and got[1].tokens == through[1].tokens


def random_calls(seed, n=30):
    import random

    rnd = random.Random(seed)
    sizes = {s: rnd.randint(1, 3) for s in range(n)}
    rows = [(s, v, slot, t, rnd.randrange(sizes[t]), rnd.choice([9, 9, 10]), t % 3 != 0) for s in sizes for v in range(sizes[s]) for slot, t in enumerate(rnd.sample(range(n), rnd.randint(0, 4)))]
    return rnd, sizes, rows


def depth_first(edges, start, hops):
    """(callee, path) behind unmatched callees, depth first, the first way to each; start: edges of one parent, in order."""
    found = {}

    def behind(node, path, depth, on):
        if depth < hops:
            for slot, s, v, matched in edges.get(node, []):
                if matched:
                    found.setdefault(s, (*path, slot))
                elif s not in on:
                    behind((s, v), (*path, slot), depth + 1, on | {s})

    for slot, s, v, matched in start:
        if matched:
            found.setdefault(s, (slot,))
        else:
            behind((s, v), (slot,), 0, {s})
    return found


@pytest.mark.parametrize("hops", [1, 2, 3, 4])
def test_unmatched_callees_give_way_in_depth_first_order(spark, hops):
    from graphloom.operators import graph

    _, sizes, rows = random_calls(hops)
    edges = {}
    for s, v, slot, t, w, _, matched in rows:
        edges.setdefault((s, v), []).append((slot, t, w, matched))
    lanes = [(s, v) for s in sizes for v in range(sizes[s])]
    roots = spark.createDataFrame([(s * 100 + v, 0, s, v) for s, v in lanes] + [(s * 100 + v, 1, s, v) for s, v in lanes], "root long, lane int, s long, v int")
    # the other lane has no calls, so that nothing is common to all lanes
    own = spark.createDataFrame([(s * 100 + v, 0, slot, t, w, k, m) for s, v, slot, t, w, k, m in rows], EDGE).unionByName(spark.createDataFrame(rows, EDGE).withColumn("section_id", F.col("section_id") + 0))
    start = roots.select("root", "lane", F.when(F.col("lane") == 0, 0).otherwise(1).alias("variant_idx"))
    own = own.filter(~((F.col("section_id") >= 100) & (F.col("section_id") % 100 > 50)))
    got = {}
    for r in graph.included(start.filter("root >= 100"), own.filter("variant_idx is not null"), 1, hops).filter("depth = 1").orderBy("root", "ord").collect():
        if r["lane"] == 0:
            got.setdefault(r["root"], []).append(r["section_id"])
    want = {}
    for s, v in lanes:
        if s >= 1:
            found = depth_first(edges, sorted(edges.get((s, v), [])), hops)
            order = sorted((path, callee) for callee, path in found.items() if callee != s * 100 + v)
            if order:
                want[s * 100 + v] = [callee for _, callee in order]
    assert got == want


def test_mixed_depths_equal_separate_batches(spark):
    rnd, sizes, rows = random_calls(9)
    edges = spark.createDataFrame(rows, EDGE)
    variants = spark.createDataFrame([(s, v) for s in sizes for v in range(sizes[s])], "section_id long, variant_idx int")
    bodies = spark.createDataFrame([(s, v, n, [272 + s] * n) for s in sizes for v in range(sizes[s]) for n in [rnd.randint(0, 6)]], BODY)
    targets = spark.createDataFrame([(s, v, k, slot, t) for s, v, slot, t, _, k, _ in rows], TARGET)
    depth = F.when(F.col("section_id") % 3 == 0, 0).when(F.col("section_id") % 3 == 1, 1).otherwise(3)
    sections = variants.select("section_id").distinct()
    made = {}
    for fill, slots in ((False, 2), (True, 1)):  # one lane has all callees in common with itself, so they are left to the pool
        mixed = batch.batch_decode(sections.withColumn("max_depth", depth), variants, edges, targets, bodies, 18, None, slots, 4, unmatched_hops=3, fill=fill)
        one = {(r.root, r.lane): (r.variant_idx, r.n_tokens, r.tokens, r.identities, r.fids) for r in mixed.collect()}
        apart = {}
        for d, rest in ((0, 0), (1, 1), (3, 2)):
            for r in batch.batch_decode(sections.filter(F.col("section_id") % 3 == rest), variants, edges, targets, bodies, 18, d, slots, 4, unmatched_hops=3, fill=fill).collect():
                apart[r.root, r.lane] = (r.variant_idx, r.n_tokens, r.tokens, r.identities, r.fids)
        assert one == apart and len(one) == slots * len(sizes)
        made[fill] = one
    own = {(r.section_id, r.variant_idx): 1 + r.body_len for r in bodies.collect()}
    assert sum(n > own[root, v] for (root, _), (v, n, *_) in made[True].items()) > 5


def test_what_is_left_takes_pool_functions_that_fit(spark):
    """Both lanes drawn call 2, so it is pruned; over all three variants it is included. 3 doesn't fit, 4 does."""
    edges = spark.createDataFrame([(1, v, k, s, 0, 9, True) for v in (0, 1) for k, s in enumerate((2, 3, 4))], EDGE)
    rows = spark.createDataFrame([(1, 0, 0), (1, 1, 1)], "root long, lane int, variant_idx int")
    variants = spark.createDataFrame([(1, v) for v in range(3)], "section_id long, variant_idx int")
    bodies = spark.createDataFrame([(1, v, 1, [272]) for v in range(3)] + [(2, 0, 2, [273, 274]), (3, 0, 6, [275] * 6), (4, 0, 1, [276])], BODY)
    got = batch.batch_decode(None, variants, edges, spark.createDataFrame([], TARGET), bodies, 8, 1, 2, rows=rows, fill=True).collect()
    assert [r.tokens for r in got] == [[9, 16, 9, 17, 18, 9, 20, 0]] * 2 and [r.n_tokens for r in got] == [7, 7]
    assert [r.identities for r in got] == [[0, 1, 2]] * 2


@pytest.mark.parametrize(("padding", "want"), [
    ("ragged", {(1, 0, 0), (1, 1, 1), (2, 0, 0)}), ("null", {(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, None), (3, 0, None), (3, 1, None)}),
    ("resample", {(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, 0), (3, 0, None), (3, 1, None)}), ("redistribute", {(1, 0, 0), (1, 1, 1), (2, 0, 0), (1, 2, 2), (3, 0, None), (3, 1, None)})])
def test_padding_modes(spark, monkeypatch, padding, want):
    variants = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 0)], "section_id long, variant_idx int")
    monkeypatch.setattr(batch.sampling, "cap_variants", lambda v, k, seed: v.filter(F.col("variant_idx") < k))
    got = batch.resolve(spark.createDataFrame([(1,), (2,), (3,), (3,)], "section_id long"), variants, 2, 1, padding)
    assert {(r.root, r.lane, r.variant_idx) for r in got.collect()} == want
    if padding == "redistribute":
        assert [(r.place, r.slot) for r in got.filter("lane = 2").collect()] == [(2, 1)]


def test_block_runs_and_their_cut(spark):
    """Blocks of 2, 0 and 2 instructions; the second instruction holds a value of two slots and its sign, the third none."""
    bodies = spark.createDataFrame([(1, 0, 6, [272, 264, 1, 257, 1, 2, 3, 4, 5, 6, 7, 8, 9, 256, 273, 265, 0], [14, 0, 3], [3, 11, 0, 3])], BODY + ", block_rl array<int>, insn_rl array<int>")
    got = {r.block: (r.n_insns, r.slots) for r in batch.block_runs(bodies, ["section_id", "variant_idx"]).collect()}
    assert got == {0: (3, [2, 2, 0]), 1: (0, []), 2: (1, [2])}
    for surviving, want in ((7, ([3, 0, 1], [2, 2, 0, 2])), (5, ([3], [2, 2, 0])), (6, ([3, 0, 1], [2, 2, 0, 2])), (2, ([3], [2, 2, 0])), (1, None)):
        alive = spark.createDataFrame([(1, 0, 0, 1, 0, surviving)], "root long, lane int, node int, section_id long, variant_idx int, surviving long")
        rows = batch.run_lengths(alive, bodies).collect()
        assert ([(r.block_runs, r.insn_runs) for r in rows] or [None]) == [want]


def test_numbering_by_ranges(spark):
    import random

    from graphloom.operators import order

    rnd = random.Random(4)
    rows = [(rnd.choice([None, "hot", "hot", "hot", f"k{rnd.randrange(9)}"]), i, rnd.randrange(3)) for i in range(600)]
    got = order.running(spark.createDataFrame(rows, "k string, i int, n int").repartition(5), ["k"], [F.desc("i")], {"at": F.lit(1), "sum": F.col("n")}).collect()
    want, at, sums = {}, {}, {}
    for k, i, n in sorted(rows, key=lambda r: -r[1]):
        want[i] = (at.get(k, 0), sums.get(k, 0))
        at[k], sums[k] = at.get(k, 0) + 1, sums.get(k, 0) + n
    assert {r["i"]: (r["at"], r["sum"]) for r in got} == want
    assert order.numbered(spark.createDataFrame([], "k string, i int"), [], ["i"], "n").collect() == []
