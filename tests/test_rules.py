"""Token patterns against a plain matcher, rules of constants and targets on literal rows."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom.functions import constants as rules
from graphloom.functions import patterns as P
from graphloom.operators import constants


def plain(tree, tokens, at):
    """Where the tree ends that starts at `at`, and its captures; None if it doesn't match. Nothing is tried twice."""
    kind, *args = tree
    if kind == "token":
        k, v, name = args
        if at < len(tokens) and k in (None, tokens[at][0]) and v in (None, tokens[at][1]):
            return at + 1, {name: tokens[at][1]} if name else {}
        return None
    if kind == "sequence":
        got = {}
        for a in args:
            if (m := plain(a, tokens, at)) is None:
                return None
            at, got = m[0], got | m[1]
        return at, got
    if kind == "either":
        return next((m for a in args if (m := plain(a, tokens, at)) is not None), None)
    if kind == "maybe":
        return plain(args[0], tokens, at) or (at, {})
    if kind == "ahead":
        return None if (m := plain(args[0], tokens, at)) is None else (at, m[1])
    if (m := plain(args[0], tokens, at)) is None:
        return None
    while (more := plain(args[0], tokens, m[0])) is not None and more[0] > m[0]:
        m = more[0], m[1] | more[1]
    return m


def compiled(tree):
    kind, *args = tree
    return P.token(*args) if kind == "token" else getattr(P, kind)(*map(compiled, args))


def random_tree(rnd, depth, names):
    kind = rnd.choice(["token"] * 3 + (["sequence", "either", "maybe", "some", "ahead"] if depth else []))
    if kind == "token":
        return "token", rnd.choice([None, "A", "B", "x.*"]), rnd.choice([None, None, "1", "a|b"]), names.pop() if names and rnd.random() < 0.3 else None
    return kind, *(random_tree(rnd, depth - 1, names) for _ in range({"sequence": rnd.randint(1, 3), "either": 2}.get(kind, 1)))


def test_patterns_equal_a_plain_matcher(spark):
    rnd = random.Random(8)
    rows = [[(rnd.choice(["A", "B", "x.*", "C"]), rnd.choice(["1", "a|b", "", "é", None])) for _ in range(rnd.randint(0, 5))] for _ in range(300)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, tokens array<struct<kind:string,value:string>>").withColumn("t", P.as_text(F.col("tokens"))).cache()
    trees = [random_tree(rnd, 3, ["c1", "c2"]) for _ in range(40)]
    made = [compiled(t) for t in trees]
    got = {r["i"]: r for r in df.select("i", *[P.matches(F.col("t"), p).alias(f"m{k}") for k, p in enumerate(made)], *[P.captured(F.col("t"), p).alias(f"c{k}") for k, p in enumerate(made) if p.names]).collect()}
    hits = 0
    for i, row in enumerate(rows):
        tokens = [(k, v or "") for k, v in row]
        for k, tree in enumerate(trees):
            m = plain(tree, tokens, 0)
            whole = m is not None and m[0] == len(tokens)
            assert got[i][f"m{k}"] == whole, (tree, tokens)
            hits += whole
            if made[k].names:
                assert got[i][f"c{k}"] == (tuple(m[1].get(n, "") for n in made[k].names) if whole else None), (tree, tokens)
    assert hits > 100


def test_patterns_that_cannot_be():
    for wrong in (lambda: P.either(P.token("A")), lambda: P.token(name="1x"), lambda: P.token(name="a") + P.token(name="a"), lambda: P.captured(F.lit(""), P.token())):
        with pytest.raises(ValueError):
            wrong()


def test_first_rule_and_control_characters(spark):
    df = spark.createDataFrame([([("A", "1\x1e2")],), ([],), (None,)], "tokens array<struct<kind:string,value:string>>").withColumn("t", P.as_text(F.col("tokens")))
    rule = P.first_rule(F.col("t"), {"two": P.token() + P.token(), "one": P.token("A", "1�2"), "none": P.sequence()})
    assert [r[0] for r in df.select(rule).collect()] == ["one", "none", None]


C = "program int, value long, is_arithmetic boolean, fp_type string, fp_postfix string"
R = "program int, start long, end long, kind string, is_vtable boolean, tls boolean, base long, offset long, target_rule string, target long"


def test_constants_take_the_first_rule(spark):
    ranges = [(0, 100, 110, "LOCAL_FUNCTION"), (0, 104, 106, "STRING"), (0, 200, 210, "RODATA"), (0, 300, 310, "THREAD_LOCAL_DATA"), (0, 400, 410, "JUMP_TABLE_SLOT"), (0, 500, 510, "CODE_PTR_TABLE_SLOT"), (0, 600, 610, "UNKNOWN"), (1, 100, 110, "PLT_FUNCTION")]
    extra = {200: (True, None, None, None, "external function", 7), 300: (None, True), 400: (None, None, 390, 10)}
    rows = [(*r, *(extra.get(r[1], ()) + (None,) * 6)[:6]) for r in ranges]
    asked = {(0, 100): [("LOCAL_FUNC", 100)], (0, 103): [("BLOCK", 103)], (0, 105): [("STRING_PTR", 105), ("FLOAT_f32", None)], (0, 202): [("VTABLE", None), ("EXT_FUNC", 7)], (0, 301): [("THREAD_LOCAL", None), ("RW_DATA_PTR", 301)],
             (0, 404): [("JUMP_TABLE", 390), ("VALUED_CONST", 10)], (0, 507): [("CODE_PTR_TABLE", None), ("RO_DATA_PTR", 500), ("VALUED_CONST", 7)], (0, 605): [("VALUED_CONST", 605)], (1, 105): [("PLT_FUNC", 105)], (0, -3): [("VALUED_CONST", 3), ("VALUE_NEGATIVE", None)], (2, 100): [("VALUED_CONST", 100)]}
    given = [(p, v, False, None, "f32" if v == 105 and p == 0 else None) for p, v in asked] + [(0, 101, True, None, None), (0, 102, True, "f64", None)]
    got = {(r["program"], r["value"]): (r["rule"], [tuple(t) for t in r["emitted"]]) for r in constants.classified(spark.createDataFrame(given, C), spark.createDataFrame(rows, R)).collect()}
    assert {k: v[1] for k, v in got.items()} == asked | {(0, 101): [("VALUED_CONST", 101)], (0, 102): [("FLOAT_f64", 102)]}
    assert got[0, 101][0] == "value" and got[0, 102][0] == "float" and got[0, 103][0] == "block"


def test_targets_that_count(spark):
    rows = [("STRING", 0, 10, 20, "x", "csel", False), ("RODATA", 10, 10, 20, "x", "csel", False), (None, 20, 10, 20, "x", "csel", False), ("RODATA", 21, 10, 20, "x", "csel", True), (None, 21, 10, 20, "ppc", "ori", False), (None, 21, 10, 20, "arm32", "ori", False)]
    df = spark.createDataFrame(rows, "kind string, target long, low long, high long, arch string, mnemonic string, has boolean")
    assert [r[0] for r in df.select(rules.target_reason(*[F.col(c) for c in df.columns])).collect()] == ["anchor", "own function", "own function", "memory access", "address pair", None]
