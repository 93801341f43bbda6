"""Blocks as text, on literal bodies."""

from graphloom.operators import render


def test_lines_of_blocks(spark):
    tokens = [272, 265, 0, 266, 1, 273, 264, 2, 274, 257, 1, 0, 256, 275, 270, 1, 4, 276, 267, 0, 267, 3, 261, 63, 240, 0, 0, 0, 0, 0, 0, 999]
    bodies = spark.createDataFrame([(1, 0, tokens, [8, 9, 0, 15], [5, 3, 5, 4, 15]), (2, 0, [], [], []), (3, 1, [272], [1], [1])], "section_id long, variant_idx int, tokens array<int>, block_rl array<int>, insn_rl array<int>")
    vocab = spark.createDataFrame([(272, "call"), (273, "jmp"), (274, "mov"), (275, "MEM_OPEN_BRACKET"), (276, "bl")], "id int, token string")
    calls = spark.createDataFrame([(1, 0, 9, 0, "main", None), (1, 0, 10, 1, None, None), (1, 0, 11, 0, "puts", "libc.so"), (3, 0, 9, 0, "other", None)], "section_id long, variant_idx int, category int, place int, name string, provider string")
    got = {(r.section_id, r.block, r.insn): (r.text, [tuple(x) for x in r.refers]) for r in render.lines(bodies, vocab, calls).collect()}
    assert got == {
        (1, 0, 0): ("call local function 0: main plt function 1: ?", [("call", 9, 0), ("call", 10, 1)]),
        (1, 0, 1): ("jmp jump block: 2", [("jump", 8, 2)]),
        (1, 1, 0): ("mov v:-256", []),
        (1, 1, 1): ("[ RO_DATA_PTR:260", []),
        (1, 3, 0): ("bl ext function 0: puts@libc.so ext function 3: ?@? f64:0x3ff0000000000000 #999", [("call", 11, 0), ("call", 11, 3)]),
        (3, 0, 0): ("call", []),
    }


def test_wide_values(spark):
    body = [(1, 0, [257, *[255] * 15, 257, *[1] * 16], [33], [33])]
    df = spark.createDataFrame(body, "section_id long, variant_idx int, tokens array<int>, block_rl array<int>, insn_rl array<int>")
    vocab, calls = spark.createDataFrame([], "id int, token string"), spark.createDataFrame([], "section_id long, variant_idx int, category int, place int, name string, provider string")
    assert render.lines(df, vocab, calls).first()["text"] == f"v:{256**15 - 1} v:0x{'01' * 16}"
