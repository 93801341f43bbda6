"""Secrets of the added kinds, texts that stay where they are, recall of line keys, and results of whole queries."""

import re

import numpy as np
import pytest
from llm_rows import ROWS
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm import queries as Q
from graphloom.llm import secrets, simhash

DATA = "/root/testdata/sf0.001"
EXTRA = [(20, "x ghp_" + "a1B2" * 10 + " y gho_" + "Z" * 35 + " ghx_" + "a" * 50), (21, "ghs_" + "q" * 36 + "é-----BEGIN RSA PRIVATE KEY-----\n-----BEGIN PRIVATE KEY-----"), (22, "-----BEGIN rsa PRIVATE KEY----- ghp_" + "a" * 34), (23, "ghr_" + "9" * 36)]


@pytest.mark.parametrize("bound", [0, secrets.BROADCAST_ROWS])
def test_added_kinds_equal_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(secrets, "BROADCAST_ROWS", bound)
    rows = [(i, t) for i, t, *_ in ROWS] + EXTRA + EXTRA[:1]
    kinds = [(k, r) for k, r in enumerate(secrets.RULES) if r in secrets.ADDED]
    want = sorted(((i or 0), sorted((m.start(), k, m.end()) for k, r in kinds for m in re.finditer(r.pattern, t or "") if len(m[r.group]) >= r.least)) for i, t in rows)
    got = secrets.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, [tuple(s) for s in r["spans"] if s["kind"] >= len(secrets.BASE)]) for r in got) == want
    assert sum(len(s) for _, s in want) == 6


def test_only_candidates_texts_are_shuffled(spark, monkeypatch):
    """The bytes that meet the candidates by key are those of candidates, not of the table."""
    monkeypatch.setattr(secrets, "BROADCAST_ROWS", 0)
    seen, keep = [], secrets.sieve

    def sieve(rows, column, keys):
        out = keep(rows, column, keys)
        seen.append(out)
        return out

    monkeypatch.setattr(secrets, "sieve", sieve)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 1000 == 7, "token = abcdefghijk").otherwise(F.concat(F.lit("plain text "), F.col("id").cast("string"))).alias("text"))
    assert secrets.find(rows).filter("size(spans) > 0").count() == 3
    assert len(seen) == 1 and seen[0].filter("__maybe").count() < 30


COLUMNS = {
    "op1_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_secret_scans": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op3_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op7_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op10_document_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op11_lm_scoring": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_have_a_row_for_each_document(spark, name):
    got, docs = Q.QUERIES[name](spark, DATA), spark.read.parquet(f"{DATA}/documents.parquet")
    assert COLUMNS[name].items() <= dict(got.dtypes).items()
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert set(ids) == {r["doc_id"] for r in docs.select("doc_id").collect()} and (name == "op3_best_fit_packing" or len(ids) == docs.count())


def test_the_pipeline_packs_what_its_stages_keep(spark):
    got = corpus_pipeline.run(spark, DATA)
    ids = {r["doc_id"] for r in got.select("doc_id").distinct().collect()}
    assert {"doc_id", "piece", "length", "sequence_id", "offset"} <= set(got.columns)
    assert 0 < len(ids) < spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).filter("n <> m or n > 2048").count() == 0


def test_keys_of_lines_with_words_changed():
    """Of lines alike, 0.9 and more share a key at each length and similarity; pairs and seed played no part in the choice of keys."""
    import random

    import pyarrow.parquet as pq

    from graphloom.llm import line_dedup

    rnd = random.Random(20261)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    lines = sorted({b" ".join(line).decode() for t in texts for line in line_dedup.normal_lines(t or "") if line})
    words = sorted({w for line in lines for w in line.split()})

    def changed(line, low, high):
        for _ in range(30):
            share = rnd.uniform(0.05, 0.4)
            new = " ".join(rnd.choice(words) if rnd.random() < share else w for w in line.split())
            n = max(len(new), len(line))
            if not line_dedup.within(line, new, int((1 - high) * n)) and line_dedup.within(line, new, int((1 - low) * n + 1e-9)):
                return new

    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 0.95)):
        for least, most in ((26, 40), (41, 80), (81, 204), (205, 400), (401, 1 << 60)):
            own = [line for line in lines if least <= len(line) <= most]
            pairs = [(line, new) for line in rnd.sample(own, min(len(own), 100)) if (new := changed(line, low, high))]
            met = sum(bool(set(line_dedup.line_keys([a.encode()])[0].tolist()) & set(line_dedup.line_keys([b.encode()])[0].tolist())) for a, b in pairs)
            assert met >= 0.85 * len(pairs) and (most <= 80 or met >= 0.9 * len(pairs)), (low, least, met, len(pairs))


def test_turns_of_one_number_are_sorted_as_they_are_written(spark):
    from graphloom.llm import chat

    rows = [(1, 0, "user", t) for t in ("0", "<|x", "&", "=")] + [(1, 0, "u\nv", "z"), (1, None, "b", None)]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).select(chat.read_back(F.col("formatted")).alias("t")).first()["t"]
    assert [tuple(t) for t in got] == [("b", ""), ("u\nv", "z"), ("user", "&"), ("user", "0"), ("user", "<|x"), ("user", "=")]


def test_near_dedup_has_texts_of_near_simhashes_meet(spark):
    base = " ".join(f"word{i * i % 9973}" for i in range(1500))
    texts = [base, base + " more", base.replace("word25 ", "other ", 1), "quite another text of few words", "", None]
    marked = simhash.marked_sets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", 5).collect()
    keys = {r["id"]: set(r["keys"]) for r in marked}
    fps = {i: simhash.simhash64(simhash.shingle_set(t, 5)) for i, t in enumerate(texts) if t}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= simhash.RADIUS]
    own = {i: set(simhash.fingerprint_keys(np.array([fp], dtype=np.uint64))[0].tolist()) for i, fp in fps.items()}
    assert (0, 1) in near and all(own[a] & own[b] for a, b in near) and not own[0] & own[3]
    assert all(own[i] <= keys[i] for i in fps) and not keys[4] and not keys[5]


def test_lines_of_one_passage_are_not_paired_by_row(spark):
    """Unlike nodes of one key make rows by blocks, not by pairs, and no link of pairs that meet is lost."""
    import random

    from graphloom.llm import line_dedup, minhash

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=6))
    passage = " ".join(word() for _ in range(20))
    rows, own = [], ""
    for i in range(300):
        own = own[:-1] + "z" if i % 10 == 9 else " ".join(word() for _ in range(10))
        rows.append((i, f"{passage} {own}"))
    kept = spark.createDataFrame(rows, "of long, text string")
    entries = spark.createDataFrame([(k, i, len(t)) for i, t in rows for k in (7, 8, 9)[: 1 + i % 3]], "key long, node long, size int")
    made = []

    def texts(wanted):
        made.append(wanted.count())
        return wanted.join(kept, F.col("node") == F.col("of")).drop("of")

    got = minhash.linked(entries, 0.8, texts, str, line_dedup.alike).collect()
    links = [(i, j) for i, a in rows for j, b in rows[i + 1 :] if line_dedup.alike(a, b)]
    assert len(links) >= 30 and sorted((r["node"], r["root"]) for r in got) == sorted((n, i) for i, j in links for n in (i, j))
    assert sum(made) < 10 * len(rows)
    made.clear()
    assert minhash.linked(entries.select(F.expr("node div 2").alias("key"), "node", "size"), 0, texts, str, lambda a, b: False).count() == 0
    assert made == [300, 300, 0]  # in keys of two, the last hub has met all


def test_workers_let_a_tokenizer_go(spark):
    """Python workers outlive stages: the next operator's tasks don't find the tokenizer of packing in memory."""
    import gc

    import public_tokenizers

    from graphloom.llm import _util, packing, text_stats

    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(400)], "doc_id long, text string").repartition(16)

    def held(batches):
        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(isinstance(x, packing.WordTokens) for x in gc.get_objects())])], names=["n"])

    def most(df):
        return df.mapInArrow(held, "n long").agg(F.max("n")).first()[0]

    packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")).count()
    assert most(docs) == 1
    for _ in range(3):  # so that every worker has a turn
        text_stats.with_stats(docs, "text").select("stats").collect()
    assert most(docs) == 0
    assert [_util.keep(("a",), lambda: 1), _util.keep(("a",), lambda: 2), _util.keep(("b",), lambda: 3), _util.keep(("a",), lambda: 4)] == [1, 1, 3, 4]
    _util.let_go()


def test_lines_are_marked_in_one_row_for_each_document(spark):
    from graphloom.llm import line_dedup

    docs = spark.createDataFrame([(1, "a b\n\nc d"), (2, "C, d\n"), (3, None)], "doc_id long, text string")
    for sims in (False, True):
        got = {r["id"]: r for r in line_dedup.marked_lines(docs, "doc_id", "text", sims).collect()}
        keys = [got[i]["keys"] for i in (1, 2, 3)]
        assert [[k is None for k in own] for own in keys] == [[False, True, False], [False, True], [True]] and keys[0][2] == keys[1][0] != keys[0][0]
        assert [got[i]["sims"] and [x is None for x in got[i]["sims"]] for i in (1, 2, 3)] == [[k is None for k in own] if sims else None for own in keys]
