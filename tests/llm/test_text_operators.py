"""Operators on single texts against brute force, on rows with all the awkward cases."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_rows import ROWS, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from graphloom.llm import byte_bpe, packing, quality_rules, secrets
from graphloom.llm.text_stats import STATS, text_stats

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = ["'", "s", "t", "re", "v", "l", "d", " ", "  ", "\n", "\t", "\xa0", "a", "B", "é", "1", "²", "!", "'s", "'ll", "中", "\U00016d40", "\x1c", "😀", "́", "<|endoftext|>", "Σ", "İ", "ß", ".", ","]


def mixtures(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(AWKWARD) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + ["", "a" * 500, "!" * 300 + " " * 200 + "x"]


def test_byte_bpe_equals_the_library():
    coder = byte_bpe.ByteBPE(RANKS, byte_bpe.class_table())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}, special_tokens={})
    texts = mixtures(4000, 1)
    for text, (pieces, starts) in zip(texts, coder.encode(texts), strict=True):
        ids = b"".join(pieces)
        assert np.frombuffer(ids, dtype="<u4").tolist() == own.encode_ordinary(text)
        assert coder.decode(ids) == text.encode() and len(starts) == len(pieces)


def test_blocks_and_cache_do_not_change_ids(monkeypatch):
    texts = mixtures(500, 2)
    coder = byte_bpe.ByteBPE(RANKS, byte_bpe.class_table())
    whole = [b"".join(p) for p, _ in coder.encode(texts)]
    monkeypatch.setattr(byte_bpe, "BLOCK", 11)
    monkeypatch.setattr(byte_bpe, "CACHE", 20)
    assert [b"".join(p) for p, _ in coder.encode(texts)] == whole


def test_byte_bpe_frames(docs, no_docs):
    encoded = byte_bpe.encode(docs, RANKS)
    back = sorted((r["id"] or 0, r["text"]) for r in byte_bpe.decode(encoded, RANKS).collect())
    assert back == sorted((i or 0, t or "") for i, t, *_ in ROWS)
    for start, end in ((0, 3), (5, 9), (7, None), (400, 900), (3, 3)):
        part = sorted((r["id"] or 0, r["text"]) for r in byte_bpe.decode(encoded, RANKS, start, end).collect())
        assert part == sorted((i or 0, (t or "")[start:end]) for i, t, *_ in ROWS)
    digests = byte_bpe.digests(docs, RANKS).collect()
    assert sorted(r["decoded_sha256"] for r in digests) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in ROWS)
    assert byte_bpe.digests(no_docs, RANKS).count() == byte_bpe.encode(no_docs, RANKS).count() == 0


def test_word_tokens_equal_the_library(monkeypatch):
    own = Tokenizer.from_file(WORDS)
    texts = mixtures(3000, 3)
    want = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    coder = packing.WordTokens(WORDS)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in coder.encode(texts)] == want
    monkeypatch.setattr(packing, "CACHE", 50)
    assert [np.frombuffer(x, dtype="<u4").tolist() for t in texts[:300] for x in coder.encode([t])] == want[:300]


def test_pairs_of_plain_words_come_from_a_table(monkeypatch):
    texts = ["Stones, stones. STONES ., . , a, É. straße, ÑANDÚ. x.y one\u2028two\x85three\x0bfour a\u0301b, " + "z" * 60 + ",", "", " \n", "(a) it's A.", "five\x1csix."]
    coder = packing.WordTokens(WORDS)
    sought, rank = [], packing.WordMerger.rank
    monkeypatch.setattr(packing.WordMerger, "rank", lambda self, x, y: sought.append(x.ndim) or rank(self, x, y))
    found = coder.encode(texts)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert sought and set(sought) == {1}  # searched for are only pairs with what has been joined


def test_words_with_many_closing_marks_are_merged_without_the_library(monkeypatch):
    texts = ["Stone.&&& stone, STONE!! straße.%%% (stone stone's stone' stone'' stone.' s", "  stone]}~ stone\\`\t|stone| ", "", "\x1cstone!!\x1f a", "stone<|endoftext|> <|endoftext|>stone"] * 2
    coder, asked, whole = packing.WordTokens(WORDS), [], packing.WordTokens.whole
    monkeypatch.setattr(packing.WordTokens, "whole", lambda self, parts: asked.extend(parts) or whole(self, parts))
    want = [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    for known in (packing.KNOWN, 3):  # with few, all are forgotten each time
        monkeypatch.setattr(packing, "KNOWN", known)
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in coder.encode(texts)] == want
        assert [np.frombuffer(x, dtype="<u4").tolist() for t in texts for x in coder.encode([t])] == want
    assert coder.encode([]) == [] and {".&&&", "!!", "]}~"} <= set(asked) and not {"stone.&&&", "Stone.&&&", "stone!!", "STONE!!", "straße.%%%", "stone]}~"} & set(asked)


@pytest.mark.parametrize("seed", range(40))
def test_packing_plan_holds_every_piece(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 10, 20, 50, 100])
    sizes = {}
    for _ in range(rnd.randint(0, 40)):
        s = rnd.randint(1, capacity)
        sizes[s] = sizes.get(s, 0) + rnd.randint(1, 4)
    groups, got = packing.solve(sizes, capacity), {}
    for count, contents in groups:
        assert sum(s * k for s, k in contents) <= capacity
        for s, k in contents:
            got[s] = got.get(s, 0) + count * k
    assert got == sizes


def fewest(items, capacity):
    """Exact minimum by search, for few items."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def reduced(items, capacity):
    """Fixed sequences, and the pieces left."""
    left = {s: items.count(s) for s in items}
    plan = packing.Plan()
    packing.reduce_dominated(left, capacity, plan)
    assert all(sum(s * k for s, k in contents) <= capacity for _, contents in plan.groups)
    return sum(n for n, _ in plan.groups), [s for s, n in left.items() for _ in range(n)]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimum(seed):
    rnd = random.Random(seed)
    items = [rnd.randint(1, 20) for _ in range(rnd.randint(1, 9))]
    fixed, rest = reduced(items, 20)
    assert fixed + fewest(rest, 20) == fewest(items, 20)


def test_reduction_keeps_an_optimum_of_many_instances():
    """Among them many small pieces beside large ones, where three and more fit in the place of one."""
    rnd, threes = random.Random(5), 0
    for _ in range(2500):
        capacity = rnd.choice([60, 100, 150, 200])
        items = [rnd.randint(1, capacity) if rnd.random() < 0.5 else rnd.randint(capacity // 8, capacity // 3) for _ in range(rnd.randint(4, 10))]
        fixed, rest = reduced(items, capacity)
        threes += len(items) > len(rest)
        assert fixed + fewest(rest, capacity) == fewest(items, capacity)
    assert threes > 1000
    assert sum(n for n, _ in packing.solve({120: 1, 118: 1, 56: 1, 26: 4}, 200)) == 2


def test_packing_frames(docs, no_docs):
    own = Tokenizer.from_file(WORDS)
    pieces = packing.pieces(docs, WORDS, capacity=64, with_ids=True)
    want = []
    for i, t, *_ in ROWS:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(i or 0, k, b, len(ids[b : b + 64]), zlib.crc32(ids[b : b + 64].tobytes())) for k, b in enumerate(range(0, len(ids), 64))]
    placed = packing.pack(pieces, 64).collect()
    assert sorted((r["id"] or 0, *r[1:5]) for r in placed) == sorted(want)
    by = {}
    for r in placed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(packing.pieces(no_docs, WORDS), 64).count() == 0


def spans(text):
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    kinds = [(re.compile(rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6), (re.compile("AKIA[A-Z0-9]+"), 0, 20), (re.compile("[0-9a-f]+"), 0, 24)]
    return sorted((m.start(), k, m.end()) for k, (p, g, least) in enumerate(kinds) for m in p.finditer(text) if len(m[g]) >= least)


def test_trigram_queries():
    clause = secrets.trigram_query(secrets.BASE[0].pattern)
    assert len(clause) == 1 and frozenset({"tok", "oke", "ken"}) in clause[0] and len(clause[0]) == 6
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    assert secrets.trigram_query("[0-9a-f]+") == [] and secrets.trigram_query("ab|abc") == []


@pytest.mark.parametrize("bound", [0, secrets.BROADCAST_ROWS])
def test_secrets_equal_brute_force(docs, no_docs, monkeypatch, bound):
    monkeypatch.setattr(secrets, "BROADCAST_ROWS", bound)  # by key, and by broadcast
    got = secrets.find(docs, rules=secrets.BASE).collect()
    assert sorted((r["doc_id"] or 0, [tuple(s) for s in r["spans"]]) for r in got) == sorted((i or 0, spans(t or "")) for i, t, *_ in ROWS)
    assert got[0]["key"] == "own key" and secrets.find(no_docs).count() == 0


def test_redaction(docs):
    got = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert got[8] == 'x [assign]" and [access] [hex]' and got[1] is None and got[13] == next(t for i, t, *_ in ROWS if i == 13)
    assert all(not spans(t or "") for t in got.values())


def test_text_statistics():
    for _, text, *_ in ROWS:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = {}
        for i in range(len(words) - 2):
            windows.setdefault(tuple(words[i : i + 3]), []).append(i)
        repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        got = text_stats(text)
        assert got[:5] == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated))


def test_quality_rules(docs, no_docs):
    got = quality_rules.score(docs).collect()
    assert len(got) == len(ROWS) and not any(r["kept"] and r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if r["base_failed"]} >= {1, 2, 3, 12} and all(r["kept"] for r in got if r["doc_id"] == 4)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(r["doc_id"] or 0 for r in got if r["kept"])
    assert quality_rules.score(no_docs).count() == quality_rules.keep_good(no_docs).count() == 0


def test_sketches_merge_and_bound_the_quartiles(spark):
    rnd = random.Random(1)
    xs = [rnd.lognormvariate(0, 1) for _ in range(2000)] + [0.0] * 100
    rows = [("en", f"s{i % 3}", (100, round(100 * x), *[0] * 9)) for i, x in enumerate(xs)]
    texts = spark.createDataFrame(rows, f"lang string, source string, stats struct<{','.join(f'{s}:bigint' for s in STATS)}>")
    counts = quality_rules.sketch(texts, ["lang", "source"]).withColumnRenamed("n", "w")
    got = quality_rules.quartiles(counts.groupBy("lang", "rule", "bucket").agg(F.sum("w").alias("w")), ["lang"]).filter("rule = 'chars_per_word'").first()
    exact = sorted(round(100 * x) / 100 for x in xs)
    q1, q3 = exact[-(-len(exact) // 4) - 1], exact[-(-len(exact) * 3 // 4) - 1]
    assert q1 <= got["q1"] <= 1.03 * q1 and q3 <= got["q3"] <= 1.03 * q3
    merged = quality_rules.sketch(texts, ["lang"]).withColumnRenamed("n", "w")
    assert quality_rules.quartiles(merged, ["lang"]).filter("rule = 'chars_per_word'").first() == got


def brute_kept(rows):
    """kept of rows (id, text, lang, source), by sketches as dictionaries."""
    stats = [dict(zip(STATS, text_stats(t), strict=True)) for _, t, *_ in rows]
    base = [s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"] for s in stats]

    def value(s, rule):
        top, bottom = quality_rules.RULES[rule]
        return s[top] / s[bottom] if s[bottom] else 0.0

    def sketched(keep, rule):
        out = Counter()
        for s, failed, row in zip(stats, base, rows, strict=True):
            if not failed and keep(row):
                x = value(s, rule)
                out[math.ceil(math.log(x) / math.log(quality_rules.GAMMA)) if x > 0 else quality_rules.ZERO] += 1
        return out

    def blend(own, parent):
        total = sum(parent.values())
        return {b: own.get(b, 0) + quality_rules.PRIOR * parent.get(b, 0) / total for b in {*own, *parent}}

    def quarters(sketch):
        total, upto, out = sum(sketch.values()), 0, []
        for b in sorted(sketch):
            upto += sketch[b]
            while len(out) < 2 and 4 * upto >= (3 if out else 1) * total * (1 - 1e-9):
                out.append(0.0 if b == quality_rules.ZERO else quality_rules.GAMMA**b)
        return out

    kept = []
    for (_, _, lang, source), s, failed in zip(rows, stats, base, strict=True):
        good = not failed
        for rule in quality_rules.RULES:
            group = sketched(lambda r: r[2:] == (lang, source), rule)  # noqa: B023
            if failed or not group:
                continue
            of_lang = blend(sketched(lambda r: r[2] == lang, rule), sketched(lambda r: True, rule))  # noqa: B023
            q1, q3 = quarters(blend(group, of_lang))
            n = max(1, s[quality_rules.RULES[rule][1]])
            wide = quarters(of_lang)
            room = quality_rules.REACH * max(q3 - q1, wide[1] - wide[0], math.sqrt(max(q3 * n, 1)) / n)
            good = good and q1 - room <= value(s, rule) <= q3 + room
        kept.append(good)
    return kept


def test_kept_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(260):
        words = prose(rnd.randint(20, 160), i).split()
        kind = rnd.randrange(8)
        words = [w.upper() if kind == 0 and rnd.random() < 0.7 else w * 4 if kind == 1 else w + "#$" if kind == 2 and rnd.random() < 0.4 else w + "!" if kind == 3 and rnd.random() < 0.5 else w for w in words]
        rows.append((i, rnd.choice([" ".join(words)] * 9 + [None]), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "c", None])))
    got = {r["doc_id"]: r["kept"] for r in quality_rules.score(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)).collect()}
    want = brute_kept(rows)
    assert [got[i] for i in range(260)] == want and 20 < sum(want) < 240
