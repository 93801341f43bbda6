"""Words of blocks and phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from llm_rows import ROWS

from graphloom.llm import phrases, word_codes


def brute(rows, least, longest, share, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) >= 2 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def passages(seed):
    rnd = random.Random(seed)
    words = ["the", "The", "été", "a|b", "x\x00", "中", "of", "it"]
    parts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 7))) for _ in range(12)]
    texts = []
    for _ in range(80):
        texts.append((rnd.choice(["en", "en", "de", None]), "".join(rnd.choice(parts) + rnd.choice([" ", " ", ". ", "\n", "\t", "  ", ",", "\r\n"]) for _ in range(rnd.randint(0, 12)))))
    return texts + [("en", None), ("fr", ""), ("en", texts[0][1]), ("und", texts[3][1])]


@pytest.mark.parametrize(("seed", "least", "longest", "share", "top"), [(1, 3, 5, 100, 2000), (2, 2, 3, 70, 5), (3, 6, 5, 40, 30)])
def test_collocations(spark, seed, least, longest, share, top):
    rows = passages(seed)
    df = spark.createDataFrame([(*r, "own id", "own f", "own chunk") for r in rows], "lang string, text string, id string, f string, chunk string").repartition(5)
    got = phrases.collocations(df, least=least, longest=longest, share=share, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, longest, share, top)
    assert sorted(map(tuple, got.collect())) == want and want


def test_awkward_documents(docs, no_docs):
    assert sorted(map(tuple, phrases.collocations(docs, least=4).collect())) == brute([(lang, text) for _, text, lang, _ in ROWS], 4, 5, 100, 2000)
    assert phrases.collocations(no_docs).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**13 + 7, 10**13 + 9, [10**13 + 11, 10**13 + 7], [10**13 + 8, 10**13 + 7])], "f long, n long, starts array<long>, ends array<long>")
    assert row.selectExpr(f"{phrases.CUT} as c").first()["c"]["score"] == 1000 * (10**13 + 7) * (10**13 + 9) // ((10**13 + 11) * (10**13 + 8))


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 20])
def test_words_of_blocks(monkeypatch, block):
    monkeypatch.setattr(word_codes, "BLOCK_BYTES", block)
    texts = [None, "", " ", "a", "B c", ".x.y z", "été  À\tü\n", "w" * 200 + " end", "tail. ", ".", "no gap", "é"]
    got = [(w, t, f) for words, text, first in word_codes.words_of(pa.array(texts, pa.string())[1:], word_codes.byte_table(b" \t", b".\n")) for w, t, f in zip(words.to_pylist(), text.tolist(), first.tolist(), strict=True)]
    want = []
    for t, text in enumerate(texts[1:]):
        for piece in re.split(r"[.\n]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            want += [(w, t, i == 0) for i, w in enumerate(re.findall(r"[^ \t]+", piece))]
    assert got == want
