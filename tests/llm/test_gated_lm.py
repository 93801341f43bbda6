"""The gated language model: counts against brute force, the network against plain steps, held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ROWS

from graphloom.llm import gated_lm, gated_net


def small_net(seed=3):
    rng = np.random.default_rng(seed)
    counts = np.sort(rng.integers(1, 90, 30))[::-1].astype(float)
    edges = np.array([0, 2, 7, 8, 30])
    mass = np.append(np.add.reduceat(counts, edges[:-1]), [40.0, 25.0])
    bias = np.log(counts / np.repeat(mass[:4], np.diff(edges)))
    out = gated_net.Output(edges, np.log(mass / mass.sum()).astype(np.float32), bias.astype(np.float32))
    weights = {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in gated_net.fresh(out, 6).items()}
    return out, weights


def plain_log_probabilities(out, w, ids):
    """One text, one token at a time, in double precision: log probabilities of all targets before each of its ids."""
    w = {k: v.astype(float) for k, v in w.items()}
    k, h, found = w["state"].shape[0], np.zeros(w["state"].shape[0]), []
    gate = lambda x: 0.5 * (1 + np.tanh(x))
    for last in [0, *ids[:-1]]:
        g, own = w["table"][last], h @ w["state"]
        z, r = gate(g[:k] + own[:k]), gate(g[k : 2 * k] + own[k : 2 * k])
        new = np.tanh(g[2 * k :] + r * (own[2 * k :] + w["shift"]))
        h = (1 - z) * new + z * h
        share = np.exp(h @ w["class"] + out.prior)
        share /= share.sum()
        every = []
        for c in range(len(out.edges) - 1):
            part = np.exp(h @ w["word"][:, out.edges[c] : out.edges[c + 1]] + out.bias[out.edges[c] : out.edges[c + 1]])
            every += list(share[c] * part / part.sum())
        found.append(np.log(np.array([*every, *share[len(out.edges) - 1 :]])))
    return found


def test_scores_are_those_of_plain_steps(monkeypatch):
    monkeypatch.setattr(gated_net, "LANES", 4)
    monkeypatch.setattr(gated_net, "STEPS", 3)
    out, weights = small_net()
    rng = np.random.default_rng(5)
    texts = [[*rng.integers(1, out.targets, n), 0] for n in (0, 5, 1, 40, 7, 0, 12, 3, 2)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = gated_net.Net(out, weights).score(np.concatenate(texts).astype(np.int32), bounds)
    for text, score in zip(texts, got, strict=True):
        steps = plain_log_probabilities(out, weights, text)
        assert all(np.exp(s).sum() == pytest.approx(1, abs=1e-6) for s in steps)
        assert score == pytest.approx(sum(s[i] for s, i in zip(steps, text, strict=True)), abs=1e-3)


def test_backward_gives_the_slopes(monkeypatch):
    out, weights = small_net()
    ids = np.array([3, 8, 31, 0, 5, 2, 30, 1, 0], dtype=np.int32)
    net, moved = gated_net.Net(out, weights), {}

    def move(self, name, gradient, n, rows=None):
        moved[name] = gradient if rows is None else (rows, gradient)

    monkeypatch.setattr(gated_net.Net, "move", move)
    net.learn(ids, np.array([0, 4, 9]))
    loss = lambda w: -gated_net.Net(out, w).score(ids, np.array([0, 4, 9])).sum()
    for name in weights:
        for at in [(0, 1), (2, 3), (1, 5)] if weights[name].ndim == 2 else [(0,), (4,)]:
            up, down = ({k: v.astype(np.float64) for k, v in weights.items()} for _ in range(2))
            up[name][at] += 1e-2
            down[name][at] -= 1e-2
            slope = (loss(up) - loss(down)) / 2e-2
            g = moved[name]
            own = (g[1][list(g[0]).index(at[0])][at[1]] if at[0] in g[0] else 0.0) if isinstance(g, tuple) else g[at]
            assert own == pytest.approx(slope, abs=2e-2 + 0.02 * abs(slope)), (name, at)


def test_untrained_shares_are_the_counts():
    words = gated_lm.Vocabulary(1000, 300, 20, pa.array([f"w{i}" for i in range(200)]), np.sort(np.random.default_rng(1).integers(1, 9, 200))[::-1])
    out, target, share, rarest, mass = words.layout()
    net = gated_net.Net(out, gated_net.fresh(out, 4))
    for i in (0, 17, 150, 199):
        got = net.score(np.array([target[i], 0], dtype=np.int32), np.array([0, 2]))[0] / math.log(10) + share[i]
        assert got == pytest.approx(math.log10((words.counts[i] + 1) / 1301) + math.log10(21 / 1301), abs=1e-4)
    assert mass == pytest.approx(1000 - words.counts.sum() - 20 + 300 - 200 - 1 + 1)


@pytest.mark.parametrize(("known", "head"), [(gated_lm.KNOWN_WORDS, gated_lm.HEAD), (9, 4)])
def test_counts_equal_brute_force(spark, docs, monkeypatch, known, head):
    monkeypatch.setattr(gated_lm, "KNOWN_WORDS", known)
    rows = [(i, (t or "").encode().lower().split()) for i, t, *_ in ROWS]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for (_, ws), h in zip(rows, held, strict=True) if not h for w in ws)
    ends = held.count(False)
    n, v = c.total() + ends, len(c) + 1
    want = sorted((-1 if i is None else i, h, len(ws) + 1, sum(c[w] > 0 for w in ws) + 1, n, round(sum(math.log10((x + 1) / (n + v + 1)) for x in [ends, *(c[w] for w in ws)]), 6)) for (i, ws), h in zip(rows, held, strict=True))
    model, counts = gated_lm.train(docs)
    got = gated_lm.score(docs, model, counts)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = got.collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:5], round(r["base_score"], 6)) for r in found) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    assert len(model.words.words) <= known


def test_nothing_to_learn_from(spark, no_docs):
    assert gated_lm.score(no_docs, *gated_lm.train(no_docs)).collect() == []
    only = spark.createDataFrame([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2), "a b")], "doc_id long, text string")
    row = gated_lm.score(only, *gated_lm.train(only)).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (True, 3, 0, 0, 0.0, 0.0)


def test_held_out_texts_score_better_than_by_counts(spark):
    rows = gated_lm.query(spark, "/root/testdata/sf0.01").filter("held_out").select("base_score", "score").collect()
    assert sum(r["score"] for r in rows) > 0.97 * sum(r["base_score"] for r in rows) and sum(r["score"] > r["base_score"] for r in rows) > 0.8 * len(rows)


def test_known_words_are_looked_up_once_for_many_blocks(monkeypatch):
    words = gated_lm.Vocabulary(1000, 300, 20, pa.array([f"w{i}" for i in range(200)]), np.arange(200, 0, -1))
    texts = pa.array([" ".join(f"w{i * j % 250}" for j in range(40)) for i in range(30)] + [None, ""])
    coder, lookup, calls = gated_lm.Coder(words), gated_lm.pc.index_in, []
    want = coder.code(texts)
    monkeypatch.setattr("graphloom.llm.word_codes.BLOCK_BYTES", 64)
    monkeypatch.setattr(gated_lm.pc, "index_in", lambda *a, **b: calls.append(1) or lookup(*a, **b))
    got = coder.code(texts)
    blocks = sum(1 for _ in gated_lm.words_of(texts, gated_lm._table()))
    assert blocks > 2 * gated_lm.LOOKUP and len(calls) == -(-blocks // gated_lm.LOOKUP)
    for name in ("ids", "bounds", "known", "base", "share"):
        assert np.allclose(getattr(got, name), getattr(want, name))
    rare = [Counter((t, w) for who, names, times in x.rare for t, w, k in zip(who.tolist(), names.to_pylist(), times.tolist(), strict=True) for _ in range(k)) for x in (got, want)]
    assert rare[0] == rare[1] and rare[0]
