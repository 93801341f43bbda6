"""Operators over groups of rows against brute force, on rows with all the awkward cases."""

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_rows import ROWS, prose
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm import chat, imatch, line_dedup, rule_ensemble, simhash, url_rules
from graphloom.llm._util import connected_components


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, x) for x in range(501, 560)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = components({x for pair in links for x in pair}, links)
    assert got == {n: r for n, r in want.items() if sum(1 for x in want.values() if x == r) > 1}


def test_covering_masks_meet_every_pair_within_the_radius():
    for masks, radius in ((simhash.covering_masks(2), 2), (simhash.covering_masks(3), 3), (simhash.pigeonhole_masks(3, 5), 3)):
        rnd = random.Random(radius)
        for _ in range(3000):
            apart = sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, radius)))
            assert any(not apart & m for m in masks)


@pytest.mark.parametrize(("radius", "every", "small", "local"), [(2, False, 2, 4096), (2, False, 12, 4096), (3, True, 2, 0), (3, True, 4, 0), (4, False, 2, 4096), (4, False, 2, 3), (3, True, 512, 0)])
def test_near_edges(spark, monkeypatch, radius, every, small, local):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(simhash, "PAIR_BUCKET", small)
    monkeypatch.setattr(simhash, "LOCAL_BUCKET", local)
    rnd = random.Random(radius)
    fps = {rnd.getrandbits(64) for _ in range(30)}
    for x in list(fps)[:6]:
        for _ in range(8):
            fps.add(x ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 3))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    masks = simhash.pigeonhole_masks(3, 5) if every else None
    got = {tuple(sorted((r["u"], r["v"]))) for r in simhash.near_edges(spark.createDataFrame([(f,) for f in signed], "fp long"), radius, masks, every).collect()}
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
    assert got == want if every else (got <= want and components(signed, got) == components(signed, want))


def brute_fp(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if len(words) >= width else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(docs, no_docs):
    fps = [(i, brute_fp(t, 3)) for i, t, *_ in ROWS]
    roots = components({f for _, f in fps}, [(a, b) for _, a in fps for _, b in fps if (a ^ b).bit_count() <= 2])
    least = {}
    for i, f in fps:
        least[roots[f]] = min(least.get(roots[f], 1 << 60), (1 << 60) if i is None else i)
    want = sorted((i or 0, f, None if least[roots[f]] == 1 << 60 else least[roots[f]]) for i, f in fps)
    got = sorted((r["id"] or 0, r["fp"] % (1 << 64), r["component"]) for r in simhash.near_components(docs).collect())
    assert got == want and simhash.near_components(no_docs).count() == 0
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {1, 4, 7} and not {2, 3} & {r["doc_id"] for r in kept.collect()}


def test_near_copies_go(spark):
    text = prose(400)
    rows = [(1, text), (2, text), (3, text.replace("alpha0", "changed", 1)), (4, prose(400, 11))]
    assert {r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1, 4}


def test_near_dedup_links_all_from_a_similarity_of_0_8(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(40):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice((30, 60, 120, 300)))]
        for j in range(3):
            changed = list(words)
            for at in rnd.sample(range(len(words)), j * max(1, len(words) // 60)):
                changed[at] = f"new{rnd.randrange(10**6)}"
            rows.append((3 * k + j, " ".join(changed)))
    sets = {i: {tuple(t.split()[a : a + 5]) for a in range(len(t.split()) - 4)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    far = sum((brute_fp(rows[a][1], 5) ^ brute_fp(rows[b][1], 5)).bit_count() > 6 for a, b in links)
    kept = {r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert far > 20 and kept == {i for i, g in components(sets, links).items() if i == g}


def test_near_dedup_decides_row_by_row(spark):
    """A null id or a shared id is no reason to go: only the row that is a copy goes."""
    copy, alone, lost = prose(60, 3), prose(60, 11).replace("a", "o"), prose(60, 5).replace("e", "u")
    rows = [(1, copy), (None, copy), (None, alone), (7, copy), (7, lost), (None, "no id here " + lost[::-1]), (None, "no id here " + lost[::-1]), (9, "twice"), (9, "twice")]
    got = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = [(0, alone), (0, "no id here " + lost[::-1]), (1, copy), (7, lost), (9, "twice")]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted(want)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_bound():
    rnd = random.Random(6)
    for _ in range(1500):
        a = "".join(rnd.choices("abcé", k=rnd.randint(0, 30)))
        b = "".join(rnd.choices("abcé", k=rnd.randint(0, 30))) if rnd.random() < 0.3 else "".join(c for c in a if rnd.random() < 0.9) + "x" * rnd.randint(0, 2)
        for most in (0, 1, 3, 8, 20):
            assert line_dedup.within(a, b, most) == (edit(a, b) <= most)


@pytest.mark.parametrize("bound", [0, line_dedup.BROADCAST_ROWS])
def test_line_dedup(spark, docs, no_docs, monkeypatch, bound):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", bound)
    base = prose(40, 9)
    more = [(20 + k, f"{base} {w}\n{base}") for k, w in enumerate(("x", "yy", "zzz", "alpha3"))]
    rows = [r[:2] for r in ROWS] + more
    got = line_dedup.dedup_lines(docs.select("doc_id", "text", "gone").unionByName(spark.createDataFrame([(*r, "g") for r in more], "doc_id long, text string, gone string"))).collect()
    unit = {(i, t) for i, t in rows}  # rows alike in id and text are one document
    key = {u: hashlib.md5(f"{'-' if u[0] is None else u[0]}\x00{u[1] or ''}".encode()).digest() for u in unit}
    lines = sorted(((-1 if u[0] is None else u[0]), key[u], p, b" ".join(w), u) for u in unit for p, w in enumerate(line_dedup.normal_lines(u[1] or "")) if w)
    forms = sorted({x[3] for x in lines})
    sims = dict(zip(forms, line_dedup.simhashes([list(dict.fromkeys(f.split())) for f in forms]).tolist(), strict=True))
    links = [(a, b) for a in forms for b in forms if a < b and (sims[a] ^ sims[b]).bit_count() <= 3 and edit(a.decode(), b.decode()) <= int(0.2 * max(len(a.decode()), len(b.decode())) + 1e-9)]
    group, seen, gone = components(forms, links), set(), {}
    for *_, p, form, u in lines:
        if group[form] in seen:
            gone.setdefault(u, set()).add(p)
        seen.add(group[form])
    want = sorted((i or 0, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get((i, t), ())) if t is not None else "null") for i, t in rows)
    assert sorted((r["doc_id"] or 0, "null" if r["text"] is None else r["text"]) for r in got) == want
    assert got[0]["gone"] in ("own gone", "g") and links
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_lines_with_a_changed_word_link(spark):
    """Every pair with an edit similarity from 0.8 links: one changed word in 6 to 50 has it, though SimHashes are far apart."""
    rnd = random.Random(12)
    rows = []
    for k in range(60):
        line = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(3, 7))) for _ in range((2, 6, 10, 20, 50)[k % 5])]
        changed = list(line)
        changed[rnd.randrange(len(line))] = "qrs" if k % 5 else line[0][:-1] + "q"
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(changed))]
    links = [(i, j) for i, a in rows for j, b in rows if i < j and line_dedup.alike(a, b)]
    want = {i for i, g in components([i for i, _ in rows], links).items() if g != i}
    assert len(want) > 40
    assert {r["doc_id"] for r in line_dedup.dedup_similar_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["n_removed"]} == want


def test_large_groups_of_near_lines_link_through_one(spark):
    words = prose(40, 9).split()
    rows = [(i, " ".join([*words[:20], f"x{chr(97 + i % 26)}{chr(97 + i // 26)}", *words[21:]])) for i in range(300)]
    assert [r["doc_id"] for r in line_dedup.dedup_similar_lines(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_removed = 0").collect()] == [0]


URLS = [(1, None), (2, "no scheme"), (3, "http://A.B.COM/en/7?x=1"), (4, "https://example.com/en/77#t"), (5, "https://x.example.net/de/8"), (6, "https://x.example.net/de/"), (7, "ftp://notexample.net/de/8"),
        (8, "http://com/en/"), (8, "http://com/en/"), (None, "a://b://c.org/es/?q"), (9, "http://org?es"), (10, "http://exämple.com/en/é"), (11, "http://x.org/es/" + "a" * 5000), (12, "http://" + "a." * 3000 + "com/en/")]


def verdict(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_url_rules(spark):
    rules = [*url_rules.RULES, ("allow", "x.example.net", "/"), ("block", "com", ""), ("allow", "com", "/e"), ("block", "example.com", "/en/77")]
    pages = spark.createDataFrame([(*r, "old") for r in URLS], "page_id long, url string, rule string")
    got = url_rules.judge(pages, spark.createDataFrame(rules, "action string, host string, path string"))
    assert sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in got.collect()) == sorted((i or 0, h, p, r or "", v) for i, u in URLS for h, p, r, v in [verdict(u, rules)])
    none = spark.createDataFrame([], "action string, host string, path string")
    assert url_rules.judge(pages, none).filter("rule is not null or verdict <> 'allow'").count() == 0
    assert url_rules.judge(pages.limit(0), none).count() == 0


def test_words_of_the_contract_rules(spark):
    want = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    pages = spark.createDataFrame([(i, f"https://www.{r}x") for i, r in enumerate(want)], "page_id long, url string")
    got = url_rules.judge(pages, spark.createDataFrame(url_rules.RULES, "action string, host string, path string"))
    assert {r["rule"]: r["verdict"] for r in got.collect()} == want


def test_chat_round_trip(spark):
    rnd = random.Random(4)
    bits = ["<|im_end|>", "<|im_sep|>", "<|im_start|>", "&amp;", "&lt;|", "&", "<", "|", "\n", "assistant", "é😀", "", "&#10;"]
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", None, "sys\ntem<|"]), rnd.choice([None, "".join(rnd.choices(bits, k=rnd.randint(0, 9)))])) for c in [None, *range(30)] for t in range(rnd.randint(1, 40))]
    rows += [(99, 0, "assistant", "tie b"), (99, 0, "assistant", "tie a"), (99, 0, "assistant", "tie a"), (99, None, "user", "first")]
    df = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    got = chat.format_chats(df).select("conv_id", chat.read_back(F.col("formatted")).alias("back"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("under"), "formatted", "loss").collect()
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((float("-inf") if t is None else t, r or "", x or ""))
    assert len(got) == len(by)
    for g in got:
        turns = sorted(by[g["conv_id"]])
        assert [tuple(b) for b in g["back"]] == [t[1:] for t in turns]
        assert g["under"] == "".join(x for _, r, x in turns if r == "assistant")
        assert g["formatted"].count("<|im_end|>") == 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:], strict=False))
    assert chat.format_chats(df.limit(0)).count() == 0


def test_fingerprints(spark, docs, no_docs):
    got = imatch.fingerprint_pairs(docs).collect()
    order = sorted(((-1 if i is None else i), t or "") for i, t, *_ in ROWS)
    want = []
    for k, (i, t) in enumerate(order):
        q = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - q] + order[(k + 1) % len(order)][1][:q]).encode()).hexdigest()))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    by = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by[4] == by[5] and len(by[5]) == 1 and by[1] == by[2] != by[3]
    assert imatch.fingerprint_pairs(no_docs).count() == 0
    assert imatch.fingerprint_pairs(spark.createDataFrame([(5, "one two three four")], "doc_id long, text string")).first()["near_next"] == 1.0


def chained(x, seed):
    return xxhash.xxh64_intdigest(struct.pack("<i", x), seed)


def brute_fingerprint(codes, text):
    """Hashes of the terms in each sub-lexicon, and the text of the fingerprint."""
    hashes = []
    for rate in imatch.RATES if codes else ():
        for sub in range(imatch.SUBSETS):
            own, h = [c for c in sorted(codes) if (lambda x: x - (x >> 63 << 64))(chained(rate, chained(c, 42))) % rate == sub], 42
            for c in own:
                h = chained(c, h)
            hashes.append(f"{h:016x}"[8:] if own else "")
    n = imatch.SUBSETS
    parts = [f"{r}:" + ".".join(hashes[n * i : n * i + n]) for i, r in enumerate(imatch.RATES)]
    return hashes, " ".join(parts) if codes else "w:" + hashlib.md5(text.encode()).hexdigest()


def test_fingerprints_equal_brute_force(spark):
    """Own words, shared words, near copies of a large group, a text without terms and repeated rows."""
    rnd, rows = random.Random(21), []
    shared = [f"s{k}" for k in range(300)]
    for i in range(150):
        rows.append((3 * i, " ".join([f"own{i}x{k}" for k in range(3)] + rnd.sample(shared, 12))))
    base = [f"group{k}" for k in range(90)]
    for i in range(70):
        rows.append((1000 + i, " ".join([*base[:60], f"odd{i}", *base[61:]])))
    rows += [(2000, ""), (2001, None), (2002, " ".join(shared[:40])), (2002, " ".join(shared[:40]))]
    got = imatch.fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    order = sorted((i, t or "") for i, t in rows)
    texts = {t for _, t in order}
    df = Counter(w for t in texts for w in {x.lower() for x in t.split()})
    known = sorted(w for w, n in df.items() if n >= imatch.LOW * len(texts))
    code = {r["w"]: r["c"] for r in spark.createDataFrame([(w,) for w in known], "w string").select("w", F.hash("w").alias("c")).collect()}
    band = {w for w in known if df[w] <= max(imatch.HIGH * len(texts), 1)}

    def prints(t):
        words = {x.lower() for x in t.split()} & code.keys()
        every, narrow = {code[w] for w in words}, {code[w] for w in words & band}
        common = len(narrow) * imatch.SPARSE < len(every)
        wide, own = brute_fingerprint(every, t), brute_fingerprint(narrow, t)
        return common, wide[0], own[0], (wide if common else own)[1]

    def like(x, y):
        if x[3] == y[3]:
            return 1.0
        a, b = (x[1], y[1]) if x[0] or y[0] else (x[2], y[2])
        both = [p == q for p, q in zip(a, b, strict=False) if p or q] if a and b else []
        return sum(both) / len(both) if both else 0.0

    want = []
    for k, (i, t) in enumerate(order):
        q, following = len(t) // 4, order[(k + 1) % len(order)][1]
        one, new, after = prints(t), prints(t[: len(t) - q] + following[:q]), prints(following)
        want.append((i, one[3], new[3], round(like(one, new), 9), round(like(one, after), 9)))
    assert sorted((r["doc_id"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == sorted(want)


def test_edited_texts_are_nearer_than_next_ones(spark):
    rows = [(i * i, " ".join(f"{w}{i // 2}" for w in dict.fromkeys(prose(300, 17 * i).split()))) for i in range(40)]
    got = imatch.fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == 40 and np.mean([r["near_edited"] for r in got]) > np.mean([r["near_next"] for r in got])


def test_near_copies_of_a_large_group_are_near(spark):
    """30 % of the rows are near copies, so all their shared terms are above the band."""
    words = [f"{w}shared" for w in dict.fromkeys(prose(300).split())]
    rows = [(i, " ".join([*words[:100], f"odd{i}", *words[101:]])) for i in range(120)]
    rows += [(1000 + i, " ".join(f"{w}{i}" for w in dict.fromkeys(prose(120, i).split()))) for i in range(280)]
    got = {r["doc_id"]: r for r in imatch.fingerprint_pairs(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert np.mean([got[i]["near_edited"] for i in range(120)]) > 0.3 and np.mean([got[i]["near_next"] for i in range(119)]) > 0.5
    assert np.mean([got[1000 + i]["near_next"] for i in range(280)]) < 0.1


def test_copies_do_not_count_for_document_frequency(spark):
    rows = [(i, "one text in many copies") for i in range(300)] + [(1000 + i, f"own{i} words{i}") for i in range(200)]
    assert imatch.lexicon(spark.createDataFrame(rows, "doc_id long, text string")).filter("term = 'copies' and band").count() == 1


def test_rule_ensemble_learns(spark):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        good = rnd.random() < 0.7
        words = prose(rnd.randint(30, 200), rnd.randrange(1000)).split()
        rows.append((i, " ".join(w if good or rnd.random() < 0.5 else w + "###" for w in words)))
        if i % 3:
            labels.append((i, int(good)))
    df = spark.createDataFrame([*rows, (None, None), (5000, ""), (1, rows[1][1])], "doc_id long, text string").withColumn("stats", F.lit("own"))
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    got = rule_ensemble.score(df, lab).collect()
    truth = dict(labels)
    test = [(truth[r["doc_id"]], r["score"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(got) == 903 and np.mean([(s >= 0.5) == (y == 1) for y, s in test]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    intercept, rules = rule_ensemble.train(df, lab)
    assert 0 < len(rules) < 200 and (intercept, rules) == rule_ensemble.train(df, lab)
    assert rule_ensemble.score(df, lab.limit(0)).select("score").distinct().count() == 1 and rule_ensemble.score(df.limit(0), lab).count() == 0


def test_held_out_labels_are_not_read(spark):
    df = spark.createDataFrame([(i, prose(60, i) + " #" * (i % 40)) for i in range(300)], "doc_id long, text string")
    lab = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 40 < 20).cast("int").alias("quality"))
    flipped = lab.withColumn("quality", F.when(rule_ensemble.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rule_ensemble.train(df, lab) == rule_ensemble.train(df, flipped)


def test_pipeline(spark, tmp_path, docs):
    docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = at
        stage(spark, at, str(tmp_path)).write.parquet(out := str(tmp_path / name.replace(" ", "_")))
        at = spark.read.parquet(out)
        if name != "packing":
            assert at.columns == before.columns and at.count() <= before.count()
            assert at.filter("n_chars <> length(text)").count() == 0
    assert at.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "secret scans", "packing"]
