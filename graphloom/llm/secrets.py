"""Secret scans through a trigram inverted index, in DataFrame expressions only.

Each rule's regex is read on the driver into a Boolean query over trigrams that every match must
contain. Postings (trigram, text key) of the trigrams that any query names are intersected per text
key; only candidate texts are verified with the regex. Rules without a mandatory trigram scan all.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm._util import beside, cut, sieve


@dataclass(frozen=True)
class Rule:
    """kind; a regex in the syntax that Java and Python share; the group whose length must reach `least`."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The contract's three kinds (fixed values), in its order.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Kinds that this operator adds.
ADDED = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
)
RULES = BASE + ADDED
SPAN = "struct<start:int,kind:int,end:int>"
#: Strings that an alternation may expand to before the query is cut at that place.
MOST_STRINGS = 64
#: Up to so many rows (a 64-character key each) and spans together (under 64 MB) are broadcast; more are joined by key.
BROADCAST_ROWS = 200_000


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """All of these must hold: one of the alternatives, each a set of lower-case trigrams. Empty: nothing is mandatory."""
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> None:
        if strings and all(len(s) >= 3 for s in strings):
            ways = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
            clauses.append(sorted((w for w in ways if not any(v < w for v in ways)), key=sorted))

    def exact(items) -> set[str] | None:
        """The strings that a sequence matches, lower-cased, or None if they are too many or not known."""
        found = {""}
        for op, arg in items:
            own = one(op, arg)
            if own is None or len(own) * len(found) > MOST_STRINGS:
                return None
            found = {a + b for a in found for b in own}
        return found

    def one(op, arg) -> set[str] | None:
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN and all(k is sre.LITERAL for k, _ in arg):
            return {chr(c).lower() for _, c in arg}
        if op is sre.SUBPATTERN:
            return exact(arg[3])
        if op is sre.BRANCH:
            each = [exact(x) for x in arg[1]]
            return None if any(x is None for x in each) else set().union(*each)
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 4:
            own = exact(arg[2])
            if own is not None:
                out = {""} if arg[0] == 0 else set()
                power = {""}
                for k in range(1, arg[1] + 1):
                    power = {a + b for a in power for b in own}
                    if len(power) > MOST_STRINGS:
                        return None
                    if k >= arg[0]:
                        out |= power
                return out
        return None

    def walk(items) -> None:
        held = {""}
        for op, arg in items:
            own = one(op, arg)
            if own is not None and len(own) * len(held) <= MOST_STRINGS:
                held = {a + b for a in held for b in own}
                continue
            close(held)
            held = {""}
            if own is not None:
                held = own
            elif op is sre.SUBPATTERN:
                walk(arg[3])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                walk(arg[2])
        close(held)

    walk(sre_parser.parse(pattern))
    return clauses


def grams_of(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({g for r in rules for clause in trigram_query(r.pattern) for way in clause for g in way})


def postings(keyed: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key): the inverted index of columns key and text, for the trigrams that the rules name.

    gram is the trigram's place in `grams`. Copies of a text share a key and so one posting.
    """
    low = F.lower("text")
    hits = F.filter(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]), lambda x: x.isNotNull())
    return keyed.select("key", F.explode(hits).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], grams: list[str]) -> DataFrame:
    """(key, rules): texts whose postings satisfy the query of any rule, and which rules."""
    place = {g: i for i, g in enumerate(grams)}
    words = range(-(-len(grams) // 62))
    bit = F.expr("shiftleft(1L, gram % 62)")
    found = index.groupBy("key").agg(*[F.bit_or(F.when(F.floor(F.col("gram") / 62) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in words])

    def has(way: frozenset[str]) -> Column:
        need = F.lit(True)
        for w in words:
            mask = sum(1 << (place[g] % 62) for g in way if place[g] // 62 == w)
            if mask:
                need = need & (F.col(f"w{w}").bitwiseAND(F.lit(mask).cast("long")) == mask)
        return need

    each = []
    for i, r in enumerate(rules):
        holds = F.lit(True)
        for clause in trigram_query(r.pattern):
            some = F.lit(False)
            for way in clause:
                some = some | has(way)
            holds = holds & some
        each.append(F.when(holds, F.lit(i)))
    return found.select("key", F.filter(F.array(*each), lambda x: x.isNotNull()).alias("rules")).filter(F.size("rules") > 0)


def matches(text: Column, rule: Rule, kind: int) -> Column:
    """Leftmost non-overlapping matches of the rule as (start, kind, end) in codepoints, failing ones dropped."""
    whole, gaps = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    none = F.array().cast(f"array<{SPAN}>")
    each = F.arrays_zip(whole.alias("whole"), part.alias("part"), gaps.alias("gap"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        fits = F.coalesce(F.length(x["part"]), F.lit(0)) >= rule.least
        return F.struct(end.alias("at"), F.when(fits, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    walked = F.aggregate(each, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    quick = rule.pattern if rule.group else re_at_least(rule)
    return F.when(text.rlike(quick), walked).otherwise(none)


def re_at_least(rule: Rule) -> str:
    """For a rule without a group, a regex that finds a match of the least length if there is one; else the rule's own."""
    return re_least_run(rule.pattern, rule.least) or rule.pattern


def re_least_run(pattern: str, least: int) -> str | None:
    items = list(sre_parser.parse(pattern))
    if len(items) == 1 and items[0][0] is sre.MAX_REPEAT and items[0][1][0] == 1 and pattern.endswith("+"):
        return f"{pattern[:-1]}{{{least}}}"
    return None


def find(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, out_col: str = "spans") -> DataFrame:
    """docs with `spans`: array of (start, kind, end) by start, then kind as listed in rules.

    Null texts count as empty and have no spans. Rows, repeats and other columns stay as they are, but for
    one named like out_col, which is replaced. Texts are found by a SHA-256 key, so ids may be null or
    repeated. An empty table gives an empty one.
    """
    gated = tuple(r for r in rules if trigram_query(r.pattern))
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = F.array().cast(f"array<{SPAN}>")
    for i, r in enumerate(rules):
        if r not in gated:
            every = F.concat(every, matches(text, r, i))
    out = docs.withColumn("__every", every).withColumn("__key", F.sha2(text, 256))
    if gated:
        grams = grams_of(gated)
        keyed = docs.select(F.sha2(text, 256).alias("key"), text.alias("text"))
        named = cut(candidates(postings(keyed, grams), gated, grams))
        picked = named.select(F.col("key").alias("k"), "rules")
        few = named.count() <= BROADCAST_ROWS
        if few:
            picked = F.broadcast(picked)
        else:  # only texts that may be candidates are shuffled, and of copies one is verified
            keyed = sieve(keyed, "key", picked.select("k")).filter("__maybe").drop("__maybe")
        found = F.array().cast(f"array<{SPAN}>")
        for i, r in enumerate(gated):
            none = F.array().cast(f"array<{SPAN}>")
            found = F.concat(found, F.when(F.array_contains("rules", i), matches(F.col("text"), r, rules.index(r))).otherwise(none))
        chosen = keyed.join(picked, F.col("key") == F.col("k"))
        chosen = chosen if few else chosen.dropDuplicates(["key"])
        verified = chosen.select("key", found.alias("found")).filter(F.size("found") > 0)
        verified = cut(verified.groupBy("key").agg(F.max("found").alias("__found")).withColumnRenamed("key", "__k"))
        held = verified.agg(F.count("*"), F.sum(F.size("__found"))).first()
        out = beside(out, "__key", verified, "__k", held[0] + (held[1] or 0) <= BROADCAST_ROWS).withColumn("__every", F.concat("__every", F.coalesce("__found", F.array().cast(f"array<{SPAN}>"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c != out_col], F.array_sort("__every").alias(out_col))


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every span replaced by [kind]; overlapping spans give one mark, of the first. Null texts stay null."""
    names = F.array(*[F.lit(f"[{r.kind}]") for r in rules])
    text = F.col(f"`{text_col}`")

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["at"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).otherwise("")
        mark = F.when(s["start"] >= acc["at"], F.element_at(names, s["kind"] + 1)).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate("__spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    found = find(docs, text_col, rules, "__spans")
    new = F.when(F.size("__spans") > 0, done).otherwise(text)
    return found.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kinds = F.array(*[F.lit(r.kind) for r in RULES])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
