"""Metadata cells: callees, libraries and occurrences; and text clean-up."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "array<struct<name:string,library:string,occurrence:int,addr:bigint>>"
SCHEMA = f"local_funcs {ENTRY}, plt_funcs {ENTRY}, ext_funcs {ENTRY}, ro_data_ptr array<string>, rw_data_ptr array<string>, string_ptr array<struct<line:string,start_offset:int,encoding:string>>, jump_tables array<string>"
#: Category key -> call type, in the order of the result.
CATEGORIES = (("local_funcs", 0), ("plt_funcs", 1), ("ext_funcs", 2))


def parse(cell: Column) -> Column:
    return F.from_json(cell, SCHEMA)


def callees(meta: Column) -> Column:
    """Array of (name, type, library, pos): distinct names of each category in order, local, linked, external."""
    def names(key: str, kind: int) -> Column:
        entries = F.coalesce(meta[key], F.array().cast(ENTRY))
        named = F.filter(entries, lambda e: e["name"].isNotNull())
        own = F.array_distinct(F.transform(named, lambda e: e["name"]))

        def library(name: Column) -> Column:
            found = F.filter(named, lambda e: (e["name"] == name) & e["library"].isNotNull())
            return F.when(F.size(found) > 0, F.element_at(found, -1)["library"]) if kind == 2 else F.lit(None).cast("string")

        return F.transform(own, lambda n: F.struct(n.alias("name"), F.lit(kind).alias("type"), library(n).alias("library")))

    every = F.concat(*[names(k, t) for k, t in CATEGORIES])
    return F.transform(every, lambda c, i: F.struct(c["name"].alias("name"), c["type"].alias("type"), c["library"].alias("library"), i.alias("pos")))


def occurrences(meta: Column) -> Column:
    """Map of local names to their occurrence; names with conflicting ones are absent."""
    local = F.filter(F.coalesce(meta["local_funcs"], F.array().cast(ENTRY)), lambda e: e["name"].isNotNull() & e["occurrence"].isNotNull())
    pairs = F.array_distinct(F.transform(local, lambda e: F.struct(e["name"].alias("name"), e["occurrence"].alias("occurrence"))))
    single = F.filter(pairs, lambda p: F.size(F.filter(pairs, lambda q: q["name"] == p["name"])) == 1)
    return F.map_from_entries(single)


def build(meta: Column) -> Column:
    """Compact JSON without empty categories."""
    keys = [k for k, _ in CATEGORIES] + ["string_ptr"]
    return F.to_json(F.struct(*[F.when(F.size(meta[k]) > 0, meta[k]).alias(k) for k in keys]))


def backfill_occurrence(meta: Column, by_addr: Column) -> Column:
    """Local entries with the occurrence that the map address -> occurrence has for theirs."""
    entries = F.transform(meta["local_funcs"], lambda e: F.struct(e["name"].alias("name"), e["library"].alias("library"), F.coalesce(F.try_element_at(by_addr, e["addr"]), e["occurrence"]).alias("occurrence"), e["addr"].alias("addr")))
    return meta.withField("local_funcs", entries)


@F.pandas_udf(T.ArrayType(T.StringType()))
def legacy_callees(cells: pd.Series) -> pd.Series:
    """Distinct local functions of a legacy cell, a literal list of tuples with name and kind in third and fourth place; errors have none."""
    def one(cell: str | None) -> list[str]:
        try:
            rows = ast.literal_eval(cell or "[]")
            return list(dict.fromkeys(r[2] for r in rows if isinstance(r, tuple) and len(r) >= 5 and r[3] == "local_function"))
        except (ValueError, SyntaxError, TypeError, IndexError):
            return []

    return cells.map(one)


def sanitize(text: Column) -> Column:
    return F.replace(F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(" ")), "\r", ""), F.lit('"'), F.lit("'"))


def single_space(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def strip_before_pipe(text: Column) -> Column:
    """Drops the three characters before each bar."""
    return F.regexp_replace(text, r".{3}\|", "|")


def split_first_instruction(text: Column) -> Column:
    """struct(head, tail) around the first '00 |'."""
    at = F.instr(text, "00 |")
    return F.struct(F.when(at == 0, text).otherwise(F.trim(F.substring(text, F.lit(1), at - 1))).alias("head"),
                    F.when(at == 0, "").otherwise(F.trim(F.substring(text, at, F.length(text)))).alias("tail"))


def tagged_blocks(cell: Column, tag: str = "LDIS") -> Column:
    """Bar-separated blocks between the first pair of tags; null without one."""
    inner = F.regexp_extract(cell, f"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.when(cell.rlike(f"(?s)<{tag}>(.*?)</{tag}>"), F.transform(F.split(F.trim(inner), r"\|", -1), lambda b: F.trim(b)))


def instruction_tokens(text: Column, symbols: Column, strings: Column) -> Column:
    """Mnemonic and operand parts; addresses become SYMBOL, STRING or ADDRESS by the arrays of known ones."""
    parts = F.split(F.regexp_replace(F.trim(text), r"^(\S+)\s+", "$1, "), ", ", -1)
    operands = F.flatten(F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda o: F.filter(F.regexp_extract_all(o, F.lit("([0-9A-Za-z_]+|[^0-9A-Za-z_]+)"), F.lit(1)), lambda s: F.trim(s) != "")))

    def one(s: Column) -> Column:
        address = F.conv(F.substring(s, F.lit(3), F.length(s)), 16, 10).cast("long")
        kind = F.when(F.array_contains(symbols, address), "SYMBOL").when(F.array_contains(strings, address), "STRING").otherwise("ADDRESS")
        return F.when(s.rlike("^0x[0-9A-Fa-f]+$") & F.length(s).between(7, 14), kind).otherwise(s)

    return F.concat(F.slice(parts, 1, 1), F.transform(operands, one))


def broken_floats(tokens: Column, kinds: list[int]) -> Column:
    """Positions of float carriers without a digit behind them."""
    at = F.transform(tokens, lambda t, i: F.when(t.isin(kinds) & (F.coalesce(F.get(tokens, i + 1), F.lit(256)) >= 256), i))
    return F.filter(at, lambda x: x.isNotNull())


def matches_pattern(classes: Column, pattern: str) -> Column:
    """Whether a stream of one-letter token classes contains a pattern: a regex over those letters."""
    return F.array_join(classes, "").rlike(pattern)
