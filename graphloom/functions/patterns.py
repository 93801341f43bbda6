"""Patterns over typed tokens: sequence, ordered choice, maybe, one or more, lookahead, with captures.

A row's tokens become one text, each token as its kind and value between control characters; a pattern compiles to
a regular expression of atomic groups and possessive repeats, which Spark runs in the JVM. So a part that has matched
is never tried in another way: of the alternatives the first that matches counts, and repeats take all they can.
A pattern matches a row if it consumes all of its tokens.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Between kind and value of a token, and behind it. Kinds and values don't hold them: they become U+FFFD.
MIDDLE, END = "\x1f", "\x1e"


@dataclass(frozen=True)
class Pattern:
    """regex: of the pattern, without a choice outside of groups; names: of its captures, in order."""

    regex: str
    names: tuple[str, ...] = ()

    def __add__(self, other: Pattern) -> Pattern:
        return sequence(self, other)

    def __or__(self, other: Pattern) -> Pattern:
        return either(self, other)


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() and c.isascii() else f"\\x{{{ord(c):x}}}" for c in text)


def token(kind: str | None = None, value: str | None = None, name: str | None = None) -> Pattern:
    """One token, of any kind and value that aren't given. name: captures its value."""
    if name is not None and not re.fullmatch(r"[A-Za-z]\w*", name):
        raise ValueError(f"{name!r} is no name of a capture")
    left = f"[^{MIDDLE}]*+" if kind is None else _quoted(kind)
    right = f"[^{END}]*+" if value is None else _quoted(value)
    return Pattern(f"{left}{MIDDLE}{right if name is None else f'({right})'}{END}", () if name is None else (name,))


def _names(parts: Sequence[Pattern]) -> tuple[str, ...]:
    names = tuple(n for p in parts for n in p.names)
    if len(set(names)) < len(names):
        raise ValueError(f"captures of one name: {names}")
    return names


def sequence(*parts: Pattern) -> Pattern:
    """All parts, one behind the other; none: matches nothing at all, and always."""
    return Pattern(f"(?>{''.join(p.regex for p in parts)})", _names(parts))


def either(*parts: Pattern) -> Pattern:
    """The first part that matches."""
    if len(parts) < 2:
        raise ValueError("a choice needs two parts")
    return Pattern(f"(?>{'|'.join(p.regex for p in parts)})", _names(parts))


def maybe(part: Pattern) -> Pattern:
    return Pattern(f"(?>{part.regex})?+", part.names)


def some(part: Pattern) -> Pattern:
    """One or more, as many as there are. A capture holds what the last of them has."""
    return Pattern(f"(?>{part.regex})++", part.names)


def ahead(part: Pattern) -> Pattern:
    """The part comes next, and isn't consumed."""
    return Pattern(f"(?={part.regex})", part.names)


def as_text(tokens: Column) -> Column:
    """tokens: an array of structs with kind and value (strings; null counts as empty)."""
    def clean(c: Column) -> Column:
        return F.translate(F.coalesce(c, F.lit("")), MIDDLE + END, "��")

    return F.array_join(F.transform(tokens, lambda t: F.concat(clean(t["kind"]), F.lit(MIDDLE), clean(t["value"]), F.lit(END))), "")


def _whole(pattern: Pattern) -> str:
    return rf"\A(?>{pattern.regex})\z"


def matches(text: Column, pattern: Pattern) -> Column:
    """Whether the tokens (as_text) are the pattern. Null for null."""
    return text.rlike(_whole(pattern))


def captured(text: Column, pattern: Pattern) -> Column:
    """A struct of the captures of a match; empty where a capture took no part; null without a match."""
    if not pattern.names:
        raise ValueError("the pattern captures nothing")
    whole = _whole(pattern)
    return F.when(text.rlike(whole), F.struct(*[F.regexp_extract(text, whole, i + 1).alias(n) for i, n in enumerate(pattern.names)]))


def first_rule(text: Column, rules: dict[str, Pattern]) -> Column:
    """Name of the first rule that the tokens are; null if none."""
    return F.coalesce(*[F.when(matches(text, p), F.lit(name)) for name, p in rules.items()])
