"""Quality classifier: a sparse ensemble of conjunctive rules, compiled into Spark columns.

Shallow trees are boosted on statistics of labelled texts; every path of theirs is a rule; an
L1-penalised logistic regression weights the rules, most of them with zero; the rest become one
column expression over the statistics.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.text_stats import with_stats

#: At most so many labelled texts are fitted, those of least hashed id; they are all that reaches the driver.
SAMPLE = 20_000
TREES, DEPTH, CUTS, LEAST_LEAF = 40, 3, 24, 20
STEPS, PENALTY = 400, 4e-4

#: Feature -> (numerator, denominator); a text without the denominator has 0.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"), "marks_per_word": ("n_marks", "n_words"), "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"), "repeats_per_word": ("n_repeat_words", "n_words"), "distinct_per_word": ("n_distinct", "n_words"),
    "dups_per_line": ("n_dup_lines", "n_lines"), "chars_per_word": ("word_chars", "n_words"), "stops_per_word": ("n_stops", "n_words"),
    "words_per_line": ("n_words", "n_lines"), "words": ("n_words", None),
}


def features() -> list[Column]:
    def one(top: str, bottom: str | None) -> Column:
        x = F.col(f"stats.{top}").cast("double")
        return x if bottom is None else F.when(F.col(f"stats.{bottom}") > 0, x / F.col(f"stats.{bottom}")).otherwise(0.0)

    return [one(*v).alias(k) for k, v in FEATURES.items()]


@dataclass(frozen=True)
class Rule:
    """All of (feature, above, threshold): the value is above the threshold, or else at most it."""

    parts: tuple[tuple[str, bool, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return reduce(operator.and_, [(x[f] > t) == above for f, above, t in self.parts])

    def column(self) -> Column:
        return reduce(operator.and_, [(F.col(f) > t) if above else (F.col(f) <= t) for f, above, t in self.parts])


def _grow(x: dict[str, np.ndarray], cuts: dict[str, np.ndarray], y: np.ndarray, rows: np.ndarray, path: tuple, found: list[Rule], out: np.ndarray) -> None:
    """A regression tree on y; adds the rule of every node below the root, and writes leaf means to out."""
    best = (1e-9, None, 0.0)
    if len(path) < DEPTH and len(rows) >= 2 * LEAST_LEAF:
        own, total = y[rows], y[rows].sum()
        for f, points in cuts.items():
            side = np.searchsorted(points, x[f][rows], side="left")
            n = np.cumsum(np.bincount(side, minlength=len(points) + 1))[:-1]
            s = np.cumsum(np.bincount(side, weights=own, minlength=len(points) + 1))[:-1]
            m = len(rows) - n
            gain = np.where((n >= LEAST_LEAF) & (m >= LEAST_LEAF), s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(m, 1) - total**2 / len(rows), -1)
            k = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (float(gain[k]), f, float(points[k]))
    if best[1] is None:
        out[rows] = y[rows].mean() if len(rows) else 0
        return
    _, f, t = best
    above = x[f][rows] > t
    for yes in (False, True):
        part = (*path, (f, yes, t))
        found.append(Rule(part))
        _grow(x, cuts, y, rows[above == yes], part, found, out)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: dict[str, np.ndarray], y: np.ndarray, seed: int = 3) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and the weighted rules. With fewer than two classes: the intercept alone."""
    prior = float(np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98))
    base = float(np.log(prior / (1 - prior)))
    if len(y) == 0 or y.min() == y.max():
        return base, []
    rng = np.random.default_rng(seed)
    cuts = {f: np.unique(np.quantile(v, np.linspace(0.01, 0.99, CUTS))) for f, v in x.items()}
    z, rules = np.full(len(y), base), []
    for _ in range(TREES):
        rows = np.sort(rng.choice(len(y), size=max(1, len(y) // 2), replace=False))
        step = np.zeros(len(y))
        grown: list[Rule] = []
        _grow(x, cuts, y - _sigmoid(z), rows, (), grown, step)
        z = z + 2.0 * step
        rules += grown
    rules = list(dict.fromkeys(rules))
    if not rules:
        return base, []
    r = np.column_stack([rule.holds(x) for rule in rules]).astype(np.float64)
    _, first = np.unique(r, axis=1, return_index=True)
    rules, r = [rules[i] for i in sorted(first)], r[:, sorted(first)]
    mean = r.mean(axis=0)
    c = r - mean
    rate = 4 / max(np.linalg.norm(c, 2) ** 2 / len(y), 1e-9)
    w, b, v, t = np.zeros(r.shape[1]), base, np.zeros(r.shape[1]), 1.0
    for _ in range(STEPS):  # accelerated proximal gradient
        error = _sigmoid(b + c @ v) - y
        new = v - rate * (c.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        b -= error.mean()
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / u * (new - w), new, u
    return float(b - w @ mean), [(rule, float(a)) for rule, a in zip(rules, w, strict=True) if a != 0]


def compile_score(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    z = reduce(operator.add, [F.when(rule.column(), w).otherwise(0.0) for rule, w in rules], F.lit(intercept))
    return 1 / (1 + F.exp(-z))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> tuple[float, list[tuple[Rule, float]]]:
    """Fits on the labelled rows of docs that aren't held out. Contradicting labels of an id: the lower one."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).withColumnRenamed("doc_id", "__id")
    texts = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select("y", "text")
    got = with_stats(texts, "text", ["y"]).select("y", *features()).toPandas()
    got = got.sort_values(list(got.columns))
    return fit({f: got[f].to_numpy(dtype=float) for f in FEATURES}, got["y"].to_numpy(dtype=float))


def score(docs: DataFrame, labels: DataFrame, cut_at: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Scores depend on the text alone: null and empty texts have all statistics zero and the score of
    that. Null ids are not held out. Without labels of both kinds every score is the same.
    """
    value = compile_score(*train(docs, labels))
    rows = with_stats(docs, "text", ["doc_id"]).select("doc_id", *features()).select("doc_id", held_out().alias("held_out"), value.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= cut_at).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
