"""Quality classifier: a sparse ensemble of rules over statistics of the whole text.

Shallow trees are grown on resampled labelled rows. Every path from a root is a rule, a
conjunction of comparisons on the statistics. A lasso-penalised logistic regression gives the
rules weights, most of them zero; what is left is compiled into one Spark column expression.

Statistics are taken in Arrow batches over whole texts and kept as a narrow table, which both
the training sample and the scores are read from. Learning uses at most ``per_class`` labelled
rows of each class, weighted back to the classes' true shares; trees and weights are fitted in
numpy on the driver.

Defined results: a null text has the statistics of the empty text; empty texts are scored like
any other. Without labelled rows of both classes the score is the share of class 1 among those
known, or 0.5. Labels whose value or key is null are not learned from. Repeated rows get equal
scores; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import bounded_sample
from martlet.llm.linear import fit_lasso, logistic
from martlet.session import materialise

STATISTICS = (
    "chars",
    "words",
    "mean_word",
    "longest_word",
    "upper_share",
    "digit_share",
    "mark_share",
    "symbol_share",
    "other_share",
    "distinct_words",
    "top_word",
    "longest_run",
    "same_neighbour",
    "distinct_lines",
    "line_words",
    "short_lines",
    "symbol_words",
    "upper_words",
    "sentence_words",
    "byte_entropy",
)
_LETTERS = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_MARKS = np.isin(np.arange(256), [ord(c) for c in ".,;:'\"?-"])
_DIGITS = np.isin(np.arange(256), [ord(c) for c in "0123456789"])
_UPPER = np.isin(np.arange(256), [ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
_SYMBOLS = np.array([33 <= i < 127 for i in range(256)]) & ~_LETTERS & ~_MARKS & ~_DIGITS
_SYMBOL_BYTES = frozenset(np.flatnonzero(_SYMBOLS).tolist())


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    data = (text or "").encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lines = data.split(b"\n")
    n, size = max(1, len(words)), max(1, len(data))
    sizes = list(map(len, words))
    common = Counter(words)
    run = longest = same = 0
    for before, word in zip(words, words[1:], strict=False):
        run = run + 1 if word == before else 0
        same += run > 0
        longest = max(longest, run)
    share = counts[counts > 0] / size
    ends = int(counts[ord(".")])
    return [
        math.log1p(len(data)),
        math.log1p(len(words)),
        sum(sizes) / n,
        math.log1p(max(sizes, default=0)),
        float(counts[_UPPER].sum()) / size,
        float(counts[_DIGITS].sum()) / size,
        float(counts[_MARKS].sum()) / size,
        float(counts[_SYMBOLS].sum()) / size,
        float(counts[128:].sum()) / size,
        len(common) / n,
        max(common.values(), default=0) / n,
        longest / n,
        same / n,
        len(set(lines)) / len(lines),
        math.log1p(len(words) / len(lines)),
        sum(len(line) < 20 for line in lines) / len(lines),
        sum(word[-1] in _SYMBOL_BYTES for word in words) / n,
        sum(map(bytes.isupper, words)) / n,
        math.log1p(len(words) / (ends + 1)),
        float(-(share * np.log2(share)).sum()) if len(data) else 0.0,
    ]


def with_statistics(text: Column) -> Column:
    """A struct of the statistics of a text column."""

    @F.pandas_udf(", ".join(f"{name} double" for name in STATISTICS))
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [statistics(text) for text in batch]
            yield pd.DataFrame(rows, columns=STATISTICS, dtype="float64")

    return measured.asNondeterministic()(text)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, threshold); above means greater, else at most."""

    terms: tuple[tuple[str, bool, float], ...]

    def holds(self, values: np.ndarray) -> np.ndarray:
        found = np.ones(len(values), bool)
        for name, above, threshold in self.terms:
            column = values[:, STATISTICS.index(name)]
            found &= column > threshold if above else column <= threshold
        return found

    def column(self) -> Column:
        found = F.lit(True)
        for name, above, threshold in self.terms:
            found = found & (F.col(name) > threshold if above else F.col(name) <= threshold)
        return found


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; the score is the logistic function of their sum."""

    bias: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def scores(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.bias)
        for rule, weight in self.weights.items():
            total += weight * rule.holds(values)
        return logistic(total)

    def column(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.weights.items():
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def grow_rules(
    values: np.ndarray,
    target: np.ndarray,
    weight: np.ndarray,
    *,
    trees: int = 24,
    depth: int = 3,
    seed: int = 3,
) -> list[Rule]:
    """The distinct paths of shallow trees on resampled rows and random statistics."""
    rng = np.random.default_rng(seed)
    rules: dict[tuple, Rule] = {}
    for _ in range(trees):
        rows = rng.choice(len(values), len(values), p=weight / weight.sum())
        picked = rng.choice(values.shape[1], max(4, values.shape[1] // 2), replace=False)
        stack = [(rows, ())]
        while stack:
            rows, path = stack.pop()
            if path:
                terms = _tightest(path)
                rules.setdefault(terms, Rule(terms))
            split = _best_split(values[rows], target[rows], picked) if len(path) < depth else None
            if split is None:
                continue
            axis, threshold = split
            above = values[rows, axis] > threshold
            for side, some in ((True, rows[above]), (False, rows[~above])):
                stack.append((some, (*path, (STATISTICS[axis], side, threshold))))
    return list(rules.values())


def _tightest(path: tuple) -> tuple:
    """The same conjunction with one bound for each statistic and direction."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, above, threshold in path:
        key, pick = (name, above), max if above else min
        bounds[key] = pick(threshold, bounds.get(key, threshold))
    return tuple(sorted((name, above, value) for (name, above), value in bounds.items()))


def _best_split(
    values: np.ndarray, target: np.ndarray, picked: np.ndarray, least: int = 10
) -> tuple[int, float] | None:
    """The (statistic, threshold) that lowers the Gini impurity most; thresholds are quantiles."""
    n, ones = len(target), target.sum()
    if n < 2 * least or ones in (0, n):
        return None
    best, found = 2 * ones * (n - ones) / n - 1e-9, None
    for axis in picked:
        column = values[:, axis]
        cuts = np.unique(np.quantile(column, np.linspace(0.01, 0.99, 33)))
        for cut in (cuts[:-1] + cuts[1:]) / 2:
            above = column > cut
            up, up_ones = above.sum(), target[above].sum()
            if up < least or n - up < least:
                continue
            down, down_ones = n - up, ones - up_ones
            impurity = 2 * up_ones * (up - up_ones) / up + 2 * down_ones * (down - down_ones) / down
            if impurity < best:
                best, found = impurity, (int(axis), float(cut))
    return found


def fit_rules(
    values: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 0.0005
) -> RuleModel:
    """Grow rules, weigh them, keep those with a weight."""
    share = float(weight @ target / weight.sum()) if len(target) else 0.5
    if share in (0.0, 1.0) or not len(target):
        return RuleModel(math.log((share + 1e-6) / (1 - share + 1e-6)))
    rules = grow_rules(values, target, weight)
    held = np.stack([rule.holds(values) for rule in rules], axis=1).astype(float)
    # Rules that hold for the same rows are one rule; the shortest speaks for them.
    order = sorted(range(len(rules)), key=lambda i: (len(rules[i].terms), rules[i].terms))
    distinct = list({held[:, i].tobytes(): i for i in reversed(order)}.values())
    bias, weights = fit_lasso(held[:, distinct], target, weight, penalty)
    kept = {rules[i]: float(w) for i, w in zip(distinct, weights, strict=True) if abs(w) > 1e-6}
    return RuleModel(bias, kept)


def train_quality_model(
    measured: DataFrame, labels: DataFrame, *, per_class: int = 6000, key: str = "id"
) -> RuleModel:
    """Fit on at most ``per_class`` rows of each class of ``labels`` (``key, label``)."""
    known = labels.where(F.col(key).isNotNull() & F.col("label").isin(0, 1))
    totals = dict(known.groupBy("label").count().collect())
    drawn = bounded_sample(known.select(key, "label"), "label", key, per_class)
    rows = measured.where(F.col(key).isNotNull()).join(drawn, key)
    sample = rows.orderBy(key, "label", *STATISTICS).toPandas()
    target = sample["label"].to_numpy(np.float64)
    found = Counter(target.tolist())
    weight = np.array([totals[int(t)] / found[t] for t in target])
    return fit_rules(sample[list(STATISTICS)].to_numpy(np.float64), target, weight)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    held_out: Column,
    threshold: float = 0.7,
    per_class: int = 6000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; held-out rows teach nothing."""
    measured = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            held_out.alias("held_out"),
            with_statistics(F.col(text_col)).alias("s"),
        ).select("id", "held_out", "s.*")
    )
    taught = labels.where(~held_out).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    model = train_quality_model(measured, taught, per_class=per_class)
    scored = measured.select(F.col("id").alias(id_col), "held_out", model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
