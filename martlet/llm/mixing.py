"""Mixing documents to target weights of domains that they belong to in part.

A softmax classifier over hashed word counts, trained on a bounded sample of a labelled table,
gives each document a posterior over the domains. Rates, how often each document is to be used
on average, then solve a least-squares problem over all documents: the expected tokens of each
domain, the sum of rate x tokens x posterior, shall equal the domain's share of the budget, with
no rate under ``least``.

Rates start at 1 and take projected-gradient steps. All rates move by the same rule, so a
document's rate is 1 plus the mean of one number per domain, weighed by its posterior, or
``least`` where that is more. A pass is one aggregate of one sum per domain over the table of
posteriors, and only these reach the driver; no rates are stored or shuffled, and a lost executor
costs nothing but its share of a pass. The steps end where the projected gradient vanishes, so
that a domain with few of the tokens is brought to its target like any other. The gap that is
left, where bounds keep targets out of reach, is part of the plan and logged.

With ``budget=None`` the budget is the smallest at which no domain has to shrink; together with
``least=1`` every document stays, and scarce domains repeat. The fraction of a rate is decided
by a hash of the document, so every run makes the same choice.

Defined results: tokens are words between white space. A document without tokens, or with a null
text, has rate 1 and its posterior is the classifier's prior. Rows without a label are mixed but
not learned from; without any label every rate is 1. Domains without a target weigh nothing.
Repeated rows have equal rates; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import logging
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import bounded_sample, fresh, own_columns
from martlet.session import materialise

BUCKETS = 1024
_CACHED_WORDS = 1 << 17
_LOOK_EVERY = 10
_LOG = logging.getLogger(__name__)


class WordCounter:
    """Hashed word counts of texts; words that come again are looked up."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def counts(self, text: str | None) -> tuple[int, np.ndarray]:
        """(tokens, log counts of the buckets scaled to length 1)."""
        words = (text or "").lower().encode("utf-8", "replace").split()
        known = self.known
        if len(known) > _CACHED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = zlib.crc32(word) % BUCKETS
        places = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        row = np.log1p(np.bincount(places, minlength=BUCKETS))
        return len(words), row / max(1e-9, np.sqrt(row @ row))


@dataclass(frozen=True)
class DomainModel:
    """Softmax weights; one column for each domain."""

    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, rows: np.ndarray) -> np.ndarray:
        if not self.domains:
            return np.zeros((len(rows), 0))
        logits = rows @ self.weights + self.bias
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit_domains(rows: np.ndarray, labels: list[str], rounds: int = 300) -> DomainModel:
    """Softmax regression by accelerated gradient steps with a small ridge penalty."""
    domains = sorted(set(labels))
    truth = np.eye(len(domains))[[domains.index(label) for label in labels]]
    given = np.hstack([rows, np.ones((len(rows), 1))])
    weights = np.zeros((given.shape[1], len(domains)))
    look, before = weights.copy(), weights
    for number in range(rounds):
        logits = given @ look
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        slope = given.T @ (e / e.sum(axis=1, keepdims=True) - truth) / len(rows) + 1e-5 * look
        before, weights = weights, look - 1.0 * slope
        look = weights + number / (number + 3) * (weights - before)
    return DomainModel(domains, weights[:-1], weights[-1])


def train_domain_model(
    labelled: DataFrame,
    *,
    per_domain: int = 300,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
) -> DomainModel:
    """Fit on at most ``per_domain`` rows of each domain of a labelled table."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"),
        F.col(id_col).alias("key"),
        F.col(text_col).alias("text"),
    )

    @F.pandas_udf("array<double>")
    def counted(texts: pd.Series) -> pd.Series:
        counter = WordCounter()
        return pd.Series([counter.counts(text)[1] for text in texts], dtype=object)

    sample = bounded_sample(rows, "label", "key", per_domain)
    read = sample.select("label", counted("text").alias("row")).orderBy("label", "row").toPandas()
    if read.empty:
        return DomainModel([], np.zeros((BUCKETS, 0)), np.zeros(0))
    return fit_domains(np.stack(read["row"].to_numpy()), read["label"].tolist())


def memberships(text: Column, model: DomainModel) -> Column:
    """``struct<n_tokens, posterior>`` of a text column."""

    @F.pandas_udf("n_tokens long, posterior array<double>")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = WordCounter()
        for batch in batches:
            tokens, found = [], []
            for start in range(0, len(batch), 256):
                some = [counter.counts(text) for text in batch.iloc[start : start + 256]]
                tokens += [n for n, _ in some]
                found += list(model.posteriors(np.stack([row for _, row in some])))
            yield pd.DataFrame({"n_tokens": tokens, "posterior": pd.Series(found, dtype=object)})

    return classify.asNondeterministic()(text)


@dataclass(frozen=True)
class MixingPlan:
    """What turns a posterior into a rate: one slope for each domain.

    ``gap`` is what the domains' expected tokens have above their targets, as a share of the
    budget; ``optimal`` says whether the projected gradient vanishes, so that no rates do better.
    """

    domains: list[str]
    least: float
    slopes: np.ndarray
    gap: np.ndarray
    optimal: bool = True
    passes: int = 0

    @property
    def start(self) -> float:
        return max(1.0, self.least)

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        if not self.domains:
            return np.full(len(posteriors), self.start)
        return np.maximum(self.least, self.start + posteriors @ self.slopes)

    def column(self, tokens: Column, posterior: Column) -> Column:
        """The rate of a document."""
        if not self.domains:
            return F.lit(1.0)
        rate = F.greatest(F.lit(float(self.least)), self.start + _moved(posterior, self.slopes))
        return F.when(tokens > 0, rate).otherwise(1.0)


def _moved(posterior: Column, slopes: np.ndarray) -> Column:
    """How far the slopes move a document's rate before the bound."""
    return sum((posterior[i] * float(slope) for i, slope in enumerate(slopes)), F.lit(0.0))


def _expected(members: DataFrame, slopes: np.ndarray, start: float, least: float) -> np.ndarray:
    """The domains' expected tokens at some slopes: one pass, one number per domain."""
    rate = F.greatest(F.lit(float(least)), start + _moved(F.col("posterior"), slopes))
    rated = members.where(F.col("n_tokens") > 0).withColumn("_used", F.col("n_tokens") * rate)
    sums = [F.sum(F.col("_used") * F.col("posterior")[i]).alias(f"s{i}") for i in range(len(slopes))]
    return np.array([s or 0.0 for s in rated.agg(*sums).first()], dtype=float)


def _steepest(
    members: DataFrame, slopes: np.ndarray, gap: np.ndarray, start: float, least: float
) -> float:
    """The largest projected gradient of all documents: what moving a single rate could still do.

    A rate at its bound can only rise.
    """
    rate = start + _moved(F.col("posterior"), slopes)
    slope = _moved(F.col("posterior"), gap)
    left = F.when(rate > least, F.abs(slope)).otherwise(F.greatest(F.lit(0.0), -slope))
    return members.where(F.col("n_tokens") > 0).agg(F.max(left)).first()[0] or 0.0


def fit_rates(
    members: DataFrame,
    domains: list[str],
    targets: dict[str, float],
    *,
    least: float = 0.0,
    budget: float | None = None,
    tolerance: float = 0.002,
    most_steps: int | None = None,
) -> MixingPlan:
    """Projected gradient over ``members`` (``n_tokens, posterior``) to the least-squares optimum.

    A step moves every rate against its gradient, the mean gap of the document's domains; as all
    rates move by the same rule, the sum of the steps is one number per domain, and a rate is
    held to its bound when it is read. Steps have momentum, which is dropped whenever it points
    uphill. Each domain's step is scaled by its tokens, so scarce domains move as fast as others.

    With ``close`` for ``tolerance`` of the smallest target's tokens, the steps end where no
    document's projected gradient is over ``close``. Where bounds keep a gap open, that needs
    equal steps for all domains: after some steps without gain, these are taken. Only
    ``most_steps``, or numbers too fine for a double, end them before; ``optimal`` then is false.
    """
    size = len(domains)
    wanted = np.array([max(0.0, targets.get(domain, 0.0)) for domain in domains])
    nothing = MixingPlan([], least, np.zeros(0), np.zeros(0))
    if not size or not wanted.sum():
        return nothing
    wanted = wanted / wanted.sum()
    start = nothing.start
    expected, passes = _expected(members, np.zeros(size), start, least), 1
    present = expected / start
    if not present.sum():
        return nothing
    if budget is None:
        budget = max(present[i] / wanted[i] for i in range(size) if wanted[i])
    wanted, close = wanted * budget, tolerance * budget * wanted[wanted > 0].min()

    scale = 1 / np.maximum(present, 1e-9 * present.sum())
    at = before = look = np.zeros(size)
    gap, optimal, speed = expected - wanted, False, 1.0
    least_gap, stale, steps = np.inf, 0, 0
    while most_steps is None or steps < most_steps:
        largest = np.abs(gap).max()
        stale = 0 if largest < 0.9 * least_gap else stale + 1
        least_gap = min(largest, least_gap)
        if largest <= close:
            optimal = True
        elif stale % _LOOK_EVERY == _LOOK_EVERY - 1:
            # A gap that does not shrink may be one that bounds keep open.
            optimal = _steepest(members, look, gap, start, least) <= close
            passes += 1
        if optimal:
            break
        if stale == _LOOK_EVERY:
            scale = np.full(size, 1 / present.max())
            at, before, speed = look, look, 1.0
        before, at = at, look - scale * gap
        if np.array_equal(at, look):
            break
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        if gap @ (at - before) > 0:
            speed = faster = 1.0
        look = at + (speed - 1) / faster * (at - before)
        speed = faster
        gap = _expected(members, look, start, least) - wanted
        passes, steps = passes + 1, steps + 1
    plan = MixingPlan(domains, least, look, gap / budget, optimal, passes)
    if not optimal or np.abs(gap).max() > close:
        missed = {domain: round(float(g), 6) for domain, g in zip(domains, gap / budget, strict=True)}
        why = "nearest possible" if optimal else "steps ended early"
        _LOG.warning("targets missed (%s), by shares of the budget: %s", why, missed)
    return plan


def copies(rate: Column, *key: Column) -> Column:
    """How often a document is used: its rate, the fraction decided by a hash of the key."""
    draw = F.pmod(F.xxhash64(F.lit(77), *key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor(rate)
    return whole + F.when(draw < rate - whole, 1).otherwise(0)


def mixing_rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    *,
    least: float = 0.0,
    budget: float | None = None,
    per_domain: int = 300,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
) -> DataFrame:
    """``doc_id, n_tokens, domain, posterior, rate, copies``; ``domain`` is the likeliest one."""
    model, members = _members(
        docs, labelled, per_domain=per_domain, id_col=id_col, text_col=text_col, label_col=label_col
    )
    plan = fit_rates(members, model.domains, targets, least=least, budget=budget)
    names = F.array(*map(F.lit, model.domains)) if model.domains else F.array().cast("array<string>")
    likeliest = F.array_position("posterior", F.array_max("posterior")).cast("int")
    rated = members.withColumn("rate", plan.column(F.col("n_tokens"), F.col("posterior")))
    return rated.select(
        F.col("id").alias(id_col),
        "n_tokens",
        F.try_element_at(names, likeliest).alias("domain"),
        "posterior",
        "rate",
        copies(F.col("rate"), F.col("id"), F.col("text_hash")).cast("long").alias("copies"),
    )


def _members(
    docs: DataFrame, labelled: DataFrame, *, per_domain: int, id_col: str, text_col: str, label_col: str
) -> tuple[DomainModel, DataFrame]:
    model = train_domain_model(
        labelled, per_domain=per_domain, id_col=id_col, text_col=text_col, label_col=label_col
    )
    found = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        memberships(F.col(text_col), model).alias("m"),
    )
    return model, materialise(found.select("id", "text_hash", "m.*"))


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    *,
    least: float = 0.0,
    budget: float | None = None,
    per_domain: int = 300,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` as often as their rates say, with all their columns."""
    model = train_domain_model(
        labelled, per_domain=per_domain, id_col=id_col, text_col=text_col, label_col=label_col
    )
    member, times, copy = fresh(docs, "_member", "_times", "_copy")
    # Written with its rows, so that every text is classified once.
    judged = materialise(docs.withColumn(member, memberships(F.col(text_col), model)))
    plan = fit_rates(
        judged.select(f"{member}.n_tokens", f"{member}.posterior"),
        model.domains,
        targets,
        least=least,
        budget=budget,
    )
    rate = plan.column(F.col(f"{member}.n_tokens"), F.col(f"{member}.posterior"))
    often = copies(rate, F.col(id_col), F.xxhash64(text_col)).cast("int")
    used = judged.withColumn(times, often).where(F.col(times) > 0)
    each = used.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return each.select(*own_columns(docs))
