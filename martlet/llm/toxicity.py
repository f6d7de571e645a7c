"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. A lexicon of words and word beginnings is mined from a bounded sample of labelled rows. Tokens
   that the same documents hold are one entry. Of the entries that (nearly) only toxic documents
   hold, all are kept whose number is so much larger than chance would give for so frequent
   entries that at most ``false_share`` of them are chance; neither a length of the list nor a
   share of the documents bounds it.
2. Voters read whole texts. The strongest entries vote toxic each where it occurs; the others do
   so in pools of about equal strength, as one rare word has too few votes to judge it by.
   Patterns vote on what the entries do together (several close to each other, many for the
   length, several different ones) or clean where none occurs. Entries that are there by chance
   look pure in the sample they were mined from; clean rows are given the hits of theirs that
   other clean documents will have.
3. A generative model with the true label hidden estimates by expectation and maximisation how
   often each voter is right where it votes. Voters whose votes go together within a label are
   correlated and must not count twice: a voter's weight is one over the sum of the variance
   that it shares with all voters.
4. A lasso-penalised logistic regression learns the posterior labels from counts of the same
   entries, and scores every whole text in Arrow batches.

Labels serve the mining and the sample's shares; the classifier only sees posterior labels.

Defined results: a null text is scored like the empty one. Without a toxic and a clean labelled
row nothing can be learned, and every score is 0. Labels whose value or key is null are not
learned from. Words are runs of letters, digits and underscores in lower case. Repeated rows get
equal scores; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import bounded_sample
from martlet.llm.linear import fit_lasso, logistic
from martlet.session import materialise

_WORD = re.compile(r"\w+")
_PREFIXES = (3, 4, 5, 6, 7, 8)
_CACHED_WORDS = 1 << 18
_NEAR = 12
PATTERNS = ("any", "hits", "distinct", "density", "close", "words")
_HALF = 0.5 - 1e-9


def tokens_of(word: str) -> list[str]:
    """A word and its beginnings; a beginning is marked by a star."""
    return [word, *(f"{word[:n]}*" for n in _PREFIXES if len(word) > n)]


@dataclass(frozen=True)
class Lexicon:
    """Entries, each a list of tokens that the same documents hold, and the columns they count in.

    ``chance`` is, per column, how many hits a clean document has by entries that mean nothing.
    """

    entries: list[list[str]]
    column: list[int]
    chance: list[float]

    @staticmethod
    def of(*tokens: str) -> Lexicon:
        """One entry and column for each token."""
        return Lexicon([[t] for t in tokens], list(range(len(tokens))), [0.0] * len(tokens))

    @property
    def columns(self) -> int:
        return len(self.chance)


@dataclass
class Reader:
    """Finds lexicon entries in texts."""

    lexicon: Lexicon

    def __post_init__(self) -> None:
        self.places, self.entry, self.share = {}, [], []
        for entry, tokens in enumerate(self.lexicon.entries):
            for token in tokens:
                self.places[token] = len(self.entry)
                self.entry.append(entry)
                self.share.append(1 / len(tokens))
        self.known: dict[str, tuple] = {}

    def found(self, word: str) -> tuple:
        """(tokens that a word is or begins with, entries of which it is half of the tokens)."""
        if (known := self.known.get(word)) is None:
            places = self.places
            tokens = tuple(places[t] for t in tokens_of(word) if t in places)
            shares: Counter[int] = Counter()
            for token in tokens:
                shares[self.entry[token]] += self.share[token]
            known = tokens, tuple(e for e, share in shares.items() if share >= _HALF)
            if len(self.known) >= _CACHED_WORDS:
                self.known.clear()
            self.known[word] = known
        return known

    def features(self, text: str | None) -> np.ndarray:
        """The patterns' measures, then per column its entries' counts, as log(1 + n)."""
        counts: Counter[int] = Counter()
        words = _WORD.findall((text or "").lower())
        hits, close, last, entries, found = 0, 0, None, set(), self.found
        for at, word in enumerate(words):
            tokens, whole = found(word)
            if tokens:
                counts.update(tokens)
                if whole:
                    hits += 1
                    entries.update(whole)
                    close += last is not None and at - last <= _NEAR
                    last = at
        row = np.zeros(len(PATTERNS) + self.lexicon.columns)
        row[: len(PATTERNS)] = _patterns(hits, len(entries), len(words), close)
        for token, count in counts.items():
            column = self.lexicon.column[self.entry[token]]
            row[len(PATTERNS) + column] += self.share[token] * math.log1p(count)
        return row


def _patterns(hits: float, distinct: float, words: int, close: float) -> tuple:
    density = 100 * hits / max(20, words)
    return (hits > 0, math.log1p(hits), distinct, math.log1p(density), close > 0, words)


def votes(features: np.ndarray) -> np.ndarray:
    """One column for each voter: 1 toxic, -1 clean, 0 abstains."""
    hits, distinct, density, close = (features[:, i] for i in range(1, 5))
    entries = features[:, len(PATTERNS) :] >= _HALF * math.log(2)
    patterns = [
        close > 0,
        distinct >= 3,
        density > math.log1p(1.0),
        hits > math.log1p(2),
        -(hits == 0).astype(int),
        -(density < math.log1p(0.1)).astype(int),
    ]
    return np.hstack([entries.astype(int), np.stack(patterns, axis=1).astype(int)])


@dataclass(frozen=True)
class LabelModel:
    """Voters' log odds of being right where they vote, their weights, and the prior."""

    prior: float
    odds: np.ndarray
    weights: np.ndarray

    def posterior(self, given: np.ndarray) -> np.ndarray:
        """Probability of toxic; a voter that abstains says nothing."""
        return logistic(
            math.log(self.prior / (1 - self.prior)) + given @ (self.odds * self.weights)
        )


def _own_shares(errors: np.ndarray) -> np.ndarray:
    """One over the sum of the variance that each voter shares with all voters."""
    cross = errors.T @ errors / len(errors) + 1e-6 * np.eye(errors.shape[1])
    spread = np.sqrt(np.diag(cross))
    return 1 / ((cross / np.outer(spread, spread)) ** 2).sum(axis=1)


def fit_label_model(given: np.ndarray, prior: float, rounds: int = 50) -> LabelModel:
    """Accuracies and correlations of voters, the true labels unknown but for their balance.

    The first guess is the majority of the votes, each weighted by what it does not share with
    other voters. A voter's accuracy is the share of its votes that agree with the label; its
    correlations are those of its votes with other voters' votes among documents of one likely
    label.
    """
    prior = float(np.clip(prior, 0.02, 0.98))
    votes_cast = given.astype(float)
    weights = _own_shares(votes_cast - votes_cast.mean(axis=0))
    toxic = 0.5 + 0.48 * np.sign(votes_cast @ weights)
    cast = np.abs(given).sum(axis=0)
    model = None
    for _ in range(rounds):
        right = (given > 0).T @ toxic + (given < 0).T @ (1 - toxic)
        accuracy = np.clip((right + 0.7) / (cast + 1), 0.02, 0.98)
        errors = votes_cast.copy()
        for some in (toxic >= 0.5, toxic < 0.5):
            errors[some] -= errors[some].mean(axis=0) if some.any() else 0
        model = LabelModel(prior, np.log(accuracy / (1 - accuracy)), _own_shares(errors))
        after = model.posterior(given)
        if np.abs(after - toxic).max() < 1e-4:
            break
        toxic = after
    return model


@dataclass(frozen=True)
class ToxicityModel:
    """The classifier; without a lexicon it knows nothing and scores 0."""

    lexicon: Lexicon
    bias: float
    weights: np.ndarray

    def scores(self, texts: list[str | None], reader: Reader) -> np.ndarray:
        if not self.lexicon.entries:
            return np.zeros(len(texts))
        total = [self.bias + self.weights @ reader.features(text) for text in texts]
        return logistic(np.array(total, dtype=float))


def _counted(sample: DataFrame) -> DataFrame:
    """``token, toxic, clean, mark``: documents of each kind, and a hash of which they are.

    Tasks count documents per token before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        marks: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            every = list(marks)
            clean, toxic = ([some[t] for t in every] for some in found)
            columns = every, toxic, clean, [marks[t] for t in every]
            for some in (*found, marks):
                some.clear()
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, t) for v, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["token", "toxic", "clean", "mark"])

        for batch in batches:
            for text, label, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = {t for word in set(_WORD.findall((text or "").lower())) for t in tokens_of(word)}
                found[label].update(tokens)
                for token in tokens:
                    marks[token] = marks.get(token, 0) ^ mark
                if len(marks) > 200_000:
                    yield flush()
        yield flush()

    rows = sample.select("text", "label", F.xxhash64(*sample.columns).alias("mark"))
    counted = rows.mapInArrow(count, "token string, toxic long, clean long, mark long")
    return counted.groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_xor("mark").alias("mark")
    )


def _false_shares(cells: list[tuple[int, int, int]], chance: float, purity: float) -> dict:
    """Per pure (toxic, clean) count of documents, the share of such entries that chance explains.

    ``cells`` has (toxic, clean, entries). Of the entries that n documents hold, chance makes
    as many as toxic as the binomial tail says; what is found beyond that number is meant.
    """
    by_size: dict[int, Counter] = {}
    for toxic, clean, entries in cells:
        by_size.setdefault(toxic + clean, Counter())[toxic] += entries
    shares = {}
    for size, found in by_size.items():
        total, seen = sum(found.values()), 0
        tail, below = 0.0, size + 1
        for toxic in sorted(found, reverse=True):
            in_toxic, in_clean = toxic / chance, (size - toxic) / (1 - chance)
            if in_toxic < purity * (in_toxic + in_clean):
                break
            for k in range(toxic, below):
                tail += math.exp(
                    math.lgamma(size + 1) - math.lgamma(k + 1) - math.lgamma(size - k + 1)
                    + k * math.log(chance) + (size - k) * math.log1p(-chance)
                )
            below = toxic
            seen += found[toxic]
            shares[toxic, size - toxic] = min(1.0, total * tail / seen)
    return shares


def mine_lexicon(
    sample: DataFrame,
    toxic: int,
    clean: int,
    *,
    purity: float,
    false_share: float,
    alone: int = 200,
    pools: int = 24,
) -> Lexicon:
    """All entries of ``sample`` (``text, label``) that say toxic; see the module's text.

    What is kept is bounded by the words of the sample. The ``alone`` strongest entries have a
    column each; the others share ``pools`` columns, those of equal strength together.
    """
    entries = materialise(
        _counted(sample)
        .where("toxic + clean >= 2")
        .groupBy("mark", "toxic", "clean")
        .agg(F.sort_array(F.collect_list(F.when(F.col("toxic") > F.col("clean"), F.col("token")))).alias("tokens"))
    )
    cells = [tuple(r) for r in entries.groupBy("toxic", "clean").count().collect()]
    chance = toxic / (toxic + clean)
    shares = {c: s for c, s in _false_shares(cells, chance, purity).items() if s <= false_share}
    if not shares:
        return Lexicon.of()
    kept = sample.sparkSession.createDataFrame(
        [(*cell, share) for cell, share in shares.items()], "toxic long, clean long, share double"
    )
    rows = entries.join(F.broadcast(kept), ["toxic", "clean"]).collect()  # of the bounded sample

    def evidence(row) -> float:
        n = row["toxic"] + row["clean"]
        found = row["toxic"] * math.log(row["toxic"] / n / chance)
        return found + (row["clean"] * math.log(row["clean"] / n / (1 - chance)) if row["clean"] else 0)

    rows.sort(key=lambda r: (-evidence(r), r["tokens"]))
    rest = max(1, len(rows) - alone)
    column = [i if i < alone else alone + (i - alone) * pools // rest for i in range(len(rows))]
    hits = [0.0] * (max(column) + 1)
    for row, at in zip(rows, column):
        hits[at] += row["share"] * (row["toxic"] + row["clean"]) / (toxic + clean)
    return Lexicon([r["tokens"] for r in rows], column, hits)


def with_chance_hits(features: np.ndarray, clean: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """The features, with hits of chance entries added to clean rows as often as they will come."""
    given, rng = features.copy(), np.random.default_rng(11)
    for column, rate in enumerate(lexicon.chance):
        struck = np.flatnonzero(clean & (rng.random(len(given)) < rate))
        given[struck, len(PATTERNS) + column] += math.log(2)
        for row in struck:
            hits, words = math.expm1(given[row, 1]) + 1, given[row, 5]
            given[row, : len(PATTERNS)] = _patterns(hits, given[row, 2] + 1, words, given[row, 4])
    return given


def train_toxicity_model(
    docs: DataFrame,
    labels: DataFrame,
    *,
    per_class: int = 3000,
    false_share: float = 0.25,
    purity: float = 0.98,
    key: str = "id",
) -> ToxicityModel:
    """Fit on the texts of at most ``per_class`` rows of each class of ``labels``."""
    known = labels.where(F.col(key).isNotNull() & F.col("label").isin(0, 1))
    totals = dict(known.groupBy("label").count().collect())
    nothing = ToxicityModel(Lexicon.of(), 0.0, np.zeros(0))
    if len(totals) < 2:
        return nothing
    # Twice per_class rows at most, so the join may send them to every task.
    drawn = F.broadcast(bounded_sample(known.select(key, "label"), "label", key, per_class))
    sample = materialise(docs.select(key, "text").join(drawn, key))
    found = dict(sample.groupBy("label").count().collect())
    if len(found) < 2:
        return nothing
    lexicon = mine_lexicon(sample, found[1], found[0], purity=purity, false_share=false_share)
    if not lexicon.entries:
        return nothing

    @F.pandas_udf("array<double>")
    def read(texts: pd.Series) -> pd.Series:
        reader = Reader(lexicon)
        return pd.Series([reader.features(text) for text in texts], dtype=object)

    rows = sample.select(key, "label", read("text").alias("features"))
    read_back = rows.orderBy(key, "label", "features").toPandas()
    labelled = read_back["label"].to_numpy()
    features = with_chance_hits(np.stack(read_back["features"].to_numpy()), labelled == 0, lexicon)
    model = fit_label_model(votes(features), found[1] / (found[0] + found[1]))
    weight = np.array([totals[int(label)] / found[int(label)] for label in labelled])
    posterior = model.posterior(votes(features))
    features[:, PATTERNS.index("words")] = 0
    bias, weights = fit_lasso(features, posterior, weight, 0.0002)
    return ToxicityModel(lexicon, bias, weights)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.lexicon)
        for batch in batches:
            yield pd.Series(model.scores(batch.tolist(), reader))

    return score.asNondeterministic()(text)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    held_out: Column,
    threshold: float = 0.7,
    per_class: int = 3000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; held-out rows teach nothing."""
    taught = labels.where(~held_out).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = train_toxicity_model(texts, taught, per_class=per_class)
    scored = docs.select(
        F.col(id_col),
        held_out.alias("held_out"),
        toxicity_score(F.col(text_col), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
