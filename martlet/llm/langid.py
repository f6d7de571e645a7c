"""Language identification by a byte convolutional network.

The network reads fixed-length windows of UTF-8 bytes: byte embeddings, filters of several
widths, a maximum over the window per filter, and a softmax over the languages. It is trained in
numpy on the driver, on windows of a bounded sample of labelled rows, and applied in Arrow
batches to all windows of every text. A document gets the mean of its windows' distributions,
weighted by their bytes.

Two facts keep the application cheap. A filter's answer is a sum over its bytes, so all filters
are tables indexed by byte pairs, and a position costs two look-ups. And windows go through in
blocks that fit the processor's cache, so memory does not grow with a text.

A network may have a rejection class for texts in none of its languages. It is learned from the
labelled windows themselves, made foreign: letters shuffled, letters exchanged for others of
their kind or of another script, and noise. The score of a text then is the share of all learned
languages together, whatever their number, so a text in two of them is not rejected.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every
text if no labelled row exists. Rows whose label or key is null are never learned from. Texts
of any length are read whole. Repeated rows get equal answers; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import bounded_sample, fresh, own_columns

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
_EMBEDDING = 8
_BLOCK = 32


@dataclass(frozen=True)
class ByteCnn:
    """A trained network; byte 0 is padding and has the zero embedding.

    With ``rejects``, a last class behind the languages stands for none of them.
    """

    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray
    rejects: bool = False

    def pair_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """All filters' sums over bytes 1-2 and over bytes 3-4, by byte pair."""

        def fill(table: np.ndarray, width: int, first: int) -> None:
            own = self.filters[width].astype(np.float32)
            part = [embedding @ own[k] if k < width else None for k in (first, first + 1)]
            pairs = table.reshape(256, 256, -1)
            at = FILTERS * (WIDTHS.index(width) - (first > 0))
            pairs[:, :, at : at + FILTERS] = part[0][:, None, :]
            if part[1] is not None:
                pairs[:, :, at : at + FILTERS] += part[1][None, :, :]

        embedding = self.embedding.astype(np.float32)
        head = np.empty((65_536, FILTERS * len(WIDTHS)), np.float32)
        tail = np.empty((65_536, FILTERS * (len(WIDTHS) - 1)), np.float32)
        for width in WIDTHS:
            fill(head, width, 0)
        for width in WIDTHS[1:]:
            fill(tail, width, 2)
        head += np.concatenate([self.bias[width] for width in WIDTHS]).astype(np.float32)
        return head, tail


def _padded(pieces: list[bytes]) -> np.ndarray:
    """Windows as rows of bytes, zeros behind the end and behind each window."""
    joined = b"".join(piece.ljust(WINDOW, b"\0") for piece in pieces)
    rows = np.frombuffer(joined, np.uint8).reshape(-1, WINDOW)
    return np.pad(rows, ((0, 0), (0, max(WIDTHS) - 1)))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Scorer:
    """Applies a network to texts."""

    def __init__(self, model: ByteCnn) -> None:
        self.model = model
        self.head, self.tail = model.pair_tables()

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """The languages' probabilities for each padded window."""
        pooled = np.empty((len(rows), self.head.shape[1]), np.float32)
        for start in range(0, len(rows), _BLOCK):
            block = rows[start : start + _BLOCK].astype(np.int32)
            pairs = block[:, :-1] << 8 | block[:, 1:]
            sums = self.head.take(pairs[:, :WINDOW], axis=0)
            sums[:, :, FILTERS:] += self.tail.take(pairs[:, 2 : WINDOW + 2], axis=0)
            pooled[start : start + _BLOCK] = sums.max(axis=1)
        features = np.maximum(pooled, 0)
        return _softmax(features @ self.model.dense + self.model.dense_bias)

    def _mean(self, data: bytes) -> np.ndarray:
        """Mean distribution of one text, in pieces of bounded size."""
        total = np.zeros(len(self.model.dense_bias))
        step = 4096 * WINDOW
        for start in range(0, len(data), step):
            part = data[start : start + step]
            pieces = [part[i : i + WINDOW] for i in range(0, len(part), WINDOW)]
            sizes = np.array([len(piece) for piece in pieces])
            total += sizes @ self.windows(_padded(pieces))
        return total / len(data)

    def texts(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; texts without a letter are unknown.

        The score is the language's own, or with a rejection class that of all languages.
        """
        known = [
            i for i, t in enumerate(texts) if t and self.model.languages and any(map(str.isalpha, t))
        ]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for start in range(0, len(known), 64):
            some = known[start : start + 64]
            for i, mean in zip(some, self._means([texts[i] for i in some]), strict=True):
                learned = mean[: len(self.model.languages)]
                names[i] = self.model.languages[int(learned.argmax())]
                scores[i] = min(1.0, float(learned.sum() if self.model.rejects else learned.max()))
        return names, scores

    def _means(self, texts: list[str]) -> list[np.ndarray]:
        """Short texts share their blocks; a long one is read piece by piece."""
        data = [_bytes(text) for text in texts]
        if sum(map(len, data)) > 4096 * WINDOW:
            return [self._mean(d) for d in data]
        pieces = [d[i : i + WINDOW] for d in data for i in range(0, len(d), WINDOW)]
        sizes = np.array([len(piece) for piece in pieces])
        weighted = self.windows(_padded(pieces)) * sizes[:, None]
        ends = np.cumsum([-(-len(d) // WINDOW) for d in data])
        sums = np.add.reduceat(weighted, np.concatenate([[0], ends[:-1]]), axis=0)
        return list(sums / np.array([len(d) for d in data])[:, None])


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


#: First and last letter of scripts that a window is put into to make it foreign.
_SCRIPTS = [
    (0x3B1, 0x3C9), (0x430, 0x44F), (0x561, 0x586), (0x5D0, 0x5EA), (0x621, 0x64A), (0x905, 0x939),
    (0xE01, 0xE2E), (0x10D0, 0x10F0), (0x3042, 0x3093), (0x30A2, 0x30F3), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
]
_VOWELS = "aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýāăąēėęěīįıōőœūůű"
_CONSONANTS = "bcdfghjklmnpqrstvwxzçðñþßćčďđğģķłļńňŕřśşšţťźžż"
_NOISE = ["abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz0123456789_(){}[];=<>+*/&.-"]


def foreign(text: str, rng: np.random.Generator) -> str:
    """A text in no learned language, made from one that is."""
    text = text.lower()
    letters = [c for c in text if c.isalpha()]
    kind = rng.integers(0, 8)
    if kind == 0:
        signs = list(_NOISE[rng.integers(0, len(_NOISE))])
        sizes = rng.integers(2, int(rng.choice([9, 16, 60])), len(text) // 4 + 1)
        return " ".join("".join(rng.choice(signs, n)) for n in sizes)[: len(text)]
    if kind == 1:
        order = iter(rng.permutation(len(letters)))
        return "".join(letters[next(order)] if c.isalpha() else c for c in text)
    if kind < 4:
        first, last = _SCRIPTS[rng.integers(0, len(_SCRIPTS))]
        put = {c: chr(rng.integers(first, last + 1)) for c in sorted(set(letters))}
        if last - first > 1000:
            return "".join(chr(rng.integers(first, last + 1)) if c.isalpha() else c for c in text)
        return "".join(put.get(c, c) for c in text)
    # Words of the same build with other letters: plain ones mostly, some with marks.
    put = {}
    for kin, plain in ((_VOWELS, 5), (_CONSONANTS, 20)):
        marked = rng.choice(list(kin[plain:]), rng.integers(0, 7), replace=False)
        others = rng.permutation([*kin[:plain], *marked])
        own = sorted({c for c in letters if c in kin})
        put |= {c: str(others[i % len(others)]) for i, c in enumerate(rng.permutation(own))}
    return "".join(put.get(c, c) for c in text)


def fit_network(
    texts: list[str],
    labels: list[str],
    *,
    epochs: int = 6,
    batch: int = 64,
    seed: int = 7,
    rejects: bool = False,
) -> ByteCnn:
    """Train on texts of up to a window; shorter crops of each teach it short texts.

    With ``rejects``, every text also teaches its words alone and, made foreign, the last class.
    """
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    pieces, target = [], []
    for text, label in zip(texts, labels, strict=True):
        data = _bytes(text)
        start, short = rng.integers(0, max(1, len(data) - 48)), rng.integers(12, 64)
        for piece in (data[:WINDOW], data[start : start + short]):
            if piece:
                pieces.append(piece)
                target.append(languages.index(label))
    if rejects and languages:
        some = np.random.default_rng(seed + 1)
        for text, label in zip(texts, labels, strict=True):
            words, made = text.split(), _bytes(foreign(text, some))
            at, short = some.integers(0, max(1, len(words))), some.integers(24, 96)
            alone = _bytes(" ".join(words[at : at + some.integers(1, 4)]))[:WINDOW]
            start = some.integers(0, max(1, len(made) - short))
            # A key, a quotation or a licence line does not make a text foreign.
            cut = int(len(data := _bytes(text)[:WINDOW]) * some.uniform(0.4, 0.8))
            mixed = data[:cut] + made[cut:WINDOW]
            for piece, kind in (
                (alone, languages.index(label)),
                (mixed, languages.index(label)),
                (made[:WINDOW], len(languages)),
                (made[start : start + short], len(languages)),
            ):
                if piece:
                    pieces.append(piece)
                    target.append(kind)
    classes = len(languages) + bool(rejects and languages)
    target = np.array(target, dtype=int)
    params = {"embedding": rng.normal(0, 0.5, (256, _EMBEDDING))}
    params["embedding"][0] = 0
    for width in WIDTHS:
        scale = 1 / np.sqrt(width * _EMBEDDING)
        params[f"filters{width}"] = rng.normal(0, scale, (width, _EMBEDDING, FILTERS))
        params[f"bias{width}"] = np.zeros(FILTERS)
    params["dense"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes))
    params["dense_bias"] = np.zeros(classes)
    if classes > 1:
        _train(params, _padded(pieces), target, epochs, batch, rng)
    return ByteCnn(
        languages,
        params["embedding"],
        {width: params[f"filters{width}"] for width in WIDTHS},
        {width: params[f"bias{width}"] for width in WIDTHS},
        params["dense"],
        params["dense_bias"],
        rejects,
    )


def _train(params: dict, rows: np.ndarray, target: np.ndarray, epochs: int, batch: int, rng) -> None:
    """Adam on the cross entropy, in place."""
    first = {name: np.zeros_like(p) for name, p in params.items()}
    second = {name: np.zeros_like(p) for name, p in params.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            pick = order[start : start + batch]
            step += 1
            for name, grad in _gradients(params, rows[pick], target[pick]).items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad**2
                mean = first[name] / (1 - 0.9**step)
                spread = np.sqrt(second[name] / (1 - 0.999**step))
                params[name] -= 0.004 * mean / (spread + 1e-8)


def _gradients(params: dict, rows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    n = len(rows)
    embedded = params["embedding"][rows]
    tops, places = [], []
    for width in WIDTHS:
        weights = params[f"filters{width}"]
        sums = sum(embedded[:, k : k + WINDOW] @ weights[k] for k in range(width))
        places.append(sums.argmax(axis=1))
        best = np.take_along_axis(sums, places[-1][:, None, :], axis=1)[:, 0]
        tops.append(best + params[f"bias{width}"])
    features = np.maximum(np.hstack(tops), 0)
    error = _softmax(features @ params["dense"] + params["dense_bias"])
    error[np.arange(n), target] -= 1
    error /= n
    grads = {"dense": features.T @ error, "dense_bias": error.sum(axis=0)}
    back = (error @ params["dense"].T) * (features > 0)
    grads["embedding"] = np.zeros_like(params["embedding"])
    # Only the position that won the maximum passes a gradient on.
    for j, width in enumerate(WIDTHS):
        own = back[:, j * FILTERS : (j + 1) * FILTERS]
        at = places[j][:, :, None] + np.arange(width)
        seen = rows[np.arange(n)[:, None, None], at]
        grads[f"filters{width}"] = np.einsum("nf,nfkd->kdf", own, params["embedding"][seen])
        grads[f"bias{width}"] = own.sum(axis=0)
        to_bytes = np.einsum("nf,kdf->nfkd", own, params[f"filters{width}"])
        np.add.at(grads["embedding"], seen.ravel(), to_bytes.reshape(-1, _EMBEDDING))
    grads["embedding"][0] = 0
    return grads


def train_language_model(
    docs: DataFrame,
    *,
    eligible: Column | None = None,
    per_language: int = 300,
    per_document: int = 2,
    rejects: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> ByteCnn:
    """Fit on at most ``per_document`` windows of ``per_language`` labelled rows per language.

    The sample, and so the model, is the same on every run over the same table.
    """
    length = F.char_length(text_col)
    starts = [
        F.pmod(F.xxhash64(F.col(id_col), F.lit(k)), F.greatest(F.lit(1), length - WINDOW)) + 1
        for k in range(per_document)
    ]
    crops = [F.substring(F.col(text_col), start.cast("int"), F.lit(WINDOW)) for start in starts]
    rows = docs.where(F.col(lang_col).isNotNull() & (length > 0))
    if eligible is not None:
        rows = rows.where(eligible)
    labelled = rows.select(
        F.col(lang_col).cast("string").alias("label"),
        F.col(id_col).alias("key"),
        F.array_distinct(F.array(*crops)).alias("crops"),
    )
    sample = bounded_sample(labelled, "label", "key", per_language).collect()
    pairs = [(crop, row["label"]) for row in sample for crop in row["crops"]]
    return fit_network([crop for crop, _ in pairs], [label for _, label in pairs], rejects=rejects)


def predict_language(text: Column, model: ByteCnn) -> Column:
    """``struct<lang_pred, score>`` of a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for batch in batches:
            names, scores = scorer.texts(batch.tolist())
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict.asNondeterministic()(text)


def identify_language(
    docs: DataFrame,
    *,
    held_out: Column,
    per_language: int = 300,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; held-out rows teach nothing."""
    model = train_language_model(
        docs,
        eligible=~held_out & F.col(id_col).isNotNull(),
        per_language=per_language,
        id_col=id_col,
        text_col=text_col,
        lang_col=lang_col,
    )
    found = docs.select(
        F.col(id_col), held_out.alias("held_out"), predict_language(F.col(text_col), model).alias("_p")
    )
    return found.select(id_col, "held_out", "_p.lang_pred", "_p.score")


def keep_identified(
    docs: DataFrame, model: ByteCnn, *, least: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows whose language is recognised with at least the given score.

    Without a rejection class a score is at least one over the number of languages. A model that
    has learned no language recognises none and rejects none: all rows stay.
    """
    if not model.languages:
        return docs
    (found,) = fresh(docs, "_language")
    judged = docs.withColumn(found, predict_language(F.col(text_col), model))
    sure = (F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= least)
    return judged.where(sure).select(*own_columns(docs))
