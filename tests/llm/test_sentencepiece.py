from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from martlet.llm import sentencepiece as sp
from martlet.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def model():
    return sp.load_model(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)


TEXTS = [
    "", " ", "  ", "hello  world", " lead", "trail ", "a\nb\tc\r\n", "ﬁ ½ é é", "日本語 𝔘", "<s>x</s>",
    "<0x0A>", "\x00z", "a" * 500, "  " * 60 + "x", "thethethe" * 80, "no" + "space" * 400, "\n\n \n",
]


def test_equals_the_library(documents, model, library):
    encoder = sp.Encoder(model)
    for text in TEXTS + [r["text"] for r in documents.limit(200).collect()]:
        assert encoder.encode(text).tolist() == library.encode(text), text[:60]
        assert encoder.decode(encoder.encode(text)) == text


def test_random_texts(model, library):
    rng, encoder = random.Random(2), sp.Encoder(model)
    for _ in range(500):
        text = "".join(rng.choice("theinganor sx é.\n日 ▁") for _ in range(rng.randrange(80)))
        if "▁" not in text:
            assert encoder.encode(text).tolist() == library.encode(text)
        assert encoder.decode(encoder.encode(text)) == text


def test_words_together_equal_words_alone(model, library, documents):
    """The search over many words at once against the streaming search and the library."""
    rng = random.Random(7)
    words = {w for r in documents.limit(150).collect() for w in (r["text"] or "").split()}
    words |= {"".join(rng.choice("abeinrstxyz.,é日 ") for _ in range(rng.randrange(1, 40))) for _ in range(2000)}
    words = sorted(words | {"a", "  ", "x" * 64, "the" * 21, "😀", "𝔘", "q", "-" * 30, "=" * 64})
    found = dict(sp.WordSearch(model).encode(words))
    assert set(found) == set(words) and sum(v is None for v in found.values()) >= 1
    plain = sp.load_model(TOKENIZER, dummy_prefix=False)
    for word, data in found.items():
        search = sp.StreamingViterbi(plain)
        alone = search.feed(word) + search.rest()
        if data is not None:
            assert np.frombuffer(data, np.int32).tolist() == alone, word


def test_small_batches_and_caches_change_nothing(model, documents, library, monkeypatch):
    monkeypatch.setattr(sp, "_WORDS_AT_ONCE", 3)
    monkeypatch.setattr(sp, "_CACHED_UNITS", 40)
    monkeypatch.setattr(sp, "_CACHED_PAIRS", 5)
    encoder = sp.Encoder(model)
    texts = [r["text"] or "" for r in documents.limit(25).collect()]
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert ids.tolist() == library.encode(text)


def test_commits_before_the_end_with_a_bounded_window(model, library):
    search, text = sp.StreamingViterbi(model), "internationalisation" * 500
    ids, widest = [], 0
    for char in sp.SPACE + text:
        ids += search.feed(char)
        widest = max(widest, len(search.nodes))
    assert len(ids) > 1000 and widest <= 5 * model.longest
    assert ids + search.rest() == library.encode(text)


def toy(kind="unigram", **changes):
    pieces = {"<unk>": 0.0, "a": -2.0, "b": -2.5, "ab": -3.0, "aba": -4.2, "ba": -3.1, sp.SPACE: -1.0}
    return sp.PieceModel(list(pieces), list(pieces.values()), [], 0, kind, **changes)


def test_unigram_finds_the_best_sum():
    model = toy(dummy_prefix=False)
    rng, encoder = random.Random(1), sp.Encoder(model)

    def best(text):
        top = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                if (i := model.ids.get(text[start:end])) is not None:
                    top[end] = max(top[end], top[start] + model.scores[i])
        return top[-1]

    for _ in range(200):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 200)))
        ids = encoder.encode(text).tolist()
        assert "".join(model.pieces[i] for i in ids) == text
        assert sum(model.scores[i] for i in ids) == pytest.approx(best(text))
    assert encoder.encode("axb").tolist() == [1, 0, 2]


def test_columns(texts, model):
    rows = [(1, None), (2, ""), (3, "the the"), (3, "the the"), (4, "x" * 100_000)]
    docs = texts(*rows).withColumn("ids", F.lit("mine"))
    got = {(r["doc_id"], r["n_tokens"], r["exact"]) for r in sp.tokenize(docs, model).collect()}
    long = len(sp.Encoder(model).encode("x" * 100_000))
    assert got == {(1, None, None), (2, 0, True), (3, 2, True), (4, long, True)}
    assert sp.tokenize(texts(), model).count() == 0
    again = docs.select("text", sp.encode_texts(F.col("text"), model).alias("codes"))
    back = again.select("text", sp.decode_ids(F.col("codes"), model).alias("back"))
    assert all(r["text"] == r["back"] for r in back.collect())


def test_bytes_without_meaning_decode_to_the_replacement(model):
    assert sp.Encoder(model).decode(np.array([model.byte_ids[0xFF]])) == "�"


def test_words_of_all_lengths_take_each_step_together(model, monkeypatch):
    """The rounds of a search follow the longest word, not the number of lengths times theirs."""
    search, steps, step = sp.WordSearch(model), [], sp.PieceTrie.step
    monkeypatch.setattr(sp.PieceTrie, "step", lambda *given: steps.append(1) or step(*given))
    words = [("internationalisation" * 3)[:size] for size in range(1, 41)]
    found = dict(search.encode(words))
    assert len(steps) <= 40
    plain = sp.load_model(TOKENIZER, dummy_prefix=False)
    for word in words:
        alone = sp.StreamingViterbi(plain)
        assert np.frombuffer(found[word], np.int32).tolist() == alone.feed(word) + alone.rest()


def test_a_column_asks_once_for_each_of_its_words(model, library, monkeypatch):
    asked, of = [], sp._Units.of
    monkeypatch.setattr(sp._Units, "of", lambda self, units: asked.extend(units) or of(self, units))
    texts = ["the cat and the dog", None, "", "and the cat"] * 300
    got = sp.Encoder(model).encode_column(pa.array(texts)).to_pylist()
    assert got == [None if t is None else library.encode(t) for t in texts]
    assert sorted(asked) == [" and", " cat", " dog", " the"]


@pytest.mark.parametrize("prefix", [True, False])
def test_columns_equal_single_texts(prefix):
    encoder = sp.Encoder(sp.load_model(TOKENIZER, dummy_prefix=prefix))
    rng = random.Random(5)
    drawn = ["".join(rng.choice("thein   é.\n日▁😀") for _ in range(rng.randrange(30))) for _ in range(300)]
    texts = [None, *TEXTS, *drawn, "", None, " ", "y" * 70, "日本" * 50]
    for some in (texts, texts[::-1], [None], [""], [None, ""], []):
        for kind in (pa.string(), pa.large_string()):
            column = pa.array(["cut off", *some, " gone"], kind)[1:-1]
            ids = encoder.encode_column(column)
            alone = [None if t is None else encoder.encode(t).tolist() for t in some]
            assert ids.to_pylist() == alone
            assert encoder.decode_column(ids).to_pylist() == some
            assert encoder.decode_column(ids[1:]).to_pylist() == some[1:]
            assert [i if i is None else i.tolist() for i in encoder.encode_all(some)] == alone


def test_a_table_keeps_what_it_takes_in():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 40, 30_000))
    values, table = keys % 100, sp.Table(7, 4)
    assert (table.get(keys) == -1).all()
    for some in np.array_split(rng.permutation(len(keys)), 9):
        table.put(keys[some], values[some])
    assert (table.get(keys) == values).all() and table.count == len(keys)
    assert (table.get(keys + (1 << 41)) == -1).all() and len(table.get(keys[:0])) == 0


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(sp, "_SLICE", 10)
    texts = ["a" * 4, None, "b" * 25, "", "c" * 3, "d" * 9, None]
    batch = pa.record_batch([pa.array(range(7)), pa.array(texts)], ["doc_id", "text"])
    some = list(sp._slices(batch))
    assert len(some) > 2 and pa.Table.from_batches(some).column(1).to_pylist() == texts
    assert sum(part.num_rows for part in sp._slices(batch.slice(0, 0))) == 0
