from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martlet.llm import tokenfiles as tf
from martlet.llm.queries import WORD_TOKENIZER, op13_token_output

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return tf.WordTokenizer.load(WORD_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_TOKENIZER)


def expected(rows, library, end=2):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows in their order."""
    ids = [library.encode(t or "", add_special_tokens=False).ids + [end] for _, t in rows]
    starts = [0, *accumulate(map(len, ids))]
    sums = [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]
    return [(d, s, len(i), c) for (d, _), s, i, c in zip(rows, starts, ids, sums)]


def test_query_equals_the_library(spark, documents, library):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    got = op13_token_output(spark, DATA)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(rows, library)


HARD = [
    (None, "no id"), (1, None), (2, ""), (3, " \n\t  "), (4, "don't  we'll go\x1cthere"),
    (5, "x" * 20_000 + " y"), (6, "<|endoftext|>a <|startoftext|>"), (7, "Éa é Σς İ ﬁ ½ 日本 😀"),
    (8, "</w> a</w>b 'S it'S"), (9, "again"), (9, "again"), (-5, "below zero"), (10, " a\u0085b\r\nc"),
    (11, "ends in space "), (12, "e ́x"), (13, "é́. İx, ½a क़! a.'s _b_ c`d` ﬀ Ⅷx²"), (14, "don't. it's, x'")
]


def test_hard_texts(spark, texts, tokenizer, library, tmp_path):
    docs = texts(*HARD).withColumn("ids", F.lit("mine")).withColumn("shard", F.lit("s"))
    tf.write_tokens(docs, str(tmp_path / "t"), tokenizer)
    order = sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0))
    got = tf.token_digests(spark, str(tmp_path / "t")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(order, library)
    closed = tf.WordTokenizer.load(WORD_TOKENIZER, specials=False)
    plain = Tokenizer.from_file(WORD_TOKENIZER)
    plain.encode_special_tokens = True
    text = "<|endoftext|> is text"
    data = next(tf.WordEncoder(closed).encode_all([text]))
    assert np.frombuffer(data, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_small_caches_change_nothing(documents, tokenizer, library, monkeypatch):
    monkeypatch.setattr(tf, "_CACHED_WORDS", 50)
    monkeypatch.setattr(tf, "_CACHED_WORD", 4)
    monkeypatch.setattr(tf, "_SLICE", 500)
    some = [r["text"] or "" for r in documents.limit(60).collect()]
    got = list(tf.WordEncoder(tokenizer).encode_all(some))
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
    assert got == want


def test_empty_table(spark, texts, tokenizer, tmp_path):
    tf.write_tokens(texts(), str(tmp_path / "t"), tokenizer)
    assert tf.token_digests(spark, str(tmp_path / "t")).count() == 0
    assert tf.token_places(spark, str(tmp_path / "t")).count() == 0
    assert tf.read_window(spark, str(tmp_path / "t"), 0, 10).count() == 0


def column_chunks(folder):
    for file in folder.glob("rows/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for group in range(meta.num_row_groups):
            for at in range(meta.row_group(group).num_columns):
                yield meta.row_group(group), meta.row_group(group).column(at)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_layout(spark, documents, tokenizer, tmp_path, encoding):
    layout = tf.Layout(encoding=encoding, rows_per_group=100, rows_per_page=20)
    tf.write_tokens(documents.where("length(text) < 3000"), str(tmp_path), tokenizer, layout=layout)
    kinds = {}
    for group, chunk in column_chunks(tmp_path):
        assert group.num_rows <= 100 and chunk.has_offset_index
        kinds.setdefault(chunk.path_in_schema, set()).update(chunk.encodings)
        if chunk.path_in_schema != "ids.list.element":
            assert chunk.has_column_index
    for name in ("doc_id", "offset", "n_tokens"):
        assert "DELTA_BINARY_PACKED" in kinds[name]
    ids = kinds["ids.list.element"]
    assert ("RLE_DICTIONARY" in ids) == (encoding == "dictionary")
    assert ("DELTA_BINARY_PACKED" in ids) == (encoding == "delta")


def test_parts_are_read_alone(spark, documents, tokenizer, library, tmp_path, capsys):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    folder = str(tmp_path / "t")
    tf.write_tokens(documents, folder, tokenizer)
    tf.token_places(spark, folder).explain()
    assert "ids" not in capsys.readouterr().out
    tf.read_documents(spark, folder, 100, 110).explain()
    assert "GreaterThanOrEqual(doc_id,100)" in capsys.readouterr().out
    some = {r["doc_id"]: r for r in tf.read_documents(spark, folder, 100, 110).collect()}
    whole = {d: library.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}
    assert {d: r["ids"] for d, r in some.items()} == {d: i for d, i in whole.items() if 100 <= d <= 110}
    stream = [token for d, _ in rows for token in whole[d]]
    for start, stop in ((0, 7), (1000, 5000), (len(stream) - 3, len(stream) + 9), (400, 400)):
        pieces = tf.read_window(spark, folder, start, stop).orderBy("start").collect()
        assert [t for p in pieces for t in p["ids"]] == stream[start:stop]


def test_a_word_costs_python_nothing_where_it_is_met_again(tokenizer, library):
    """Known words, plain or before signs, reach neither the library nor a Python call."""
    import sys

    encoder = tf.WordEncoder(tokenizer)
    texts = pa.array(["über alles, grand; it's 12 façades. " * 2_000])
    want = np.array(library.encode(texts[0].as_py(), add_special_tokens=False).ids + [2], "<u4")
    calls = []
    for _ in range(2):
        calls.append(0)
        sys.setprofile(lambda *_: calls.__setitem__(-1, calls[-1] + 1))
        try:
            sizes, ids = encoder.encode_column(texts, 2)
        finally:
            sys.setprofile(None)
        assert sizes.tolist() == [len(want)] and np.array_equal(ids, want)
    assert calls[1] <= calls[0] < 2_000
    encoder.library = None
    assert np.array_equal(encoder.encode_column(texts, 2)[1], want)
