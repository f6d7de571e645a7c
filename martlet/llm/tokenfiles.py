"""Token ids of documents in Parquet files that can be read in parts.

A folder of tokens holds two tables:

* ``rows``: one row per document, in ascending order of the documents over the files and within
  them: ``shard`` (the number of the task that wrote it), ``doc_id``, ``offset`` (the ids before it
  in its shard), ``n_tokens`` and ``ids``, a list column.
* ``shards``: one row per shard: ``shard, start`` (the ids of all shards before it), ``tokens, rows``.

The ids are dictionary encoded (a vocabulary is small against the text: some 16 bits an id before
compression) or delta encoded; ``doc_id``, ``offset`` and ``n_tokens`` are delta encoded, as they
ascend or vary little. Row groups and pages are cut by rows and bytes, and each file has a page
index. So places and counts are read without a byte of the ids, and a window of documents or of
token positions reads the pages it needs.

Documents are dealt to tasks by ranges of (id, hash of the text), so that rows which share an id
are no hot spot, and sorted there; a task encodes its rows as they pass and adds up their lengths.
Nothing but one number per shard meets in one place.

Words are encoded by the tokenizers library, each once for as long as a bounded cache of the
process holds it: the tokenizers meant here end words at white space and drop it, and close each
run of letters by a token that ends a word. Arrow and numpy columns tell the words apart and put
their ids in place; letters and the signs behind them are words of their own there.

Defined results: a null text counts as empty; an empty text is the end id alone. A null id comes
first. Rows of equal id follow each other by the text's hash, then the text; repeated rows each
have their own place. Very long texts are encoded whole. An empty table gives an empty folder that
reads as no rows. Other columns take no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

_CACHED_WORD = 64
_CACHED_WORDS = 600_000  # some 50 bytes each
_NO_IDS = np.zeros(0, "<u4")
_AT_ONCE = 2048
_SIDE_BY_SIDE = 256
_SLICE = 1 << 23  # bytes of text that are encoded together
#: Signs that no contraction begins with: behind letters, neither changes how the other is read.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Layout:
    """How the files are laid out."""

    encoding: str = "dictionary"  # of the ids; or "delta"
    rows_per_group: int = 1 << 20
    bytes_per_group: int = 64 << 20
    rows_per_page: int = 2000
    bytes_per_page: int = 256 << 10
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"unknown encoding of ids: {self.encoding}")
        plain = ["doc_id", "offset", "n_tokens"]
        if self.encoding == "delta":
            plain.append("ids.list.element")
        return {
            "compression": self.compression,
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.block.size": str(self.bytes_per_group),
            "parquet.block.row.count.limit": str(self.rows_per_group),
            "parquet.page.row.count.limit": str(self.rows_per_page),
            "parquet.page.size": str(self.bytes_per_page),
            **{f"parquet.enable.dictionary#{name}": "false" for name in plain},
        }


@dataclass(frozen=True)
class WordTokenizer:
    """A tokenizer file as text, for tasks to load; ``specials`` reads special tokens in texts."""

    definition: str
    specials: bool = True

    @classmethod
    def load(cls, path: str | Path, specials: bool = True) -> WordTokenizer:
        return cls(Path(path).read_text(encoding="utf-8"), specials)


class WordEncoder:
    """Encodes texts word by word; words that come again are looked up."""

    _held: dict[str, WordEncoder] = {}

    def __init__(self, tokenizer: WordTokenizer) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer.definition)
        self.library.encode_special_tokens = not tokenizer.specials
        ending = self.library.model.end_of_word_suffix
        self.closes = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.closes[i] = bool(ending) and token.endswith(ending)
        self.words = pa.array([], pa.large_string())
        self.ids, self.sizes = _NO_IDS, np.zeros(0, np.int64)

    @classmethod
    def of(cls, tokenizer: WordTokenizer) -> WordEncoder:
        """The encoder of this process; tasks that follow each other share what it has seen."""
        key = f"{hashlib.sha256(tokenizer.definition.encode()).hexdigest()} {tokenizer.specials}"
        if key not in cls._held:
            cls._held.clear()
            cls._held[key] = cls(tokenizer)
        return cls._held[key]

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        sizes, ids = self.encode_column(pa.array(texts, pa.string()), 0)
        for stop, size in zip(np.cumsum(sizes).tolist(), sizes.tolist()):
            yield ids[stop - size : stop - 1].tobytes()

    def encode_column(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, closed by ``end``, and the ids of all of them."""
        texts = texts.cast(pa.large_string())
        before = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // _SLICE
        cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(texts)]
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        for start, stop in zip(cuts, cuts[1:]):
            size, data = self._encode(texts.slice(start, stop - start), end)
            sizes.append(size)
            ids.append(data)
        return np.concatenate(sizes), np.concatenate(ids)

    def _encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Arrow cuts the words and tells them apart, numpy puts their ids where they occur."""
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        met = cut.flatten().dictionary_encode()
        word = met.dictionary
        stem = pc.utf8_rtrim(word, _SIGNS)
        tail = pc.replace_substring_regex(word, r"^\pL+", "")
        both = pc.add(pc.binary_length(stem), pc.binary_length(tail))
        parted = pc.and_(pc.utf8_is_alpha(stem), pc.equal(both, pc.binary_length(word)))
        first, second = pc.if_else(parted, stem, word), pc.if_else(parted, tail, "")
        held = len(self.words)
        parts = pa.concat_arrays([self.words, first, second]).dictionary_encode()
        self._learn(parts.dictionary)
        at = parts.indices.to_numpy()[held:].reshape(2, -1).T.ravel()
        ids = np.append(_gather(self.ids, self.sizes, at), np.array(end, "<u4"))
        sizes = np.append(self.sizes[at].reshape(-1, 2).sum(axis=1), 1)
        self._forget(at)
        stops = cut.offsets.to_numpy()[1:].astype(np.int64)
        at = np.insert(met.indices.to_numpy(), stops, len(word))
        ends = np.cumsum(sizes[at])
        return np.diff(ends[stops + np.arange(len(stops))], prepend=0), _gather(ids, sizes, at)

    def _learn(self, words: pa.Array) -> None:
        """Hold ``words``, which begin with those held already."""
        new = words.slice(len(self.words))
        letters = pc.utf8_is_alpha(new).to_numpy(zero_copy_only=False)
        letters &= pc.utf8_length(new).to_numpy() <= _CACHED_WORD
        plain, other = new.filter(pa.array(letters)), new.filter(pa.array(~letters)).to_pylist()
        starts = pa.array([*range(0, len(plain), _SIDE_BY_SIDE), len(plain)], pa.int32())
        space = pa.scalar(" ", plain.type)
        lines = pc.binary_join(pa.ListArray.from_arrays(starts, plain), space)
        learned = [self._side_by_side(line) for line in lines.to_pylist()]
        for start in range(0, len(other), _AT_ONCE):
            learned.append(self._one_by_one(other[start : start + _AT_ONCE]))
        # What was learned by letters and others, in the order of the words.
        sizes = np.concatenate([np.zeros(0, np.int64), *(size for _, size in learned)])
        ids = np.concatenate([_NO_IDS, *(data for data, _ in learned)])
        place = np.empty(len(new), np.int64)
        place[np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])] = np.arange(len(new))
        self.ids = np.append(self.ids, _gather(ids, sizes, place))
        self.sizes = np.append(self.sizes, sizes[place])
        self.words = words

    def _forget(self, at: np.ndarray) -> None:
        """Let long words go, and if too many are held, those that are not ``at`` a place met."""
        stays = pc.utf8_length(self.words).to_numpy() <= _CACHED_WORD
        if len(self.words) > _CACHED_WORDS:
            stays &= np.bincount(at, minlength=len(self.words)) > 0
        if not stays.all():
            self.ids = self.ids[np.repeat(stays, self.sizes)]
            self.sizes = self.sizes[stays]
            self.words = self.words.filter(pa.array(stays))

    def _side_by_side(self, line: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of words of letters: each is whole at a token that ends a word."""
        some = line.split(" ")
        found = self.library.encode_batch_fast([line], add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(some):
            return ids, np.diff(ends, prepend=0)
        # A letter that the tokenizer writes as more than a word.
        return self._one_by_one(some)

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode(words, is_pretokenized=True, add_special_tokens=False)
        of = np.array(found.word_ids, np.int64)
        return np.array(found.ids, "<u4"), np.bincount(of, minlength=len(words))


def _gather(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ids of the words ``at`` these places, one after the other."""
    size = sizes[at]
    place = np.repeat((np.cumsum(sizes) - sizes)[at] - np.cumsum(size) + size, size)
    place += np.arange(len(place))
    return ids[place]


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about a slice, so that fewer words are met again in the next one."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > _SLICE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: WordTokenizer,
    *,
    end_id: int = 2,
    layout: Layout = Layout(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all documents, each closed by ``end_id``, and the index of the shards."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, offset = WordEncoder.of(tokenizer), TaskContext.get().partitionId(), 0
        for batch in _together(batches):
            sizes, ids = encoder.encode_column(batch.column(1), end_id)
            ends = np.cumsum(sizes)
            values = pa.array(ids.view("<i4"), pa.int32())
            lists = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sizes), shard, np.int32)),
                    batch.column(0),
                    pa.array(offset + ends - sizes),
                    pa.array(sizes),
                    lists,
                ],
                _names(),
            )
            offset += int(sizes.sum())

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    place = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(*place).sortWithinPartitions(*place, "text")
    written = dealt.mapInArrow(encode, _rows_schema(rows.schema["doc_id"]))
    written.write.options(**layout.options()).parquet(f"{folder}/rows")

    spark = docs.sparkSession
    shards = _rows(spark, folder).groupBy("shard").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))
    shards.select("shard", start.alias("start"), "tokens", "rows").coalesce(1).write.parquet(
        f"{folder}/shards"
    )


def _names() -> list[str]:
    return ["shard", "doc_id", "offset", "n_tokens", "ids"]


def _rows_schema(id_field: StructField) -> StructType:
    kinds = [IntegerType(), id_field.dataType, LongType(), LongType(), ArrayType(IntegerType())]
    return StructType([StructField(n, k) for n, k in zip(_names(), kinds, strict=True)])


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/rows")


def _placed(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """Rows with their global ``start`` instead of shard and offset."""
    shards = spark.read.parquet(f"{folder}/shards").select(
        F.col("shard").alias("_shard"), F.col("start").alias("_start")
    )
    joined = rows.join(shards, F.col("shard") == F.col("_shard"))
    return joined.withColumn("start", F.col("_start") + F.col("offset")).drop(
        "_shard", "_start", "shard", "offset"
    )


def token_places(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, n_tokens, start`` of every document; the ids are not read."""
    return _placed(spark, _rows(spark, folder).drop("ids"), folder)


def read_documents(spark: SparkSession, folder: str, first, last) -> DataFrame:
    """``doc_id, n_tokens, ids, start`` of the documents with ids from ``first`` to ``last``."""
    rows = _rows(spark, folder).where(F.col("doc_id").between(first, last))
    return _placed(spark, rows, folder)


def read_window(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """``start, ids`` of the pieces that make up the token positions from ``start`` to ``stop - 1``.

    One piece per document that the window meets. The shards in reach come from their index; in
    the first and the last one the offset cuts the pages that are read.
    """
    shards = spark.read.parquet(f"{folder}/shards")
    reach = shards.where((F.col("start") < stop) & (F.col("start") + F.col("tokens") > start))
    ends = reach.agg(F.min("shard"), F.max("shard"), F.min("start"), F.max("start")).first()
    rows = _rows(spark, folder)
    if ends[0] is None:
        wanted = rows.where(F.lit(False))
    else:
        low, high, low_start, high_start = ends
        wanted = rows.where(
            F.col("shard").between(low, high)
            & ((F.col("shard") > low) | (F.col("offset") + F.col("n_tokens") > start - low_start))
            & ((F.col("shard") < high) | (F.col("offset") < stop - high_start))
        )
    met = _placed(spark, wanted, folder)
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    left = F.least(F.lit(stop) - F.col("start"), F.col("n_tokens"))
    piece = F.slice("ids", (skip + 1).cast("int"), F.greatest(left - skip, F.lit(0)).cast("int"))
    cut = met.select((F.col("start") + skip).alias("start"), piece.alias("ids"))
    return cut.where(F.size("ids") > 0)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back: the crc32 of ids in 32-bit little endian."""
    rows = _rows(spark, folder)
    schema = StructType([f for f in rows.schema if f.name != "ids"])
    schema.add("ids_crc32", LongType())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            kept = [batch.column(f.name) for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], schema.names)

    done = rows.mapInArrow(digest, schema)
    return _placed(spark, done, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
