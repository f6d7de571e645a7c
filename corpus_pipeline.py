"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

1. Language ID: documents in no known language go, and those without a letter.
2. Exact dedup: of equal texts, the row with the largest id stays.
3. SimHash near-dedup: of texts whose fingerprints are linked, the smallest id stays.
4. Mixing: documents repeat until the languages' tokens meet their target shares; none goes.
5. SentencePiece: every row is encoded, and decoded again for proof.

Each stage works on all rows that the one before kept, and all but the last return the columns
of ``documents``. Defined results for nulls, empty and long texts, ties, repeated rows, empty
tables and further columns are those of the operators. Where no row has a label, no language is
learned: stage 1 then rejects nothing, and stage 4 leaves every document at one copy.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from martlet.llm import exact_dedup, langid, mixing, sentencepiece, simhash
from martlet.llm.common import hold_few_texts, learnable, table
from martlet.llm.queries import MIXING_TARGETS, TOKENIZER
from martlet.session import remove_folder, shared_folder

#: The share that the learned languages together must have against the class of foreign texts.
LEAST_SCORE = 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network recognises."""
    hold_few_texts(spark)
    model = langid.train_language_model(docs, eligible=learnable("doc_id", 4, 2), rejects=True)
    return langid.keep_identified(docs, model, least=LEAST_SCORE)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, with the shingles and bits of the operator's query."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, scarce languages as often as their targets ask."""
    return mixing.mix(docs, docs, MIXING_TARGETS, least=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row."""
    return sentencepiece.tokenize(docs, sentencepiece.load_model(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("mixing to target weights", mix_languages),
    ("SentencePiece", encode),
]

#: The stages rest on trained models, which SQL cannot express; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a data folder.

    A stage's table is deleted when the next one is written; the last one stays, as the result
    reads it.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            remove_folder(spark, f"{folder}/{number - 1}")
    return docs
