"""Corpus pipeline: five stages over ``documents``, each written and read again.

1. language: documents in no learned language, or hardly like one, are dropped.
2. near copies: of documents linked by word shingles (Jaccard 0.8) one stays.
3. repeats: byte strings that occur in an earlier document are cut out.
4. mix: documents are repeated or left out so that the sources meet their weights.
5. tokens: texts become ids, which are decoded again as a check.

A stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept.  All but the last return the columns of ``documents``.  Nulls, empty and
long texts, repeated rows, empty tables and extra columns are treated as each
operator's module says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphcluster.llm import bpe_tree, language, mixing, ngram_join, suffix_dedup
from graphcluster.llm.common import Table, read

MIN_SCORE = 0.3   #: least share of a text's trigrams that its language must know
TOKENIZER = "byte_bpe_50k.tiktoken"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; filters learn from the labels of these documents."""
    columns = docs.columns
    model = language.learn(docs)
    told = language.identify(docs, model, lang="_lang", score="_score")
    return told.where((F.col("_lang") != language.UNKNOWN) & (F.col("_score") >= MIN_SCORE)).select(*columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur in an earlier document."""
    return suffix_dedup.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids (packed unsigned 32-bit) and whether they decode to the text."""
    path = public_tokenizers.path(TOKENIZER)
    both = bpe_tree.round_trip(docs.select("doc_id", "source", "lang", "text"), path, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return both.select("doc_id", "source", "lang", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       "ids", same.alias("round_trip"))


STAGES = [("language", languages), ("near_copies", near_copies), ("repeats", repeats),
          ("mix", mix), ("tokens", tokens)]

#: SQL can't express the learned language filters or the merges of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Table(stage(spark, docs, sf_dir), f"stage-{name}").df
    return docs
