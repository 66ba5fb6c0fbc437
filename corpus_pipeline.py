"""The corpus pipeline: documents in, token digests of what is worth training on out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  Whoever runs the stages writes each result as Parquet and
reads it back as the next one's docs; run() does so in the shared folder.

For every stage: a null or empty text is scored as an empty one; a null key is never labelled and never dropped for that; repeated rows are
judged alike, each by itself; further columns, whatever their names, stay in all but the last stage; an empty table
gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from factloom.llm import cotrain, mixing, simhash, tokens, toxicity
from factloom.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier finds good; without labels of both classes all stay."""
    return cotrain.keep(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))


def civility(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not find toxic; one without words is not."""
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the least key; documents without words are one group, of repeated rows of a key one stays."""
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at their rates, none more than once; without labels all stay."""
    mixture = mixing.solve(docs, table(spark, sf_dir, "labels"), max_rate=1.0, ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return mixing.draw(docs, mixture)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document: doc_id, n_tokens, ids_sha256, decoded_sha256; an empty text has no tokens."""
    return tokens.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), digest=True)


STAGES = [("quality", quality), ("civility", civility), ("near_dedup", near_dedup), ("mix", mix), ("tokenise", tokenise)]

#: The classifiers cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
