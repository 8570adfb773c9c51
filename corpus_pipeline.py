"""From raw documents to token ids: the stages of a training-data pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents; all but the last keep the columns
of ``documents``. ``STAGES`` names them in order and ``run`` applies them.

1. toxicity: documents the ordinal model finds toxic go.
2. near_copies: one document of each group of near copies stays.
3. repeats: bytes that 200-byte strings repeated elsewhere cover go; ``n_chars`` follows.
4. mix: rows are repeated or left out so that sources meet their target weights.
5. encode: each document's byte-level BPE ids, and the text they decode to.

Null texts stay null up to the last stage, which gives them no ids. Empty tables pass
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import encode
from tessera.llm.jaccard_join import drop_near_copies
from tessera.llm.mixing import mix
from tessera.llm.suffix_dedup import remove_repeats
from tessera.llm.tables import read, saved
from tessera.llm.toxicity import drop_toxic

RANKS = "byte_bpe_multi_50k.tiktoken"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity_stage), ("near_copies", near_copies_stage), ("repeats", repeats_stage),
          ("mix", mix_stage), ("encode", encode_stage)]

#: The learned, iterative and tokenizer stages have no SQL form; tests compare them
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
