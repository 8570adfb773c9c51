"""The ``opN_*`` queries, each over its whole table, and their SQL."""

from __future__ import annotations

from . import importance, licenses, merkle, mixing, quality
from .bpe import encode_digests
from .importance import op12_importance
from .jaccard_join import jaccard_groups
from .merkle import op11_merkle_manifest
from .neighbours import nearest
from .personal_data import op13_personal_data
from .pitman_yor import scores
from .suffix_dedup import repeat_digests
from .tables import read
from .token_counts import token_counts
from .toxicity import toxicity


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_suffix_dedup(spark, sf_dir):
    return repeat_digests(read(spark, sf_dir, "documents"))


def op2_license_scan(spark, sf_dir):
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark, sf_dir):
    return jaccard_groups(read(spark, sf_dir, "documents")).drop("rid")


def op4_token_counts(spark, sf_dir):
    return token_counts(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op5_pitman_yor(spark, sf_dir):
    return scores(read(spark, sf_dir, "documents"))


def op6_byte_bpe(spark, sf_dir):
    import public_tokenizers
    return encode_digests(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_toxicity(spark, sf_dir):
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_quality_rules(spark, sf_dir):
    return quality.quality(read(spark, sf_dir, "documents"))


def op9_mix_sources(spark, sf_dir):
    return mixing.mix_plan(read(spark, sf_dir, "documents")).drop("rid", "reps")


def op10_nearest(spark, sf_dir):
    return nearest(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_license_scan, op3_jaccard_join, op4_token_counts, op5_pitman_yor, op6_byte_bpe,
                                      op7_toxicity, op8_quality_rules, op9_mix_sources, op10_nearest, op11_merkle_manifest, op12_importance, op13_personal_data)}
ORACLES = {"op8_quality_rules": quality.SQL, "op9_mix_sources": mixing.SQL, "op11_merkle_manifest": merkle.SQL,
           "op12_importance": importance.SQL}
