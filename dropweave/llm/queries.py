"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

import os
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropweave.llm import (chat_windows, edit_decontamination, hash_tree, jaccard_join, line_edit_join, one_bit_ann, passage_attention, sentencepiece_codec, source_divergence,
                           token_alignment, toxicity_gru, url_trees, warc)
from dropweave.llm._common import id_crc, table
from dropweave.llm._learning import judged, labelled_sample, scored
from dropweave.session import stage

TREE = hash_tree.Tree.regular(regions=5, racks=2, shards=4)
RULES = [url_trees.Rule.of(verdict, text) for verdict, text in (
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))]
NEIGHBOURS = 20


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    """A public vocabulary file; ``TOKENIZER_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if not folder:
        spec = find_spec("public_tokenizers")
        folder = str(Path(spec.origin).parent) if spec else "/opt/tokenizers"
    return f"{folder}/{name}"


def one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = one_bit_ann.prepare(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return one_bit_ann.search(vectors, vectors.filter("vec_id % 20 = 0"), NEIGHBOURS)


def passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts, labels = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", id_crc("doc_id") % 4 == 2,
                                    passage_attention.PER_CLASS, passage_attention.SAMPLE_BYTES)
    model = passage_attention.train(texts, labels)
    return judged(docs, scored(docs, model, passage_attention.score, "text", ["doc_id"]), 4, 2, 0.7)


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_codec.Pieces.load(vocabulary())
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), pieces, keep=["doc_id"])


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_edit_join.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), edits=None)


def jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard(table(spark, sf_dir, "documents"), TREE)


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.col("score"))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity_gru.Network | float:
    """Trained on labelled rows outside the held-out fifth."""
    texts, known = labelled_sample(docs, labels, "toxic", id_crc("doc_id") % 5 == 0, toxicity_gru.PER_CLASS, toxicity_gru.SAMPLE_BYTES)
    return toxicity_gru.train(texts, known)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return judged(docs, scored(docs, model, toxicity_gru.score, "text", ["doc_id"]), 5, 0, 0.5)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    found = chat_windows.windows(given.union(added), Path(vocabulary("byte_bpe_50k.json")).read_bytes())
    return chat_windows.digests(stage(found, "windows"))


def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = token_alignment.Tokenizers.load(vocabulary("byte_bpe_50k.json"), vocabulary())
    return token_alignment.align(table(spark, sf_dir, "documents"), both)


ALL = {
    "op1_one_bit_neighbours": one_bit_neighbours,
    "op2_passage_quality": passage_quality,
    "op3_warc": warc_records,
    "op4_sentencepiece": sentencepiece,
    "op5_line_edit_join": line_dedup,
    "op6_jaccard_join": jaccard_components,
    "op7_hash_tree": hash_shards,
    "op8_url_trees": url_verdicts,
    "op9_toxicity_gru": toxicity,
    "op10_edit_decontamination": decontamination,
    "op11_chat_windows": chat,
    "op12_source_divergence": divergence,
    "op13_token_alignment": alignment,
}
