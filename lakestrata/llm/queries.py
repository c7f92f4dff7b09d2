"""One query per operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import run_folder
from .alignment import count_links, linked_blocks
from .chat import format_conversations, read_back
from .common import fold, stored, with_package
from .decontaminate import benchmark_leaks
from .divergence import source_divergence
from .langid import identify_language, train_language_id
from .lm_score import score_documents, train_language_model
from .mixing import mix_sources, taken_words
from .packing import cut_pieces, place_pieces
from .repeats import remove_repeats
from .simhash import simhash_components
from .token_store import read_documents, write_token_store
from .topk import top_k
from .toxicity import is_toxic, score_toxicity, train_toxicity

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    LLM_QUERIES[build.__name__] = with_package(build)
    return build


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of a toxic label for every document; one fold of five is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = train_toxicity(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        is_toxic().cast("int").alias("predicted"),
    )


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, 4 bits."""
    return simhash_components(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, and the item."""
    leaks = benchmark_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return leaks.select("doc_id", "item_id", "n_windows", "coverage", "exact")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes of each, by weights 1, 2, 3 in turn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return taken_words(mix_sources(docs))


@query
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, written as directly addressable codes, read back."""
    path = run_folder(spark, "token-store")
    write_token_store(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_documents(spark, path)


@query
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without repeated strings of 200 bytes."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by models that learn from six folds of seven."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    model = train_language_model(docs.filter(~held_out))
    return score_documents(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; one fold of four is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = train_language_id(docs.filter(~held_out))
    return identify_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that is made of control strings, formatted,
    stored and read back."""
    said = "\\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema
    )
    # The built-in template writes a turn without a look at others.
    formatted = format_conversations(turns.unionByName(planted), history=0)
    return read_back(stored(formatted, "chat"))


@query
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows by inner product for every hundredth embedding."""
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, F.col("vec_id") % 100 == 0)


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 ids."""
    pieces = cut_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place_pieces(stored(digests, "pieces")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all sources of a language from each other, and the ten terms
    that set each apart from its language."""
    return source_divergence(table(spark, sf_dir, "documents"))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two public tokenizers aligned over every document."""
    blocks = linked_blocks(
        table(spark, sf_dir, "documents"),
        tokenizer_path(),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    blocks = blocks.withColumn("groups_sha256", sha).drop("groups")
    return count_links(stored(blocks, "linked")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
        "n_overlaps", "n_shared",
    )
