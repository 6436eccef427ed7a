"""Queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from aerostrata.llm import (
    byte_pieces,
    conversation_repair,
    length_histogram,
    licences,
    neighbours,
    packing,
    prefix_trie,
    pseudonyms,
    quality_rules,
    simhash,
    tiered_packing,
    token_files,
    winnowing,
)
from aerostrata.llm.oracles import ORACLES
from aerostrata.llm.staging import run_folder, stored

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def _documents(spark: SparkSession, data_dir: str) -> DataFrame:
    """Ids and texts, so that further columns of any name cannot clash with results."""
    return _table(spark, data_dir, "documents").select("doc_id", "text")


def op1_pseudonyms(spark: SparkSession, data_dir: str) -> DataFrame:
    """All documents with private values replaced, and how many there were in each."""
    replaced = pseudonyms.pseudonymized(
        _documents(spark, data_dir), key=corpus_pipeline.PSEUDONYM_KEY, counts_col="n_replaced"
    )
    return replaced.select("doc_id", "n_replaced", "text")


def op2_length_histogram(spark: SparkSession, data_dir: str) -> DataFrame:
    """For every length that occurs: documents and tokens below, above and if cut there."""
    lengths = length_histogram.histogram(
        _documents(spark, data_dir), public_tokenizers.path("byte_bpe_50k.json")
    )
    return length_histogram.suffix_sums(stored(lengths, run_folder(spark, "lengths")))


def op3_token_file(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents as read back from a Huffman-coded token file."""
    file = token_files.write(
        _documents(spark, data_dir),
        run_folder(spark, "token-file"),
        public_tokenizers.path("byte_bpe_50k.json"),
        end_id=2,
    )
    return token_files.read(spark, file).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op4_simhash(spark: SparkSession, data_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(
        _documents(spark, data_dir),
        run_folder(spark, "simhash"),
        shingle_words=corpus_pipeline.SHINGLE_WORDS,
        radius=corpus_pipeline.RADIUS,
    )
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_line_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    """All documents without later repeats of runs of 50 words and more."""
    left = winnowing.deduplicated(
        _documents(spark, data_dir),
        run_folder(spark, "lines"),
        lines_col="n_lines",
        deleted_col="n_deleted_lines",
    )
    return left.select("doc_id", "n_lines", "n_deleted_lines", "text")


def op6_licences(spark: SparkSession, data_dir: str) -> DataFrame:
    """Known licence sentences and recognised licences of every document."""
    found = licences.with_licences(_documents(spark, data_dir))
    return found.select(
        "doc_id",
        F.size("licence_sentences").cast("long").alias("n_sentences"),
        F.array_join("licence_sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


def op7_byte_pieces(spark: SparkSession, data_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes decoded from them."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_pieces.encode(
        _documents(spark, data_dir), ranks, public_tokenizers.PATTERN
    )
    return byte_pieces.decode(encoded, ranks).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_packing(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return corpus_pipeline.packed(spark, _documents(spark, data_dir))


def op9_neighbours(spark: SparkSession, data_dir: str) -> DataFrame:
    """The 20 nearest found for every vector whose id is divisible by 20."""
    return neighbours.search(
        _table(spark, data_dir, "embeddings"),
        F.col("vec_id") % 20 == 0,
        run_folder(spark, "neighbours"),
        k=20,
        dim=64,
    )


def op10_quality_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    """Measurements of every document and the verdicts of two policies, from a stored ledger."""
    ledger = quality_rules.stored_ledger(_documents(spark, data_dir), run_folder(spark, "ledger"))
    base, v1 = quality_rules.POLICIES["base"], quality_rules.POLICIES["v1"]
    return quality_rules.judged(ledger, base_kept=base, kept=v1).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.col("failed").alias("failed_rules"),
        (~F.col("base_kept")).alias("base_failed"),
        "kept",
    )


def op10_ablations(spark: SparkSession, data_dir: str) -> DataFrame:
    """For every rule of both policies: documents that fail it, that fail it alone, and kept without it."""
    ledger = quality_rules.stored_ledger(_documents(spark, data_dir), run_folder(spark, "ledger"))
    parts = [
        quality_rules.ablations(ledger, policy, "failed").select(F.lit(name).alias("policy"), "*")
        for name, policy in quality_rules.POLICIES.items()
    ]
    return parts[0].unionByName(parts[1])


def op11_conversation_repair(spark: SparkSession, data_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest repair and a digest of the result."""
    turns = _table(spark, data_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, rows = conversation_repair.repaired(
        conversation_repair.damaged(turns), run_folder(spark, "conversation-repair")
    )
    digests = conversation_repair.digests(rows)
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("c")
    same = lambda other: F.col("c.conv_id").eqNullSafe(F.col(f"{other}.conv_id"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        every.join(found.alias("f"), same("f"), "left")
        .join(digests.alias("d"), same("d"), "left")
        .select(
            "c.conv_id",
            *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op12_tiered_packing(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 512 to 4096 tokens."""
    _, placed, parted = tiered_packing.packed(
        _documents(spark, data_dir),
        run_folder(spark, "tiered-packing"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
    )
    return tiered_packing.checksums(placed, parted).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group"
    )


def op13_prefix_trie(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every node of the trie of conversations that begin like the first of their five ids."""
    folder = run_folder(spark, "prefix-trie")
    turns = prefix_trie.turns_in_order(_table(spark, data_dir, "conversations"), folder)
    ids = stored(turns.select("conv_id").distinct(), f"{folder}/ids")
    begun = stored(prefix_trie.rebuilt(turns), f"{folder}/rebuilt")
    return prefix_trie.trie(begun, ids, folder)


def queries() -> dict[str, Query]:
    return {
        "op1_pseudonyms": op1_pseudonyms,
        "op2_length_histogram": op2_length_histogram,
        "op3_token_file": op3_token_file,
        "op4_simhash": op4_simhash,
        "op5_line_dedup": op5_line_dedup,
        "op6_licences": op6_licences,
        "op7_byte_pieces": op7_byte_pieces,
        "op8_packing": op8_packing,
        "op9_neighbours": op9_neighbours,
        "op10_quality_rules": op10_quality_rules,
        "op10_ablations": op10_ablations,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_tiered_packing": op12_tiered_packing,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
