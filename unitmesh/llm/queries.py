"""The registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from unitmesh.llm import sql
from unitmesh.llm.decontam import contamination
from unitmesh.llm.line_dedup import dedup_lines
from unitmesh.llm.merkle import manifest
from unitmesh.llm.negatives import hard_negatives
from unitmesh.llm.packing import pack
from unitmesh.llm.quality import score_quality
from unitmesh.llm.secrets import scan_secrets
from unitmesh.llm.sharding import shard_documents
from unitmesh.llm.simhash import near_duplicates
from unitmesh.llm.token_counts import count_tokens
from unitmesh.llm.topk import top_k
from unitmesh.llm.toxicity import score_toxicity
from unitmesh.llm.warc import pages_through_archives
from unitmesh.session import table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    if hasattr(sql, fn.__name__.upper()):
        ORACLES[fn.__name__] = getattr(sql, fn.__name__.upper())
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their near-duplicate components."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line deduplication over all documents: lines before, lines dropped, digest of the rest."""
    done = dedup_lines(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents; a document is a repository of the owner ``source``."""
    done = scan_secrets(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                       "spans", "n_owned", "n_copied")


@_query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive-unlabelled quality score of every document."""
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector, by exact integer products."""
    return top_k(_table(spark, sf_dir, "embeddings"))


@_query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside benchmark windows, and the items they come from."""
    done = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return done.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                       F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit packing of all documents into sequences of 2048 words, near duplicates apart."""
    return pack(_table(spark, sf_dir, "documents"), near=True)


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as legacy archives, converted to WARC archives and read back."""
    return pages_through_archives(_table(spark, sf_dir, "pages"))


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under the 32k piece model."""
    import public_tokenizers

    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards of even counts, equal texts together."""
    return shard_documents(_table(spark, sf_dir, "documents"))


@_query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents with proofs, checked against a copy in which every
    fifth text (by the id's CRC) has its capitals lower-cased."""
    text = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return manifest(_table(spark, sf_dir, "documents"), {"text": text}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


@_query
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector and its five best rows of the same label."""
    return hard_negatives(_table(spark, sf_dir, "embeddings"))
