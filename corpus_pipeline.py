"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ringlake.llm import minhash, mixing, packing, quality, repeats
from ringlake.sources.scratch import written

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near their language's histograms."""
    return quality.judge(docs).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its runs of five words; of rows with one id and text, the least."""
    key = {k: c.alias(k) for k, c in minhash.document_key().items()}
    kept = minhash.grouped(docs).where("kept").select("doc", "tie").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # Rows of a group differ in the other columns only; as JSON these have an order, maps too.
    order = F.to_json(F.struct(*[F.col(f"row.`{c}`") for c in others])) if others else F.lit("")
    return (
        docs.select(F.struct("*").alias("row"), *key.values())
        .join(kept, ["doc", "tie"], "left_semi")
        .groupBy("doc", "tie")
        .agg(F.min_by("row", order).alias("row"))
        .select("row.*")
    )


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occurred before; ``n_chars`` follows."""
    return _recounted(repeats.without_repeats(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source in part; ``n_chars`` follows."""
    return _recounted(mixing.mixed_documents(docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


def _recounted(docs: DataFrame) -> DataFrame:
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("best-fit packing", packed_sequences),
]

# Sketches, parsing and pricing have no SQL form; tests compare each operator with brute force, and the stages with the operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
