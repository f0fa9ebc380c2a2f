"""The operators as queries over the given tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ringlake.llm import (
    binary, chat, embeddings, langid, lexical, merkle, minhash, mixing, packing, quality, repeats, token_counts, urls,
)
from ringlake.llm.text import table
from ringlake.sources.scratch import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_robust_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_embeddings(table(spark, sf_dir, "embeddings"))


def op2_repeat_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A row for each of the given rows: alike ones get the same answer.
    rows = repeats.remove_repeats(docs).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# A conversation of two turns that say what other templates use as control strings.
EXTRA_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    turns = given.unionByName(extra.select(*[F.col(f.name).cast(f.dataType) for f in given.schema]))
    out = chat.format_chats(turns, chat.text_part(F.col("text")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (
        out.withColumns(
            {"turns": chat.read_back(F.col("formatted")), "loss": chat.under_loss(F.col("formatted"), F.col("loss_spans"))}
        )
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(said, 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op4_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages")).withColumn("score", F.round("score", 6))


def op5_count_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # The text is needed for the counts only, so it is left out before the joins.
    return quality.judge(docs).select(
        "row.doc_id", "base.*", F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"), "kept",
    )


def op7_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-ids")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    binary.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    digests = {
        "n_tokens": F.expr("octet_length(ids) div 4").cast("long"),
        "ids_crc32": F.crc32("ids"),
    }
    return binary.read_ids(spark, folder, digests).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_mix_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, keep=["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")


def op9_pack_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op10_minhash_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, size=4, percent=80)


def op11_subtree_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return merkle.audited(table(spark, sf_dir, "documents")).select(*columns)


def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.withColumns({"score": F.round("score", 9), "entropy": F.round("entropy", 6)})


def op13_lemp_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical.ranked(docs.select("doc_id", "text"), items)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (op1_robust_graph, op2_repeat_parse, op3_chat_parts, op4_url_ratio, op5_count_transducer, op6_quality_divergence, op7_rans_files, op8_mix_budgets, op9_pack_patterns, op10_minhash_odd, op11_subtree_exchange, op12_kneser_ney, op13_lemp_buckets)
}
