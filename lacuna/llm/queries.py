"""The registered queries op1 to op13: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import chat, hilbert, html_text, mixing, negatives, packing, quality, simhash, substring, topk, trie, urls, warc
from lacuna.llm.common import table
from lacuna.llm.sql import ORACLES

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = urls.labelled_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return urls.judge_urls(pages)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=(3, 2), repeat=2)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), max_len=2048)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = html_text.train(html_text.labelled_sample(pages, table(spark, sf_dir, "documents")))
    return html_text.extract(pages, model)


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shard(table(spark, sf_dir, "documents"), shards=8)


#: the conversation that the contract adds: both turns hold control strings (fixed value)
PLANTED = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text"))
    return chat.digests(chat.render(chat.reconstruct(chat.row_events(rows.unionByName(extra)))))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0, segment_bytes=4096, chunk_bytes=1024)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(trie.turn_lists(table(spark, sf_dir, "conversations"))))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


QUERIES = {f.__name__: f for f in (op1_simhash, op2_url_filters, op3_mixing, op4_packing, op5_topk, op6_quality, op7_html,
                                   op8_substring, op9_sharding, op10_chat, op11_warc, op12_prefix_trie, op13_hard_negatives)}


def queries() -> dict:
    import corpus_pipeline
    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
