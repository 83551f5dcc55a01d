"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.llm import chat, decontaminate, licenses, lm, mixing, phrases, quality, search, sharding, simhash, tokens, toxicity, url_filter
from lakelayer.llm.common import read


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", chat.SPOKEN), (-7, 1, "assistant", chat.SPOKEN)], "conv_id long, turn long, role string, text string")
    return chat.digests(rows.unionByName(more))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = licenses.scan(read(spark, sf_dir, "documents"))
    return docs.select("doc_id", "sentence_ids", "licences", "n_known", "n_unmatched")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    slim = docs.withColumn("text_crc32", F.crc32(F.col("text").cast("binary")))
    out = sharding.shard_records(slim)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), lm.training_rows())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), with_text=False)
    return docs.drop("lang", "source", *[c for c in docs.columns if c.startswith("fence_")])


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.col("item_ids").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated", "n_near")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_filter.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    return pages.drop("url")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    learn = toxicity.learnt_rows()
    out = toxicity.score(docs, read(spark, sf_dir, "labels"), learn)
    return out.select("doc_id", (~learn).alias("held_out"), "score", "predicted")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read(spark, sf_dir, "documents").select("lang", "text"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.read_files(tokens.write_files(docs, public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_license_scan, op3_sharding, op4_lm_score, op5_quality_rules, op6_simhash, op7_decontamination, op8_url_filter, op9_toxicity, op10_mixing, op11_phrases, op12_lexical_search, op13_token_output)}

ORACLES = {"op1_chat_format": chat.SQL, "op2_license_scan": licenses.SQL, "op8_url_filter": url_filter.SQL, "op10_mixing": mixing.SQL, "op11_phrases": phrases.SQL, "op12_lexical_search": search.SQL}
