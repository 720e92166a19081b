"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import byte_cnn, lm_score, quality_rules, sql
from wardline.llm.base import pick
from wardline.llm.byte_bpe import encode_decode
from wardline.llm.cross_align import align_documents
from wardline.llm.embed_dedup import link_embeddings
from wardline.llm.line_dedup import dedup_lines
from wardline.llm.minhash import Plan, near_duplicates
from wardline.llm.source_mix import mix_sources
from wardline.llm.suffix_dedup import remove_repeats
from wardline.llm.token_files import token_table
from wardline.llm.url_filter import judge_urls
from wardline.llm.whitening import whiten

QUERIES, ORACLES = {}, dict(sql.ORACLES)

#: (verdict, host, path)
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(table(spark, folder, "documents"), "doc_id", "text")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, folder, "labels")))


@query
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_table(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


#: Labels of ids with this remainder of crc32(id as text) mod 3 are held out.
HELD_OUT = 1


def id_remainder():
    return F.crc32(F.col("doc_id").cast("string")) % 3


@query
def op4_embed_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return link_embeddings(table(spark, folder, "embeddings"))


@query
def op5_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(table(spark, folder, "documents"), "doc_id", "text")
    net = byte_cnn.fit(docs, table(spark, folder, "labels"), id_remainder() != HELD_OUT)
    scored = byte_cnn.add_score(docs, net)
    return scored.select("doc_id", (id_remainder() == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All sources at equal weights."""
    mixed = mix_sources(pick(table(spark, folder, "documents"), "doc_id", "source"))
    return mixed.select("doc_id", "source", "block", "phase", "position", "place")


@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(table(spark, folder, "documents"), "doc_id", "text")
    return dedup_lines(docs, removed_col="n_removed").select("doc_id", "text", "n_removed")


@query
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    coded = encode_decode(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Shingles of four words."""
    return near_duplicates(table(spark, folder, "documents"), Plan(words=4))


@query
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = pick(table(spark, folder, "pages"), "page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op11_cross_align(spark: SparkSession, folder: str) -> DataFrame:
    found = align_documents(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"),
                            tokenizer_file("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


@query
def op12_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Learned from ids whose crc32 is not divisible by ten; a null id is held out."""
    docs = table(spark, folder, "documents")
    learned = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 != 0, F.lit(False))
    scored = lm_score.score(docs, *lm_score.fit(docs, learned))
    return scored.select("doc_id", (~learned).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))
