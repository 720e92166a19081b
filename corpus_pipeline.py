"""A training corpus from raw documents: filter, clean, thin, mix and encode.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame;
all but the last return the columns of ``documents``. Other columns are left out, also where their
names differ from those in case alone. Rows of one id are rows of their own in every stage, and
identical rows stay together or go together. Texts are used whole, however long. An empty table
passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.llm import byte_cnn
from wardline.llm.base import pick
from wardline.llm.byte_bpe import encode_decode
from wardline.llm.line_dedup import dedup_lines
from wardline.llm.minhash import near_duplicates
from wardline.llm.queries import HELD_OUT, id_remainder, tokenizer_file
from wardline.llm.source_mix import mix_sources
from wardline.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, fitted on labels that are not held out, takes for good.

    Null and empty texts are scored as a chunk without a letter; a tie at 0.5 is kept.
    """
    docs = pick(docs, *COLUMNS)
    net = byte_cnn.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), id_remainder() != HELD_OUT)
    return byte_cnn.add_score(docs, net, score_col="_score").where("_score >= 0.5").select(*COLUMNS)


def drop_seen_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of three lines seen before; a text all of whose lines go is gone.

    Null, empty and short texts stay as they are.
    """
    docs = pick(docs, *COLUMNS)
    cleaned = dedup_lines(docs, removed_col="_removed")
    changed = F.col("_removed") > 0
    length = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.where(~changed | (F.col("text") != "")).withColumn("n_chars", length).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate component.

    Null and empty texts and rows of null id are near to nothing and stay. Identical rows all stay
    if their id is the smallest.
    """
    docs = pick(docs, *COLUMNS)
    judged = near_duplicates(docs)
    dropped = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of a mix of equally weighted sources; ``encode`` numbers it.

    A null source is a source; texts are not looked at.
    """
    docs = pick(docs, *COLUMNS)
    return cut_lineage(mix_sources(docs)).orderBy("position", "place").select(*COLUMNS)


def in_file_order(docs: DataFrame) -> DataFrame:
    """Rows read from files that Spark wrote, with their ``position`` by part number and place in the file."""
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    piece = F.regexp_extract("_metadata.file_name", r"-c(\d+)\D", 1).cast("long")
    flat = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])  # names may differ in case alone
    placed = flat.select("*", part.alias("_part"), piece.alias("_piece"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_part", "_piece").agg((F.max("_row") + 1).alias("_rows"))
    # one small row per file
    before = F.sum("_rows").over(Window.orderBy("_part", "_piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col("_part").alias("_p"), F.col("_piece").alias("_c"), F.coalesce(before, F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), F.col("_part").eqNullSafe(F.col("_p")) & F.col("_piece").eqNullSafe(
        F.col("_c"))).select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)],
                             (F.col("_start") + F.col("_row")).alias("position"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, whether they decode to its bytes again, and its ``position`` in the mix.

    Positions count the rows of the files of ``docs``, which a sort wrote in the order of their
    part numbers, from 0 on: sorting by them gives the mixed order. Null and empty texts have no ids
    and count as lossless.
    """
    import public_tokenizers

    rows = pick(in_file_order(docs), *COLUMNS, "position").withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    coded = encode_decode(rows, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          extra=("lang", "source", "_sha", "position"))
    return coded.select("doc_id", "lang", "source", "position", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        (F.sha2("decoded", 256) == F.col("_sha")).alias("lossless"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_seen_lines),
    ("MinHash near-dedup", keep_one_of_each),
    ("mixing sources", mix),
    ("byte-level BPE", encode),
]

#: No SQL expresses a trained network; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
