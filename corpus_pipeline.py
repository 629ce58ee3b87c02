"""From raw documents to training tokens: five stages, each a written table.

Every stage takes all that the one before kept. All but the last return the columns
of ``documents``, further columns included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordervane.llm import byte_bpe, decontaminate, hyperminhash, language_id, line_dedup
from ordervane.llm.settings import SMALL_BATCHES, settings
from ordervane.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _others(docs: DataFrame) -> Column:
    """All columns but the text, as one that no name can clash with."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")


def _columns(docs: DataFrame, rows: DataFrame, new: dict[str, Column]) -> DataFrame:
    """The columns of ``docs``: the new ones, and the others as they were."""
    return rows.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter; fills in the language where there is none.

    The network learns from a bounded sample of the labelled documents.
    """
    net = language_id.train(docs)
    rows = docs.select(_others(docs), "text")
    kept = language_id.label_languages(rows, net, keep=["row", "text"]).filter(F.col("lang_pred") != language_id.UNKNOWN)
    lang = F.coalesce("row.lang", F.col("lang_pred").cast(docs.schema["lang"].dataType))
    return _columns(docs, kept, {"text": F.col("text"), "lang": lang})


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that an earlier line equals up to one edit.

    A document that loses lines and has none left but blank ones is dropped. Lines that are
    too short to be judged are not known to be copies, so a document of such lines stays.
    """
    rows = docs.select(_others(docs), "doc_id", "text")
    cut = line_dedup.remove_lines(spark, rows, scratch_folder(spark, "pipeline-lines"), keep=["row"])
    touched = F.size("removed") > 0
    left = F.col("kept").rlike(r"\S")
    n_chars = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return _columns(docs, cut.filter(~touched | left), {
        "text": F.when(F.col("n_lines") > 0, F.col("kept")),  # only a null text has no line
        "n_chars": F.when(touched, n_chars).otherwise(F.col("row.n_chars")),
    })


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every class of near copies.

    Rows without id stay. Of rows with one id and one text one stays; different texts with one
    id are documents of their own.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    row_key = F.struct("doc_id", F.xxhash64("text").alias("hash"))
    found = hyperminhash.near_duplicates(spark, named.select(row_key.alias("doc_id"), "text"), scratch_folder(spark, "pipeline-near"),
                                         words=5, percent=80)
    dropped = found.filter(~F.col("kept")).select(F.col("doc_id").alias("row_key")).distinct()
    kept = named.withColumn("row_key", row_key).join(dropped, "row_key", "left_anti").dropDuplicates(["doc_id", "text"])
    return kept.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share a passage with a benchmark item.

    Only the text decides, so rows are named by a digest of it: rows without id are
    examined like all others, and different texts with one id each by itself.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    digest = F.coalesce(F.md5("text"), F.lit(""))
    found = decontaminate.find_passages(spark, docs.select(digest.alias("doc_id"), "text"), items, scratch_folder(spark, "pipeline-seeds"))
    leaked = found.select(F.col("doc_id").alias("digest")).distinct()
    others = docs.select(_others(docs), "text", digest.alias("digest"))
    return _columns(docs, others.join(leaked, "digest", "left_anti"), {"text": F.col("text")})


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token numbers, with the digest of what they decode to.

    The numbers are stored before they are decoded, so that a task has one Python worker and not two: workers
    stay alive for later stages, and all of them would hold vocabularies in the executor's memory.
    """
    ids = byte_bpe.encode(docs)
    folder = scratch_folder(spark, "pipeline-ids")
    with settings(spark, SMALL_BATCHES):
        ids.write.option("compression", "zstd").parquet(folder)
    coded = byte_bpe.decode(spark.read.schema(ids.schema).parquet(folder))
    return coded.select("doc_id", byte_bpe.n_tokens("ids").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("byte_bpe", token_stage),
]

#: No SQL says what the network learns; ``tests/llm`` hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark, "pipeline")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
